"""Registered queries, the logs they run on, and the SQL they are compared with."""
