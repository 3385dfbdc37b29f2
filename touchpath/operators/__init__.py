"""Operators shared by the reports."""
