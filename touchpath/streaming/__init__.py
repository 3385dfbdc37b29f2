"""The incremental jobs on arriving files."""
