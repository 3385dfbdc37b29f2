"""touchpath: channel attribution and traffic reports over web and app logs, on Spark."""
