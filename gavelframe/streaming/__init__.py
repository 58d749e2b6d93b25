"""The incremental runs for folders and tables that keep growing."""
