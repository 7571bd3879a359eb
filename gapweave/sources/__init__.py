"""File layouts, readers and writers."""
