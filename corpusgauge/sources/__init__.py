"""Table readers and writers."""
