"""Session-document and run-table sources."""
