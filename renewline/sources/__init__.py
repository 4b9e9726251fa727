"""Table schemas, readers, writers and the CSV import."""
