"""Import of CSV files as they arrive. The reports themselves need later rows
of a timeline (the next contract), so they run on tables, not on streams."""
