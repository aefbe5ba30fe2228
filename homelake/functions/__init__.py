"""Column functions: each takes Columns (or column names) and returns Columns."""
