"""Column expressions, case-name parsing and statistics."""
