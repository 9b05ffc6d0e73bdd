"""Column expressions and small column-level transformations."""
