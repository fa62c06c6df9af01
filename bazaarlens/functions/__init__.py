"""Column expressions: numeric parsing, rounding and delivery dates."""
