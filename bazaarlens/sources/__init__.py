"""Where data comes from and goes to: raw CSV, parquet, tables, scratch space."""
