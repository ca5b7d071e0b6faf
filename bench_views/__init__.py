"""Profile-shaped views of the benchmark tables, as DataFrames and as SQL (test support, not part of the package)."""
