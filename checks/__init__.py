"""The driver's tables as inputs of the package, and DuckDB queries for the same results."""
