"""DuckDB statements of every registered query, for the correctness check."""
