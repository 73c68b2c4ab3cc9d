"""DuckDB oracle SQL for every registered query (correctness gate)."""
