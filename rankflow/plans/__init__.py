"""End-to-end jobs and the driver-table query catalogue (queries + DuckDB oracle SQL)."""
