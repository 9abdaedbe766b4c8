"""Named queries over the driver tables (builders plus DuckDB oracle SQL)."""
