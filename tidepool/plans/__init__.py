"""The query suite (with DuckDB twins) and plan inspection helpers."""
