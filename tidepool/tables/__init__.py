"""Versioned tables on plain Parquet."""
