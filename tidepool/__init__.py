"""tidepool: a small PySpark library for layered (bronze/silver/gold) data,
versioned Parquet tables, streaming ingest and ad-hoc queries.

Everything is DataFrame / SQL / Structured Streaming code that Catalyst
plans; no Python UDF sits on a hot path.
"""

__version__ = "0.1.0"
