"""Catalog and SQL DDL.

Thin on purpose: these are Spark SQL statements; the functions only put the
statement text in one place and keep identifiers quoted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def _q(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """``CREATE DATABASE IF NOT EXISTS``."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_q(name)}{loc}")


def drop_table(spark: SparkSession, name: str) -> None:
    """K15."""
    spark.sql(f"DROP TABLE IF EXISTS {_q(name)}")


def create_table(spark: SparkSession, name: str, ddl: str, *, fmt: str = "parquet",
                 partitioned_by: Sequence[str] = (), location: str | None = None) -> None:
    """``CREATE TABLE t (cols) USING parquet [PARTITIONED BY] [LOCATION]``."""
    parts = f" PARTITIONED BY ({', '.join(_q(c) for c in partitioned_by)})" if partitioned_by else ""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_q(name)} ({ddl}) USING {fmt}{parts}{loc}")


def register_location(spark: SparkSession, name: str, location: str, fmt: str = "parquet",
                      partitioned: bool = False) -> DataFrame:
    """Adopt files already on storage as a named table (schema read
    from the files); partitions are discovered with ``REPAIR TABLE``."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_q(name)} USING {fmt} LOCATION '{location}'")
    if partitioned:
        spark.sql(f"REPAIR TABLE {_q(name)}")
    return spark.table(name)


def insert_rows(spark: SparkSession, name: str, rows: Sequence[tuple]) -> None:
    """K4: ``INSERT INTO … VALUES``; the values are bound as parameters, typed
    by the table's own columns."""
    kinds = [t for _, t in spark.table(name).dtypes]
    values = ", ".join("(" + ", ".join(f"CAST(:r{i}c{j} AS {t})" for j, t in enumerate(kinds)) + ")"
                       for i in range(len(rows)))
    args = {f"r{i}c{j}": v for i, row in enumerate(rows) for j, v in enumerate(row)}
    spark.sql(f"INSERT INTO {_q(name)} VALUES {values}", args=args)


def append(df: DataFrame, name: str) -> None:
    """K6: ``df.writeTo(name).append()`` on V2 catalogs (Iceberg-style);
    session-catalog Parquet tables are V1, where the same append is
    ``insertInto`` with the columns first put in the table's order."""
    from pyspark.errors import AnalysisException
    try:
        df.writeTo(name).append()
    except AnalysisException as e:
        if "v1 table" not in str(e).lower():
            raise
        cols = df.sparkSession.table(name).columns
        df.select(*cols).write.insertInto(name)


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """K17 ``SHOW TABLES``."""
    return spark.sql(f"SHOW TABLES IN {_q(database)}" if database else "SHOW TABLES")


def create_view(spark: SparkSession, name: str, query: str, temporary: bool = True) -> DataFrame:
    """A (temporary) view over a query, e.g. a filter, queried later."""
    kind = "TEMPORARY VIEW" if temporary else "VIEW"
    spark.sql(f"CREATE OR REPLACE {kind} {_q(name)} AS {query}")
    return spark.table(name)
