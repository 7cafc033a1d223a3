"""File and catalog sources.

All readers take an explicit schema where the format allows one: schema
inference costs a full extra pass over the input, which at 100 TB is a job
of its own. Inference stays available as an opt-in (S3 in the reference).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Tables the driver generates; one Parquet file (or directory) each.
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table_path(base_dir: str, name: str) -> str:
    return f"{base_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """One table of the test set. Column pruning and filter pushdown are
    left to Catalyst: callers select what they need and the scan's
    ``ReadSchema`` / ``PushedFilters`` follow."""
    return spark.read.parquet(table_path(base_dir, name))


def sql_on_files(spark: SparkSession, pattern: str, fmt: str = "parquet",
                 select: str = "*", where: str | None = None) -> DataFrame:
    """SQL straight over files, glob allowed (``parquet.`dir/*.parquet```).

    The reference writes ``FROM 's3://…/*.parquet'`` (D16); Spark's spelling
    is the backquoted ``format.`path``` form.
    """
    q = f"SELECT {select} FROM {fmt}.`{pattern}`"
    if where:
        q += f" WHERE {where}"
    return spark.sql(q)


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             header: bool = True, infer_schema: bool = False,
             keep_whitespace: bool = True) -> DataFrame:
    """S3: CSV with header. Explicit schema by default (no inference pass)."""
    r = spark.read.option("header", header)
    if keep_whitespace:
        r = (r.option("ignoreLeadingWhiteSpace", False)
              .option("ignoreTrailingWhiteSpace", False))
    if schema is not None:
        r = r.schema(schema)
    elif infer_schema:
        r = r.option("inferSchema", True)
    return r.csv(path)


def read_json(spark: SparkSession, path: str, schema: StructType | str,
              corrupt_column: str | None = None) -> DataFrame:
    """Newline-delimited JSON with a fixed schema.

    With ``corrupt_column`` set, unparseable lines are kept in that column
    (PERMISSIVE mode) instead of being silently nulled.
    """
    r = spark.read.schema(schema)
    if corrupt_column:
        r = (r.option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", corrupt_column))
    return r.json(path)


def read_text(spark: SparkSession, path: str, whole_text: bool = False) -> DataFrame:
    """Text lines (``value`` column), or one row per file."""
    return spark.read.text(path, wholetext=whole_text)


def read_orc(spark: SparkSession, path: str) -> DataFrame:
    """S12."""
    return spark.read.orc(path)


def read_jdbc(spark: SparkSession, url: str, table: str, *, partition_column: str,
              lower_bound: int, upper_bound: int, num_partitions: int,
              properties: dict[str, str] | None = None) -> DataFrame:
    """Partitioned JDBC read; one range query per partition so the
    database is read in parallel instead of through one connection.
    No database is available here, so this is not exercised in tests."""
    return spark.read.jdbc(
        url, table, column=partition_column, lowerBound=lower_bound,
        upperBound=upper_bound, numPartitions=num_partitions,
        properties=properties or {},
    )


def read_partitioned(spark: SparkSession, path: str,
                     basePath: str | None = None) -> DataFrame:
    """Hive-style ``key=value`` directories; partition columns are
    discovered and filters on them prune directories before any file opens."""
    r = spark.read
    if basePath:
        r = r.option("basePath", basePath)
    return r.parquet(path)
