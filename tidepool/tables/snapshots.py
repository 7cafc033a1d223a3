"""Tables kept as whole snapshots (T1-T14, M7), with Spark's own writers.

Every change writes the next version as a Parquet folder,
``version=N/operation=OP``; Spark's ``_SUCCESS`` file marks it complete, so a
failed write is never read and its folder is written anew. There is no log, no
manifest and no file list: versions are found by listing folders, rows by
``spark.read.parquet``. Made for tables that rare jobs change as a whole (a
nightly merge). A feed that only grows belongs in partitioned Parquet
(:mod:`tidepool.streaming.ingest`); on a lake with a table format, use its
``MERGE``. One writer at a time: two writers of one version collide on the
folder, and the second one fails.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidepool.tables import rows
from tidepool.tables.rows import DuplicateSourceKeys, SchemaMismatch  # noqa: F401  (part of this API)


class TableError(ValueError):
    """The table does not exist, or exists already."""


class VersionNotFound(TableError):
    """No such version of the table."""


def _listing(spark: SparkSession, path: str) -> list[tuple[int, str, float, str]]:
    """(version, operation, time, folder) of every complete version, ascending."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    pattern = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/version=*/operation=*/_SUCCESS")
    found = []
    for s in pattern.getFileSystem(conf).globStatus(pattern) or []:
        folder = s.getPath().getParent()
        found.append((int(folder.getParent().getName().split("=")[1]), folder.getName().split("=")[1],
                      s.getModificationTime() / 1000, folder.toString()))
    return sorted(found)


def is_table(spark: SparkSession, path: str) -> bool:
    return bool(_listing(spark, path))


def latest_version(spark: SparkSession, path: str) -> int:
    found = _listing(spark, path)
    if not found:
        raise TableError(f"no table at {path}")
    return found[-1][0]


def read(spark: SparkSession, path: str, version: int | None = None,
         as_of: dt.datetime | str | None = None) -> DataFrame:
    """The newest version, a numbered one, or the newest one written
    up to a time."""
    found = _listing(spark, path)
    if not found:
        raise TableError(f"no table at {path}")
    if as_of is not None:
        at = dt.datetime.fromisoformat(as_of) if isinstance(as_of, str) else as_of
        at = at if at.tzinfo else at.replace(tzinfo=dt.timezone.utc)
        found = [v for v in found if v[2] <= at.timestamp()]
    elif version is not None:
        found = [v for v in found if v[0] == version]
    if not found:
        raise VersionNotFound(f"{path} has no version {as_of if version is None else version}")
    return spark.read.parquet(found[-1][3])


def _commit(df: DataFrame, path: str, version: int, operation: str) -> int:
    # a folder without _SUCCESS is what a failed writer left: it is overwritten
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/version={version}/operation={operation}")
    return version


def create(spark: SparkSession, path: str, schema: str | StructType) -> int:
    """An empty table."""
    if is_table(spark, path):
        raise TableError(f"{path} exists")
    return _commit(spark.createDataFrame([], schema), path, 0, "CREATE")


def write(df: DataFrame, path: str, mode: str = "overwrite", merge_schema: bool = False) -> int:
    """A whole new version, or the current one plus ``df``,
    whose columns must be the table's (``merge_schema``: new ones are added, and
    missing ones are null)."""
    spark = df.sparkSession
    found = _listing(spark, path)
    version = found[-1][0] + 1 if found else 0
    if mode == "overwrite" or not found:
        return _commit(df, path, version, "WRITE")
    if mode != "append":
        raise ValueError(f"unknown mode {mode!r}")
    table = read(spark, path)
    rows.check_schema(table.schema, df.schema, allow_new_columns=merge_schema, allow_missing=merge_schema)
    return _commit(table.unionByName(df, allowMissingColumns=merge_schema), path, version, "APPEND")


def update(spark: SparkSession, path: str, condition: Column | str, assignments: Mapping[str, Column | str]) -> int:
    """T3."""
    return _commit(rows.updated(read(spark, path), condition, assignments), path,
                   latest_version(spark, path) + 1, "UPDATE")


def delete(spark: SparkSession, path: str, condition: Column | str) -> int:
    """T4."""
    return _commit(rows.deleted(read(spark, path), condition), path, latest_version(spark, path) + 1, "DELETE")


def merge(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], order_by: str | None = None,
          version: int | None = None) -> int:
    """Upsert by key; with ``order_by`` a matched row is replaced only
    by one that is not older. ``version`` names the version to write: a replay
    of it starts from the version before and overwrites it."""
    from tidepool.session import cut_lineage
    source = cut_lineage(source)  # read several times: it must not change meanwhile
    rows.check_unique(source, keys)
    before = [v for v in _listing(spark, path) if version is None or v[0] < version]
    if not before:
        raise TableError(f"no table at {path}")
    table = spark.read.parquet(before[-1][3])
    return _commit(rows.merged(table, source, keys, order_by=order_by), path,
                   before[-1][0] + 1 if version is None else version, "MERGE")


def add_columns(spark: SparkSession, path: str, columns: Mapping[str, str]) -> int:
    """New columns, null in every row."""
    table = read(spark, path)
    clash = [c for c in columns if c in table.columns]
    if clash:
        raise SchemaMismatch(f"columns exist already: {clash}")
    out = table.select("*", *[F.lit(None).cast(t).alias(c) for c, t in columns.items()])
    return _commit(out, path, latest_version(spark, path) + 1, "ADD COLUMNS")


def history(spark: SparkSession, path: str) -> DataFrame:
    """Version, operation, time and rows of every version. Rows are counted
    from the Parquet footers of all versions in one scan, whatever their number."""
    found = _listing(spark, path)
    if not found:
        raise TableError(f"no table at {path}")
    log = spark.createDataFrame([(v, op, dt.datetime.fromtimestamp(t, dt.timezone.utc)) for v, op, t, _ in found],
                                "version bigint, operation string, timestamp timestamp")
    # the folder names are partition columns; no column of the data is read
    rows_of = (spark.read.option("basePath", path).parquet(*[folder for *_, folder in found])
               .groupBy(F.col("version").cast("bigint").alias("version")).agg(F.count(F.lit(1)).alias("num_rows")))
    return (log.join(rows_of, "version", "left")
            .select("version", "operation", "timestamp", F.coalesce("num_rows", F.lit(0)).alias("num_rows")))


def expire(spark: SparkSession, path: str, keep_last: int) -> list[int]:
    """Delete all but the newest ``keep_last`` versions; readers of an
    older one must have ended."""
    if keep_last < 1:
        raise ValueError("the current version cannot expire")
    gone = _listing(spark, path)[:-keep_last]
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for _, _, _, folder in gone:
        at = jvm.org.apache.hadoop.fs.Path(folder).getParent()
        at.getFileSystem(conf).delete(at, True)
    return [v for v, *_ in gone]
