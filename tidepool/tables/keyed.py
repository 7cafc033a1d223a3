"""Tables laid out in key buckets: MERGE, UPDATE, DELETE and append write only
the buckets they touch (T2-T4, T6, X12).

A row lives in bucket ``hash(keys) mod buckets``. A change with number N reads
the buckets it touches, writes their new rows to
``rows/bucket=B/batch=N/attempt=U`` and then, as one small table,
``commits/batch=N``: for every touched bucket the folders that hold its rows from
now on. All other buckets keep theirs, so a change of ten keys rewrites at most
ten buckets. Everything is written by Spark's own Parquet writer; a change is
visible when its commit table is, and a failed attempt is never referred to.

Change N always starts from the state before N: a replayed micro-batch (same
number) gives the same rows, and its commit replaces the one before. Older
numbers stay readable. One writer at a time. The number of buckets bounds the
folders a read opens and what the driver holds; take about one per 0.5-1 GB of
rows, so that rewriting a touched bucket stays one short task.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidepool.session import cut_lineage
from tidepool.tables import rows

COMMIT = "bucket int, folders array<string>, num_rows long, operation string"


class KeyedTable:
    """A table at ``path``; :func:`create` lays it out, :func:`open_table` finds it."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int, schema: StructType):
        self.spark, self.path, self.keys, self.buckets, self.schema = spark, path.rstrip("/"), list(keys), buckets, schema

    # --- state -----------------------------------------------------------------

    def commits(self) -> DataFrame:
        """bucket, folders, num_rows, operation, batch of every change."""
        return self.spark.read.schema(f"{COMMIT}, batch long").parquet(f"{self.path}/commits")

    def _live(self, batch: int | None, only: Iterable[int] | None = None) -> DataFrame:
        c = self.commits()
        if batch is not None:
            c = c.where(F.col("batch") <= batch)
        if only is not None:
            c = c.where(F.col("bucket").isin(list(only)))
        return c.groupBy("bucket").agg(F.max_by(F.struct("folders", "num_rows"), "batch").alias("s")).select("bucket", "s.*")

    def last_batch(self) -> int:
        return self.commits().agg(F.max("batch")).first()[0]

    def read(self, batch: int | None = None, only: Iterable[int] | None = None) -> DataFrame:
        """The rows now, or as they were after change ``batch``; ``only`` names
        buckets. The live folders are listed by name (at most a few a bucket), so
        the scan opens nothing else."""
        folders = [f for r in self._live(batch, only).collect() for f in r.folders]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/rows/{f}" for f in sorted(folders)])

    def history(self) -> DataFrame:
        """Batch, operation, buckets written and rows in them, of every change."""
        return (self.commits().where("bucket >= 0").groupBy("batch", "operation")
                .agg(F.count(F.lit(1)).alias("buckets"), F.sum("num_rows").alias("num_rows")))

    # --- changes -----------------------------------------------------------------

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _touched(self, df: DataFrame) -> list[int]:
        return sorted(r[0] for r in df.select(self.bucket().alias("b")).distinct().collect())  # at most `buckets`

    def _write(self, out: DataFrame, batch: int, touched: list[int], operation: str, keep: Mapping[int, list[str]]) -> None:
        attempt = uuid.uuid4().hex[:12]
        tagged = out.select(*self.schema.names, self.bucket().alias("bucket"), F.lit(batch).alias("batch"),
                            F.lit(attempt).alias("attempt"))
        # rebalance: AQE splits a bucket that holds most of the rows over several writers
        (tagged.hint("rebalance", "bucket").write.mode("append").partitionBy("bucket", "batch", "attempt")
         .parquet(f"{self.path}/rows"))
        # what this attempt wrote; a bucket left without rows has no folder
        written = (self.spark.read.schema(f"{self.schema.fields[0].name} {self.schema.fields[0].dataType.simpleString()}, "
                                          "bucket int, batch long, attempt string")
                   .option("basePath", f"{self.path}/rows").parquet(f"{self.path}/rows/bucket=*/batch={batch}/attempt=*")
                   if self._any(batch) else None)
        counts = {} if written is None else {
            r.bucket: r["count"] for r in written.where(F.col("attempt") == attempt).groupBy("bucket").count().collect()}
        state = []
        for b in touched:
            folders = list(keep.get(b, ()))
            if b in counts:
                folders.append(f"bucket={b}/batch={batch}/attempt={attempt}")
            state.append((b, folders, counts.get(b, 0), operation))
        (self.spark.createDataFrame(state, COMMIT).coalesce(1).write.mode("overwrite")
         .parquet(f"{self.path}/commits/batch={batch}"))

    def _any(self, batch: int) -> bool:
        from pyspark.errors import AnalysisException
        try:
            self.spark.read.option("basePath", f"{self.path}/rows").parquet(f"{self.path}/rows/bucket=*/batch={batch}/attempt=*")
        except AnalysisException as e:
            if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return False
            raise
        return True

    def _next(self, batch: int | None) -> int:
        return self.last_batch() + 1 if batch is None else batch

    def merge(self, source: DataFrame, order_by: str | None = None, batch: int | None = None) -> list[int]:
        """Upsert by key. With ``order_by`` a matched row is replaced only
        by one that is not older. Returns the buckets written."""
        rows.check_schema(self.schema, source.schema)
        source = cut_lineage(source.select(*self.schema.names))  # read several times
        rows.check_unique(source, self.keys)
        n, touched = self._next(batch), self._touched(source)
        before = self.read(n - 1, touched)
        self._write(rows.merged(before, source, self.keys, order_by=order_by), n, touched, "MERGE", {})
        return touched

    def update(self, condition: Column | str, assignments: Mapping[str, Column | str], batch: int | None = None) -> list[int]:
        """Only buckets with a matching row are rewritten. Keys cannot change."""
        if set(assignments) & set(self.keys):
            raise rows.SchemaMismatch("an update cannot change the keys of a keyed table")
        n = self._next(batch)
        touched = self._touched(self.read(n - 1).where(condition))
        self._write(rows.updated(self.read(n - 1, touched), condition, assignments), n, touched, "UPDATE", {})
        return touched

    def delete(self, condition: Column | str, batch: int | None = None) -> list[int]:
        """T4: only buckets with a matching row are rewritten."""
        n = self._next(batch)
        touched = self._touched(self.read(n - 1).where(condition))
        self._write(rows.deleted(self.read(n - 1, touched), condition), n, touched, "DELETE", {})
        return touched

    def append(self, df: DataFrame, batch: int | None = None) -> list[int]:
        """New files only; the buckets keep the ones they have. Keys are
        not checked: a key may be repeated then."""
        rows.check_schema(self.schema, df.schema)
        df = cut_lineage(df.select(*self.schema.names))
        n, touched = self._next(batch), self._touched(df)
        keep = {r.bucket: r.folders for r in self._live(n - 1, touched).collect()}
        self._write(df, n, touched, "APPEND", keep)
        return touched


def create(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], buckets: int = 64) -> KeyedTable:
    """An empty table (change 0) with its layout."""
    t = KeyedTable(spark, path, keys, buckets, schema)
    layout = json.dumps({"keys": list(keys), "buckets": buckets, "schema": json.loads(schema.json())})
    spark.createDataFrame([(layout,)], "layout string").coalesce(1).write.mode("errorifexists").parquet(f"{t.path}/layout")
    # a bucket that no row has: it makes the commit table exist
    (spark.createDataFrame([(-1, [], 0, "CREATE")], COMMIT).coalesce(1).write.mode("overwrite")
     .parquet(f"{t.path}/commits/batch=0"))
    return t


def open_table(spark: SparkSession, path: str) -> KeyedTable:
    """The table at ``path``."""
    layout = json.loads(spark.read.parquet(f"{path.rstrip('/')}/layout").first()[0])
    return KeyedTable(spark, path, layout["keys"], layout["buckets"], StructType.fromJson(layout["schema"]))


def exists(spark: SparkSession, path: str) -> bool:
    from pyspark.errors import AnalysisException
    try:
        open_table(spark, path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True
