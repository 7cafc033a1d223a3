"""Streams into Parquet tables.

``foreachBatch`` writes each micro-batch with Spark's own Parquet writer into a
folder named by the stream and its batch id, ``stream=S/batch=N``, in overwrite
mode: a batch replayed after a failure (written but not yet marked done in the
checkpoint) replaces its own folder, so every event is in the table exactly
once. The stream id is derived from the checkpoint location, which is what
stays the same across restarts. Invalid events always go to a quarantine
table, with the same batch folders: every event ends in exactly one of the two.
"""

from __future__ import annotations

import hashlib

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidepool.operators.clean import dedup
from tidepool.streaming.events import is_valid_order, parse_orders
from tidepool.tables import keyed


def stream_id(checkpoint: str) -> str:
    return "s" + hashlib.sha1(checkpoint.rstrip("/").encode()).hexdigest()[:16]


def rejected_path(table_path: str, quarantine_path: str | None = None) -> str:
    """Where a table's invalid events go."""
    return quarantine_path or f"{table_path.rstrip('/')}_rejected"


def read_ingested(spark: SparkSession, path: str) -> DataFrame:
    """The streamed table (or its quarantine) as a batch table."""
    return spark.read.parquet(path).drop("stream", "batch")


def _write_batch(df: DataFrame, path: str, sid: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/stream={sid}/batch={batch_id}")


def _valid() -> Column:
    return F.coalesce(is_valid_order(), F.lit(False))


def _trigger(writer, processing_time: str | None, available_now: bool):
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=processing_time or "5 seconds")


def run_ingest(spark: SparkSession, events: DataFrame, table_path: str, checkpoint: str, *,
               quarantine_path: str | None = None, processing_time: str | None = "5 seconds",
               available_now: bool = False, query_name: str | None = None) -> StreamingQuery:
    """Parse events and append each micro-batch as one folder; invalid
    records go to the quarantine (``<table>_rejected`` unless named)."""
    parsed = parse_orders(events)
    sid, rejected = stream_id(checkpoint), rejected_path(table_path, quarantine_path)

    def sink(batch: DataFrame, batch_id: int) -> None:
        # Used twice (valid/invalid); persisted with disk fallback. If an
        # executor is lost the blocks are recomputed from the source files.
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            _write_batch(batch.filter(_valid()).drop("_raw"), table_path, sid, batch_id)
            _write_batch(batch.filter(~_valid()), rejected, sid, batch_id)
        finally:
            batch.unpersist()

    w = parsed.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    return _trigger(w, processing_time, available_now).start()


def run_upsert(spark: SparkSession, events: DataFrame, table_path: str, checkpoint: str,
               keys: list[str], order_by: list[str], *, buckets: int = 64, quarantine_path: str | None = None,
               processing_time: str | None = "5 seconds", available_now: bool = False) -> StreamingQuery:
    """Incremental MERGE instead of overwrite. Each micro-batch is
    reduced to its latest row per key, then merged into a table of key buckets
    (:mod:`tidepool.tables.keyed`), of which it rewrites only those it has a key
    of; a row is replaced only by one that is not older by ``order_by[0]``, whichever
    batch it comes in. Micro-batch N is change N + 1: replayed, it starts from the
    same state and replaces its own change. Invalid records go to the quarantine.
    One stream owns the table."""
    parsed = parse_orders(events)
    sid, rejected = stream_id(checkpoint), rejected_path(table_path, quarantine_path)

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            good = batch.filter(_valid()).drop("_raw", "_ingested_at")
            _write_batch(batch.filter(~_valid()), rejected, sid, batch_id)
            table = (keyed.open_table(spark, table_path) if keyed.exists(spark, table_path)
                     else keyed.create(spark, table_path, good.schema, keys, buckets))
            table.merge(dedup(good, keys, order_by, keep="last"), order_by=order_by[0], batch=batch_id + 1)
        finally:
            batch.unpersist()

    w = parsed.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return _trigger(w, processing_time, available_now).start()


def await_or_stop(q: StreamingQuery, timeout_s: float | None = None) -> None:
    """Block until the query ends (``availableNow``) or the timeout,
    then stop it cleanly; Ctrl+C also stops it."""
    try:
        q.awaitTermination(timeout_s) if timeout_s else q.awaitTermination()
    except KeyboardInterrupt:
        pass
    finally:
        if q.isActive:
            q.stop()
