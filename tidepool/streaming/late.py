"""Out-of-order events (X7): rows behind the watermark go to a table of their own.

Spark's stateful operators drop a row that comes behind the watermark. Here each
micro-batch is split before that: the watermark of batch N is the largest event
time of all earlier batches less ``delay``; rows behind it (and rows without a
time) are written to the late table, the others to the on-time table, and the
largest time so far to a table of marks. All three are folders per batch, written
in overwrite mode: a replayed batch reads the marks before it, so it is split the
same way and replaces its own folders. On time + late = input.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def split_late(batch: DataFrame, ts_col: str, newest, delay: str) -> DataFrame:
    """``batch`` with ``is_late``, given the largest event time before it (None
    for the first batch)."""
    if newest is None:
        return batch.withColumn("is_late", F.col(ts_col).isNull())
    behind = F.col(ts_col) < F.lit(newest) - F.expr(f"INTERVAL {delay}")
    return batch.withColumn("is_late", F.coalesce(behind, F.lit(True)))


def run_split(spark: SparkSession, events: DataFrame, ts_col: str, delay: str, path: str, checkpoint: str,
              available_now: bool = False, processing_time: str = "5 seconds") -> StreamingQuery:
    """Write ``events`` under ``path``: ``on_time``, ``late`` and ``marks``, each with
    one folder ``batch=N`` a micro-batch."""
    base = path.rstrip("/")

    def sink(batch: DataFrame, batch_id: int) -> None:
        newest = None
        if batch_id > 0:
            newest = (spark.read.parquet(f"{base}/marks").where(F.col("batch") < batch_id)
                      .agg(F.max("newest")).first()[0])
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            tagged = split_late(batch, ts_col, newest, delay)
            for name, keep in (("on_time", ~F.col("is_late")), ("late", F.col("is_late"))):
                tagged.where(keep).drop("is_late").write.mode("overwrite").parquet(f"{base}/{name}/batch={batch_id}")
            (batch.agg(F.greatest(F.max(ts_col), F.lit(newest)).alias("newest"))
             .coalesce(1).write.mode("overwrite").parquet(f"{base}/marks/batch={batch_id}"))
        finally:
            batch.unpersist()

    w = events.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)).start()


def read_split(spark: SparkSession, path: str) -> DataFrame:
    """All events with their batch and ``status`` (``on_time`` or ``late``)."""
    base = path.rstrip("/")
    return (spark.read.parquet(f"{base}/on_time").withColumn("status", F.lit("on_time"))
            .unionByName(spark.read.parquet(f"{base}/late").withColumn("status", F.lit("late"))))
