"""As-of join (M11): for every row the newest row of another table that is
strictly earlier, per key, without collecting a key.

Both tables are united and range-partitioned by (key, time); inside a range the
last value is carried forward by a window. What a range cannot know - the last
value before its first row - is one row a range, and is carried on over the
ranges. So a key that holds a third of all rows is spread over as many ranges as
its rows fill, and no task or state ever holds a key's history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepool.operators.ranking import _ranges


def asof_join(left: DataFrame, right: DataFrame, key: str, ts: str, values: Sequence[str], tie: str | None = None,
              prefix: str = "last_", partitions: int | None = None) -> DataFrame:
    """``left`` with ``prefix + c`` for every c of ``values`` (and ``ts``): those of the
    newest row of ``right`` with the same key and a strictly smaller time; of rows
    at one time the one with the largest ``tie``. Null where there is none, or where
    key or time is null."""
    carried = [ts, *values]
    wide = left.select(F.col(key).alias("__key"), F.col(ts).alias("__ts"), F.lit(0).alias("__side"),
                       F.lit(None).cast(right.schema[tie].dataType if tie else "long").alias("__tie"),
                       F.struct(*left.columns).alias("__row"),
                       F.lit(None).cast(right.select(F.struct(*carried)).schema[0].dataType).alias("__value"))
    known = (right.where(F.col(key).isNotNull() & F.col(ts).isNotNull())
             .select(F.col(key).alias("__key"), F.col(ts).alias("__ts"), F.lit(1).alias("__side"),
                     (F.col(tie) if tie else F.lit(None).cast("long")).alias("__tie"),
                     F.lit(None).cast(wide.schema["__row"].dataType).alias("__row"), F.struct(*carried).alias("__value")))
    whole = wide.where("__key IS NOT NULL AND __ts IS NOT NULL").unionByName(known)
    # at one time left rows come first: they see strictly earlier values only
    placed = _ranges(whole, [F.col(c).asc() for c in ("__key", "__ts", "__side", "__tie")], partitions)

    edges = placed.groupBy("__range").agg(F.min_by("__key", "__place").alias("first"), F.max_by("__key", "__place").alias("last"))
    ends = (placed.where("__side = 1").groupBy("__range", "__key").agg(F.max_by("__value", "__place").alias("v"))
            .join(F.broadcast(edges), "__range").where(F.col("__key") == F.col("last")).select("__range", "v"))
    # one row a range: the newest value of its last key, taken on while the key lasts
    running = Window.partitionBy("last").orderBy("__range").rowsBetween(Window.unboundedPreceding, 0)
    line = Window.orderBy("__range")
    passed = (edges.join(ends, "__range", "left").withColumn("v", F.last("v", ignorenulls=True).over(running))
              .withColumn("__carry", F.when(F.lag("last").over(line) == F.col("first"), F.lag("v").over(line)))
              .select("__range", F.col("first").alias("__first"), "__carry"))
    inside = Window.partitionBy("__range", "__key").orderBy("__place").rowsBetween(Window.unboundedPreceding, 0)
    out = (placed.withColumn("__inside", F.last("__value", ignorenulls=True).over(inside)).where("__side = 0")
           .join(F.broadcast(passed), "__range")
           .withColumn("__found", F.coalesce("__inside", F.when(F.col("__key") == F.col("__first"), F.col("__carry"))))
           .select("__row.*", *[F.col(f"__found.{c}").alias(f"{prefix}{c}") for c in carried]))
    rest = left.where(F.col(key).isNull() | F.col(ts).isNull()).select(
        "*", *[F.lit(None).cast(right.schema[c].dataType).alias(f"{prefix}{c}") for c in carried])
    return out.unionByName(rest)
