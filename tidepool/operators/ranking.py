"""Total order over a whole table (O1): ranks without a one-task window.

``row_number() OVER (ORDER BY …)`` without a partition key sends every row to
one task. Here the rows are range-partitioned by the order columns, numbered
inside their range, and shifted by the number of rows in the ranges before: one
range shuffle, and per range one row for the offsets. A hot order value does
not pile up in one range: rows are collapsed to their distinct values first
(with map-side combine), and each value then stands for its count.

Columns are ordered as Spark orders them (nulls first when ascending); names
starting with ``__rank`` are reserved.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.session import cut_lineage

Order = Sequence[tuple[str, bool]]


def _sort(order: Order) -> list[Column]:
    return [F.col(f"`{c}`").asc() if ascending else F.col(f"`{c}`").desc() for c, ascending in order]


def _offsets(sizes: DataFrame) -> DataFrame:
    """(__range, __before): rows in all earlier ranges. ``sizes`` has one row a
    range, so its window is as small as the number of shuffle partitions."""
    running = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("__range", F.coalesce(F.sum("__rows").over(running), F.lit(0)).alias("__before"))


def _ranges(df: DataFrame, order: list[Column], partitions: int | None) -> DataFrame:
    """``df`` in ranges of ``order``, sorted inside each; ``__range`` is the
    range's number, ``__place`` the row's number in it (from 0). Written to the
    checkpoint folder: the range bounds come from a sample, and both later
    reads must see the same ones."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut_lineage(
        df.repartitionByRange(n, *order).sortWithinPartitions(*order)
          .select("*", F.spark_partition_id().alias("__range"),
                  F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("__place")))


def row_numbers(df: DataFrame, order: Order, name: str = "rank", unique: bool = False,
                partitions: int | None = None) -> DataFrame:
    """Every row with its place (1, 2, 3 …) in the total order of the table.

    Rows that ``order`` leaves equal are put in order by a hash of all columns;
    rows equal in all columns are interchangeable, and are collapsed first so
    that a row repeated a billion times is one row of a range (columns must be
    of types that can be grouped). ``unique`` says that the order columns are a
    key: the collapse and its shuffle are left out.
    """
    columns = list(df.columns)
    if unique:
        placed = _ranges(df, _sort(order), partitions)
        sizes = placed.groupBy("__range").agg(F.count(F.lit(1)).alias("__rows"))
        return (placed.join(F.broadcast(_offsets(sizes)), "__range")
                .select(*[F.col(f"`{c}`") for c in columns], (F.col("__before") + F.col("__place") + 1).alias(name)))
    every = [F.col(f"`{c}`") for c in columns]
    rows = df.groupBy(*every).agg(F.count(F.lit(1)).alias("__n"))
    tie = F.xxhash64(*[c.cast("string") for c in every])
    placed = _ranges(rows.withColumn("__tie", tie), [*_sort(order), F.col("__tie").asc()], partitions)
    return (_weighted(placed).select(*every, F.explode(F.expr("sequence(__first, __first + __n - 1)")).alias(name)))


def _weighted(placed: DataFrame) -> DataFrame:
    """``__first``: the number of the first of the ``__n`` rows that a placed
    row stands for; ``__group``: its own number among the placed rows."""
    sizes = placed.groupBy("__range").agg(F.sum("__n").alias("__rows"))
    groups = placed.groupBy("__range").agg(F.count(F.lit(1)).alias("__rows"))
    inside = Window.partitionBy("__range").orderBy("__place").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("__n").over(inside), F.lit(0))
    return (placed.withColumn("__inside", before)
            .join(F.broadcast(_offsets(sizes)), "__range")
            .withColumn("__first", F.col("__before") + F.col("__inside") + 1).drop("__before")
            .join(F.broadcast(_offsets(groups)), "__range")
            .withColumn("__group", F.col("__before") + F.col("__place") + 1).drop("__before"))


def ranks(df: DataFrame, order: Order, name: str = "rank", dense: bool = False,
          partitions: int | None = None) -> DataFrame:
    """``rank()`` (or ``dense_rank()``) of every row over the whole table: rows
    with equal order values share a rank. Only distinct values are ranked; the
    rows take theirs by a join on the order columns (nulls match), whose skewed
    values AQE splits."""
    keys = [c for c, _ in order]
    values = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count(F.lit(1)).alias("__n"))
    found = _weighted(_ranges(values, _sort(order), partitions)).select(
        *[F.col(f"`{k}`").alias(f"__rank{i}") for i, k in enumerate(keys)],
        F.col("__group" if dense else "__first").alias("__rank"))
    same = None
    for i, k in enumerate(keys):
        one = df[f"`{k}`"].eqNullSafe(found[f"__rank{i}"])
        same = one if same is None else same & one
    return df.join(found, same).select(*[df[f"`{c}`"] for c in df.columns], found["__rank"].alias(name))
