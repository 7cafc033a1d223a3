"""Aggregations (G1-G15) and time bucketing for batch data.

Every aggregate here is a ``groupBy().agg()`` with built-in functions, so
Spark plans a partial aggregate before the shuffle and a final one after
it: a hot key never reaches the shuffle as raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MONEY = "decimal(38,2)"


def money_sum(c: str | Column) -> Column:
    """Exact sum of two-decimal money values (D8): cast each value to
    DECIMAL(18,2) and sum as decimal, so the result does not depend on the
    order in which partitions are combined (a double sum does)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.sum(col.cast("decimal(18,2)")).cast(MONEY)


def money_avg(c: str) -> Column:
    """Average of two-decimal money values, rounded half up to cents, from
    the exact sum (null without values)."""
    n = F.count(c)
    cents = avg_cents(F.sum(F.col(c).cast("decimal(18,2)")), F.when(n > 0, n))
    return (cents.cast("decimal(38,2)") / 100).cast("decimal(38,2)")


def avg_cents(total: Column, n: Column) -> Column:
    """Average of a money total in whole cents, rounded half-up with integer
    arithmetic only: exact, and identical on every engine (a double average
    sits on a different side of .5 depending on summation order)."""
    cents = (total * 100).cast("bigint")
    return int_div(cents * 2 + n, n * 2)


def int_div(a: Column, b: Column) -> Column:
    """Floor division of non-negative integers, exactly: ``a - a mod b`` is
    a multiple of ``b``, so the decimal quotient is a whole number."""
    exact = (a - F.pmod(a, b)).cast("decimal(38,0)") / b.cast("decimal(38,0)")
    return exact.cast("bigint")


def count_by(df: DataFrame, *keys: str, name: str = "count") -> DataFrame:
    """G1: rows per key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


# --- Gold tables over the Silver contract ------------------------------------
# Gold column names of the reference.
#   daily revenue:   order_date, region, total_revenue, order_count, avg_order_value
#   product summary: product, total_units_sold, total_revenue, avg_unit_price, order_count

def daily_revenue(silver: DataFrame) -> DataFrame:
    """Revenue, orders and average order value per (order_date, region)."""
    return (silver.groupBy("order_date", "region")
                  .agg(money_sum("total_amount").alias("total_revenue"),
                       F.count("order_id").alias("order_count"),
                       money_avg("total_amount").alias("avg_order_value")))


def product_summary(silver: DataFrame) -> DataFrame:
    """Units, revenue, average unit price and orders per product."""
    return (silver.groupBy("product")
                  .agg(F.sum("quantity").alias("total_units_sold"),
                       money_sum("total_amount").alias("total_revenue"),
                       money_avg("amount").alias("avg_unit_price"),
                       F.count("order_id").alias("order_count")))


def region_summary(df: DataFrame, amount_col: str = "total_amount") -> DataFrame:
    """Orders and rounded revenue per region."""
    return (df.groupBy("region")
              .agg(F.count(F.lit(1)).alias("orders"),
                   money_sum(amount_col).alias("revenue")))


def monthly_revenue(df: DataFrame, ts_col: str, amount_col: str,
                    by: Sequence[str] = ("region",)) -> DataFrame:
    """Revenue per (year, month[, by…])."""
    return (df.groupBy(F.year(ts_col).alias("order_year"),
                       F.month(ts_col).alias("order_month"), *by)
              .agg(money_sum(amount_col).alias("revenue"),
                   F.count(F.lit(1)).alias("orders")))


def dict_agg(df: DataFrame, by: Sequence[str], spec: dict[str, str],
             rename: dict[str, str] | None = None) -> DataFrame:
    """The dict form ``agg({"col": "sum"})``; Spark names the outputs
    ``sum(col)``, which ``rename`` maps to readable names."""
    out = df.groupBy(*by).agg(spec)
    for old, new in (rename or {}).items():
        out = out.withColumnRenamed(old, new)
    return out


# --- Time bucketing ----------------------------------------------------------

def tumbling(df: DataFrame, ts_col: str, width: str, keys: Sequence[str] = (),
             aggs: Sequence[Column] | None = None) -> DataFrame:
    """X6 batch form: fixed, non-overlapping windows per key."""
    aggs = list(aggs) if aggs else [F.count(F.lit(1)).alias("n")]
    g = df.groupBy(F.window(ts_col, width).alias("w"), *keys).agg(*aggs)
    return g.select(F.col("w.start").alias("window_start"),
                    F.col("w.end").alias("window_end"), *keys,
                    *[c for c in g.columns if c not in ("w", *keys)])


def sliding(df: DataFrame, ts_col: str, width: str, slide: str, keys: Sequence[str] = (),
            aggs: Sequence[Column] | None = None) -> DataFrame:
    """X6 "rolling" form (D10): overlapping windows; each row lands in
    width/slide windows, an expansion bounded by that ratio."""
    aggs = list(aggs) if aggs else [F.count(F.lit(1)).alias("n")]
    g = df.groupBy(F.window(ts_col, width, slide).alias("w"), *keys).agg(*aggs)
    return g.select(F.col("w.start").alias("window_start"),
                    F.col("w.end").alias("window_end"), *keys,
                    *[c for c in g.columns if c not in ("w", *keys)])


def sessions_builtin(df: DataFrame, ts_col: str, gap: str, keys: Sequence[str],
                     aggs: Sequence[Column] | None = None) -> DataFrame:
    """X13 with Spark's ``session_window`` as is: simple, but every event of
    a key is shuffled to one task (the partial aggregate keys on each
    event's own window, so nothing combines before the shuffle)."""
    aggs = list(aggs) if aggs else [F.count(F.lit(1)).alias("n")]
    g = df.groupBy(*keys, F.session_window(ts_col, gap).alias("s")).agg(*aggs)
    return g.select(*keys, F.col("s.start").alias("session_start"),
                    F.col("s.end").alias("session_end"),
                    *[c for c in g.columns if c not in ("s", *keys)])


def sessions(df: DataFrame, ts_col: str, gap: str, keys: Sequence[str],
             fanout: int = 1024) -> DataFrame:
    """X13 batch form: per key, activity sessions that close after ``gap``
    of silence — ``[first event, last event + gap)`` and the event count,
    exactly as ``session_window`` defines them — with no task ever holding
    more than a bounded slice of one key's history.

    1. **Cells.** Time is cut into cells one ``gap`` wide. Two events of the
       same cell are less than ``gap`` apart, so a cell always lies inside
       one session and collapses to (first, last, count): a plain aggregate
       with a map-side partial phase, so even a burst holding a third of
       all rows is combined before any shuffle.
    2. **Local merge.** Cells are merged in time order inside groups of
       ``fanout`` consecutive cells per key: a new session starts where a
       cell's first event is at least ``gap`` after the previous cell's
       last one. A window partition holds at most ``fanout`` rows.
    3. **Edge merge.** A local session can only continue into another group
       if it starts within ``gap`` of its group's start or reaches the
       group's end. Only those edge sessions (≤ 2 per key and group) are
       merged per key, by the running maximum end; the other sessions pass
       through the same window in partitions of their own.
    """
    keys = list(keys)
    # the gap's length, counted from the epoch itself: no session time zone in it
    gap_us = F.expr(f"unix_micros(timestamp_micros(0) + INTERVAL {gap})")
    ts_us = F.unix_micros(F.col(ts_col).cast("timestamp"))
    grp_us = gap_us * F.lit(fanout)
    # cell and group ids are their start instants in µs (integer arithmetic)
    # rows without a time belong to no session (as in session_window)
    cells = (df.filter(F.col(ts_col).isNotNull())
               .select(*keys, F.col(ts_col).alias("_ts"), (ts_us - F.pmod(ts_us, gap_us)).alias("_cell"))
               .groupBy(*keys, "_cell")
               .agg(F.min("_ts").alias("_first"), F.max("_ts").alias("_last"),
                    F.count(F.lit(1)).alias("n"))
               .withColumn("_grp", F.col("_cell") - F.pmod(F.col("_cell"), grp_us)))
    in_grp = Window.partitionBy(*keys, "_grp").orderBy("_cell")
    gap_i = F.expr(f"INTERVAL {gap}")
    # session_window merges an event exactly ``gap`` after the last one
    # (the session end is inclusive), so a new session needs a larger gap
    starts = F.coalesce(F.col("_first") > F.lag("_last").over(in_grp) + gap_i, F.lit(True))
    local = (cells.withColumn("_new", starts.cast("int"))
                  .withColumn("_lsid", F.sum("_new").over(in_grp.rowsBetween(Window.unboundedPreceding, 0)))
                  .groupBy(*keys, "_grp", "_lsid")
                  .agg(F.min("_first").alias("session_start"),
                       (F.max("_last") + gap_i).alias("session_end"), F.sum("n").alias("n")))
    start_us = F.unix_micros(F.col("session_start").cast("timestamp"))
    end_us = F.unix_micros(F.col("session_end").cast("timestamp"))
    g0 = F.col("_grp")
    edge = (start_us <= g0 + gap_us) | (end_us >= g0 + grp_us)
    # Edge sessions share the window partition (key, NULL); each inner
    # session is alone in (key, its start). The final aggregate groups by
    # (key, _mk, _sid), which the window's partitioning already satisfies.
    tagged = local.withColumn("_mk", F.when(edge, F.lit(None)).otherwise(start_us))
    order = Window.partitionBy(*keys, "_mk").orderBy("session_start", "session_end")
    prev_end = F.max("session_end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    flagged = tagged.withColumn("_new", F.coalesce(F.col("session_start") > prev_end, F.lit(True)))
    numbered = flagged.withColumn("_sid", F.sum(F.col("_new").cast("int")).over(
        order.rowsBetween(Window.unboundedPreceding, 0)))
    return (numbered.groupBy(*keys, "_mk", "_sid")
                    .agg(F.min("session_start").alias("session_start"),
                         F.max("session_end").alias("session_end"), F.sum("n").alias("n"))
                    .select(*keys, "session_start", "session_end", "n"))


def resample(df: DataFrame, ts_col: str, unit: str, aggs: Sequence[Column],
             fill: bool = True, step: str | None = None) -> DataFrame:
    """Bucket by ``date_trunc(unit)`` and aggregate; with ``fill`` every
    empty bucket between the first and last one appears with NULL measures.

    The empty buckets are derived from the aggregate itself: each bucket
    emits the run of missing buckets up to the next non-empty one
    (``lead`` + ``sequence``). So the data is scanned and aggregated once
    (both branches share the aggregate's exchange), and the ordered pass
    sees one row per bucket. The next bucket is looked up per day, and across
    days among one row per day, so no task orders more than a day's buckets or
    one row per day.
    """
    bucket = F.date_trunc(unit, F.col(ts_col)).cast("timestamp_ntz").alias("bucket")
    agg = df.groupBy(bucket).agg(*aggs)
    if not fill:
        return agg
    step = F.expr(f"INTERVAL {step or '1 ' + unit}")
    measures = [c for c in agg.columns if c != "bucket"]
    # each bucket row emits itself at position 0 and the empty buckets up to
    # the next row after it, with NULL measures
    by_day = agg.withColumn("_day", F.to_date("bucket"))
    days = by_day.groupBy("_day").agg(F.min("bucket").alias("_first"))
    days = days.select("_day", F.lead("_first").over(Window.orderBy("_day")).alias("_after"))
    with_next = (by_day.withColumn("_next", F.lead("bucket").over(Window.partitionBy("_day").orderBy("bucket")))
                 .join(days, "_day"))
    nxt = F.coalesce("_next", "_after")
    gaps = F.when(nxt > F.col("bucket") + step,
                  F.sequence(F.col("bucket") + step, nxt - step, step))
    buckets = F.concat(F.array(F.col("bucket")), F.coalesce(gaps, F.array().cast("array<timestamp_ntz>")))
    exploded = with_next.select(F.posexplode(buckets).alias("_pos", "_b"), *measures)
    return exploded.select(F.col("_b").alias("bucket"),
                           *[F.when(F.col("_pos") == 0, F.col(m)).alias(m) for m in measures])


# --- Reshaping ---------------------------------------------------------------

def pivot_count(df: DataFrame, row_key: str, pivot_col: str,
                values: Sequence[str]) -> DataFrame:
    """One count column per pivot value. The value list is given, so
    Spark does not run an extra distinct job to discover it; ``count(lit(1))``
    because ``count("*")`` is rejected inside pivot."""
    return df.groupBy(row_key).pivot(pivot_col, list(values)).agg(F.count(F.lit(1)))


def unpivot(df: DataFrame, ids: Sequence[str], values: Sequence[str],
            variable: str = "measure", value: str = "value") -> DataFrame:
    """Wide → long, a narrow per-row expansion (no shuffle)."""
    return df.unpivot(list(ids), list(values), variable, value)


def sliding_panes(df: DataFrame, ts_col: str, width_s: int, slide_s: int, keys: Sequence[str] = ()) -> DataFrame:
    """``window_start``, keys and n of every sliding window that holds a row,
    from panes: rows are counted once per pane of one slide (map-side combine; no
    row is ever copied), and a window adds up its ``width / slide`` panes. After the
    first aggregate the work depends on the time span and the keys only. ``width_s``
    must be a multiple of ``slide_s``; rows without a time are left out."""
    if width_s % slide_s:
        raise ValueError("the width must be a multiple of the slide")
    keys = list(keys)
    at = F.floor(F.unix_timestamp(F.col(ts_col).cast("timestamp")) / slide_s)
    panes = (df.where(F.col(ts_col).isNotNull()).groupBy(*keys, at.alias("__pane"))
             .agg(F.count(F.lit(1)).alias("__n")))
    behind = width_s // slide_s - 1
    # every window that a pane belongs to exists as a row: the panes themselves and
    # the zero panes before them
    spans = panes.groupBy(*keys).agg(F.min("__pane").alias("__lo"), F.max("__pane").alias("__hi"))
    every = spans.select(*keys, F.explode(F.sequence(F.col("__lo") - behind, F.col("__hi"))).alias("__pane"))
    same = every["__pane"] == panes["__pane"]
    for k in keys:
        same = same & every[k].eqNullSafe(panes[k])
    dense = every.join(panes, same, "left").select(*[every[k] for k in keys], every["__pane"], F.coalesce("__n", F.lit(0)).alias("__n"))
    w = Window.partitionBy(*keys).orderBy("__pane").rangeBetween(0, behind)
    return (dense.withColumn("n", F.sum("__n").over(w)).where("n > 0")
            .select(F.timestamp_seconds(F.col("__pane") * slide_s).alias("window_start"), *keys, "n"))
