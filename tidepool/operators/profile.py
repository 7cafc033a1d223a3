"""Table profile (G12): the ``SUMMARIZE`` the reference names for DuckDB.

Long form, one row per column: rows, nulls, distinct values, min, max
(min/max as strings so all column types fit one schema).

* ``approx=True`` (default): one aggregate pass; distinct counts are
  HyperLogLog sketches that merge on the map side.
* ``approx=False``: exact distinct counts in a second scan: the columns are
  unpivoted to (column, value as text) and counted as one keyed distinct, with
  map-side combine, so only distinct values cross the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_OUT = ("column_name", "nulls", "distinct_values", "min_value", "max_value", "rows")


def _basic(df: DataFrame, cols: Sequence[str], distinct=None) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for c in cols:
        aggs += [F.count(F.when(F.col(c).isNull(), 1)).alias(f"{c}__nulls"),
                 F.min(c).cast("string").alias(f"{c}__min"),
                 F.max(c).cast("string").alias(f"{c}__max")]
        if distinct is not None:
            aggs.append(distinct(c).alias(f"{c}__distinct"))
    return df.agg(*aggs)


def _long(wide: DataFrame, cols: Sequence[str], with_distinct: bool) -> DataFrame:
    d = "`{c}__distinct`" if with_distinct else "CAST(NULL AS BIGINT)"
    stack = ", ".join(
        f"'{c}', `{c}__nulls`, {d.format(c=c)}, `{c}__min`, `{c}__max`" for c in cols)
    return wide.selectExpr(
        f"stack({len(cols)}, {stack}) AS (column_name, nulls, distinct_values, min_value, max_value)",
        "_rows AS rows")


def summarize(df: DataFrame, columns: Sequence[str] | None = None,
              approx: bool = True, rsd: float = 0.02) -> DataFrame:
    cols = list(columns or df.columns)
    if approx:
        wide = _basic(df, cols, lambda c: F.approx_count_distinct(c, rsd))
        return _long(wide, cols, True)
    base = _long(_basic(df, cols), cols, False).drop("distinct_values")
    pairs = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v"))
                                          for c in cols])).alias("p")).select("p.*")
    counts = (pairs.where("v IS NOT NULL").distinct()
              .groupBy("column_name").agg(F.count(F.lit(1)).alias("distinct_values")))
    return (base.join(counts, "column_name", "left")
            .withColumn("distinct_values", F.coalesce("distinct_values", F.lit(0).cast("bigint"))).select(*_OUT))


#: Rank error that a KLL sketch with k = 400 keeps with a probability of 99 %
#: (its size, a few kilobytes a column, does not grow with the rows).
KLL_K = 400
RANK_ERROR = 0.01


def distribution(df: DataFrame, columns: Sequence[str], quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """column_name, n (values neither null nor NaN), mean, deviation and a
    quantile per entry of ``quantiles`` (``q25`` for 0.25 ...) of numeric columns. One
    aggregate: each task keeps a KLL sketch per column and sends that; sketches are
    merged. A quantile's rank is off by ``RANK_ERROR`` at most (see there)."""
    from pyspark.sql.functions import kll_sketch_agg_double, kll_sketch_get_quantile_double
    aggs = []
    for i, c in enumerate(columns):
        v = F.col(f"`{c}`").cast("double")
        v = F.when(~F.isnan(v), v)
        aggs += [F.count(v).alias(f"n{i}"), F.avg(v).alias(f"m{i}"), F.stddev_samp(v).alias(f"s{i}"),
                 kll_sketch_agg_double(v, F.lit(KLL_K)).alias(f"k{i}")]
    one = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("n"), F.col(f"m{i}").alias("mean"),
                              F.col(f"s{i}").alias("deviation"),
                              *[F.when(F.col(f"n{i}") > 0, kll_sketch_get_quantile_double(F.col(f"k{i}"), F.lit(float(q))))
                                .alias(f"q{round(q * 100)}") for q in quantiles])
                     for i, c in enumerate(columns)])
    return one.select(F.inline(rows))


def frequent(df: DataFrame, column: str, share: float = 0.01) -> DataFrame:
    """Value and n of every value that holds at least ``share`` of the rows;
    exact: at most 1/share values qualify, found from the per-value counts (with
    map-side combine) without sorting them. The rows are counted at once."""
    least = df.count() * share
    return (df.groupBy(F.col(f"`{column}`").alias("value")).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= F.lit(least)))
