"""Joins (J1-J8).

Strategy is left to AQE: a join becomes a broadcast join only when the
*materialised* side is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``
(planner estimates are switched off, see ``session.py``), otherwise it stays
sort-merge, with skewed partitions split. No join here hints a broadcast and
none runs a job while the query is built.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def _keys(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def distinct_keys(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Key set of one side. The distinct runs as a partial + final aggregate,
    so repeated keys collapse on the map side before the shuffle, and the
    result is already hash-partitioned on the keys for the join after it."""
    return df.select(*_keys(keys)).distinct()


def anti(left: DataFrame, right: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Rows of ``left`` with no match in ``right`` (e.g. Bronze rows that
    Silver cleaned out). The right side is reduced to its key set first."""
    ks = _keys(keys)
    return left.join(distinct_keys(right, ks), on=ks, how="left_anti")


def keep_status(left: DataFrame, right: DataFrame, keys: str | Sequence[str],
                status_col: str = "status", kept: str = "KEPT",
                filtered: str = "FILTERED") -> DataFrame:
    """Every left row with ``KEPT`` if its key survived into ``right``,
    else ``FILTERED``. Left duplicates are kept; the right side is reduced to
    distinct keys so it can never multiply left rows."""
    ks = _keys(keys)
    hit = distinct_keys(right, ks).withColumn("_hit", F.lit(True))
    return (left.join(hit, on=ks, how="left")
                .withColumn(status_col,
                            F.when(F.col("_hit").isNull(), F.lit(filtered))
                             .otherwise(F.lit(kept)))
                .drop("_hit"))


def enrich(fact: DataFrame, dim: DataFrame, on: str | Sequence[str] | Column,
           how: str = "inner") -> DataFrame:
    """Fact ⋈ dimension."""
    return fact.join(dim, on=on, how=how)


def hot_keys(df: DataFrame, keys: str | Sequence[str], share: int = 1000) -> list[tuple]:
    """Keys that hold more than one ``share``-th of the rows: fewer than
    ``share`` by arithmetic, whatever the data. One aggregate with map-side
    combine; only these keys reach the driver."""
    ks = _keys(keys)
    counts = df.groupBy(*ks).agg(F.count(F.lit(1)).alias("_n"))
    total = df.count()
    return [tuple(r[k] for k in ks) for r in counts.where(F.col("_n") * share > total).collect()]


def salted_join(big: DataFrame, small: DataFrame, keys: str | Sequence[str],
                salts: int = 16, how: str = "inner", seed: int = 7) -> DataFrame:
    """Equi-join that spreads every hot key of ``big`` over ``salts`` tasks.

    Rows of ``big`` with a hot key (:func:`hot_keys`) get a random salt in
    ``[0, salts)``; only the rows of ``small`` with those keys are replicated
    once per salt, all others stay single. AQE's skew-join split covers
    sort-merge joins automatically; this is the explicit form for plans AQE
    cannot split (e.g. a hot key on the build side of an outer join).
    Only inner and left joins keep their meaning under salting.
    """
    if how not in ("inner", "left", "left_outer", "left_semi", "left_anti"):
        raise ValueError(f"salted join does not preserve {how!r} semantics")
    ks = _keys(keys)
    hot = F.lit(False)
    for key in hot_keys(big, ks):
        same = F.lit(True)
        for k, v in zip(ks, key):
            same = same & F.col(k).eqNullSafe(F.lit(v))
        hot = hot | same
    b = big.withColumn("_salt", F.when(hot, (F.rand(seed) * salts).cast("int")).otherwise(F.lit(0)))
    copies = F.when(hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    s = small.withColumn("_salt", F.explode(copies))
    return b.join(s, on=ks + ["_salt"], how=how).drop("_salt")
