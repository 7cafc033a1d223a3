"""Cleaning operators for the Silver layer.

All of them are built-in column expressions or aggregates, so they stay in
whole-stage codegen and never leave the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def normalize_code(c: str | Column) -> Column:
    """``upper(trim(x))`` — region codes arrive as ``eu`` or ``" APAC "``."""
    return F.upper(F.trim(F.col(c) if isinstance(c, str) else c))


def parse_timestamp(c: str | Column, fmt: str | None = None) -> Column:
    """F6 under ANSI mode: an unparseable value becomes NULL instead of
    failing the whole job (``to_timestamp`` raises on Spark 4)."""
    col = F.col(c) if isinstance(c, str) else c
    col = col.cast("string")
    return F.try_to_timestamp(col, F.lit(fmt)) if fmt else F.try_to_timestamp(col)


def parse_number(c: str | Column, to_type: str) -> Column:
    """Strict-mode-safe numeric parse: bad text → NULL (then a rule rejects it)."""
    col = F.col(c) if isinstance(c, str) else c
    return col.try_cast(to_type)


@dataclass(frozen=True)
class Rule:
    """A named *reject* condition. A row is rejected by the first rule whose
    condition is true; a NULL condition counts as not rejected, so write
    NULL handling into the rule itself (D14: "amount is NULL or ≤ 0")."""

    name: str
    reject_if: Column


@dataclass
class RuleResult:
    tagged: DataFrame
    valid: DataFrame
    rejected: DataFrame
    counts: DataFrame


def tag_rules(df: DataFrame, rules: Sequence[Rule], tag_col: str = "_rejected_by") -> DataFrame:
    """One projection that names the first failing rule (NULL = valid)."""
    expr = None
    for r in rules:
        cond = F.coalesce(r.reject_if, F.lit(False))
        expr = F.when(cond, F.lit(r.name)) if expr is None else expr.when(cond, F.lit(r.name))
    tag = expr.otherwise(F.lit(None).cast("string")) if expr is not None else F.lit(None).cast("string")
    return df.withColumn(tag_col, tag)


def apply_rules(df: DataFrame, rules: Sequence[Rule], tag_col: str = "_rejected_by") -> RuleResult:
    """Keep-and-count in one pass.

    The reference filters rule by rule and runs a full ``count()`` after each
    step; here every row is tagged once, and the valid rows, the quarantined
    rows and the per-rule counts are three views of the same tagged frame
    (cache ``tagged`` if more than one of them is materialised).
    """
    tagged = tag_rules(df, rules, tag_col)
    valid = tagged.filter(F.col(tag_col).isNull()).drop(tag_col)
    rejected = tagged.filter(F.col(tag_col).isNotNull())
    counts = (tagged
              .groupBy(F.coalesce(F.col(tag_col), F.lit("valid")).alias("rule"))
              .agg(F.count(F.lit(1)).alias("rows")))
    return RuleResult(tagged, valid, rejected, counts)


def dedup(df: DataFrame, keys: Sequence[str], order_by: Sequence[str],
          keep: str = "first") -> DataFrame:
    """One row per key — the first (or last) by ``order_by``:
    ``row_number() = 1``.

    Ties are broken by all remaining columns (D4), so the result is
    deterministic. The filter on the rank becomes a partial WindowGroupLimit
    before the shuffle, so a key that holds a third of the table crosses it as
    one row for each input task.
    """
    keys = list(keys)
    order_by = [c for c in order_by if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    if keep not in ("first", "last"):
        raise ValueError("keep must be 'first' or 'last'")
    order = [F.col(c).asc() if keep == "first" else F.col(c).desc() for c in order_by + rest]
    w = Window.partitionBy(*keys).orderBy(*(order or [F.lit(1)]))
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
