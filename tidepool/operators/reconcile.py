"""Reconciliation by content (G10): which keys were lost, added or changed.

Both tables are reduced to one digest per key bucket: the number of rows and the
sum of their 64-bit row hashes, which no order of rows changes and which partial
aggregates add up. Only the rows of buckets whose digests differ are joined by
key. Two equal layers cost one scan and one tiny shuffle each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.session import cut_lineage


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def digests(df: DataFrame, keys: Sequence[str], columns: Sequence[str], buckets: int) -> DataFrame:
    """bucket, rows, digest. A null and an absent value hash differently from any
    value: the null pattern is hashed too."""
    nulls = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns])
    row = F.xxhash64(*columns, nulls).cast("decimal(38,0)")
    return (df.groupBy(_bucket(keys, buckets).alias("bucket"))
            .agg(F.count(F.lit(1)).alias("rows"), F.sum(row).alias("digest")))


def differences(before: DataFrame, after: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None,
                buckets: int = 4096) -> DataFrame:
    """keys and ``status`` (lost, added, changed) of all keys whose rows differ.
    ``columns`` (default: those of ``before``) are compared; keys must be unique and
    not null in both."""
    keys, columns = list(keys), list(columns or before.columns)
    a, b = (digests(t, keys, columns, buckets).toDF("bucket", f"r{i}", f"d{i}") for i, t in enumerate((before, after)))
    unequal = cut_lineage(a.join(b, "bucket", "full").where("NOT (r0 <=> r1 AND d0 <=> d1)").select("bucket"))
    bad = F.broadcast(unequal)  # at most `buckets` numbers

    def rows(df: DataFrame, name: str) -> DataFrame:
        # keys of struct order: all compared columns as one value
        return (df.withColumn("bucket", _bucket(keys, buckets)).join(bad, "bucket", "left_semi")
                .select(*keys, F.struct(*columns).alias(name)))
    both = rows(before, "__old").join(rows(after, "__new"), keys, "full")
    status = (F.when(F.col("__new").isNull(), "lost").when(F.col("__old").isNull(), "added")
              .when(~F.col("__old").eqNullSafe(F.col("__new")), "changed"))
    return both.select(*keys, status.alias("status")).where("status IS NOT NULL")
