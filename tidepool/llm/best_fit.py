"""Op 5, best-fit packing under conflicts.

Documents are packed into training sequences of ``capacity`` bytes (UTF-8).
A bin must not hold two documents of one duplicate cluster (equal texts), nor
more than ``per_source`` of one source. Bins are kept in order of residual;
each carries a bitmap of its clusters and ``per_source`` bitmaps of its
sources (bit s of plane j: it holds more than j documents of source s). A
document goes to the tightest bin that fits; when that one conflicts, the
search goes on to its successors until a compatible bin is found, and opens a
bin when none is left.

Plan: only (row number, length, source, cluster) crosses a shuffle. Rows are
dealt by a hash of their row number into shards of bounded size, so neither a
hot source nor a hot cluster gathers in one group; each shard packs its own
rows, longest first. Texts beyond the capacity are cut: every full piece is a
bin of its own, the rest is packed. Nothing is dropped.

Defined cases: a null or empty text has length 0 and no bin (null), its row
stays; a null source conflicts with nothing; repeated rows are separate
items of one cluster; ties in length go by row number; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm import common
from tidepool.session import cut_lineage

CAPACITY = 32768
PER_SOURCE = 4
#: A shard holds about this many bins' worth of bytes, or this many rows.
SHARD_BINS = 256
SHARD_ROWS = 4096

SCHEMA = ("doc_id long, source string, piece int, start long, length long, bin_id string, "
          "bin_length long")


def pack(lengths: list[int], sources: list[int | None], clusters: list[int | None],
         capacity: int = CAPACITY, per_source: int = PER_SOURCE) -> list[int]:
    """The bin of every item, given longest first. ``sources`` and ``clusters``
    are small numbers (bit positions) or None: no conflict."""
    room: list[tuple[int, int]] = []  # (residual, bin), ascending
    planes: list[list[int]] = []
    held: list[int] = []
    out = []
    for length, source, cluster in zip(lengths, sources, clusters):
        s = 0 if source is None else 1 << source
        c = 0 if cluster is None else 1 << cluster
        i = bisect_left(room, (length, -1))
        while i < len(room) and (held[room[i][1]] & c or planes[room[i][1]][-1] & s):
            i += 1
        if i < len(room):
            residual, b = room.pop(i)
        else:
            residual, b = capacity, len(held)
            planes.append([0] * per_source)
            held.append(0)
        held[b] |= c
        for j in range(per_source):
            if not planes[b][j] & s:
                planes[b][j] |= s
                break
        if residual > length:
            insort(room, (residual - length, b))
        out.append(b)
    return out


def _places(column: pd.Series, least: int = 1) -> list[int | None]:
    """Bit positions of the values that occur more than ``least`` times; the
    others can't conflict."""
    counts = column.value_counts()
    place = {v: i for i, v in enumerate(sorted(counts.index[counts > least]))}
    return [place.get(v) for v in column]


def _packer(capacity: int, per_source: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "row"], ascending=[False, True])
        bins = pack(rows.length.tolist(), _places(rows.source, per_source), _places(rows.cluster),
                    capacity, per_source)
        rows["bin"] = bins
        rows["bin_length"] = rows.groupby("bin").length.transform("sum")
        rows["bin_id"] = [f"{s}-{b}" for s, b in zip(rows.shard, bins)]
        return rows[["doc_id", "source", "piece", "start", "length", "bin_id", "bin_length"]]
    return run


def assign(docs: DataFrame, capacity: int = CAPACITY, per_source: int = PER_SOURCE) -> DataFrame:
    """One row per piece of a document: its place in the text (in bytes) and
    its bin."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = cut_lineage(common.columns(docs, doc_id="long", source="string", text="string").select(
        "doc_id", "source", F.octet_length(text).cast("long").alias("size"),
        F.md5(text.cast("binary")).alias("cluster"), F.monotonically_increasing_id().alias("row")))
    total, n = rows.agg(F.coalesce(F.sum(F.col("size") % capacity), F.lit(0)), F.count("*")).first()
    shards = max(1, -(-total // (capacity * SHARD_BINS)), -(-n // SHARD_ROWS))
    whole = (rows.where(f"size >= {capacity}")
             .withColumn("piece", F.explode(F.expr(f"sequence(0, cast(size div {capacity} as int) - 1)")))
             .select("doc_id", "source", "piece", (F.col("piece") * F.lit(capacity).cast("long")).alias("start"),
                     F.lit(capacity).cast("long").alias("length"),
                     F.concat_ws("-", F.lit("full"), F.col("row"), F.col("piece")).alias("bin_id"),
                     F.lit(capacity).cast("long").alias("bin_length")))
    rest = (rows.where(f"size % {capacity} > 0")
            .select("row", "doc_id", "source", "cluster",
                    F.expr(f"cast(size div {capacity} as int)").alias("piece"),
                    F.expr(f"cast(size - size % {capacity} as long)").alias("start"),
                    F.expr(f"cast(size % {capacity} as long)").alias("length"),
                    F.expr(f"pmod(xxhash64(row), {shards}L)").alias("shard")))
    packed = rest.groupBy("shard").applyInPandas(_packer(capacity, per_source), SCHEMA)
    empty = rows.where("size = 0").select(
        "doc_id", "source", F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start"),
        F.lit(0).cast("long").alias("length"), F.lit(None).cast("string").alias("bin_id"),
        F.lit(0).cast("long").alias("bin_length"))
    return packed.unionByName(whole).unionByName(empty)


def op5_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequence bins of every document."""
    return assign(common.table(spark, sf_dir, "documents"))
