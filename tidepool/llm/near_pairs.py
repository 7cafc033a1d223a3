"""Pairs of near copies without all pairs of a group: what the similarity
operators of this subpackage share.

A *node* is a distinct set, with the ``doc_id`` and the digest that lead back to
its text. ``compared`` verifies pairs on whole sets and says how they differ;
``differences`` describes all members of a list by their differences from the
list's common text, and ``left_pairs`` meets those over shared differences only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepool.llm import components
from tidepool.session import settled

#: Hash slots of the filter that picks the texts to verify: the bound of what
#: it broadcasts (4 bytes each).
SLOTS = 1 << 20


def near_ids(rows: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """``rows`` whose ``doc_id`` may be one of ``ids`` (``left_semi``) or surely
    is none of them (``left_anti``): a broadcast of the ids' hash slots, at most
    ``SLOTS`` numbers. It only spares exact joins most of their rows."""
    slot = F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(SLOTS)).cast("int")
    slots = ids.select(slot.alias("__slot")).distinct()
    return rows.join(F.broadcast(slots), slot == F.col("__slot"), how)


def as_lists(rows: list[np.ndarray]) -> pa.ListArray:
    """An Arrow list column of unsigned numbers, as signed ones."""
    offsets = pa.array(np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32))
    flat = np.concatenate(rows) if rows else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(offsets, pa.array(flat.view(np.int64)))


def _overlap(shingles: Callable, digest: Callable) -> Callable:
    """Whole sets of both texts of every pair: common shingles, those that only x
    has, and those that only y has."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = batch.column("y").to_numpy()
            some, at, which = np.unique(y, return_index=True, return_inverse=True)
            ys = list(shingles(batch.column("yt").take(pa.array(at))))
            yd = [digest(s)[0] for s in ys]
            keep, sx, sy, both, besides, lacks = [], [], [], [], [], []
            want_x, want_y = batch.column("xd").to_numpy(), batch.column("yd").to_numpy()
            for i, (s, j) in enumerate(zip(shingles(batch.column("xt")), which.tolist())):
                # a repeated doc_id brings other texts along: they name other sets
                if digest(s)[0] != want_x[i] or yd[j] != want_y[i]:
                    continue
                mine = s[np.isin(s, ys[j], assume_unique=True, invert=True)]
                keep.append(i), sx.append(len(s)), sy.append(len(ys[j])), both.append(len(s) - len(mine)), besides.append(mine)
                lacks.append(ys[j][np.isin(ys[j], s, assume_unique=True, invert=True)])
            keep = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("x").take(keep), batch.column("y").take(keep),
                 *(pa.array(c, pa.int64()) for c in (sx, sy, both)), as_lists(besides), as_lists(lacks)],
                ["x", "y", "sx", "sy", "both", "besides", "lacks"])
    return run


def compared(texts: DataFrame, nodes: DataFrame, pairs: DataFrame, shingles: Callable, digest: Callable, pct: int) -> DataFrame:
    """x, y, sx, sy, both, linked, and what x has besides y and lacks of it, of node
    pairs (x, y). ``shingles`` gives the sorted sets of a text column, ``digest``
    two numbers that name one (the first is a node's ``d1``)."""
    name = nodes.select("node", "doc_id", "d1")
    named = settled(pairs.select("x", "y").join(name.toDF("x", "xid", "xd"), "x").join(name.toDF("y", "yid", "yd"), "y"))
    # a filter of bounded size, before any text is shuffled; the joins on the ids decide
    texts = near_ids(texts, named.select(F.explode(F.array("xid", "yid")).alias("doc_id")), "left_semi")
    rows = (named.join(texts.select(F.col("doc_id").alias("xid"), F.col("text").alias("xt")), "xid")
            .join(texts.select(F.col("doc_id").alias("yid"), F.col("text").alias("yt")), "yid"))
    found = rows.select("x", "y", "xd", "yd", "xt", "yt").mapInArrow(
        _overlap(shingles, digest), "x long, y long, sx long, sy long, both long, besides array<long>, lacks array<long>")
    return settled(found.withColumn("linked", F.expr(f"100 * both >= {pct} * (sx + sy - both)")),
                   "1 + size(besides) + size(lacks)")


def component_of(links: DataFrame, members: DataFrame) -> DataFrame:
    """(node, comp) of every member; comp is the smallest node."""
    named = components.connected(links.select(F.col("x").alias("a"), F.col("y").alias("b")))
    return settled(members.join(named, "node", "left").select("node", F.coalesce("component", "node").alias("comp")))


def joined(comp: DataFrame, links: DataFrame) -> DataFrame:
    """(node, comp) after ``links`` (x, y) between the components of ``comp``: only
    these links are followed, not those that made the components."""
    over = settled(links.join(comp.toDF("x", "a"), "x").join(comp.toDF("y", "b"), "y").where("a <> b").select("a", "b"))
    if over.isEmpty():
        return comp
    named = components.connected(over).toDF("comp", "component")
    return settled(comp.join(named, "comp", "left").select("node", F.coalesce("component", "comp").alias("comp")))


def differences(met: DataFrame, comp: DataFrame, pct: int) -> DataFrame:
    """Per list that spans components and member x of it: list, x, its size n, its
    ``own`` differences from the list's common text, its weight a, that text's size p,
    the least member y and the differences (times 100 + pct) that any partner ``needs``
    to share with it. ``met`` holds list (the pivot), x, n, size (the pivot's), besides
    and lacks; a list's pivot is no member of it."""
    rows = met.join(comp.toDF("x", "cx"), "x")
    lists = (rows.groupBy("list").agg(F.count(F.lit(1)).alias("k"), F.min("cx").alias("lo"), F.max("cx").alias("hi"))
             .where("lo < hi").select("list", "k"))
    rows = settled(rows.drop("cx").join(lists, "list"), "1 + size(besides) + size(lacks)")
    one = F.expr("explode(concat(transform(besides, t -> struct(t AS t, false AS inside)), "
                 "transform(lacks, t -> struct(t AS t, true AS inside))))")
    # what most members have besides the pivot or lack of it: fewer than twice a member's mean number
    flips = (rows.select("list", "k", one.alias("d")).groupBy("list", "k", "d.t", "d.inside").agg(F.count(F.lit(1)).alias("c"))
             .where("2 * c > k").groupBy("list")
             .agg(F.collect_list(F.expr("if(inside, null, t)")).alias("more"), F.collect_list(F.expr("if(inside, t, null)")).alias("less")))
    none = F.expr("cast(array() AS array<bigint>)")
    sized = settled(
        rows.join(flips, "list", "left").withColumns({c: F.coalesce(c, none) for c in ("more", "less")})
        .withColumn("over", F.expr("concat(array_except(besides, more), array_except(less, lacks))"))
        .withColumn("under", F.expr("concat(array_except(lacks, less), array_except(more, besides))"))
        .select("list", "x", "n", F.concat("over", "under").alias("own"),
                F.expr("size + size(more) - size(less)").alias("p"), F.expr(f"n * {pct} + size(under) * {100 + pct}").alias("a")), "1 + size(own)")
    least = sized.groupBy("list").agg(F.min("a").alias("low"), F.min_by("x", F.struct("a", "x")).alias("y"))
    return sized.join(least, "list").withColumn("needs", F.expr(f"a + low - p * {100 + pct}"))


def left_pairs(sized: DataFrame, comp: DataFrame, pct: int) -> DataFrame:
    """(x, y) of members of one list and different components that share a
    difference which any two that link share."""
    # a partner z has at least as many differences as it must share, which gives
    # a(z) >= a(x) - (100 - pct) |z|
    far = f"2 * a * {pct} - {(100 - pct) * 100} * n - p * {(100 + pct) * pct}"
    unit = (100 + pct) * pct
    need = F.expr(f"greatest((greatest(needs * {pct}, {far}) + {unit - 1}) div {unit}, 1)")
    # read twice below, so unpacked and written once
    apart = settled(sized.withColumn("need", need).where("need <= size(own)").join(comp.toDF("x", "cx"), "x")
                        .select("list", "x", "cx", "n", F.expr(f"2 * a - p * {100 + pct}").alias("w"), "need", F.explode("own").alias("t")))
    # differences within one component come first in the order: no two that are left can share them
    seen = (apart.groupBy("list", "t").agg(F.count(F.lit(1)).alias("c"), F.min("cx").alias("lo"), F.max("cx").alias("hi"))
            .where("lo < hi").select("list", "t", "c"))
    rest = F.row_number().over(Window.partitionBy("list", "x").orderBy(F.desc("c"), F.desc("t")))
    index = settled(apart.join(seen, ["list", "t"]).withColumn("rest", rest).where("rest >= need")
                        .select("list", "t", "x", "cx", "n", "w", "rest"))
    one, two = (index.select("list", "t", *[F.col(c).alias(f"{c}_{s}") for c in ("x", "cx", "n", "w", "rest")]) for s in "ab")
    # at the first shared difference, in their order, no more than the rest of both can be shared
    return (one.join(two, ["list", "t"])
            .where(f"x_a < x_b AND cx_a <> cx_b AND 100 * least(n_a, n_b) >= {pct} * greatest(n_a, n_b) "
                   f"AND w_a + w_b <= 2 * least(rest_a, rest_b) * {100 + pct}")
            .select(F.col("x_a").alias("x"), F.col("x_b").alias("y")).distinct())
