"""Op 3, n-gram Jaccard join: adaptive multi-match prefixes.

A document's set holds its distinct shingles of five words (a shorter
document: its whole sequence as one). Two documents link when
``100 * |x & y| >= 75 * |x | y|``; the result names the connected component.

Plan:

1. One pass over all texts counts every shingle into a sketch of fixed size
   (``CELLS``); the ascending estimate, then the hash, is a total order of
   shingles (frequent ones last). Any total order gives the same links; this
   one keeps common passages out of the prefixes.
2. Each document emits a prefix of that order. With ``n`` shingles and at
   least ``ceil(0.75 n)`` of them shared by any partner, the first
   ``n - ceil(0.75 n) + m`` hold at least ``m`` shared ones. ``m`` (1 to
   ``MOST``) is chosen per document by estimated cost: a longer prefix means
   more index rows, but a partner must then match ``min(m_x, m_y)`` times.
3. Equal sets are collapsed into one node first, so copies never meet in the index.
4. Near copies come in large groups, whose pairs are never all emitted: in a
   first round every node meets only its best pivot (of every shingle's list one, by hash).
   Links are verified on the whole sets and joined into components; most lists then
   hold one component only.
5. A list that still spans components and has at most ``FEW`` members emits the pairs
   between components (a bounded number per index row), each once with the number of its
   lists: all that it shares, unless both nodes are in lists of the kind below as well.
   A longer one gets a pivot, the
   node with most links in the component with most members in the list. The lists of
   a pivot emit their pairs if these are no more than the shingles of their members
   (texts that share a passage), so that the pairs grow with the input.
   In all others all members are compared with the pivot and described by their
   differences from the members' common text, and two of them are met only over a
   difference that any two that link must share (``near_pairs.differences``,
   ``near_pairs.left_pairs``). So a group's badly changed members never meet all
   others, and no pair that links is missed.
6. All pairs left are verified on the whole sets if they share the required
   ``min(m_x, m_y)`` prefix shingles and these, with what their prefixes leave, can
   reach the threshold.

Shingles are 64-bit hashes of the whole shingle; two different shingles of
one candidate pair agree with probability 2^-64.

Defined cases: null or empty texts have an empty set and link with nothing;
equal rows link (same set); rows that repeat a ``doc_id`` with another text are
documents of their own (each with its own component, named by the smallest
``doc_id`` in it); rows without a ``doc_id`` have a null component and link with
nothing; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm import common, near_pairs
from tidepool.llm.words import Words, mix, text_buffer, windows
from tidepool.session import cut_lineage, settled

SHINGLE = 5
PCT = 75
#: Cells of the frequency sketch (4 bytes each), fixed at every input size.
CELLS = 1 << 20
#: Largest number of required prefix matches.
MOST = 4
#: Members of an open list up to which its pairs are emitted in any case (speed only).
FEW = 8


def least_overlap(n, pct: int = PCT):
    """ceil(pct/100 * n): shingles that any partner of an n-set shares."""
    return -(-n * pct // 100)


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of every text of a batch."""
    data, offsets = text_buffer(column)
    words = Words(data, offsets)
    h, first = words.hashes(lower=True), words.first
    grams, ok = windows(h, first, SHINGLE)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= SHINGLE:
            yield np.unique(grams[a:b - SHINGLE + 1])
        elif b > a:
            acc = np.array([b - a], np.uint64)
            for w in h[a:b]:
                acc = mix((acc ^ w) * np.uint64(0x9E3779B97F4A7C15))
            yield acc
        else:
            yield np.zeros(0, np.uint64)


def _digest(s: np.ndarray) -> tuple[int, int]:
    """128 bits of a sorted set."""
    place = np.arange(1, len(s) + 1, dtype=np.uint64)
    a = mix(s + place * np.uint64(0xC2B2AE3D27D4EB4F)).sum(dtype=np.uint64)
    b = mix((s ^ np.uint64(0xD6E8FEB86659FD93)) * (place * np.uint64(2) + np.uint64(1))).sum(dtype=np.uint64)
    return int(a.view(np.int64)), int(b.view(np.int64))


# --- pass 1: sizes, digests, sketch -----------------------------------------

def _first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cells = np.zeros(CELLS, np.int32)
    names = ["doc_id", "key", "n_shingles", "d1", "d2", "cells"]
    for batch in batches:
        rows = []
        sets = list(shingle_sets(batch.column("text")))
        for s in sets:
            rows.append((len(s), *_digest(s)))
        if sets:
            at = np.concatenate(sets) & np.uint64(CELLS - 1)
            cells += np.bincount(at.astype(np.int64), minlength=CELLS).astype(np.int32)
        n, d1, d2 = (pa.array([r[i] for r in rows], pa.int64()) for i in range(3))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("key"), n, d1, d2, pa.nulls(len(rows), pa.binary())], names)
    if cells.any():  # one row per task besides its documents
        yield pa.RecordBatch.from_arrays(
            [pa.array([0], pa.int64())] * 5 + [pa.array([zlib.compress(cells.tobytes(), 1)], pa.binary())], names)


def _sketch(parts: DataFrame) -> np.ndarray:
    """Sum of the tasks' sketches, added up in a tree on the executors."""
    rows = parts.where("cells IS NOT NULL").select("cells").rdd
    total = common.tree(rows.map(lambda r: np.frombuffer(zlib.decompress(r.cells), np.int32)), np.add)
    return np.zeros(CELLS, np.int32) if total is None else total


# --- pass 2: prefixes ---------------------------------------------------------

def in_order(s: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the set in the global order, its shingles' estimates)."""
    est = cells[(s & np.uint64(CELLS - 1)).astype(np.int64)]
    order = np.lexsort((s, est))
    return s[order], est[order]


def prefix(s: np.ndarray, cells: np.ndarray, noise: float) -> tuple[np.ndarray, int, int]:
    """(the first shingles of the set in the global order, required matches,
    the last one's estimate)."""
    s, est = in_order(s, cells)
    base = len(s) - least_overlap(len(s))
    excess = np.maximum(est[:base + MOST] - noise, 0.0)
    longest = min(MOST, len(s) - base)
    # index rows, plus partners that reach m matches (at most sum/m), each
    # of which costs about as much as 8 index rows to verify
    cost = [base + m + 8.0 * excess[:base + m].sum() / m for m in range(1, longest + 1)]
    m = int(np.argmin(cost)) + 1
    return s[:base + m], m, int(est[base + m - 1])


def _second_pass(cells_at, noise: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, d1, d2, least, tokens = [], [], [], [], []
            for s in shingle_sets(batch.column("text")):
                if len(s) == 0:
                    continue
                p, m, _ = prefix(s, cells_at.value, noise)
                a, b = _digest(s)
                size.append(len(s)), d1.append(a), d2.append(b), least.append(m), tokens.append(p)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(x, pa.int64()) for x in (size, d1, d2, least)), near_pairs.as_lists(tokens)],
                ["n_shingles", "d1", "d2", "least", "tokens"])
    return run


# --- candidates and verification ------------------------------------------------

def _compared(texts: DataFrame, nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    return near_pairs.compared(texts, nodes, pairs, shingle_sets, _digest, PCT)


def _possible(matches: Column, sx: Column, mx: Column, sy: Column, my: Column) -> Column:
    """Can the pair reach the threshold with ``matches`` common prefix tokens?

    Whichever prefix ends first in the global order, all common tokens up to
    there are counted, and the rest of that document is at most its size less
    its prefix; the larger of both bounds holds whichever it is.
    """
    need = F.ceil((sx + sy) * F.lit(PCT) / F.lit(100 + PCT) - F.lit(1e-9))
    rest_x = F.ceil(sx * F.lit(PCT) / F.lit(100)) - mx
    rest_y = F.ceil(sy * F.lit(PCT) / F.lit(100)) - my
    return ((matches + F.greatest(rest_x, rest_y) >= need) & (matches >= F.least(mx, my))
            & (F.least(sx, sy) * 100 >= F.greatest(sx, sy) * PCT))


def _reachable(pairs: DataFrame) -> DataFrame:
    return pairs.where(_possible(*[F.col(c) for c in ("matches", "sx", "mx", "sy", "my")]))


def _enough(pairs: DataFrame, shared: DataFrame) -> DataFrame:
    """The pairs (x, y) that share as many prefix shingles as their prefixes require."""
    some = pairs.select(F.explode(F.array("x", "y")).alias("node")).distinct()
    about = settled(shared.join(some, "node", "left_semi").groupBy("node")
                        .agg(F.collect_set("token").alias("t"), F.first("size").alias("s"), F.first("least").alias("m")))
    both = (pairs.join(about.toDF("x", "tx", "sx", "mx"), "x").join(about.toDF("y", "ty", "sy", "my"), "y")
            .withColumn("matches", F.size(F.array_intersect("tx", "ty"))))
    return _reachable(both).select("x", "y")


def _linked(texts: DataFrame, nodes: DataFrame, shared: DataFrame, sizes: DataFrame, rounds: int) -> DataFrame:
    """(node, comp) of every node of the index lists (token, node, its size and least)."""
    members = sizes.select("node")
    comp, done = members.withColumn("comp", F.col("node")), None
    for turn in range(rounds):
        low = shared.groupBy("token").agg(
            F.min_by(F.struct("node", "size", "least"), F.struct(F.xxhash64("node", F.lit(turn)), "node")).alias("y"))
        # sizes come with the lists, so that no row per pair is joined with its nodes
        met = (shared.join(low, "token").where("node <> y.node").groupBy(F.col("node").alias("x"), F.col("y.node").alias("y"))
               .agg(F.count(F.lit(1)).alias("matches"), F.first("size").alias("sx"), F.first("least").alias("mx"),
                    F.first("y.size").alias("sy"), F.first("y.least").alias("my")))
        # lists of other pivots may hold more matches: here the bound is a guess
        met = _reachable(met)
        if done is not None:
            met = (_sides(met, comp).where("cx <> cy")
                   .join(done.select("x", "y"), ["x", "y"], "left_anti"))
        met = settled(met.groupBy("x").agg(F.max_by("y", F.struct("matches", -F.col("y"))).alias("y")))
        seen = _compared(texts, nodes, met)
        new = seen.where("linked").select("x", "y")
        comp = near_pairs.component_of(new, members) if done is None else near_pairs.joined(comp, new)
        done = seen if done is None else done.unionByName(seen)
    links = done.where("linked").select("x", "y")

    # lists that span components
    open_ = settled(_open(shared, comp))
    if open_.isEmpty():
        return comp
    # each longer list's pivot (a component without links is one node)
    hubs = (links.select(F.explode(F.array("x", "y")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("c"))
            .join(comp, "node").groupBy("comp").agg(F.max_by("node", F.struct("c", -F.col("node"))).alias("hub")))
    pivots = settled(open_.where(F.col("k") > FEW).join(hubs.withColumnRenamed("comp", "main"), "main", "left")
                         .select("token", "k", F.coalesce("hub", "main").alias("y")))
    around = settled(shared.join(pivots, "token").where("node <> y").select(F.col("node").alias("x"), "y").distinct())
    dear = _dear(pivots, around, sizes)
    apart = not dear.isEmpty()
    short = open_.where(F.col("k") <= FEW).select("token").union(pivots.join(dear, "y", "left_anti").select("token"))
    if apart:
        wanted = settled(around.join(dear, "y", "left_semi").select("x", "y"))
        inside = wanted.select(F.col("x").alias("node")).union(dear).distinct().withColumn("inside", F.lit(True))
        # once per node, before any index row
        about = comp.join(inside, "node", "left").withColumn("inside", F.coalesce("inside", F.lit(False)))
    else:
        about = comp.withColumn("inside", F.lit(False))
    pairs = settled(_matched(settled(shared.join(short, "token").join(about, "node"))))
    near = pairs.where("NOT hidden").select("x", "y")
    tried = done.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))

    if apart:
        away = _compared(texts, nodes, wanted.join(done.select("x", "y"), ["x", "y"], "left_anti"))
        done = done.unionByName(away)
        tried = done.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
        lists = (done.join(wanted, ["x", "y"], "left_semi").dropDuplicates(["x", "y"])
                 .select(F.col("y").alias("list"), "x", F.col("sx").alias("n"), F.col("sy").alias("size"), "besides", "lacks"))
        sized = near_pairs.differences(lists, comp, PCT)
        # enough in common whatever they share of their differences
        comp = near_pairs.joined(comp, away.where("linked").select("x", "y")
                                 .union(sized.where("needs <= 0 AND x <> y").select("x", "y")))
        unsure = pairs.where("hidden").select("x", "y").union(near_pairs.left_pairs(sized, comp, PCT))
        unsure = settled(_sides(unsure, comp).where("cx <> cy").select("x", "y").distinct().join(tried, ["x", "y"], "left_anti"))
        near = _sides(near, comp).where("cx <> cy").select("x", "y").union(_enough(unsure, shared)).distinct()
    near = settled(near.join(tried, ["x", "y"], "left_anti"))
    if near.isEmpty():
        return comp
    return near_pairs.joined(comp, _compared(texts, nodes, near).where("linked").select("x", "y"))


def _open(shared: DataFrame, comp: DataFrame) -> DataFrame:
    """(token, k, main) of the lists that span components: members, and the component
    with most of them. Of two components whose sizes are too far apart no members
    link, so that their common list stays shut."""
    parts = (shared.join(comp, "node").groupBy("token", "comp")
             .agg(F.count(F.lit(1)).alias("c"), F.min("size").alias("lo"), F.max("size").alias("hi")))
    return (parts.groupBy("token")
            .agg(F.sum("c").alias("k"), F.count(F.lit(1)).alias("spans"), F.max("lo").alias("top"),
                 F.min_by("hi", F.struct("lo", "hi")).alias("reach"), F.max_by("comp", F.struct("c", -F.col("comp"))).alias("main"))
            .where(f"spans > 2 OR spans = 2 AND {PCT} * top <= 100 * reach").select("token", "k", "main"))


def _matched(few: DataFrame) -> DataFrame:
    """The pairs (x, y) between components that lists hold (token, node, comp, size,
    least, inside) and that can reach the threshold. All that a pair shares lies in
    these lists unless both are ``inside`` other open lists as well; such a pair stays,
    ``hidden``."""
    a, b = (few.select("token", *[F.col(c).alias(f"{c}_{s}") for c in ("node", "comp", "size", "least", "inside")]) for s in "ab")
    pairs = (a.join(b, "token")
             .where(f"node_a < node_b AND comp_a <> comp_b AND 100 * least(size_a, size_b) >= {PCT} * greatest(size_a, size_b)")
             .groupBy(F.col("node_a").alias("x"), F.col("node_b").alias("y"))
             .agg(F.count(F.lit(1)).alias("matches"), F.first("size_a").alias("sx"), F.first("least_a").alias("mx"),
                  F.first("size_b").alias("sy"), F.first("least_b").alias("my"), F.first(F.expr("inside_a AND inside_b")).alias("hidden")))
    return pairs.where(F.col("hidden") | _possible(*[F.col(c) for c in ("matches", "sx", "mx", "sy", "my")])).select("x", "y", "hidden")


def _dear(pivots: DataFrame, around: DataFrame, sizes: DataFrame) -> DataFrame:
    """The pivots y whose lists hold more pairs than their members and the pivot, once
    each, hold shingles: so neither way makes more rows than the members' sets."""
    pairs = pivots.groupBy("y").agg(F.sum(F.expr("k * (k - 1) / 2")).alias("pairs"))
    own = sizes.select(F.col("node").alias("y"), F.col("size").alias("sy"))
    sets = around.join(sizes.select(F.col("node").alias("x"), "size"), "x").groupBy("y").agg(
        F.count(F.lit(1)).alias("k"), F.sum("size").alias("sx"))
    return settled(pairs.join(sets, "y").join(own, "y").where("pairs > sx + k * sy").select("y"))


def _sides(pairs: DataFrame, comp: DataFrame) -> DataFrame:
    return pairs.join(comp.toDF("x", "cx"), "x").join(comp.toDF("y", "cy"), "y")


def _found(docs: DataFrame, rounds: int = 1) -> DataFrame:
    """doc_id, key (a hash of id and text), n_shingles, component_id and the key of the
    row that stands for the component, of every input row."""
    spark = docs.sparkSession
    # the many joins of short tables shuffle both sides: each broadcast is built and held on the driver
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    texts = (common.columns(docs, doc_id="long", text="string")
             .select("doc_id", "text", F.xxhash64("doc_id", "text").alias("key")))
    first = cut_lineage(texts.mapInArrow(
        _first_pass, "doc_id long, key long, n_shingles long, d1 long, d2 long, cells binary"))
    sketch = _sketch(first)
    rows = first.where("cells IS NULL").drop("cells")
    sets = ["n_shingles", "d1", "d2"]
    # one node per set; its number is fixed by the checkpoint
    nodes = settled(rows.where("doc_id IS NOT NULL AND n_shingles > 0").groupBy(*sets)
                        .agg(F.min(F.struct("doc_id", "key")).alias("r"))
                        .select(*sets, "r.doc_id", "r.key", F.monotonically_increasing_id().alias("node")))

    cells = spark.sparkContext.broadcast(sketch)
    noise = float(sketch.mean() + 3 * np.sqrt(sketch.mean()) + 1)
    named = texts.where("doc_id IS NOT NULL").select("doc_id", "text")
    full = named.mapInArrow(_second_pass(cells, noise), "n_shingles long, d1 long, d2 long, least long, tokens array<long>")
    index = (full.groupBy(*sets).agg(F.first(F.struct("least", "tokens")).alias("r"))
             .join(nodes.select(*sets, "node"), sets)
             .select("node", F.col("n_shingles").alias("size"), "r.least", F.explode("r.tokens").alias("token")))
    several = index.groupBy("token").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("token")
    shared = settled(index.join(several, "token", "left_semi"))
    sizes = settled(shared.select("node", "size", "least").distinct())
    comp = _linked(named, nodes, shared, sizes, rounds)

    lone = (nodes.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node")))
    least = lone.groupBy("comp").agg(F.min(F.struct("doc_id", "key")).alias("least"))
    by_set = lone.join(least, "comp").select(*sets, "least")
    return (rows.join(by_set, sets, "left")
            .select("doc_id", "key", "n_shingles",
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("least.doc_id", "doc_id")).alias("component_id"),
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("least.key", "key")).alias("stays")))


def join(docs: DataFrame, rounds: int = 1) -> DataFrame:
    """doc_id, n_shingles, component_id of every input row; ``rounds`` (at least
    one) of meetings with a pivot come first (speed only)."""
    return _found(docs, rounds).select("doc_id", "n_shingles", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents without near duplicates: of each component the row with
    the smallest ``doc_id`` stays, with all columns; of rows equal in ``doc_id`` and
    text one stays. Rows without a ``doc_id`` stay."""
    found = settled(_found(docs).where("doc_id IS NOT NULL").select("doc_id", "key", "stays"))
    gone = found.where("key <> stays").select("doc_id", "key")
    repeated = found.groupBy("doc_id", "key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("doc_id", "key")
    gone = settled(gone.distinct())
    # only rows that may be concerned are shuffled; the joins decide
    concerned = settled(gone.union(repeated).select("doc_id").distinct())
    named = docs.where("doc_id IS NOT NULL")
    sure = near_pairs.near_ids(named, concerned, "left_anti").unionByName(docs.where("doc_id IS NULL"))
    rest = (near_pairs.near_ids(named, concerned, "left_semi")
            .withColumn("__key", F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")))
            .withColumn("__id", F.col("doc_id").cast("long")))
    rest = (rest.join(gone.toDF("__id", "__key"), ["__id", "__key"], "left_anti")
            .dropDuplicates(["__id", "__key"]))
    return sure.unionByName(rest.select(*[F.col(f"`{c}`") for c in docs.columns]))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of every document."""
    return join(common.table(spark, sf_dir, "documents"))
