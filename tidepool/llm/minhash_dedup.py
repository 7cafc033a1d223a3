"""Op 11, MinHash near-dedup: universal hash minima, banding, signature
verification, components by alternating large-star and small-star.

A document's set holds its distinct shingles of four words (a shorter document:
its whole sequence as one). Two documents link when
``100 * |x & y| >= 80 * |x | y|``; every link is confirmed on the whole sets.

1. One pass over all texts: ``BANDS * ROWS`` minima of universal hashes
   ``a h + b mod 2^64`` of the shingles, one key per band of ``ROWS`` minima, and a
   signature of one byte per minimum. Two documents that link share a band but
   for a chance of at most ``(1 - 0.8^ROWS)^BANDS`` (1.3e-7).
2. Equal sets become one node, so copies never meet.
3. Pairs of a band are never all emitted. In each of ``MEETINGS`` rounds every node
   is compared with one pivot (a band's first node by a hash that changes with the
   round, of those the one it shares most bands with); the links give components,
   and most bands then hold one component only.
4. The members of a band that still spans components are all compared with one
   pivot, the node with most links in the component with most members, and
   described by what they lack of it and have besides it. Shingles that more than half of a pivot's members
   lack or have besides are flipped, so that the reference becomes the members'
   common text P, and a member x keeps the set D(x) of its own differences from
   P, m(x) of them missing shingles. As
   ``|x & z| = |P| - m(x) - m(z) + |D(x) & D(z)|``, x and z link exactly when
   ``180 |D(x) & D(z)| >= a(x) + a(z) - 180 |P|`` with ``a(x) = 80 |x| + 180 m(x)``.
   Where the right side is 0 or less for some pair, they link, and each of the two
   links in the same way to the member with the smallest ``a``: that one's links
   stand for them. All other links share a difference, and are met over one in a
   prefix of the differences, rarest first (prefix and position filter). So the hundreds of
   changed copies of one text, which share little besides it, never meet.
5. The pairs left are first compared by signature (at least ``AGREE`` equal
   minima; two that link have fewer with a chance of 1e-11), then on the whole sets.

Shingles are 64-bit hashes of the whole shingle; sets are named by 128 bits.

Defined cases: null or empty texts, and texts without words, have an empty set
and link with nothing; rows that repeat a ``doc_id`` with another text are
documents of their own (each with its own component, named by the smallest
``doc_id`` in it); rows without a ``doc_id`` have a null component, link with
nothing and are kept; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm import common, near_pairs
from tidepool.llm.words import Words, mix, text_buffer, windows
from tidepool.session import cut_lineage

SHINGLE = 4
PCT = 80
BANDS = 40
ROWS = 5
#: Equal minima (of BANDS * ROWS) below which a pair is not compared further.
AGREE = 120
#: Rounds in which every node of an open band meets one pivot (speed only).
MEETINGS = 1
#: Shingles hashed at a time, so that a hash's values stay in the CPU cache.
CHUNK = 1 << 16

_STEP = np.uint64(0x9E3779B97F4A7C15)
_A = mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * _STEP) | np.uint64(1)
_B = mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * _STEP + np.uint64(7))


def shingles(column: pa.Array) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text of a batch."""
    data, offsets = text_buffer(column)
    words = Words(data, offsets)
    h, first = words.hashes(lower=True), words.first
    grams, _ = windows(h, first, SHINGLE)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= SHINGLE:
            out.append(np.unique(grams[a:b - SHINGLE + 1]))
        elif b > a:
            whole = np.array([b - a], np.uint64)
            for w in h[a:b]:
                whole = mix((whole ^ w) * _STEP)
            out.append(whole)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def digest(s: np.ndarray) -> tuple[int, int]:
    """128 bits that name a sorted set."""
    place = np.arange(1, len(s) + 1, dtype=np.uint64)
    a = mix(s * np.uint64(0xFF51AFD7ED558CCD) + place).sum(dtype=np.uint64)
    b = mix((s + np.uint64(0x2545F4914F6CDD1D)) ^ (place * _STEP)).sum(dtype=np.uint64)
    return int(a.view(np.int64)), int(b.view(np.int64))


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """The minimum of every hash over every (non-empty) set: sets x hashes."""
    out = np.empty((len(sets), len(_A)), np.uint64)
    begin = 0
    while begin < len(sets):
        end, size = begin + 1, len(sets[begin])
        while end < len(sets) and size + len(sets[end]) <= CHUNK:
            size += len(sets[end])
            end += 1
        flat = np.concatenate(sets[begin:end])
        starts = np.cumsum([0] + [len(s) for s in sets[begin:end - 1]])
        for i in range(len(_A)):
            out[begin:end, i] = np.minimum.reduceat(flat * _A[i] + _B[i], starts)
        begin = end
    return out


def band_keys(low: np.ndarray) -> np.ndarray:
    low = low.reshape(len(low), BANDS, ROWS)
    acc = np.broadcast_to(mix(np.arange(1, BANDS + 1, dtype=np.uint64) * _STEP), low.shape[:2])
    for r in range(ROWS):
        acc = mix((acc ^ low[:, :, r]) * _STEP)
    return acc


def _first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = shingles(batch.column("text"))
        named = [digest(s) for s in sets]
        low = iter(minima([s for s in sets if len(s)]))
        keys, signs, none = [], [], np.zeros(0, np.uint64)
        for s in sets:
            m = next(low) if len(s) else None
            keys.append(none if m is None else band_keys(m[None])[0])
            signs.append(b"" if m is None else (mix(m) & np.uint64(255)).astype(np.uint8).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
             *(pa.array([d[i] for d in named], pa.int64()) for i in (0, 1)), near_pairs.as_lists(keys), pa.array(signs, pa.binary())],
            ["doc_id", "n_shingles", "d1", "d2", "bands", "sign"])


def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose signatures agree in at least AGREE places."""
    for batch in batches:
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in ("sx", "sy"))
        good = pa.array((a == b).sum(axis=1) >= AGREE)
        yield batch.select(["x", "y"]).filter(good)


def _compared(texts: DataFrame, nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    return near_pairs.compared(texts, nodes, pairs, shingles, digest, PCT)


def _open(shared: DataFrame, comp: DataFrame) -> DataFrame:
    """(band, node, comp) of the bands that span components."""
    tagged = shared.join(comp, "node")
    lists = tagged.groupBy("band").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("band")
    return cut_lineage(tagged.join(lists, "band", "left_semi"))


def _linked(texts: DataFrame, nodes: DataFrame, shared: DataFrame) -> DataFrame | None:
    """(node, comp) of every node of the band lists."""
    members = cut_lineage(shared.select("node").distinct())
    comp, rows, done, links = members.withColumn("comp", F.col("node")), shared, None, None
    for turn in range(MEETINGS):
        low = rows.groupBy("band").agg(F.min_by("node", F.struct(F.xxhash64("node", F.lit(turn)), "node")).alias("y"))
        met = rows.join(low, "band").where("node <> y").groupBy(F.col("node").alias("x"), "y").agg(F.count(F.lit(1)).alias("c"))
        if done is not None:
            met = met.join(done.select("x", "y"), ["x", "y"], "left_anti")
        met = cut_lineage(met.groupBy("x").agg(F.max_by("y", F.struct("c", -F.col("y"))).alias("y")))
        found = _compared(texts, nodes, met)
        done = found if done is None else done.unionByName(found)
        links = done.where("linked").select("x", "y")
        comp = near_pairs.component_of(links, members)
        rows = _open(shared, comp)
        if rows.isEmpty():
            return comp

    # each open band's pivot: of the component with most members in the band, the
    # node with most links (a component without links is one node)
    degree = (links.select(F.explode(F.array("x", "y")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("c"))
              .join(comp, "node").groupBy("comp").agg(F.max_by("node", F.struct("c", -F.col("node"))).alias("hub")))
    pivots = cut_lineage(rows.groupBy("band", "comp").agg(F.count(F.lit(1)).alias("c"))
                         .groupBy("band").agg(F.max_by("comp", F.struct("c", -F.col("comp"))).alias("comp"))
                         .join(degree, "comp", "left").select("band", F.coalesce("hub", "comp").alias("y")))
    wanted = (rows.select("band", F.col("node").alias("x")).join(pivots, "band").where("x <> y").select("x", "y").distinct()
              .join(done.select("x", "y", F.lit(True).alias("known")), ["x", "y"], "left"))
    more = cut_lineage(wanted.where("known IS NULL").select("x", "y"))
    away = _compared(texts, nodes, more)
    # a list: the members of all open bands of a pivot
    done = done.unionByName(away)
    met = (done.join(wanted.select("x", "y"), ["x", "y"], "left_semi").dropDuplicates(["x", "y"])
           .select(F.col("y").alias("list"), "x", F.col("sx").alias("n"), F.col("sy").alias("size"), "besides", "lacks"))
    sized = near_pairs.differences(met, comp, PCT)
    # enough in common whatever they share of their differences
    sure = sized.where("needs <= 0 AND x <> y").select("x", "y")
    links = links.union(away.where("linked").select("x", "y")).union(sure)
    comp = near_pairs.component_of(links, members)
    pairs = near_pairs.left_pairs(sized, comp, PCT)
    tried = done.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
    pairs = cut_lineage(pairs.join(tried, ["x", "y"], "left_anti"))
    sign = nodes.select("node", "sign")
    near = cut_lineage(pairs.join(sign.toDF("x", "sx"), "x").join(sign.toDF("y", "sy"), "y")
                       .mapInArrow(_agreeing, "x long, y long"))
    if near.isEmpty():
        return comp
    last = _compared(texts, nodes, near)
    return near_pairs.component_of(links.union(last.where("linked").select("x", "y")), members)


def dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every input row."""
    texts = common.columns(docs, doc_id="long", text="string").where("doc_id IS NOT NULL")
    every = common.columns(docs, doc_id="long", text="string")
    rows = cut_lineage(every.mapInArrow(
        _first_pass, "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>, sign binary"))
    key = ["n_shingles", "d1", "d2"]
    # one node per set; its number is fixed by the checkpoint
    nodes = cut_lineage(rows.where("doc_id IS NOT NULL AND n_shingles > 0").groupBy(*key)
                        .agg(F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands"), F.first("sign").alias("sign"))
                        .withColumn("node", F.monotonically_increasing_id()))
    index = nodes.select("node", F.explode("bands").alias("band"))
    several = index.groupBy("band").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("band")
    shared = cut_lineage(index.join(several, "band", "left_semi").select("band", "node"))
    comp = _linked(texts, nodes, shared)

    lone = nodes.select(*key, "node", "doc_id").join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    least = lone.groupBy("comp").agg(F.min("doc_id").alias("least"))
    named = lone.join(least, "comp").select(*key, "least")
    found = (rows.select("doc_id", *key).join(named, key, "left")
             .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id"))))
    return found.select("doc_id", "n_shingles", "component_id",
                        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def op11_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document, and which one is kept."""
    return dedup(common.table(spark, sf_dir, "documents"))
