"""Op 8, document fingerprints: Lempel-Ziv phrases.

A text is parsed like LZ78 into dictionary phrases: the longest known phrase
plus one more token is a new phrase (tokens: words; a word beyond
``LONG_WORD`` characters, as in scripts without blanks, is read character by
character). The set of phrase hashes is the document's shape to a compressor;
its fingerprint is a signature of ``HASHES`` minimum hashes (the low 16 bits of
each: unequal minima agree with probability 2^-16 at every length), written in hex.
Likeness is the share of equal minima: an estimate of the Jaccard likeness of
the phrase sets. Equal texts have equal fingerprints.

The query also fingerprints an edited text: the last quarter of the code
points replaced by the first as many of the next document (ascending
``doc_id``; after the last: the first). Ids are cut into ranges; every
document goes to its range and the first one of a range to the range before
it as well. A task reads its ranges in descending order, so that a document's
successor is the one it has just read: one shuffle of the texts, one document
in memory, nothing collected but the ranges' lower ends.

Defined cases: a null text is an empty one; an empty text has the fingerprint
of an empty set, like another empty set (1) and unlike any other (0); rows that
repeat a ``doc_id`` have the same next document, the next larger ``doc_id``,
whose least text stands for it; a null ``doc_id`` has no next document: its
text is edited with nothing and ``near_next`` is null; a single ``doc_id`` is
its own next document; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm import common
from tidepool.llm.words import mix

HASHES = 64
LONG_WORD = 64
#: The fingerprint of an empty set.
NOTHING = "ffff" * HASHES
#: Ranges of ids for each shuffle partition.
RANGES = 4

_MASK = (1 << 64) - 1
_GROW = 0x9E3779B97F4A7C15
#: Odd multipliers and offsets of the minimum hashes, from a fixed rule.
_A = mix(np.arange(1, HASHES + 1, dtype=np.uint64)) | np.uint64(1)
_B = mix(np.arange(HASHES + 1, 2 * HASHES + 1, dtype=np.uint64))

SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double, n_phrases long, next_id long")


class _Tokens(dict):
    """Word -> 64-bit hash, for one batch."""

    def __missing__(self, word: str) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h


def tokens(text: str) -> list[str]:
    out = text.split()
    if out and max(map(len, out)) > LONG_WORD:
        out = [t for w in out for t in (w if len(w) > LONG_WORD else (w,))]
    return out


def phrases(text: str, known: _Tokens) -> np.ndarray:
    """Hashes of the distinct phrases of the parse."""
    seen: set[int] = set()
    here = 0
    for h in map(known.__getitem__, tokens(text)):
        here = ((here + h) * _GROW) & _MASK
        if here not in seen:
            seen.add(here)
            here = 0
    return np.fromiter(seen, np.uint64, len(seen))


def signature(found: np.ndarray) -> str:
    """Minimum hashes as hex; of no phrase: all ones."""
    if not len(found):
        return NOTHING
    # the high bits of a minimum near 0 as the set grows, the low ones do not
    low = (mix(found)[:, None] * _A + _B).min(axis=0) & np.uint64(0xFFFF)
    return low.astype(">u2").tobytes().hex()


def likeness(a: str, b: str) -> float:
    """Share of equal minima of two fingerprints."""
    if a != b and NOTHING in (a, b):
        return 0.0
    x, y = (np.frombuffer(bytes.fromhex(s), ">u2") for s in (a, b))
    return float((x == y).mean())


def edited(text: str, head: str) -> str:
    """``text`` with its last quarter replaced by as much of ``head``."""
    n = len(text) // 4
    return text[:len(text) - n] + head[:n]


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by range, peeked ones first, then by descending id."""
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    kinds = {"doc_id": pa.int64(), "n_chars": pa.int64(), "near_edited": pa.float64(), "near_next": pa.float64(),
             "n_phrases": pa.int64(), "next_id": pa.int64()}
    following: tuple[int, str, str] | None = None  # id, least text and its fingerprint
    current: tuple[int, str, str] | None = None
    place = None
    for batch in batches:
        known, rows = _Tokens(), []
        for part, peek, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("part", "peek", "doc_id", "text"))):
            found = phrases(text, known)
            one = signature(found)
            if doc_id is None:
                rows.append(_row(None, text, "", one, len(found), None, None, known))
                continue
            if part != place:
                place, following, current = part, None, None
            if current is None or (doc_id, peek) != current[0]:
                following, current = current, ((doc_id, peek), text, one)
            elif text < current[1]:
                current = (current[0], text, one)
            if not peek:
                rows.append(_row(doc_id, text, following[1], one, len(found), following[2], following[0][0], known))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], kinds.get(n, pa.string())) for i, n in enumerate(names)], names)


def _row(doc_id: int | None, text: str, head: str, one: str, n: int, beside: str | None, next_id: int | None,
         known: _Tokens) -> tuple:
    other = edited(text, head)
    two = one if other == text else signature(phrases(other, known))
    return (doc_id, len(text), hashlib.sha256(other.encode("utf-8")).hexdigest(), one, two, likeness(one, two),
            None if beside is None else likeness(one, beside), n, next_id)


def _lower_ends(ids: DataFrame, ranges: int) -> np.ndarray:
    """The least id of each of at most ``ranges`` ranges of about equally many ids."""
    placed = ids.distinct().repartitionByRange(ranges, "doc_id").groupBy(F.spark_partition_id().alias("part"))
    return np.array(sorted(r.low for r in placed.agg(F.min("doc_id").alias("low")).collect()), np.int64)


def fingerprint(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likenesses."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = common.columns(docs, doc_id="long", text="string").withColumn("text", F.coalesce("text", F.lit("")))
    lows = _lower_ends(texts.select("doc_id").where("doc_id IS NOT NULL"), RANGES * parts)
    n = max(1, len(lows))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every row with its id's range; the first id of a range once more, as
        a peek, with the range before it."""
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            at = np.searchsorted(lows, ids, side="right") - 1
            first = np.flatnonzero(lows[at] == ids)
            for rows, part, peek in ((batch, at, False), (batch.take(pa.array(first)), (at[first] - 1) % n, True)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part.astype(np.int32)), pa.array(np.full(len(part), peek)), *rows.columns],
                    ["part", "peek", "doc_id", "text"])

    known = (texts.where("doc_id IS NOT NULL")
             .mapInArrow(place, "part int, peek boolean, doc_id long, text string"))
    alone = texts.where("doc_id IS NULL").select(
        F.expr(f"cast(pmod(xxhash64(text), {n}) as int)").alias("part"), F.lit(False).alias("peek"), "doc_id", "text")
    rows = known.unionByName(alone) if len(lows) else alone
    return (rows.repartition(parts, "part")
            .sortWithinPartitions("part", F.desc("peek"), F.desc("doc_id"))
            .mapInArrow(_describe, SCHEMA))


def op8_lz_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and likenesses of every document."""
    return fingerprint(common.table(spark, sf_dir, "documents"))
