"""Op 13, target-distribution importance resampling over hashed n-grams.

A document is drawn the likelier the more its words look like the target's
(``benchmark``) and the less like the raw corpus (``documents``).

* Features: a table of 256 bytes lower-cases A-Z and blanks every ASCII byte that
  is neither digit nor letter (``bytes.translate``); ``bytes.split`` yields the
  words. Bytes of other UTF-8 characters stay, so they belong to words. The
  crc32 of a word is the seed for the crc32 of `` next word``, which gives those
  of all runs of two and three words without building one string; a feature's
  bucket is its crc32 modulo ``BUCKETS``.
* Counts: each task reduces its texts in one Counter (at most ``BUCKETS`` keys)
  and emits it; Spark adds them up. All texts are counted.
* A bucket's gain is ``floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B))))`` (t of T
  features of the target and s of S of the corpus fall in it). The gains are at
  most ``BUCKETS`` numbers, the only thing that is broadcast.
* A document's weight is the sum of its features' gains; its score adds Gumbel
  noise from the sha256 of its id. The highest scores of the documents with at
  least ``MIN_WORDS`` words are drawn: a sample without replacement in proportion
  to exp(weight / 1000). Their order is a global one (range shuffle of ids and
  scores, :mod:`tidepool.operators.ranking`); nothing is sorted in one task.

Defined cases: a null or empty text has no features and weight 0; without
target or corpus every gain is what the formula gives for zeros; repeated rows
are scored and drawn each for itself, and rows equal in all results share the
order arbitrarily; a null ``doc_id`` gives a null score, is never drawn and does
not count among the N documents; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm import common
from tidepool.operators import ranking
from tidepool.session import cut_lineage

BUCKETS = 10000
#: Documents with fewer words are never drawn.
MIN_WORDS = 20
#: Share of those documents that is drawn, in per cent.
PCT = 5
SEED = "42"

KEPT = frozenset(b"0123456789abcdefghijklmnopqrstuvwxyz") | frozenset(range(0x80, 0x100))
#: The 256-byte table: lower case for A-Z, a blank for every separator.
TABLE = bytes(low if low in KEPT else 0x20 for low in (b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(TABLE).split()


def features(found: list[bytes], buckets: int = BUCKETS) -> np.ndarray:
    """The buckets of all runs of one, two and three words."""
    one = list(map(crc32, found))
    after = [b" " + w for w in found[1:]]
    two = list(map(crc32, after, one))
    three = list(map(crc32, after[1:], two))
    return np.array(one + two + three, np.uint32) % np.uint32(buckets)


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> dict[int, int]:
    """How many features of all texts fall in each bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally: Counter = Counter()
        for batch in batches:
            for t in batch.column("text"):
                tally.update(features(words(t.as_py()), buckets).tolist())
        yield pa.RecordBatch.from_arrays([pa.array(list(tally), pa.int32()), pa.array(list(tally.values()), pa.int64())],
                                         ["bucket", "n"])
    parts = texts.select("text").mapInArrow(run, "bucket int, n long")
    return {r.bucket: r.n for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect()}  # at most `buckets` rows


def gains(corpus: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> np.ndarray:
    s_all, t_all = sum(corpus.values()), sum(target.values())
    return np.array([math.floor(1000 * math.log(float(target.get(b, 0) + 1) * float(s_all + buckets)
                                                / (float(corpus.get(b, 0) + 1) * float(t_all + buckets))))
                     for b in range(buckets)], np.int64)


def _weights(gain_at, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = gain_at.value
        for batch in batches:
            n_words, n, weight = [], [], []
            for t in batch.column("text"):
                found = words(t.as_py())
                at = features(found, buckets)
                n_words.append(len(found)), n.append(len(at)), weight.append(int(gain[at].sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (n_words, n, weight))],
                ["doc_id", "n_words", "n_features", "weight"])
    return run


def resample(docs: DataFrame, target: DataFrame, pct: int = PCT, min_words: int = MIN_WORDS,
             buckets: int = BUCKETS, seed: str = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank (null where not drawn)
    of every row of ``docs``."""
    texts = common.columns(docs, doc_id="long", text="string")
    gain = gains(bucket_counts(texts, buckets), bucket_counts(common.columns(target, text="string"), buckets), buckets)
    weighed = texts.mapInArrow(_weights(docs.sparkSession.sparkContext.broadcast(gain), buckets),
                               "doc_id long, n_words long, n_features long, weight long")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")), 256)
    uniform = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + F.lit(0.5)) / F.lit(4294967296.0)
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log(uniform)))
    scored = cut_lineage(weighed.withColumn("score", F.col("weight") + noise))
    fit = (F.col("n_words") >= min_words) & F.col("doc_id").isNotNull()
    eligible = scored.where(fit)
    drawn = pct * eligible.count() // 100
    order = [("score", False), ("doc_id", True), ("weight", True), ("n_features", True), ("n_words", True)]
    ranked = ranking.row_numbers(eligible, order)
    return (ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
            .unionByName(scored.where(~fit).withColumn("rank", F.lit(None).cast("long"))))


def op13_importance_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's weight and score, and the rank of those drawn."""
    found = resample(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


#: The crc32 of all distinct features, byte by byte: one step of the recursion
#: takes the next byte of every feature that has one. The table of 256 remainders
#: is computed from the polynomial.
OP13_SQL = r"""
WITH RECURSIVE remainders AS (
  SELECT list(r ORDER BY b) AS t FROM (
    SELECT b, list_reduce([b] || range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS r
    FROM range(256) q(b))),
texts AS (
  SELECT 0 AS side, row_number() OVER () AS id, doc_id, coalesce(text, '') AS text FROM documents
  UNION ALL SELECT 1, row_number() OVER (), NULL, coalesce(text, '') FROM benchmark),
split AS (
  SELECT side, id, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
placed AS (SELECT side, id, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM split),
runs AS (
  SELECT side, id, w AS one, lead(w) OVER k AS b, lead(w, 2) OVER k AS c FROM placed WINDOW k AS (PARTITION BY side, id ORDER BY i)),
feats AS (
  SELECT side, id, one AS f FROM runs
  UNION ALL SELECT side, id, one || ' ' || b FROM runs WHERE b IS NOT NULL
  UNION ALL SELECT side, id, one || ' ' || b || ' ' || c FROM runs WHERE c IS NOT NULL),
counted AS (SELECT side, id, f, COUNT(*) AS n FROM feats GROUP BY ALL),
words AS (SELECT DISTINCT f, hex(encode(f)) AS h FROM counted),
step(f, h, i, c) AS (
  SELECT f, h, 0, CAST(4294967295 AS BIGINT) FROM words
  UNION ALL
  SELECT f, h, i + 1, xor(c >> 8, t[(xor(c, CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT)) & 255) + 1])
  FROM step, remainders WHERE 2 * i < length(h)),
buckets AS (SELECT f, xor(c, 4294967295) % 10000 AS b FROM step WHERE 2 * i = length(h)),
bagged AS (SELECT side, id, b, SUM(n) AS n FROM counted JOIN buckets USING (f) GROUP BY ALL),
sums AS (SELECT b, SUM(n) FILTER (side = 0) AS s, SUM(n) FILTER (side = 1) AS t FROM bagged GROUP BY b),
totals AS (SELECT coalesce(SUM(s), 0) AS s_all, coalesce(SUM(t), 0) AS t_all FROM sums),
gain AS (
  SELECT b, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (s_all + 10000)::DOUBLE
                                 / ((coalesce(s, 0) + 1)::DOUBLE * (t_all + 10000)::DOUBLE))) AS BIGINT) AS g
  FROM sums, totals),
weighed AS (SELECT id, SUM(n) AS n, SUM(n * g) AS weight FROM bagged JOIN gain USING (b) WHERE side = 0 GROUP BY id),
scored AS (
  SELECT doc_id, len(w) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
         CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('42:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE)
                                                         / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM split LEFT JOIN weighed USING (id) WHERE side = 0),
ranked AS (
  SELECT *, n_words >= 20 AND doc_id IS NOT NULL AS fit,
         row_number() OVER (PARTITION BY n_words >= 20 AND doc_id IS NOT NULL ORDER BY score DESC, doc_id, weight, n_features) AS r,
         (SELECT 5 * COUNT(*) // 100 FROM scored WHERE n_words >= 20 AND doc_id IS NOT NULL) AS drawn FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN fit AND r <= drawn THEN r END AS rank FROM ranked
"""
