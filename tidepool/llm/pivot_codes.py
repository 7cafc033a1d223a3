"""Op 12, product codes of vectors, assigned through LAESA pivots.

Every component x becomes the integer ``floor(4096 x)``; a vector is cut into
``PARTS`` equal parts, and each part position has a codebook of ``ENTRIES``
entries, refined over ``ROUNDS`` rounds (assign all parts, replace each entry by
the floored mean of its parts) and used for a last assignment.

LAESA: each part position has ``PIVOTS`` fixed pivots (the first entries of its
first codebook). Once, every part's distance to each pivot is computed and
written beside it, floored to an integer. In each round the pivots' distances
to the moving entries are computed (a few hundred numbers), and
``| d(part, pivot) - d(pivot, entry) | - 1`` is a lower bound of the distance of
part and entry that holds for the floored values too. Entries are tried in
ascending order of that bound with exact integer arithmetic, and a part leaves
the search as soon as its next bound reaches its best distance: the entries left
are strictly farther, so no tie is lost and the result is exact.

Plan: vectors, integers and pivot distances are written once; each round reads
them, broadcasts one codebook (PARTS x ENTRIES vectors, a bound free of the
input) and adds up sums and counts per entry, one row an entry and task. No
vector crosses a shuffle. The errors per label meet the rows by a join, whose
label side is broadcast only where it was counted to be small.

Defined cases: a row whose vector is null or empty, or holds a null, NaN or
infinite component, is dropped; so is one whose length differs from that of the
first kept vector (smallest ``vec_id``, null ids last; ties by the vector), which
must be a multiple of ``PARTS`` (else ValueError). Repeated rows count each for
itself, also as seeds; with fewer than ``ENTRIES`` rows the codebooks have as many
entries as there are rows. An empty table gives an empty result. Components
beyond ``LARGEST`` in size would overflow the exact integers: they are refused
with an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm import common
from tidepool.session import cut_lineage

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
PIVOTS = 4
#: Largest magnitude of a component: squared distances of whole vectors of up to
#: 256 components then fit 63 bits.
LARGEST = 16384.0
#: Labels up to which their sums are broadcast (16 bytes each).
LABELS_SENT = 100_000


def roots(squares: np.ndarray) -> np.ndarray:
    """floor(sqrt(n)) of non-negative integers, exact."""
    r = np.sqrt(squares.astype(np.float64)).astype(np.int64)
    r -= r * r > squares
    return r + ((r + 1) * (r + 1) <= squares)


def squared(x: np.ndarray, entry: np.ndarray) -> np.ndarray:
    gap = x - entry
    return np.einsum("...i,...i->...", gap, gap)


def assign(part: np.ndarray, near: np.ndarray, book: np.ndarray, hubs: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(nearest entry, its squared distance, exact evaluations) of every row of
    ``part`` (n x d), whose floored pivot distances are ``near`` (n x pivots);
    ties go to the lower index."""
    n, k = len(part), len(book)
    between = roots(squared(hubs[:, None, :], book[None, :, :]))  # pivots x entries
    bound = np.zeros((n, k), np.int64)
    for j in range(len(hubs)):
        np.maximum(bound, np.abs(near[:, j, None] - between[j]) - 1, out=bound)
    order = np.argsort(bound, axis=1, kind="stable")
    best = np.full(n, np.iinfo(np.int64).max)
    at = np.zeros(n, np.int64)
    open_, tried = np.arange(n), 0
    for turn in range(k):
        entry = order[open_, turn]
        low = bound[open_, entry]
        # the true distance exceeds the bound, so at best == bound^2 it loses too
        left = (low == 0) | (low * low < best[open_])
        open_, entry = open_[left], entry[left]
        if not len(open_):
            break
        d = squared(part[open_], book[entry])
        tried += len(open_)
        better = (d < best[open_]) | ((d == best[open_]) & (entry < at[open_]))
        best[open_[better]], at[open_[better]] = d[better], entry[better]
    return at, best, tried


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width).astype(np.int64)


def _kept(vectors: DataFrame) -> DataFrame:
    """Rows with a usable vector; ``x`` holds the integers."""
    good = F.expr("embedding IS NOT NULL AND size(embedding) > 0 AND "
                  "forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))")
    whole = F.expr(f"transform(embedding, x -> CASE WHEN abs(x) <= {LARGEST}D THEN CAST(floor(x * {SCALE}) AS INT) "
                   f"ELSE CAST(raise_error('embedding component beyond {LARGEST}') AS INT) END)")
    return vectors.where(F.coalesce(good, F.lit(False))).select("vec_id", "label", whole.alias("x"))


def _with_pivots(width: int, hubs: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("x"), width).reshape(batch.num_rows, PARTS, -1)
            near = np.stack([roots(squared(x, hubs[:, j])) for j in range(hubs.shape[1])], axis=2)
            flat = pa.array(near.reshape(-1).astype(np.int32))
            offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * (PARTS * hubs.shape[1]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), batch.column("x"), pa.ListArray.from_arrays(offsets, flat)],
                ["vec_id", "label", "x", "near"])
    return run


def _assigned(batch: pa.RecordBatch, books: np.ndarray, hubs: np.ndarray):
    """For every part position: (position, its parts, nearest entries, squared distances)."""
    n, width = batch.num_rows, books.shape[0] * books.shape[2]
    x = _matrix(batch.column("x"), width).reshape(n, PARTS, -1)
    near = _matrix(batch.column("near"), PARTS * hubs.shape[1]).reshape(n, PARTS, -1)
    for p in range(PARTS):
        at, best, _ = assign(x[:, p], near[:, p], books[p], hubs[p])
        yield p, x[:, p], at, best


def _sums(books_at, hubs: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = books_at.value
        total = np.zeros(books.shape, np.int64)
        count = np.zeros(books.shape[:2], np.int64)
        for batch in batches:
            for p, part, at, _ in _assigned(batch, books, hubs):
                np.add.at(total[p], at, part)
                count[p] += np.bincount(at, minlength=books.shape[1])
        part, entry = np.nonzero(count)
        offsets = pa.array(np.arange(len(part) + 1, dtype=np.int32) * books.shape[2])
        yield pa.RecordBatch.from_arrays(
            [pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(count[part, entry]),
             pa.ListArray.from_arrays(offsets, pa.array(total[part, entry].reshape(-1)))], ["part", "entry", "n", "total"])
    return run


def _codes(books_at, hubs: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = books_at.value
        for batch in batches:
            code = np.zeros((batch.num_rows, PARTS), np.uint8)
            error = np.zeros(batch.num_rows, np.int64)
            for p, _, at, best in _assigned(batch, books, hubs):
                code[:, p] = at
                error += best
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array([row.tobytes().hex() for row in code], pa.string()),
                 pa.array(error)], ["vec_id", "label", "code", "error"])
    return run


def refine(rows: DataFrame, books: np.ndarray, hubs: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """The codebooks (parts x entries x components) after ``rounds`` rounds over
    ``rows`` (x, near): each entry becomes the floored mean of its parts, an
    unused one stays."""
    sc = rows.sparkSession.sparkContext
    for _ in range(rounds):
        sent = sc.broadcast(books)
        parts = rows.select("x", "near").mapInArrow(_sums(sent, hubs), "part int, entry int, n long, total array<long>")
        each = parts.select("part", "entry", "n", F.posexplode("total").alias("i", "v"))
        # sums of 64-bit components over any number of rows: added as decimals
        found = (each.groupBy("part", "entry", "i").agg(F.sum("n").alias("n"), F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
                 .collect())  # PARTS x ENTRIES x components numbers at most
        books = books.copy()
        for r in found:
            books[r.part, r.entry, r.i] = int(r.v) // r.n
        sent.unpersist()
    return books


def _digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray | None]:
    """(vec_id, label, code, error, label_error and codebooks_sha256 of every kept
    row; the codebooks, None for an empty table)."""
    spark = vectors.sparkSession
    kept = _kept(common.columns(vectors, vec_id="long", embedding="array<double>", label="int"))
    seeds = kept.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(ENTRIES).select("x").collect()
    schema = "vec_id long, label int, code string, error long, label_error long, codebooks_sha256 string"
    if not seeds:
        return spark.createDataFrame([], schema), None
    width = len(seeds[0].x)
    if width % PARTS:
        raise ValueError(f"vectors of {width} components cannot be cut into {PARTS} equal parts")
    if any(len(r.x) != width for r in seeds):  # rare: seeds of the right length only
        seeds = (kept.where(F.size("x") == width).orderBy(F.col("vec_id").asc_nulls_last(), "x")
                 .limit(ENTRIES).select("x").collect())
    books = np.array([r.x for r in seeds], np.int64).reshape(len(seeds), PARTS, -1).transpose(1, 0, 2).copy()
    hubs = books[:, :PIVOTS].copy()
    rows = cut_lineage(kept.where(F.size("x") == width).mapInArrow(
        _with_pivots(width, hubs), "vec_id long, label int, x array<int>, near array<int>"))
    books = refine(rows, books, hubs, rounds)
    coded = cut_lineage(rows.mapInArrow(_codes(spark.sparkContext.broadcast(books), hubs),
                                        "vec_id long, label int, code string, error long"))
    sums = cut_lineage(coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).cast("long").alias("label_error"))
                       .withColumnRenamed("label", "__label"))
    if sums.count() <= LABELS_SENT:
        sums = F.broadcast(sums)
    return (coded.join(sums, F.col("label").eqNullSafe(F.col("__label")))
            .select("vec_id", "label", "code", "error", "label_error", F.lit(_digest(books)).alias("codebooks_sha256"))), books


def op12_pivot_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and errors of every usable vector of ``embeddings``."""
    return compress(common.table(spark, sf_dir, "embeddings"))[0].drop("label")


def _sql() -> str:
    """Plain k-means over the parts, one pair of steps a round; no pivots."""
    steps = []
    for r in range(ROUNDS + 1):
        steps.append(f"""
near{r} AS (
  SELECT id, part, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM (
    SELECT p.id, p.part, b.entry, list_sum(list_transform(list_zip(p.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
    FROM parts p JOIN book{r} b USING (part)) GROUP BY id, part)""")
        if r < ROUNDS:
            steps.append(f"""
mean{r} AS (
  SELECT part, entry, list(m ORDER BY i) AS v FROM (
    SELECT part, entry, i, CAST((SUM(x) - ((SUM(x) % COUNT(*)) + COUNT(*)) % COUNT(*)) // COUNT(*) AS BIGINT) AS m
    FROM (SELECT part, entry, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM near{r} JOIN parts USING (id, part))
    GROUP BY ALL) GROUP BY ALL),
book{r + 1} AS (SELECT b.part, b.entry, coalesce(m.v, b.v) AS v FROM book{r} b LEFT JOIN mean{r} m USING (part, entry))""")
    return f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS id, vec_id, label,
         list_transform(embedding, lambda x: CAST(floor(x::DOUBLE * {SCALE}) AS BIGINT)) AS x
  FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
parts AS (
  SELECT id, part, list_slice(x, part * (len(x) // {PARTS}) + 1, (part + 1) * (len(x) // {PARTS})) AS v
  FROM kept, range({PARTS}) q(part)),
book0 AS (SELECT part, id - 1 AS entry, v FROM parts WHERE id <= {ENTRIES}),{",".join(steps)},
coded AS (
  SELECT id, string_agg(lpad(lower(hex(entry)), 2, '0'), '' ORDER BY part) AS code, SUM(d)::BIGINT AS error
  FROM near{ROUNDS} GROUP BY id),
digest AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book{ROUNDS})
SELECT vec_id, code, error, CAST(SUM(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN kept USING (id), digest
"""


OP12_SQL = _sql()
