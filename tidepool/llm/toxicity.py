"""Op 10, toxicity: weak supervision.

Many weak voters - lexicons of words and patterns of word beginnings, mined
from labelled learning rows - vote on every learning document. A generative
label model estimates by expectation-maximisation how often each voter votes
each way on either class, and from what the classes leave unexplained the
correlations between voters, by which correlated voters share their weight.
The given label is one more voter. A linear (logistic, L1) classifier is
trained on the posterior labels and scores every document.

Learning sees rows whose crc32(doc_id as text) mod 5 is not 0: a sample of at
most about ``LABELLED`` labelled and ``UNLABELLED`` other rows, drawn evenly by a
hash of the id; these bounds are parameters. Only this bounded sample's
features reach the driver. A score sees the text alone; scoring is one narrow
pass over all documents without any shuffle.

Features are hashed: a word (a run of letters, lower-cased) and its first 4
and 5 bytes, each counted once a document.

Defined cases: a null or empty text has no feature and scores like the
classifier's constant; rows that repeat a ``doc_id`` are scored one by one; a
document with several labels learns their mean; labels without a document or
value are ignored; with no usable label of either class every score is 0; a
null ``doc_id`` is neither held out nor learned from; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm import common
from tidepool.llm.words import hash_spans, text_buffer

LABELLED = 12000
UNLABELLED = 4000
CELLS = 1 << 20
PREFIXES = (4, 5)
LEXICONS, PATTERNS, CLEAN = 12, 12, 4
LEAST_RATIO = 12.0
LEAST_ODDS = 3.5
GOLD = 0.98
ROUNDS = 25
#: A weight must explain more than so many documents of the sample.
L1_DOCS = 3.0
STEPS = 400

SCHEMA = "doc_id long, held_out boolean, score double, predicted int"

LETTER = np.zeros(256, bool)
LETTER[[*range(ord("a"), ord("z") + 1), *range(128, 256)]] = True


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(cell of every feature occurrence, its text), unordered, with repeats.
    Even cells are words, odd ones word beginnings."""
    data, offsets = text_buffer(pc.utf8_lower(column.fill_null("")))
    n = len(data)
    letter = LETTER[data]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = cut[0] = cut[n] = True
    before, after = cut[:n].copy(), cut[1:].copy()
    before[1:] |= ~letter[:-1]
    after[:-1] |= ~letter[1:]
    start = np.flatnonzero(letter & before)
    end = np.flatnonzero(letter & after) + 1
    owner = np.searchsorted(offsets, start, side="right") - 1
    half = np.uint64(CELLS // 2)
    cells = [(hash_spans(data, start, end) % half).astype(np.int64) * 2]
    owners = [owner]
    for k in PREFIXES:
        long = np.flatnonzero(end - start > k)
        cells.append((hash_spans(data, start[long], start[long] + k) % half).astype(np.int64) * 2 + 1)
        owners.append(owner[long])
    return np.concatenate(cells), np.concatenate(owners)


def _once(cells: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each (text, cell) once, by text."""
    key = np.unique(owner * CELLS + cells)
    return key % CELLS, key // CELLS


# --- label model and classifier (numpy, on the bounded sample) -----------------------

def mine(cell: np.ndarray, owner: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Log odds of every cell among labelled documents; nan where the cell says
    too little (likelihood ratio below ``LEAST_RATIO``)."""
    toxic, clean = label > 0.5, label <= 0.5  # nan: neither
    n_toxic, n_clean = toxic.sum(), clean.sum()
    a = np.bincount(cell[toxic[owner]], minlength=CELLS)
    b = np.bincount(cell[clean[owner]], minlength=CELLS)
    odds = np.log((a + 0.5) / (n_toxic + 1)) - np.log((b + 0.5) / (n_clean + 1))
    share = n_toxic / (n_toxic + n_clean)
    both = np.maximum(a + b, 1)
    ratio = 2 * (a * np.log(np.maximum(a, 1) / (both * share)) + b * np.log(np.maximum(b, 1) / (both * (1 - share))))
    odds[ratio < LEAST_RATIO] = np.nan
    return odds


def votes(cell: np.ndarray, owner: np.ndarray, n: int, odds: np.ndarray) -> np.ndarray:
    """n x voters: 1 toxic, -1 clean, 0 abstains. A lexicon or pattern voter
    holds a share of the telling cells; a clean voter holds a share of them all
    and speaks when none occurs."""
    out = np.zeros((n, LEXICONS + PATTERNS + CLEAN), np.int8)
    hit = np.nan_to_num(odds)[cell] >= LEAST_ODDS
    c, o = cell[hit], owner[hit]
    word = c % 2 == 0
    mixed = (c // 2) * 2654435761 % (1 << 32) >> 8
    out[o[word], mixed[word] % LEXICONS] = 1
    out[o[~word], LEXICONS + mixed[~word] % PATTERNS] = 1
    seen = np.zeros((n, CLEAN), bool)
    seen[o, mixed % CLEAN] = True
    out[:, LEXICONS + PATTERNS:] = np.where(seen, 0, -1)
    return out


def label_model(v: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Posterior probability of the toxic class. ``label``: nan where none."""
    known = ~np.isnan(label)
    prior = np.clip(label[known].mean(), 0.01, 0.99)
    gold = np.where(known, np.log(GOLD / (1 - GOLD)) * (2 * np.nan_to_num(label) - 1), 0.0)
    post = np.where(known, GOLD * np.nan_to_num(label) + (1 - GOLD) * (1 - np.nan_to_num(label)), prior)
    one_hot = np.stack([v == -1, v == 0, v == 1], 2).astype(np.float64)
    weight = np.ones(v.shape[1])
    for _ in range(ROUNDS):
        rates = []
        for w in (post, 1 - post):  # P(vote | class) of every voter
            r = np.tensordot(w, one_hot, axes=(0, 0)) + 0.1
            rates.append(r / r.sum(1, keepdims=True))
        ratio = np.log(rates[0]) - np.log(rates[1])
        # correlation left within the classes: correlated voters share their weight
        mean = [r[:, 2] - r[:, 0] for r in rates]
        left = v - (post[:, None] * mean[0] + (1 - post)[:, None] * mean[1])
        cov = left.T @ left / len(v)
        sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
        corr = np.clip(cov / np.outer(sd, sd), 0, 1)
        np.fill_diagonal(corr, 0)
        weight = 1 / (1 + corr.sum(1))
        prior = np.clip(post.mean(), 0.01, 0.99)
        fit = np.log(prior / (1 - prior)) + gold + (np.einsum("nvk,vk->nv", one_hot, ratio) * weight).sum(1)
        post = 1 / (1 + np.exp(-np.clip(fit, -30, 30)))
    return post


def classifier(cell: np.ndarray, owner: np.ndarray, n: int, target: np.ndarray,
               odds: np.ndarray) -> tuple[np.ndarray, float]:
    """L1 logistic regression on soft labels by accelerated proximal gradient
    steps; (weight per cell, constant)."""
    use = np.flatnonzero(np.abs(np.nan_to_num(odds)) >= LEAST_ODDS / 2)
    weights = np.zeros(CELLS)
    place = np.full(CELLS, -1)
    place[use] = np.arange(len(use))
    keep = place[cell] >= 0
    col, row = place[cell[keep]], owner[keep]
    size = np.bincount(row, minlength=n)
    w, c = np.zeros(len(use)), float(np.log(target.mean() / (1 - target.mean())))
    yw, yc, t = w.copy(), c, 1.0
    # each coordinate's step: rows share their curvature among `size` ones
    per_col = np.bincount(col, weights=size[row] + 1, minlength=len(use)) / (4 * n) + 1e-9
    for _ in range(STEPS):
        z = yc + np.bincount(row, weights=yw[col], minlength=n)
        err = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - target
        grad = np.bincount(col, weights=err[row], minlength=len(use)) / n
        step = 1 / per_col
        new = yw - step * grad
        new = np.sign(new) * np.maximum(np.abs(new) - step * L1_DOCS / n, 0)
        new_c = yc - err.mean() / (np.mean(size + 1) / 4)
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        yw, yc = new + (t - 1) / t2 * (new - w), new_c + (t - 1) / t2 * (new_c - c)
        w, c, t = new, new_c, t2
    weights[use] = w
    return weights, c


def fit(cell: np.ndarray, owner: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, float] | None:
    """Weights and constant from the sample's features and labels (nan: none)."""
    known = ~np.isnan(label)
    if not (label[known] > 0.5).any() or not (label[known] <= 0.5).any():
        return None
    odds = mine(cell, owner, label)
    post = label_model(votes(cell, owner, len(label), odds), label)
    return classifier(cell, owner, len(label), post, odds)


def score_batch(column: pa.Array, model: tuple[np.ndarray, float] | None) -> np.ndarray:
    if model is None:
        return np.zeros(len(column))
    weights, constant = model
    cell, owner = features(column)
    telling = weights[cell] != 0
    cell, owner = _once(cell[telling], owner[telling])
    z = constant + np.bincount(owner, weights=weights[cell], minlength=len(column))
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


# --- Spark -------------------------------------------------------------------------

def _drawn(share: float) -> Column:
    return F.pmod(F.xxhash64("doc_id", F.lit("draw")), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)))


def learn(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED,
          unlabelled: int = UNLABELLED) -> tuple[np.ndarray, float] | None:
    spark = docs.sparkSession
    known = (common.columns(labels, doc_id="long", toxic="double")
             .where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out())
             .groupBy("doc_id").agg(F.avg("toxic").alias("toxic")))
    texts = common.columns(docs, doc_id="long", text="string").where(F.col("doc_id").isNotNull() & ~held_out())
    n_labels, n_docs = known.count(), texts.count()
    if not n_labels:
        return None
    # evenly drawn: about `labelled` rows, and never twice as many
    drawn = known.where(_drawn(min(1.0, labelled / n_labels))).limit(2 * labelled).toPandas()
    ids = drawn.doc_id.to_numpy()
    order = np.argsort(ids)
    at = spark.sparkContext.broadcast((ids[order], drawn.toxic.to_numpy()[order]))
    others = min(1.0, unlabelled / max(1, n_docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, toxic = at.value
        for batch in batches:
            own = batch.column("doc_id").to_numpy()
            slot = np.minimum(np.searchsorted(ids, own), max(0, len(ids) - 1))
            has = ids[slot] == own if len(ids) else np.zeros(len(own), bool)
            take = np.flatnonzero(has | batch.column("other").to_numpy(zero_copy_only=False))
            if not len(take):
                continue
            part = batch.take(pa.array(take))
            cell, owner = _once(*features(part.column("text")))
            first = np.searchsorted(owner, np.arange(len(take) + 1)).astype(np.int32)
            label = np.where(has[take], toxic[slot[take]] if len(ids) else 0.0, np.nan)
            yield pa.RecordBatch.from_arrays(
                [pa.array(own[take]), pa.array(label),
                 pa.ListArray.from_arrays(pa.array(first), pa.array(cell.astype(np.int32)))],
                ["doc_id", "label", "cells"])

    sample = (texts.withColumn("other", _drawn(others)).mapInArrow(run, "doc_id long, label double, cells array<int>")
              .orderBy("doc_id").toArrow())
    cells = sample.column("cells").combine_chunks()
    flat = cells.flatten().to_numpy().astype(np.int64)
    size = pc.list_value_length(cells).to_numpy(zero_copy_only=False)
    return fit(flat, np.repeat(np.arange(len(size)), size), sample.column("label").to_numpy())


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from ``docs`` and ``labels``, score every document."""
    at = docs.sparkSession.sparkContext.broadcast(learn(docs, labels))
    rows = common.columns(docs, doc_id="long", text="string").withColumn("held_out", held_out())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = score_batch(batch.column("text"), at.value)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "held_out")), pa.array(s),
                 pa.array((s >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])
    return rows.mapInArrow(run, SCHEMA)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return score(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))
