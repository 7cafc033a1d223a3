"""Op 7, language ID: multilingual mixture inference.

Every language has a table of n-gram probabilities (hashed byte 4-grams of
lower-cased words with their borders), counted over all learning rows. A
word's likelihood under a language is the tempered product over its n-grams;
a document is a mixture of languages. Expectation-maximisation estimates the
proportions over all languages; then the sets of the 1, 2, 3 ... most
proportionate languages are refitted and the set with the best penalised
likelihood (``PENALTY * k * ln(words + 1)``) is selected. The prediction is the
language with the largest proportion in it, that proportion its score.

Learning uses text and non-null ``lang`` of rows whose crc32(doc_id as text)
mod 4 is not 2; a prediction sees the text only. Counting keeps one table per
language and task, added up in a tree (``CELLS`` numbers per language, whatever
the input's size); prediction is one narrow pass without any shuffle.

Defined cases: a null text or one without a letter is ``und`` with score 0 (so
is every text when nothing was learned); ties go to the first language by
name; a null ``doc_id`` is neither held out nor learned from; every input row
gives one output row; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm import common
from tidepool.llm.words import text_buffer

CELLS = 1 << 16
SMOOTH = 0.5
#: Overlapping n-grams repeat their evidence: a word counts with this power.
TEMPER = 0.5
STEPS = 10
PENALTY = 3.0
#: The pipeline rejects documents whose main language has less than this share.
MIN_SHARE = 0.5
UNKNOWN = "und"

SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double, n_langs int, shares string"

LETTER = np.zeros(256, bool)
LETTER[[*range(ord("a"), ord("z") + 1), *range(128, 256)]] = True


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


class Grams:
    """N-gram cell of every letter byte of a batch; ``words`` are runs of
    letters: index of each word's first n-gram, and each text's first word."""

    def __init__(self, column: pa.Array):
        data, offsets = text_buffer(pc.utf8_lower(column.fill_null("")))
        n = len(data)
        letter = LETTER[data]
        clean = np.where(letter, data, 0x20).astype(np.uint32)
        padded = np.concatenate([[0x20], clean, [0x20, 0x20]]).astype(np.uint32)
        border = np.zeros(n + 1, bool)
        border[offsets] = border[0] = border[n] = True
        before, after = padded[:n].copy(), padded[2:n + 2].copy()
        before[border[:n]] = 0x20
        after[border[1:]] = 0x20
        last = np.concatenate([padded[3:], [0x20]])[:n].astype(np.uint32)
        last[after == 0x20] = 0x20
        last[:-1][border[2:]] = 0x20
        gram = before | clean << np.uint32(8) | after << np.uint32(16) | last << np.uint32(24)
        where = np.flatnonzero(letter)
        self.cell = ((gram[where] * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.int64)
        start = np.flatnonzero(letter & (before == 0x20))
        self.word = np.searchsorted(where, start)
        self.first = np.searchsorted(start, offsets)


# --- learning --------------------------------------------------------------------

def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[str, np.ndarray] = {}
    for batch in common.parts(batches):
        for lang in pc.unique(batch.column("lang")).to_pylist():
            own = batch.filter(pc.equal(batch.column("lang"), lang))
            n = np.bincount(Grams(own.column("text")).cell, minlength=CELLS)
            found[lang] = found[lang] + n if lang in found else n
    for lang, n in found.items():
        yield pa.RecordBatch.from_pydict({"lang": [lang], "n": [zlib.compress(n.astype(np.int64).tobytes(), 1)]})


def _add(a: dict[str, np.ndarray], b: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    return {k: a[k] + b[k] if k in a and k in b else a.get(k, b.get(k)) for k in {*a, *b}}


def learn(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """(languages by name, log probability per cell and language)."""
    rows = (common.columns(docs, doc_id="long", lang="string", text="string")
            .where(F.col("doc_id").isNotNull() & ~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull()))
    # counting and adding up in stages of their own: never two Python workers for one task
    parts = rows.select("lang", "text").mapInArrow(_count, "lang string, n binary").hint("rebalance").rdd
    total = common.tree(parts.map(lambda r: {r.lang: np.frombuffer(zlib.decompress(r.n), np.int64)}), _add) or {}
    names = sorted(k for k, n in total.items() if n.any())
    table = np.zeros((CELLS, len(names)), np.float32)
    for i, k in enumerate(names):
        n = total[k] + SMOOTH
        table[:, i] = np.log(n / n.sum())
    return names, table


# --- inference --------------------------------------------------------------------

def _em(e: np.ndarray, first: np.ndarray, share: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """(proportions, log likelihood) of every text; ``e`` has a row per word,
    ``share`` the first proportions (0: not in the set)."""
    n = np.diff(first)
    owner = np.repeat(np.arange(len(n)), n)
    for _ in range(steps):
        r = e * share[owner]
        r /= r.sum(1, keepdims=True)
        share = np.add.reduceat(r, first[:-1], axis=0) / n[:, None]
    fit = np.log((e * share[owner]).sum(1))
    return share, np.add.reduceat(fit, first[:-1])


def infer(column: pa.Array, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(proportions of the selected set, its size) of every text; size 0: no letter."""
    n_texts, n_langs = len(column), table.shape[1]
    shares, sizes = np.zeros((n_texts, n_langs)), np.zeros(n_texts, np.int64)
    g = Grams(column)
    n_words = np.diff(g.first)
    letters = pc.match_substring_regex(column.fill_null(""), r"\p{L}").to_numpy(zero_copy_only=False)
    live = np.flatnonzero((n_words > 0) & letters)
    if not n_langs or not len(live):
        return shares, sizes
    fit = np.add.reduceat(table[g.cell], g.word, axis=0).astype(np.float64) * TEMPER
    e = np.exp(np.maximum(fit - fit.max(1, keepdims=True), -60))

    def part(texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows = np.concatenate([np.arange(g.first[t], g.first[t + 1]) for t in texts])
        return e[rows], np.concatenate([[0], np.cumsum(n_words[texts])])

    own, first = part(live)
    full, _ = _em(own, first, np.full((len(live), n_langs), 1 / n_langs), STEPS)
    order = np.argsort(-full, axis=1, kind="stable")
    best = np.full(len(live), -np.inf)
    going = np.arange(len(live))
    for k in range(1, n_langs + 1):
        start = np.zeros((len(going), n_langs))
        inside = order[going, :k]
        np.put_along_axis(start, inside, np.maximum(np.take_along_axis(full[going], inside, 1), 1e-9), 1)
        start /= start.sum(1, keepdims=True)
        own, first = part(live[going])
        share, like = _em(own, first, start, STEPS if k > 1 else 0)
        like -= PENALTY * k * np.log(n_words[live[going]] + 1)
        better = like > best[going]
        going, share = going[better], share[better]
        best[going] = like[better]
        shares[live[going]], sizes[live[going]] = share, k
        if not len(going):
            break
    return shares, sizes


def _predict(names: list[str], at) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.parts(batches):
            shares, sizes = infer(batch.column("text"), at.value)
            pred, score, text = [], [], []
            for s, k in zip(shares, sizes):
                top = int(np.argmax(s)) if k else 0
                pred.append(names[top] if k else UNKNOWN)
                score.append(float(min(1.0, s[top])) if k else 0.0)
                text.append(",".join(f"{names[i]}:{s[i]:.3f}" for i in np.argsort(-s, kind="stable")[:k]))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "held_out")), pa.array(pred, pa.string()),
                 pa.array(score, pa.float64()), pa.array(sizes, pa.int32()), pa.array(text, pa.string())],
                ["doc_id", "held_out", "lang_pred", "score", "n_langs", "shares"])
    return run


def identify(docs: DataFrame) -> DataFrame:
    """Learn from ``docs`` (doc_id, text, lang) and predict every row."""
    names, table = learn(docs)
    at = docs.sparkSession.sparkContext.broadcast(table)
    rows = common.columns(docs, doc_id="long", text="string").withColumn("held_out", held_out())
    return rows.mapInArrow(_predict(names, at), SCHEMA)


def _keep(at, min_share: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.parts(batches):
            shares, sizes = infer(batch.column("text"), at.value)
            ok = (sizes > 0) & (shares.max(axis=1, initial=0.0) >= min_share)
            yield batch.filter(pa.array(ok))
    return run


def keep(docs: DataFrame, min_share: float = MIN_SHARE) -> DataFrame:
    """The documents with a known main language, with all their columns."""
    names, table = learn(docs)
    at = docs.sparkSession.sparkContext.broadcast(table)
    return docs.mapInArrow(_keep(at, min_share), docs.schema)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    return identify(common.table(spark, sf_dir, "documents"))
