"""Op 4, quality rules: repetition coverage.

Words are runs outside ``[\\x20\\x09-\\x0D]``. Rolling hashes of several
n-gram lengths are computed in numpy over a whole Arrow batch; a document is
judged by the share of its characters that lie inside repeated n-grams and
in repeated lines. Duplicates are searched inside one document only, so the
operator is one narrow pass without any shuffle, whatever the skew.

Defined cases: a null or empty text has no word (all counts 0, rejected);
``doc_id`` may be null or repeated, every input row gives one output row;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidepool.llm import common
from tidepool.llm.words import Words, per_text, text_buffer, windows

SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True

#: n-gram length -> largest allowed share (per cent) of word characters that
#: lie inside n-grams found twice or more in the document.
COVERAGE_PCT = {5: 60, 7: 55, 10: 50}
#: Largest allowed share (per cent) of word characters in repeated lines.
LINE_PCT = 30
#: Largest allowed number of symbols for each 100 words.
SYMBOL_PCT = 30
MIN_WORDS = 50
REPEAT_PCT = 50

SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
          "n_repeat_words long, dup_line_chars long, cover_5 long, cover_7 long, cover_10 long, "
          "base_failed boolean, kept boolean")


def _covered(h: np.ndarray, first: np.ndarray, n: int) -> np.ndarray:
    """True for words inside an n-word window found twice or more in the text."""
    key, ok = windows(h, first, n)
    owner = np.repeat(np.arange(len(first) - 1, dtype=np.uint64), np.diff(first))
    key += owner * np.uint64(0x9E3779B97F4A7C15)  # windows of different texts differ
    key = key[ok]
    ordered = np.sort(key)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    out = np.zeros(len(h) + 1, np.int64)
    if len(twice):
        slot = np.minimum(np.searchsorted(twice, key), len(twice) - 1)
        at = np.flatnonzero(ok)[twice[slot] == key]
        np.add.at(out, at, 1)
        np.add.at(out, at + n, -1)
    return np.cumsum(out[:-1]) > 0


def _lines(data: np.ndarray, offsets: np.ndarray, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text: lines with a word equal to an earlier one, and their word characters."""
    n = len(offsets) - 1
    count, size = np.zeros(n, np.int64), np.zeros(n, np.int64)
    raw = data.tobytes()
    for i in range(n):
        a, b = offsets[i], offsets[i + 1]
        lines = raw[a:b].split(b"\n")
        if len(lines) < 2 or len(set(lines)) == len(lines):
            continue
        seen, at = set(), int(a)
        for line in lines:
            if line in seen:
                if line.split():
                    count[i] += 1
                    size[i] += chars[at + len(line)] - chars[at]
            else:
                seen.add(line)
            at += len(line) + 1
    return count, size


def measure(column: pa.Array) -> dict[str, np.ndarray]:
    """All measures of a batch of texts."""
    data, offsets = text_buffer(column)
    words = Words(data, offsets)
    h, first = words.hashes(), words.first
    letter = ((data & 0xC0) != 0x80)  # first bytes of code points
    in_word = np.zeros(len(data) + 1, np.int64)
    np.add.at(in_word, words.start, 1)
    np.add.at(in_word, words.end, -1)
    letter &= np.cumsum(in_word[:-1]) > 0
    chars = np.concatenate([[0], np.cumsum(letter, dtype=np.int64)])
    size = chars[words.end] - chars[words.start]
    out = {"n_words": np.diff(first), "word_chars": chars[offsets[1:]] - chars[offsets[:-1]],
           "n_symbols": per_text(SYMBOL[data], offsets),
           "n_repeat_words": per_text(_covered(h, first, 3), first)}
    out["n_dup_lines"], out["dup_line_chars"] = _lines(data, offsets, chars)
    for n in COVERAGE_PCT:
        out[f"cover_{n}"] = per_text(np.where(_covered(h, first, n), size, 0), first)
    return out


def verdict(m: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(base_failed, kept), in whole numbers only."""
    base = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > REPEAT_PCT * m["n_words"])
    bad = base | (100 * m["dup_line_chars"] > LINE_PCT * m["word_chars"])
    bad |= 100 * m["n_symbols"] > SYMBOL_PCT * m["n_words"]
    for n, pct in COVERAGE_PCT.items():
        bad |= 100 * m[f"cover_{n}"] > pct * m["word_chars"]
    return base, ~bad


def _score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    for batch in common.parts(batches):
        m = measure(batch.column("text"))
        m["base_failed"], m["kept"] = verdict(m)
        cols = [batch.column("doc_id")] + [pa.array(m[c]) for c in names[1:]]
        yield pa.RecordBatch.from_arrays(cols, names)


def score(docs: DataFrame) -> DataFrame:
    """One row per document: the measures, ``base_failed`` and ``kept``."""
    return common.columns(docs, doc_id="long", text="string").mapInArrow(_score, SCHEMA)


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in common.parts(batches):
        yield batch.filter(pa.array(verdict(measure(batch.column("text")))[1]))


def keep(docs: DataFrame) -> DataFrame:
    """The documents that pass, with all their columns."""
    return docs.mapInArrow(_keep, docs.schema)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality verdict of every document."""
    return score(common.table(spark, sf_dir, "documents"))


def _oracle() -> str:
    sizes = (3, *COVERAGE_PCT)

    def gram(n: int) -> str:
        return " || ' ' || ".join(["w"] + [f"lead(w, {i}) OVER p" for i in range(1, n)])

    grams = ", ".join(f"{gram(n)} AS g{n}" for n in sizes)
    twice = ", ".join(f"g{n} IS NOT NULL AND count(*) OVER (PARTITION BY rid, g{n}) > 1 AS t{n}" for n in sizes)
    inside = ", ".join(f"bool_or(t{n}) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN {n - 1} PRECEDING "
                       f"AND CURRENT ROW) AS c{n}" for n in sizes)
    covers = ", ".join(f"sum(CASE WHEN c{n} THEN length(w) ELSE 0 END) AS cover_{n}" for n in COVERAGE_PCT)
    names = [c.split()[0] for c in SCHEMA.split(", ")][:10]
    wide = ", ".join(f"CAST(coalesce({c}, 0) AS BIGINT) AS {c}" for c in names[1:])
    rules = " AND ".join([f"100 * cover_{n} <= {pct} * word_chars" for n, pct in COVERAGE_PCT.items()])
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
l AS (SELECT rid, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
u AS (SELECT rid, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM l),
g AS (SELECT rid, w, i, {grams} FROM u WINDOW p AS (PARTITION BY rid ORDER BY i)),
k AS (SELECT rid, w, i, {twice} FROM g),
c AS (SELECT rid, w, {inside} FROM k),
a AS (SELECT rid, count(*) AS n_words, sum(length(w)) AS word_chars,
             sum(CASE WHEN c3 THEN 1 ELSE 0 END) AS n_repeat_words, {covers} FROM c GROUP BY rid),
s AS (SELECT rid, unnest(string_split(t, chr(10))) AS line,
             generate_subscripts(string_split(t, chr(10)), 1) AS i FROM d),
r AS (SELECT rid, line, row_number() OVER (PARTITION BY rid, line ORDER BY i) AS nth,
             length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS size FROM s),
b AS (SELECT rid, count(*) AS n_dup_lines, sum(size) AS dup_line_chars FROM r
      WHERE nth > 1 AND size > 0 GROUP BY rid),
m AS (SELECT doc_id, length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
             a.* EXCLUDE (rid), b.* EXCLUDE (rid)
      FROM d LEFT JOIN a USING (rid) LEFT JOIN b USING (rid)),
f AS (SELECT doc_id, {wide} FROM m),
v AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_PCT} * n_words AS base_failed FROM f)
SELECT *, NOT base_failed AND 100 * dup_line_chars <= {LINE_PCT} * word_chars
          AND 100 * n_symbols <= {SYMBOL_PCT} * n_words AND {rules} AS kept FROM v"""


OP4_SQL = _oracle()
