"""Op 2, token counts: map-side two-tier lookup.

A SentencePiece BPE model never merges across a border "letter, then word
mark" or next to a line end when no piece spans one (checked when the model
is loaded), so a text's tokens are the sum over its pre-tokens: runs of
blanks with the word behind them, and line ends. Pre-token lengths are looked
up, never shuffled:

* tier 1: a compact table (64-bit hash -> length) of the most frequent
  pre-tokens, at most ``TABLE`` entries, broadcast. It is built from counts
  over all documents: every task keeps a bounded heavy-hitter summary and
  the summaries are merged in a tree; it decides speed only, never results.
* tier 2: misses go to a bounded cache in each Python worker and are encoded
  by the library when new.

A model whose pieces do span such borders (or has user-defined symbols) is
counted text by text by the library. Pre-tokens are told apart by 64-bit
hashes: with the at most ``TABLE + CACHE`` known ones, one wrong length is
expected in about 3e13 distinct pre-tokens.

Defined cases: a null or empty text has 0 bytes and 0 tokens; every input row
gives one output row; an empty table gives an empty result.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from tidepool.llm import common
from tidepool.llm.words import hash_spans, text_buffer

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
TABLE = 1 << 15
CACHE = 1 << 19

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"

MARK = "▁"
#: Merged behind a serialised model, these bytes switch off the word mark
#: that the library puts before every text (normalizer_spec, field 3).
NO_PREFIX = b"\x1a\x02\x18\x00"


def model_path(path: str | None) -> str:
    """``path``, or the public vocabulary of this machine's tokenizer package."""
    if path is not None:
        return path
    import public_tokenizers
    return public_tokenizers.path(MODEL)


class Encoder:
    """The library's processor and what splitting texts needs to know of it."""

    def __init__(self, path: str):
        import sentencepiece
        with open(path, "rb") as f:
            raw = f.read()
        self.whole = sentencepiece.SentencePieceProcessor(model_proto=raw)
        self.part = sentencepiece.SentencePieceProcessor(model_proto=raw + NO_PREFIX)
        pieces = [self.whole.id_to_piece(i) for i in range(self.whole.get_piece_size())
                  if not (self.whole.is_control(i) or self.whole.is_byte(i) or self.whole.is_unknown(i))]
        probe = " Å Å ﬁ "  # a normaliser would rewrite or trim this
        self.splits = (not any(re.search(f"[^{MARK}]{MARK}|.\n|\n.", p, re.S) for p in pieces)
                       and not any("\n" in p for p in pieces)
                       and self.whole.normalize(probe) == MARK + probe.replace(" ", MARK)
                       and len(self.part.encode("a b")) == len(self.part.encode("a")) + len(self.part.encode(" b")))

    def lengths(self, pretokens: list[bytes]) -> list[int]:
        return [len(x) for x in self.part.encode([t.decode() for t in pretokens], num_threads=1)]


_ENCODERS: dict[str, Encoder] = {}
_CACHE: dict[str, dict[int, int]] = {}


def encoder(path: str | None) -> Encoder:
    """The worker's encoder for a model file, loaded once."""
    at = model_path(path)
    if at not in _ENCODERS:
        _ENCODERS[at] = Encoder(at)
    return _ENCODERS[at]


class Pretokens:
    """Pre-tokens of a batch: spans over ``data`` (each text behind one blank)."""

    def __init__(self, column: pa.Array):
        marked = pc.binary_join_element_wise(pa.scalar(" ", column.type), column, pa.scalar("", column.type))
        self.data, self.offsets = data, offsets = text_buffer(marked)
        n = len(data)
        cut = np.zeros(n + 1, bool)
        cut[offsets] = cut[0] = cut[n] = True
        blank, line = data == 0x20, data == 0x0A
        cut[1:n] |= blank[1:] & ~blank[:-1]  # a run of blanks opens a pre-token
        cut[:n] |= line
        cut[1:] |= line
        border = np.flatnonzero(cut)
        self.start, self.end = border[:-1], border[1:]
        self.first = np.searchsorted(self.start, offsets)
        self.hash = hash_spans(data, self.start, self.end)

    def bytes_at(self, which: np.ndarray) -> list[bytes]:
        return [self.data[a:b].tobytes() for a, b in zip(self.start[which], self.end[which])]


def _has_mark(column: pa.Array) -> np.ndarray:
    """Texts that spell the word mark themselves are left to the library."""
    return pc.match_substring(column, MARK).fill_null(False).to_numpy(zero_copy_only=False)


def count_batch(column: pa.Array, path: str | None, table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Tokens of every text of a batch."""
    enc = encoder(path)
    if column.null_count:
        column = column.fill_null("")
    if not enc.splits:
        return np.array([len(enc.whole.encode(t.as_py())) for t in column], np.int64)
    p = Pretokens(column)
    known, size = table
    out = np.zeros(len(p.start), np.int64)
    hit = np.zeros(len(p.start), bool)
    if len(known):
        slot = np.minimum(np.searchsorted(known, p.hash), len(known) - 1)
        hit = known[slot] == p.hash
        out[hit] = size[slot[hit]]
    miss = np.flatnonzero(~hit)
    if len(miss):
        cache = _CACHE.setdefault(model_path(path), {})
        keys, at, back = np.unique(p.hash[miss], return_index=True, return_inverse=True)
        names = keys.tolist()
        new = [i for i, k in enumerate(names) if k not in cache]
        if len(cache) + len(new) > CACHE:
            cache.clear()
            new = list(range(len(names)))
        if new:
            found = enc.lengths(p.bytes_at(miss[at[new]]))
            cache.update(zip([names[i] for i in new], found))
        out[miss] = np.array([cache[k] for k in names], np.int64)[back]
    total = np.concatenate([[0], np.cumsum(out)])
    counts = total[p.first[1:]] - total[p.first[:-1]]
    counts[pc.binary_length(column).to_numpy(zero_copy_only=False) == 0] = 0
    for i in np.flatnonzero(_has_mark(column)):
        counts[i] = len(enc.whole.encode(column[int(i)].as_py()))
    return counts


# --- tier 1 -----------------------------------------------------------------

Summary = dict[int, tuple[int, bytes]]  # hash -> (count, pre-token)


def _merge(a: Summary, b: Summary, keep: int = 2 * TABLE) -> Summary:
    """Counts added; only the ``keep`` most frequent stay."""
    for k, (n, t) in b.items():
        a[k] = (a[k][0] + n, t) if k in a else (n, t)
    return _trim(a, keep)


def _trim(a: Summary, keep: int) -> Summary:
    if len(a) <= keep:
        return a
    return dict(sorted(a.items(), key=lambda x: (-x[1][0], x[0]))[:keep])


def _summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Summary = {}
    for batch in batches:
        p = Pretokens(batch.column("text").fill_null(""))
        keys, at, n = np.unique(p.hash, return_index=True, return_counts=True)
        often = np.flatnonzero(n >= 2)  # one-offs of a batch never make the table
        for k, m, i in zip(keys[often].tolist(), n[often].tolist(), at[often].tolist()):
            old = seen.get(k)
            seen[k] = (m, p.data[p.start[i]:p.end[i]].tobytes()) if old is None else (old[0] + m, old[1])
        if len(seen) > 8 * TABLE:
            seen = _trim(seen, 2 * TABLE)
    yield pa.RecordBatch.from_pydict({"summary": [pickle.dumps(_trim(seen, 2 * TABLE))]})


def frequent(docs: DataFrame, path: str | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Tier 1: (sorted hashes, lengths) of at most ``TABLE`` frequent
    pre-tokens, counted over every text of ``docs``."""
    enc = encoder(path)
    empty = np.zeros(0, np.uint64), np.zeros(0, np.uint8)
    if not enc.splits:
        return empty
    parts = docs.select("text").mapInArrow(_summarise, "summary binary").rdd.map(lambda r: pickle.loads(r.summary))
    top = _trim(parts.treeAggregate({}, _merge, _merge, depth=3), TABLE)
    if not top:
        return empty
    keys = np.array(sorted(top), np.uint64)
    size = np.array(enc.lengths([top[k][1] for k in keys.tolist()]), np.int64)
    return keys, size


def counter(docs: DataFrame, path: str | None, limit: int) -> Callable:
    table = docs.sparkSession.sparkContext.broadcast(frequent(docs, path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text")
            n = count_batch(text, path, table.value)
            size = pc.binary_length(text.fill_null("")).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), size, pa.array(n), pa.array(n > limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])
    return run


def count(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """Bytes and tokens of every text; ``path`` names a SentencePiece model
    that every executor can open."""
    own = common.columns(docs, doc_id="long", text="string")
    return own.mapInArrow(counter(own, path, limit), SCHEMA)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document."""
    return count(common.table(spark, sf_dir, "documents"))
