"""Op 6, SentencePiece encoding and decoding: shared-prefix Viterbi.

A text is encoded into the pieces of a SentencePiece model with the largest
sum of scores (the unigram rule; ties: fewer pieces, then the longest last
piece). No piece spans a border "letter, then word mark" (checked when the
model is loaded), so the best encoding of a text is that of its marked words,
one behind the other. Each Arrow batch takes its distinct marked words that
the worker does not know yet, sorts them - the order of a depth-first walk of
their trie - and runs Viterbi's forward pass down that walk: scores of the
prefix shared with the word before are reused, only the new suffix is
computed. Encodings are kept in a bounded cache in each worker.

Characters without a piece become byte pieces (where the model has them) at
the library's price, the least score less 10 a character. With a BPE model's
file, like the public vocabulary used here, the pieces' scores are their merge
ranks; the encoding is the best one under those scores, not the merge order's.
Both decode to the same text.

Decoding puts the pieces' bytes together with numpy, one batch at a time.

Defined cases: null and empty texts have no pieces, and decode to empty ones; the word
mark U+2581 in a text reads as a blank, like in the library; every input row
gives one output row; a model without the checked borders is encoded text by
text; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.llm import common
from tidepool.llm.token_counts import MARK, Pretokens, encoder, model_path

CACHE = 1 << 18
WORD = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")


class Lattice:
    """Pieces and scores of a model, and the forward pass over sorted words."""

    def __init__(self, path: str):
        enc = encoder(path)
        sp = enc.whole
        self.splits, self.normalize = enc.splits, sp.normalize
        self.pieces: dict[str, tuple[int, float]] = {}
        self.bytes: dict[int, int] = {}
        raw: list[bytes] = []
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                raw.append(bytes([int(piece[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                raw.append(b"" if sp.is_control(i) else " ⁇ ".encode())
            else:
                self.pieces[piece] = (i, sp.get_score(i))
                raw.append(piece.replace(MARK, " ").encode())
        self.unknown = sp.unk_id()
        self.trie: dict = {}  # character -> (node below, id, score) or (.., None, None)
        for piece, (i, s) in sorted(self.pieces.items()):  # a prefix before its longer ones
            node = self.trie
            for char in piece[:-1]:
                node = node.setdefault(char, ({}, None, None))[0]
            node[piece[-1]] = (node.get(piece[-1], ({}, None, None))[0], i, s)
        self.price = min((s for _, s in self.pieces.values()), default=0.0) - 10.0
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.raw_end = np.cumsum([len(r) for r in raw])
        self.raw_size = np.diff(self.raw_end, prepend=0)

    def encode_sorted(self, words: list[str]) -> list[list[int]]:
        """Pieces of every word; ``words`` ascending, each once.

        ``alive[d]`` holds the pieces still open after d characters, as (start,
        node of the piece trie), longest first."""
        price, root = self.price, self.trie
        score, count, size, alive = [0.0], [0], [0], [[(0, root)]]  # by end place; size 0: no piece
        out, before = [], ""
        for word in words:
            shared, most = 0, min(len(before), len(word))
            while shared < most and before[shared] == word[shared]:
                shared += 1
            for kept in (score, count, size, alive):
                del kept[shared + 1:]
            for end in range(shared + 1, len(word) + 1):
                char, best, fewest, last, still = word[end - 1], float("-inf"), 0, 0, []
                for start, node in alive[end - 1]:
                    found = node.get(char)
                    if found is None:
                        continue
                    node, _, gain = found
                    if gain is not None:
                        s, c = score[start] + gain, count[start] + 1
                        if s > best or (s == best and c < fewest):
                            best, fewest, last = s, c, end - start
                    if node:
                        still.append((start, node))
                if score[end - 1] + price > best:
                    best, fewest, last = score[end - 1] + price, count[end - 1] + 1, 0
                still.append((end, root))
                score.append(best)
                count.append(fewest)
                size.append(last)
                alive.append(still)
            out.append(self._back(word, size))
            before = word
        return out

    def _back(self, word: str, size: list[int]) -> list[int]:
        ids: list[int] = []
        end = len(word)
        while end:
            n = size[end]
            if n:
                ids.append(self.pieces[word[end - n:end]][0])
            elif self.bytes:
                ids.extend(self.bytes[b] for b in reversed(word[end - 1].encode()))
            else:
                ids.append(self.unknown)
            end -= n or 1
        return ids[::-1]

    def encode_text(self, text: str) -> list[int]:
        """One text by itself."""
        if not text:
            return []
        marked = self.normalize(text)
        words = WORD.findall(marked) if self.splits else [marked]
        distinct = sorted(set(words))
        known = dict(zip(distinct, self.encode_sorted(distinct)))
        return [i for w in words for i in known[w]]


_LATTICES: dict[str, Lattice] = {}
_KNOWN: dict[str, dict[int, bytes]] = {}


def lattice(path: str | None) -> Lattice:
    at = model_path(path)
    if at not in _LATTICES:
        _LATTICES[at] = Lattice(at)
    return _LATTICES[at]


def encode_batch(column: pa.Array, path: str | None = None) -> pa.ListArray:
    """Piece ids of every text of a batch."""
    model = lattice(path)
    texts = column.fill_null("")
    alone = {}
    if model.splits:
        marked = pc.match_substring(texts, MARK).to_numpy(zero_copy_only=False)
        alone = {int(i): model.encode_text(texts[int(i)].as_py()) for i in np.flatnonzero(marked)}
    else:
        alone = {i: model.encode_text(t) for i, t in enumerate(texts.to_pylist())}
    skip = np.zeros(len(texts), bool)
    skip[list(alone)] = True
    skip |= pc.binary_length(texts).to_numpy(zero_copy_only=False) == 0
    p = Pretokens(pc.if_else(pa.array(skip), "", texts))
    known = _KNOWN.setdefault(model_path(path), {})
    keys, at, back = np.unique(p.hash, return_index=True, return_inverse=True)
    names = keys.tolist()
    new = [i for i, k in enumerate(names) if k not in known]
    if len(known) + len(new) > CACHE:
        known.clear()
        new = list(range(len(names)))
    words = [b.decode().replace(" ", MARK) for b in p.bytes_at(at[new])]
    order = sorted(range(len(new)), key=words.__getitem__)
    for i, ids in zip(order, model.encode_sorted([words[i] for i in order])):
        known[names[new[i]]] = np.array(ids, np.int32).tobytes()
    parts = [known[k] for k in names]
    flat = np.frombuffer(b"".join(parts), np.int32)
    size = np.array([len(b) // 4 for b in parts], np.int64)
    end = np.cumsum(size)
    own = size[back]
    total = np.concatenate([[0], np.cumsum(own)])
    ids = flat[np.arange(total[-1]) - np.repeat(total[:-1] - (end - size)[back], own)] if len(back) else flat[:0]
    bounds = total[p.first]
    if not skip.any():
        return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids))
    lists = [alone.get(i, ()) if skip[i] else ids[bounds[i]:bounds[i + 1]] for i in range(len(texts))]
    return pa.array(lists, pa.list_(pa.int32()))


def decode_batch(column: pa.ListArray, path: str | None = None) -> pa.Array:
    """Texts of the piece ids of a batch."""
    model = lattice(path)
    ids = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    n = pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False)
    size = model.raw_size[ids]
    total = np.concatenate([[0], np.cumsum(size)])
    data = model.raw[np.arange(total[-1]) - np.repeat(total[:-1] - (model.raw_end - model.raw_size)[ids], size)] \
        if len(ids) else model.raw[:0]
    bounds = total[np.concatenate([[0], np.cumsum(n)])]
    raw = data.tobytes()
    # the first blank is the mark that encoding put there
    return pa.array([raw[a + (raw[a:a + 1] == b" "):b].decode("utf-8", "replace")
                     for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())], pa.string())


def encode(docs: DataFrame, path: str | None = None, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the piece ids of every text as a new column (or anew)."""
    docs = docs.drop(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column(ids, encode_batch(batch.column(text), path))
    return docs.mapInArrow(run, T.StructType([*docs.schema, T.StructField(ids, T.ArrayType(T.IntegerType()))]))


def decode(docs: DataFrame, path: str | None = None, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``docs`` with the text of every list of piece ids as a new column (or anew)."""
    docs = docs.drop(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column(text, decode_batch(batch.column(ids), path))
    return docs.mapInArrow(run, T.StructType([*docs.schema, T.StructField(text, T.StringType())]))


def op6_viterbi_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document: their number, a hash of the ids in order, and
    whether decoding gives the text again."""
    docs = common.columns(common.table(spark, sf_dir, "documents"), doc_id="long", text="string")
    text = F.regexp_replace(F.coalesce("text", F.lit("")), MARK, " ")
    return decode(encode(docs)).select(
        "doc_id", F.size("ids").cast("long").alias("n_pieces"), F.xxhash64("ids").alias("ids_hash"),
        (F.col("decoded") == text).alias("round_trip"))
