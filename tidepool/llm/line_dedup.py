"""Op 9, line dedup: content-defined line chunks (DataFrame functions only).

Every text is split at ``\\n``. A polynomial rolling hash over the last two line
hashes makes about 15 of 16 lines a chunk border. A chunk starts at every line and
ends at the next border behind it (at most ``MOST_LINES`` lines on), so it has two
lines or more and its bounds depend on its own lines alone: an insertion shifts
none, and a passage is cut alike whatever stands around it. A chunk that occurs
again anywhere is removed, after its bytes have been compared with the first
occurrence, which stays (the smallest ``doc_id``, then the earliest place).
Removed chunks overlap; together they form runs of lines, and a run with less than
``MIN_CHARS`` characters besides blanks stays. Lines without a word belong to no
chunk; those inside a removed run go with it.

Not found: the last line of a passage where it is no border (about one in
16), and with it the whole passage where that has two lines only.

Plan: chunks are first counted by a 64-bit hash alone, with map-side sums; only
those with a repeated hash go on. Documents that hold some send these chunks'
bytes to a comparison with the first one's; the confirmed chunks go back to the
documents. The texts are shuffled by document, once where no other columns hang
on them (both joins then read the same exchange); every join is a sort-merge join
between plain exchanges, which AQE splits for a hot chunk, and no group is ever
collected but the chunks of one document.

Defined cases: a null text stays null, an empty one empty; a document all of
whose lines are repeats becomes an empty text but stays a row; rows that
agree in ``doc_id`` and text are one document and give equal results; a null
``doc_id`` sorts first; an empty table gives an empty result; other columns
pass through unchanged (``n_chars`` is renewed where it exists).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm import common
from tidepool.session import cut_lineage

#: A line is a border unless rolling hash % 1000003 % 16 is 0.
BORDER_MOD = 16
#: A chunk without a border ends after so many lines.
MOST_LINES = 8
MIN_CHARS = 40

_BLANK = " \t\x0b\x0c\r"
_SPLIT = "split(text, '\n', -1)"

# The chunks of a text: array<struct<s, e, h>>, first and last line and the hash of
# the bytes. Every step is bound to a lambda variable (a one-element transform), so
# that it is computed once a text and never inside the lambdas that read it.
_LINES = (f"filter(transform({_SPLIT}, (x, i) -> named_struct('i', i, 'x', x)), "
          f"l -> translate(l.x, '{_BLANK}', '') <> '')")
_HASHES = "transform(ls, l -> cast(conv(substr(md5(l.x), 1, 8), 16, 10) as bigint))"
_ENDS = (f"filter(sequence(0, size(ls) - 1), i -> i > 0 AND (i = size(ls) - 1 OR "
         f"((get(hs, i - 1) * 31 + get(hs, i)) % 1000003) % {BORDER_MOD} <> 0))")
_SPANS = ("flatten(transform(es, (e, k) -> transform(sequence(if(k > 0, get(es, k - 1), 0), e - 1), "
          f"s -> named_struct('s', s, 'e', least(e, s + {MOST_LINES - 1})))))")
_HASHED = ("transform(cs, c -> named_struct('s', ls[c.s].i, 'e', ls[c.e].i, 'h', "
           "xxhash64(array_join(transform(slice(ls, c.s + 1, c.e - c.s + 1), l -> l.x), '\n'))))")
_CHUNKS = (f"flatten(flatten(flatten(flatten(transform(array({_LINES}), ls -> transform(array({_HASHES}), hs -> "
           f"transform(array({_ENDS}), es -> transform(array({_SPANS}), cs -> {_HASHED}))))))))")
# The chunks in __held with their bytes: the lines with a word from s to e.
_BYTES = (f"flatten(transform(array({_SPLIT}), ls -> transform(__held, c -> named_struct('c', c, 'bytes', "
          f"array_join(filter(slice(ls, c.s + 1, c.e - c.s + 1), x -> translate(x, '{_BLANK}', '') <> ''), '\n')))))")
# Runs of lines covered by the chunks in __gone that have enough characters.
_COVERED = "array_sort(array_distinct(flatten(transform(__gone, g -> sequence(g.s, g.e)))))"
_RUNS = ("zip_with(filter(cov, (x, i) -> i = 0 OR get(cov, i - 1) <> x - 1), "
         "filter(cov, (x, i) -> i = size(cov) - 1 OR get(cov, i + 1) <> x + 1), (s, e) -> named_struct('s', s, 'e', e))")
_ENOUGH = (f"flatten(flatten(transform(array({_COVERED}), cov -> transform(array({_SPLIT}), ls -> "
           f"filter({_RUNS}, r -> aggregate(slice(ls, r.s + 1, r.e - r.s + 1), 0, "
           f"(n, x) -> n + length(translate(x, '{_BLANK}', ''))) >= {MIN_CHARS})))))")
# The lines outside __runs, whose ends are in order.
_LEFT = (f"array_join(flatten(flatten(transform(array({_SPLIT}), ls -> transform(sequence(0, size(__runs)), k -> "
         "slice(ls, coalesce(get(__runs, k - 1).e, -1) + 2, "
         "coalesce(get(__runs, k).s, size(ls)) - coalesce(get(__runs, k - 1).e, -1) - 1))))), '\n')")


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__key``, a hash of id and text."""
    return docs.withColumn("__key", F.xxhash64(F.col("doc_id").cast("long"), F.col("text")))


def repeats(keyed: DataFrame) -> DataFrame:
    """(__id, __k, __gone): the chunks to remove of each document, as structs
    of their first and last line."""
    rows = (keyed.select(F.col("doc_id").cast("long").alias("doc_id"), "__key", F.explode(F.expr(_CHUNKS)).alias("c"))
            .select("doc_id", "__key", "c.s", "c.e", "c.h"))
    again = rows.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
    # only chunks with a repeated hash; read twice below
    again = cut_lineage(rows.join(again, "h"))
    at = F.struct("doc_id", "__key", "s")
    first = again.groupBy("h").agg(F.min(at).alias("first"))
    held = (again.join(first, "h").groupBy(F.col("doc_id").alias("__id"), F.col("__key").alias("__k"))
            .agg(F.collect_set(F.struct("s", "e", "h", at.eqNullSafe(F.col("first")).alias("is_first"))).alias("__held")))
    # a document that holds only first occurrences still gives their bytes
    held = cut_lineage(held)
    found = (keyed.join(held, _same(), "inner")
             .select("__id", "__k", F.explode(F.expr(_BYTES)).alias("f")).select("__id", "__k", "f.c.*", "f.bytes"))
    kept = (found.where("is_first").groupBy("h").agg(F.first("bytes").alias("first_bytes")))
    gone = found.where("NOT is_first").join(kept, "h").where("bytes = first_bytes")
    return gone.groupBy("__id", "__k").agg(F.collect_set(F.struct("s", "e")).alias("__gone"))


def _same():
    return F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.col("__key") == F.col("__k"))


def dedup(docs: DataFrame, counts: bool = False) -> DataFrame:
    """``docs`` without repeated chunks; with ``counts`` also n_lines
    and n_removed (lines) of every document."""
    keyed = _keyed(docs)
    full = (keyed.join(repeats(keyed), _same(), "left")
            .withColumn("__runs", F.when(F.col("__gone").isNotNull(), F.expr(_ENOUGH))))
    changed = F.coalesce(F.size("__runs"), F.lit(0)) > 0
    if counts:
        full = (full.withColumn("n_lines", F.expr("cast(coalesce(length(text) - length(replace(text, '\n', '')) + 1, 0) as long)"))
                .withColumn("n_removed", F.expr("coalesce(aggregate(__runs, 0L, (n, r) -> n + r.e - r.s + 1), 0L)")))
    full = full.withColumn("text", F.when(changed, F.expr(_LEFT)).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        full = full.withColumn("n_chars", F.when(changed, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    extra = ["n_lines", "n_removed"] if counts else []
    return full.select(*[F.col(f"`{c}`") for c in docs.columns], *extra)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without globally repeated multi-line chunks."""
    docs = common.table(spark, sf_dir, "documents")
    return dedup(docs.select("doc_id", "text"), counts=True)


OP9_SQL = rf"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                  generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents),
w AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS j, ('0x' || substr(md5(line), 1, 8))::BIGINT AS h
      FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
b AS (SELECT *, j > 1 AND (j = max(j) OVER (PARTITION BY doc_id) OR ((lag(h) OVER (PARTITION BY doc_id ORDER BY j)
             * 31 + h) % 1000003) % {BORDER_MOD} <> 0) AS border FROM w),
n AS (SELECT doc_id, i, j, min(CASE WHEN border THEN j END) OVER near AS next, max(j) OVER near AS far,
             list(line) OVER upto AS ls, list(i) OVER upto AS places FROM b
      WINDOW near AS (PARTITION BY doc_id ORDER BY j ROWS BETWEEN 1 FOLLOWING AND {MOST_LINES - 1} FOLLOWING),
             upto AS (PARTITION BY doc_id ORDER BY j ROWS BETWEEN CURRENT ROW AND {MOST_LINES - 1} FOLLOWING)),
c AS (SELECT doc_id, i AS s, places[coalesce(next, far) - j + 1] AS e,
             array_to_string(ls[1:coalesce(next, far) - j + 1], chr(10)) AS chunk FROM n WHERE far IS NOT NULL),
g AS (SELECT *, row_number() OVER (PARTITION BY chunk ORDER BY doc_id, s) > 1 AS gone FROM c),
u AS (SELECT DISTINCT doc_id, unnest(generate_series(s, e)) AS i FROM g WHERE gone),
v AS (SELECT doc_id, i, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS run FROM u),
x AS (SELECT doc_id, i, sum(length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')))
             OVER (PARTITION BY doc_id, run) >= {MIN_CHARS} AS gone FROM v JOIN l USING (doc_id, i)),
t AS (SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT coalesce(gone, false)), '') AS text,
             count(*) AS n_lines, count(*) FILTER (gone) AS n_removed FROM l LEFT JOIN x USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, t.text, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed
FROM documents d LEFT JOIN t USING (doc_id)"""
