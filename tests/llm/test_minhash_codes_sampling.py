"""Ops 11 to 13: odd cases, brute force, exact pruning."""
import collections
import hashlib
import math
import os
import random
import re
import sys
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import edge  # noqa: E402

from tidepool.llm import common, importance_sample, minhash_dedup, pivot_codes, registry  # noqa: E402

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")


@pytest.fixture(scope="module")
def docs(spark):
    common.prepare(spark)
    return edge.documents(spark)


# --- op 11 ----------------------------------------------------------------------

def sets_of(texts, n=4):
    out = []
    for t in texts:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out.append(frozenset(tuple(w[k:k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else []))
    return out


def brute(rows):
    """(n_shingles, smallest reachable id) of every row, rows being nodes."""
    sets = sets_of(t for _, t in rows)
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                up[find(a)] = find(b)
    least = collections.defaultdict(lambda: math.inf)
    for k, (i, _) in enumerate(rows):
        least[find(k)] = min(least[find(k)], i)
    return [(len(sets[k]), least[find(k)]) for k in range(len(rows))]


def check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash_dedup.dedup(df).collect())
    assert got == sorted((i, n, c, i == c) for (i, _), (n, c) in zip(rows, brute(rows)))


def test_minhash_edge(spark, docs):
    rows = [(i, t) for i, t, *_ in edge.rows()]
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1, r.kept) for r in minhash_dedup.dedup(docs).collect())
    named = [(i, t) for i, t in rows if i is not None]
    want = [(i, n, c, i == c) for (i, _), (n, c) in zip(named, brute(named))]
    want += [(-1, len(s), -1, True) for s in sets_of(t for i, t in rows if i is None)]
    assert got == sorted(want)
    assert minhash_dedup.dedup(edge.empty(spark)).count() == 0


def test_minhash_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in registry.QUERIES["op11_minhash_dedup"](spark, SF).collect()}
    assert got == {i: found for (i, _), found in zip(rows, brute(rows))}


@pytest.mark.parametrize("seed", range(3))
def test_minhash_families(spark, seed):
    """Families of changed copies on both sides of the threshold: words replaced
    (at shared places too), cut off, added, chains; with and without the text that
    the copies were made of; a passage that unrelated documents share."""
    pick = random.Random(seed)
    rows, i = [], pick.randrange(5)
    for family in range(4):
        base = [f"f{family}w{k}" for k in range(pick.choice([40, 90, 150]))]
        spots = [pick.randrange(len(base)) for _ in range(6)]
        texts = [base] if pick.random() < .5 else []
        for _ in range(40):
            t = list(base)
            for _ in range(pick.randrange(8)):
                t[pick.choice(spots) if pick.random() < .3 else pick.randrange(len(t))] = pick.choice([f"e{pick.randrange(10**6)}", "common"])
            if pick.random() < .3:
                t = t[:int(len(t) * pick.uniform(.75, 1))]
            if pick.random() < .2:
                t = t + [f"x{pick.randrange(10**6)}" for _ in range(pick.randrange(12))]
            texts.append(t)
        chain = list(base)
        for step in range(8):
            chain = [f"c{step}n{k}" for k in range(2)] + chain[:-2]
            texts.append(chain)
        for t in texts:
            rows.append((i, " ".join(t)))
            i += pick.randrange(1, 4)
    passage = " ".join(f"shared{k}" for k in range(60))
    for k in range(40):
        rows.append((i + k, passage + " " + " ".join(f"own{k}x{j}" for j in range(pick.randrange(5, 40)))))
    pick.shuffle(rows)
    check(spark, rows)


# --- op 12 ----------------------------------------------------------------------

def plain_codes(rows, rounds=6):
    """Product codes without pivots, in Python integers."""
    kept = sorted((r for r in rows if r[1]), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if all(x is not None and math.isfinite(x) for x in r[1])]
    xs = [[math.floor(x * 4096) for x in r[1]] for r in kept]
    d = len(xs[0]) // 8
    part = [[x[p * d:(p + 1) * d] for x in xs] for p in range(8)]
    books = [[part[p][k] for k in range(min(16, len(xs)))] for p in range(8)]

    def near(v, book):
        return min((sum((a - b) ** 2 for a, b in zip(v, e)), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p in range(8):
            at = [near(v, books[p])[1] for v in part[p]]
            for k in range(len(books[p])):
                mine = [v for v, a in zip(part[p], at) if a == k]
                if mine:
                    books[p][k] = [sum(c) // len(mine) for c in zip(*mine)]
    found = [[near(part[p][i], books[p]) for p in range(8)] for i in range(len(xs))]
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    per_label = collections.Counter()
    for r, f in zip(kept, found):
        per_label[r[2]] += sum(e for e, _ in f)
    return sorted((str(r[0]), "".join(f"{k:02x}" for _, k in f), sum(e for e, _ in f), per_label[r[2]], digest)
                  for r, f in zip(kept, found))


def codes(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, label int, x string, near int")
    found, books = pivot_codes.compress(df.repartition(3))
    return sorted((str(r.vec_id), r.code, r.error, r.label_error, r.codebooks_sha256) for r in found.collect()), books


def f32(v):
    return [None if x is None else float(np.float32(x)) for x in v]


@pytest.mark.parametrize("n,width", [(120, 16), (9, 8), (60, 64)])
def test_codes_match_plain_search(spark, n, width):
    common.prepare(spark)
    pick = random.Random(n)
    rows = [(i if i % 10 else None, f32(pick.gauss(0, .2) for _ in range(width)), pick.choice([None, 0, 1])) for i in range(n)]
    rows += rows[3:6]  # repeated rows, and vectors that make ties
    rows += [(1000 + i, f32([(-1) ** i * 0.5] * width), 7) for i in range(6)]
    rows += [(2000, None, 1), (2001, [], 1), (2002, f32([None] + [0.1] * (width - 1)), 1),
             (2003, [float("nan")] + [0.0] * (width - 1), 1), (2004, [float("-inf")] + [0.0] * (width - 1), None)]
    assert codes(spark, rows)[0] == plain_codes(rows)


def test_codes_edges(spark):
    common.prepare(spark)
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert pivot_codes.compress(empty)[0].count() == 0
    assert codes(spark, [(1, None, None)])[0] == []
    rows = [(i, f32([i / 10] * 8), 1) for i in range(20)]
    assert codes(spark, rows + [(50, f32([1.0] * 16), 1)])[0] == plain_codes(rows)  # another length is dropped
    with pytest.raises(ValueError):
        codes(spark, [(1, f32([0.1] * 9), 1)])


def test_pivot_bounds_prune_and_stay_exact():
    rng = np.random.default_rng(2)
    centres = rng.integers(-3000, 3000, (16, 8))
    part = centres[rng.integers(0, 16, 4000)] + rng.integers(-200, 200, (4000, 8))
    part[:40] = centres[0]  # ties
    book = np.concatenate([centres[:8], centres[:8]])  # every entry twice: the lower index wins
    hubs = part[:4]
    near = np.stack([pivot_codes.roots(pivot_codes.squared(part, h)) for h in hubs], axis=1)
    at, best, tried = pivot_codes.assign(part, near, book, hubs)
    exact = pivot_codes.squared(part[:, None], book[None])
    assert (best == exact.min(1)).all() and (at == exact.argmin(1)).all()
    assert tried < 0.6 * exact.size
    squares = np.array([0, 1, 3, 4, 8, 9, (1 << 30) ** 2 - 1, (1 << 30) ** 2])
    assert pivot_codes.roots(squares).tolist() == [math.isqrt(int(s)) for s in squares]


# --- op 13 ----------------------------------------------------------------------

def plain_sample(docs, target):
    low = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")

    def feats(t):
        w = low.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        runs = [" ".join(w[i:i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]
        return len(w), [zlib.crc32(r.encode()) % 10000 for r in runs]
    bags = [(i, *feats(t)) for i, t in docs]
    s, t = collections.Counter(b for *_, f in bags for b in f), collections.Counter(b for x in target for b in feats(x)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (big_s + 10000) / ((s[b] + 1) * (big_t + 10000)))) for b in range(10000)}
    out = []
    for i, n, f in bags:
        weight, score = sum(gain[b] for b in f), None
        if i is not None:
            h = int(hashlib.sha256(f"42:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + .5) / 4294967296)))
        out.append([i, len(f), weight, score, None, n])
    fit = sorted((r for r in out if r[5] >= 20 and r[0] is not None), key=lambda r: (-r[3], r[0], r[2], r[1]))
    for k, r in enumerate(fit[:5 * len(fit) // 100], 1):
        r[4] = k
    return sorted(str(tuple(r[:5])) for r in out)


def test_sample_edge(spark, docs):
    extra = [(100 + i, " ".join(f"Word{(i * j) % 50}-x é{j}" for j in range(25)), None, None, None, *[None] * 7) for i in range(80)]
    more = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    target = ["word1 word2 é3", None, "", "x É 日本 word1"]
    got = importance_sample.resample(more, spark.createDataFrame([(t, "z") for t in target], "text string, doc_id string"))
    got = sorted(str((r.doc_id, r.n_features, r.weight, r.score, r["rank"])) for r in got.collect())
    assert got == plain_sample([(r.doc_id, r.text) for r in more.select("doc_id", "text").collect()], target)
    assert sum("None)" not in g for g in got) == 4  # 5 % of the 85 to 99 long enough
    none = spark.createDataFrame([], "text string")
    assert importance_sample.resample(edge.empty(spark), none).count() == 0
    assert importance_sample.resample(docs, none).where("score IS NULL").count() == 2


def test_sample_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = sorted(str((r.doc_id, r.n_features, r.weight, r.score, r["rank"]))
                 for r in registry.QUERIES["op13_importance_sample"](spark, SF).collect())
    assert got == plain_sample(rows, target)
