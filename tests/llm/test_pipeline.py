"""The corpus pipeline on small documents: what every stage keeps, against plain
readings of its rule, on the rows that its predecessor kept."""
import collections
import os
import random
import re
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import edge  # noqa: E402

import corpus_pipeline  # noqa: E402
from tidepool.llm import quality_rules  # noqa: E402

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")


@pytest.fixture(scope="module")
def kept(spark):
    """The documents before and after every stage but the last, and the packing."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {"": docs}
    for name, stage in corpus_pipeline.STAGES:
        folder = f"{spark.conf.get('spark.checkpoint.dir', '/tmp')}/test-pipeline-{random.getrandbits(60):x}-{name}"
        stage(spark, docs, SF).write.parquet(folder.replace("file:", ""))
        docs = out[name] = spark.read.parquet(folder.replace("file:", ""))
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def shingles(text):
    ws = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(ws[i:i + 5]) for i in range(len(ws) - 4)} if len(ws) >= 5 else {tuple(ws)} if ws else set()


def test_columns(kept):
    for name in ("quality", "language", "lines", "near_copies"):
        assert kept[name].columns == kept[""].columns


def test_quality(kept):
    before, after = texts(kept[""]), texts(kept["quality"])
    verdict = {r.doc_id: r.kept for r in quality_rules.score(kept[""]).collect()}
    assert after and after.items() <= before.items()
    for i, text in before.items():
        ws = WORD.findall(text or "")
        windows = [tuple(ws[k:k + 3]) for k in range(len(ws) - 2)]
        times = collections.Counter(windows)
        at = {p for k, w in enumerate(windows) if times[w] > 1 for p in (k, k + 1, k + 2)}
        if len(ws) < 50 or 100 * len(at) > 50 * len(ws):
            assert i not in after
        else:
            assert (i in after) == verdict[i]


def test_language(kept):
    before, after = texts(kept["quality"]), texts(kept["language"])
    assert after.items() <= before.items() and len(after) >= 0.95 * len(before)


def test_lines(kept):
    """Every line stays somewhere; a document only loses lines, in order."""
    before, after = texts(kept["language"]), texts(kept["lines"])
    assert before.keys() == after.keys()
    for i, text in before.items():
        rest = iter((text or "").split("\n"))
        assert not after[i] or all(x in rest for x in after[i].split("\n"))
    every = {x for t in before.values() for x in (t or "").split("\n")}
    assert every - {x for t in after.values() for x in (t or "").split("\n")} <= {""}


def test_near_copies(kept):
    """Of every group of linked documents the smallest id stays, unchanged."""
    before, after = texts(kept["lines"]), texts(kept["near_copies"])
    sets = {i: shingles(t) for i, t in before.items()}
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i
    holders = collections.defaultdict(list)
    for i in sorted(sets):
        for s in sets[i]:
            holders[s].append(i)
    seen = {(x, y) for ids in holders.values() for k, x in enumerate(ids) for y in ids[k + 1:]}
    for x, y in seen:
        both = len(sets[x] & sets[y])
        if 100 * both >= 75 * (len(sets[x]) + len(sets[y]) - both):
            a, b = sorted((top(x), top(y)))
            root[b] = a
    assert after == {i: t for i, t in before.items() if top(i) == i}


def test_packing(kept):
    packed = {r.doc_id for r in kept["packing"].select("doc_id").distinct().collect()}
    assert packed == set(texts(kept["near_copies"]))


def test_run_is_its_stages(spark, kept):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == kept["packing"].columns
    assert sorted(map(str, got.collect())) == sorted(map(str, kept["packing"].collect()))


def test_odd_rows_and_empty_table(spark):
    """Clashing columns pass through; an empty table runs through every stage."""
    for docs in (edge.documents(spark), edge.empty(spark)):
        for name, stage in corpus_pipeline.STAGES:
            docs = spark.createDataFrame(stage(spark, docs, SF).collect(), stage(spark, docs, SF).schema)
            if name != "packing":
                assert docs.columns == edge.SCHEMA.names
        assert docs.count() or docs.columns
