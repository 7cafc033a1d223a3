from fixtures import WORD_LINES
from tidepool.operators import text


def test_word_count_golden(spark):
    df = spark.createDataFrame([(l,) for l in WORD_LINES] * 10000, ["line"])
    got = {r.word: r["count"] for r in text.word_count(df, "line").collect()}
    assert got["spark"] == 50000 and got["is"] == 30000 and got["docker"] == 20000
    for w in ("distributed", "easy", "fast", "fun", "learning", "makes", "with"):
        assert got[w] == 10000
    assert len(got) == 10


def test_top_words_tie_break(spark):
    df = spark.createDataFrame([("b a",), ("a b",), ("c",)], ["t"])
    assert [tuple(r) for r in text.top_words(df, "t", 2).collect()] == [("a", 2), ("b", 2)]


def test_split_keeps_empty_tokens(spark):
    df = spark.createDataFrame([("a  b",)], ["t"])
    got = {r.word: r["count"] for r in text.word_count(df, "t").collect()}
    assert got == {"a": 1, "": 1, "b": 1}
