"""Documents with every odd case the operators must bear."""
from pyspark.sql import types as T

LONG = " ".join(f"word{i % 5000}x{i % 7}" for i in range(40000))
BODY = "\n".join(" ".join(f"w{j}l{i}" for j in range(14)) for i in range(9))

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # names that operators use inside
    T.StructField("token", T.StringType()), T.StructField("gone", T.StringType()),
    T.StructField("size", T.LongType()), T.StructField("score", T.DoubleType()),
    T.StructField("ids", T.StringType()), T.StructField("bin", T.StringType()), T.StructField("h", T.StringType()),
])


def rows():
    texts = [
        (1, BODY, "en", "a"), (2, BODY, "en", "a"), (2, BODY, "en", "a"),  # a copy, a repeated row
        (3, BODY.replace("w3l4", "other"), "en", None),  # a near copy
        (4, None, "en", "b"), (5, "", None, "b"), (6, "  \n\t ", "de", "b"),
        (7, "one two", "de", "b"), (8, "one two", "fr", "c"), (9, "1234 !!", "fr", "c"),
        (None, BODY, "en", "a"), (None, None, None, None),
        (10, LONG, "en", "a"), (11, "x" * 200000, "en", "a"),
        (12, BODY.upper(), "en", "a"), (13, "a\n\n\nb\r\nc", "es", "c"),
        (14, "Grüße aus Köln, ça va? 日本語 🙂", None, "c"), (15, "same id", "en", "c"), (15, "other text here", "en", "c"),
    ]
    return [(i, t, lang, src, None if t is None else len(t), "t", None, 1, 0.5, "i", "b", None)
            for i, t, lang, src in texts]


def documents(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
