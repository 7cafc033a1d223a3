"""Word count (M1: F1 lower, F3 split, F4 explode, G1 count, O2 sort)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def words(df: DataFrame, text_col: str, sep: str = " ", word_col: str = "word") -> DataFrame:
    """One row per token of the whole text: ``explode(split(lower(text), sep))``.

    ``split`` takes a regex and keeps empty tokens (two separators in a row
    give ``""``), exactly like the reference; ``explode`` drops NULL texts.
    """
    return df.select(F.explode(F.split(F.lower(F.col(text_col)), sep)).alias(word_col))


def word_count(df: DataFrame, text_col: str, sep: str = " ") -> DataFrame:
    """Count per distinct word. The explode and the partial count run in the
    same stage, so only (word, partial count) pairs cross the shuffle."""
    return words(df, text_col, sep).groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def top_words(df: DataFrame, text_col: str, n: int = 20, sep: str = " ") -> DataFrame:
    """M1 + O4: the ``n`` most frequent words; ties broken by the word so
    the answer is deterministic. ``orderBy().limit()`` plans as a per-task
    top-n merged on the driver (TakeOrderedAndProject), never a full sort."""
    return (word_count(df, text_col, sep)
            .orderBy(F.col("count").desc(), F.col("word").asc())
            .limit(n))
