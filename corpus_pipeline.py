"""The corpus pipeline: from raw documents to packed training sequences.

Each stage is one operator of :mod:`tidepool.llm` over all rows that its
predecessor kept; the result of each is written as Parquet and read again, so
a lost executor costs at most one stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tidepool.llm import best_fit, common, language_id, line_dedup, ngram_join, quality_rules
from tidepool.session import scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 4: documents that fail the quality rules go."""
    common.prepare(spark)
    return quality_rules.keep(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 7: documents without a main language go."""
    common.prepare(spark)
    return language_id.keep(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 9: line chunks that an earlier document holds go."""
    common.prepare(spark)
    return line_dedup.dedup(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 3: of near duplicates the one with the smallest id stays."""
    common.prepare(spark)
    return ngram_join.keep_one(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 5: the bin of every piece of every document."""
    common.prepare(spark)
    return best_fit.assign(docs)


STAGES = [("quality", quality), ("language", language), ("lines", lines), ("near_copies", near_copies),
          ("packing", packing)]

#: No SQL twin: the language mixture and the packing are iterative. Tests run
#: the stages against their brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; intermediate tables go to the shared
    checkpoint folder."""
    docs = common.table(spark, sf_dir, "documents")
    folder = scratch_path(spark, f"pipeline-{uuid.uuid4().hex}")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
