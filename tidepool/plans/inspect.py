"""Plan inspection through the public ``DataFrame.explain`` output."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def explain_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def pushed_filters(df: DataFrame) -> list[str]:
    return re.findall(r"PushedFilters: \[(.*?)\]", explain_text(df))


def read_schemas(df: DataFrame) -> list[str]:
    return re.findall(r"ReadSchema: (struct<.*?>)\n", explain_text(df))


def exchanges(df: DataFrame) -> int:
    """Number of shuffle exchanges in the (pre-AQE) physical plan."""
    return len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition|Exchange RoundRobinPartitioning",
                          explain_text(df, "simple")))


def uses_python(df: DataFrame) -> bool:
    return bool(re.search(r"EvalPython|InPandas|PythonUDF|MapInArrow", explain_text(df, "simple")))
