"""The Python escape hatch (U1-U3), kept off every hot path.

Use these only for logic Spark has no built-in for. Both forms move data in
Arrow batches; a plain row-at-a-time ``udf`` (pickled rows) is never used.
A Python predicate is opaque to Catalyst, so a filter written with one is
*not* pushed into the Parquet scan (U3) — ``tests/test_udfs.py`` shows it.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType


@F.pandas_udf(StringType())
def nfkc_casefold(s: pd.Series) -> pd.Series:
    """Unicode NFKC normalisation + casefold over a whole Arrow batch
    (no built-in equivalent: ``lower`` does not fold ``ß``/ligatures)."""
    return s.str.normalize("NFKC").str.casefold()


@F.udf(returnType=StringType(), useArrow=True)
def strip_accents(s: str | None) -> str | None:
    """A per-value Python function, Arrow-batched."""
    if s is None:
        return None
    d = unicodedata.normalize("NFKD", s)
    return "".join(ch for ch in d if not unicodedata.combining(ch))


@F.pandas_udf(BooleanType())
def is_error_level(s: pd.Series) -> pd.Series:
    """U3 illustration: a predicate Catalyst cannot see into."""
    return s == "error"
