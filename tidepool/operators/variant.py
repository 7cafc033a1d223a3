"""JSON with drifting fields as VARIANT.

A JSON text is parsed once into Spark's binary VARIANT; fields are taken out by
path and type, and a field that is absent or of another type is null. Rows whose
text is no JSON are kept, with a null variant and ``malformed`` set. The schema
of all values is found by one mergeable aggregate.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def parse(df: DataFrame, column: str, out: str = "v") -> DataFrame:
    """``df`` with the variant and ``malformed`` (a text that is no JSON; null
    texts are null variants, not malformed)."""
    return (df.withColumn(out, F.try_parse_json(F.col(column)))
            .withColumn("malformed", F.col(column).isNotNull() & F.col(out).isNull()))


def fields(df: DataFrame, paths: Mapping[str, tuple[str, str]], variant: str = "v") -> DataFrame:
    """``df`` without the variant and with one column per entry: name -> (path, type)."""
    return df.select("*", *[F.try_variant_get(F.col(variant), path, kind).alias(name)
                            for name, (path, kind) in paths.items()]).drop(variant)


def schema(df: DataFrame, variant: str = "v") -> DataFrame:
    """One row: the schema that all variants fit (text)."""
    return df.agg(F.schema_of_variant_agg(variant).alias("schema"))
