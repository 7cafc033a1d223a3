from pyspark.sql import functions as F

from conftest import SF01
from tidepool.functions import scalars, udfs
from tidepool.plans.inspect import explain_text, pushed_filters, uses_python


def test_pandas_udf_normalises(spark):
    df = spark.createDataFrame([("Straße ﬁne",), (None,)], ["t"])
    got = [r[0] for r in df.select(udfs.nfkc_casefold("t")).collect()]
    assert got == ["strasse fine", None]
    assert "ArrowEvalPython" in explain_text(df.select(udfs.nfkc_casefold("t")), "simple")


def test_arrow_udf_strips_accents(spark):
    df = spark.createDataFrame([("éèçà",)], ["t"])
    assert df.select(udfs.strip_accents("t")).first()[0] == "eeca"


def test_python_predicate_blocks_pushdown(spark):
    ev = spark.read.parquet(f"{SF01}/events.parquet")
    builtin = ev.filter(F.col("event_type") == "error").select("event_id")
    opaque = ev.filter(udfs.is_error_level("event_type")).select("event_id")
    assert any("EqualTo(event_type,error)" in p for p in pushed_filters(builtin))
    assert not any("event_type" in p for p in pushed_filters(opaque))
    assert builtin.count() == opaque.count()
    assert uses_python(opaque) and not uses_python(builtin)


def test_scalars(spark):
    df = spark.createDataFrame([(1.005, None), (20.0, 3.0)], "x double, y double")
    rows = df.select(scalars.round_money("x").alias("r"), scalars.flag(F.col("y") > 1).alias("f"),
                     scalars.label(F.col("x") > 10, "big", "small").alias("l")).collect()
    assert [str(r.r) for r in rows] == ["1.01", "20.00"]
    assert [r.f for r in rows] == [False, True] and [r.l for r in rows] == ["small", "big"]
