"""Total order, as-of join, regression, content reconciliation, panes, late rows, journeys, VARIANT."""
import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF001
from tidepool.ml import least_squares
from tidepool.operators import ranking, variant
from tidepool.operators.aggregates import sliding_panes
from tidepool.operators.asof import asof_join
from tidepool.operators.profile import distribution, frequent
from tidepool.operators.reconcile import differences
from tidepool.streaming import journeys, late


def text(rows):
    return sorted(map(str, rows))


@pytest.fixture(scope="module")
def tied(spark):
    pick = random.Random(1)
    rows = [(pick.choice([None, 1, 2, 3, 5]), pick.randrange(4), pick.choice("ab")) for _ in range(500)] + [(1, 1, "a")] * 400
    return spark.createDataFrame(rows, "a int, b int, c string")


@pytest.mark.parametrize("kind", ["row_number", "rank", "dense_rank"])
def test_global_ranks_match_windows(spark, tied, kind):
    tied.createOrReplaceTempView("tied")
    if kind == "row_number":
        got = ranking.row_numbers(tied, [("a", False), ("b", True), ("c", True)])
        want = "row_number() OVER (ORDER BY a DESC, b, c)"
    else:
        got = ranking.ranks(tied, [("a", True), ("b", False)], dense=kind == "dense_rank")
        want = f"{kind}() OVER (ORDER BY a, b DESC)"
    assert text(got.collect()) == text(spark.sql(f"SELECT *, {want} AS rank FROM tied").collect())


def test_global_rank_has_no_one_task_window_over_rows(spark, tied):
    got = ranking.row_numbers(spark.range(2000).selectExpr("id * 7 % 2000 AS k"), [("k", False)], unique=True)
    assert got.where("rank <> 2000 - k").count() == 0
    assert ranking.row_numbers(tied.limit(0), [("a", True)]).count() == 0


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_asof_join_matches_brute_force(spark, partitions):
    pick = random.Random(partitions)
    at = dt.datetime(2026, 1, 1)
    # key 1 holds most rows and spans ranges; key 9 has no right row; nulls on both sides
    left = [(i, pick.choice([1, 1, 1, 1, 2, 9, None]), pick.choice([None] + [at + dt.timedelta(minutes=pick.randrange(90))] * 9))
            for i in range(400)]
    right = [(i, pick.choice([1, 1, 2, 3, None]), pick.choice([None] + [at + dt.timedelta(minutes=pick.randrange(90))] * 9), pick.choice([None, i]))
             for i in range(60)]
    out = asof_join(spark.createDataFrame(left, "id int, k int, ts timestamp_ntz"),
                    spark.createDataFrame(right, "n int, k int, ts timestamp_ntz, v int"), "k", "ts", ["v", "n"], tie="n",
                    partitions=partitions)
    got = {r.id: (r.last_ts, r.last_v, r.last_n) for r in out.collect()}
    assert len(got) == len(left)
    for i, k, ts in left:
        found = [(t, n, v) for n, key, t, v in right if None not in (k, ts, key, t) and key == k and t < ts]
        t, n, v = max(found, key=lambda f: (f[0], f[1])) if found else (None, None, None)
        assert got[i] == (t, v, n)


def test_least_squares(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(1e6, 1, (500, 2))
    y = 3 + x @ [2.0, -1.0] + rng.normal(0, .1, 500)
    df = spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(x, y)] + [(None, 1.0, 2.0)], "a double, b double, y double")
    got = {r.term: r for r in least_squares(df, "y", ["a", "b"]).collect()}
    centred = x - x.mean(0)
    slope, *_ = np.linalg.lstsq(centred, y - y.mean(), rcond=None)
    left = ((y - y.mean() - centred @ slope) ** 2).sum() / 497
    error = np.sqrt(left * np.diag(np.linalg.inv(centred.T @ centred)))
    assert [got["a"].estimate, got["b"].estimate] == pytest.approx(slope, rel=1e-8)
    assert [got["a"].std_error, got["b"].std_error] == pytest.approx(error, rel=1e-6)
    with pytest.raises(ValueError):
        least_squares(df.withColumn("b", F.col("a") * 2), "y", ["a", "b"])
    with pytest.raises(ValueError):
        least_squares(df.limit(0), "y", ["a"])


def test_differences(spark):
    a = spark.createDataFrame([(1, "x", None), (2, "y", 1), (3, None, 2), (4, "same", 3)], "k int, s string, n int")
    b = spark.createDataFrame([(2, "y", None), (3, None, 2), (4, "same", 3), (5, "new", 0)], "k int, s string, n int")
    assert text(differences(a, b, ["k"]).collect()) == text(spark.createDataFrame(
        [(1, "lost"), (2, "changed"), (5, "added")], "k int, status string").collect())
    assert differences(a, a.orderBy(F.desc("k")), ["k"]).count() == 0
    assert differences(a.limit(0), b, ["k"]).where("status = 'added'").count() == 4


def test_sliding_panes_match_window_function(spark):
    pick = random.Random(4)
    rows = [(dt.datetime(2026, 1, 1) + dt.timedelta(seconds=pick.randrange(20000)), pick.choice(["a", "b", None])) for _ in range(200)]
    df = spark.createDataFrame(rows + [(None, "a")], "ts timestamp, k string")
    got = sliding_panes(df, "ts", 3600, 300, ["k"])
    want = (df.where("ts IS NOT NULL").groupBy(F.window("ts", "1 hour", "5 minutes").alias("w"), "k").agg(F.count("*").alias("n"))
            .select(F.col("w.start").alias("window_start"), "k", "n"))
    assert text(got.collect()) == text(want.collect())
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Aggregate")  # printed top down: only panes are expanded
    with pytest.raises(ValueError):
        sliding_panes(df, "ts", 3600, 700)


def test_distribution_and_frequent(spark):
    df = spark.range(100001).selectExpr("CAST(id AS double) AS x", "CASE WHEN id % 2 = 0 THEN CAST('NaN' AS double) END AS y")
    a, b = distribution(df, ["x", "y"]).collect()
    assert (a.n, a.mean) == (100001, 50000.0) and abs(a.q50 - 50000) <= 1000 and abs(a.q25 - 25000) <= 1000
    assert (b.n, b.mean, b.q50) == (0, None, None)
    assert [(r.value, r.n) for r in frequent(df.selectExpr("IF(x < 5000, 1, x) AS v"), "v").collect()] == [(1.0, 5000)]


def test_late_rows_are_counted_and_replays_agree(spark, tmp):
    at = dt.datetime(2026, 1, 1, tzinfo=dt.timezone.utc)

    def feed(n, minutes):
        spark.createDataFrame([(n * 100 + i, None if m is None else at + dt.timedelta(minutes=m)) for i, m in enumerate(minutes)],
                              "id int, ts timestamp").write.parquet(f"{tmp}/in/{n}")
        stream = spark.readStream.schema("id int, ts timestamp").parquet(f"{tmp}/in/*")
        late.run_split(spark, stream, "ts", "10 MINUTES", f"{tmp}/out", f"{tmp}/chk", available_now=True).awaitTermination()
    feed(0, [0, 100, None])
    feed(1, [89, 90, 200])
    feed(2, [95, 189, 190, 300])
    got = {(r.batch, r.status): r.ids for r in late.read_split(spark, f"{tmp}/out").groupBy("batch", "status")
           .agg(F.sort_array(F.collect_list("id")).alias("ids")).collect()}
    assert got == {(0, "on_time"): [0, 1], (0, "late"): [2], (1, "on_time"): [101, 102], (1, "late"): [100],
                   (2, "on_time"): [202, 203], (2, "late"): [200, 201]}


def test_journey_steps():
    hour = 3600
    out, opened = journeys.step(None, 10, True, False, hour)
    assert (out, opened) == ([], 10)
    assert journeys.step(10, 10 + hour, False, True, hour) == ([(10, 10 + hour, True)], None)  # the last moment counts
    assert journeys.step(10, 11 + hour, False, True, hour) == ([(10, 10 + hour, False)], None)
    assert journeys.step(10, 11 + hour, True, False, hour) == ([(10, 10 + hour, False)], 11 + hour)
    assert journeys.step(None, 5, False, True, hour) == ([], None)
    assert journeys.step(10, 20, True, False, hour) == ([], 10)


def test_variant_keeps_malformed_rows(spark):
    df = spark.createDataFrame([(1, '{"k": 5}'), (2, '{"k": "x"}'), (3, "{broken"), (4, None), (5, '{"other": [1, 2]}')], "id int, j string")
    parsed = variant.parse(df, "j")
    got = {r.id: (r.malformed, r.k, r.o) for r in variant.fields(parsed, {"k": ("$.k", "int"), "o": ("$.other[1]", "int")}).collect()}
    assert got == {1: (False, 5, None), 2: (False, None, None), 3: (True, None, None), 4: (False, None, None), 5: (False, None, 2)}
    assert "other" in variant.schema(parsed).first()[0]


def test_catalog_registered_beside_a_temporary_view(spark):
    """Temporary views of the session are no tables of the database."""
    spark.range(1).createOrReplaceTempView("customers")
    try:
        rows = E.queries()["catalog_registered"](spark, SF001).collect()
    finally:
        spark.catalog.dropTempView("customers")
    assert rows and all(r.listed and r.dropped for r in rows)
