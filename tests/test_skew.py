"""A key holding a third of all rows must not change results, and the
skew-prone operators must be expressed as map-side-combinable aggregates."""
from pyspark.sql import functions as F

from tidepool.operators import aggregates as agg
from tidepool.operators import clean, joins
from tidepool.plans.inspect import explain_text


def hot(spark, n=30_000):
    # key 0 holds a third of the rows
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("v"),
        (F.lit("2024-01-01").cast("timestamp") + F.make_interval(mins=F.col("id").cast("int"))).alias("ts"))


def aggregate_form(df, keys, order_by):
    """W1 as ``min(struct)`` per key, an independent form of the same answer."""
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    picked = df.groupBy(*keys).agg(F.min(F.struct(*order_by, *rest)).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def test_dedup_hot_key(spark):
    df = hot(spark)
    out = clean.dedup(df, ["k"], ["ts"]).collect()
    assert len(out) == 20_001
    assert [r.v for r in out if r.k == 0] == [0]
    assert sorted(tuple(r) for r in out) == sorted(tuple(r) for r in aggregate_form(df, ["k"], ["ts"]).collect())
    assert "WindowGroupLimit" in explain_text(clean.dedup(df, ["k"], ["ts"]))


def test_salted_join_hot_key(spark):
    big = hot(spark)
    small = spark.range(0, 30_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    a = joins.salted_join(big, small, "k", salts=8).agg(F.count(F.lit(1)), F.sum("w")).first()
    b = big.join(small, "k").agg(F.count(F.lit(1)), F.sum("w")).first()
    assert tuple(a) == tuple(b)


def test_sessions_hot_key(spark):
    df = hot(spark)
    s = agg.sessions(df, "ts", "5 minutes", ["k"]).filter("k = 0").collect()
    assert len(s) == 1 and s[0].n == 10_000


def test_no_broadcast_hint_in_joins(spark):
    """Broadcasts are AQE's decision, by materialised bytes."""
    a, b = spark.range(100).withColumnRenamed("id", "k"), spark.range(10).withColumnRenamed("id", "k")
    assert "strategy=broadcast" not in explain_text(joins.enrich(a, b, "k"), "extended")


def test_sessions_equal_builtin_in_any_time_zone(spark):
    df = spark.createDataFrame([(1, 0), (1, 3 * 3600), (1, 20 * 3600), (2, 7200), (2, 14400)], "k int, s long") \
        .select("k", F.timestamp_seconds("s").alias("ts"))
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            a = sorted(tuple(r) for r in agg.sessions(df, "ts", "2 hours", ["k"]).collect())
            b = sorted(tuple(r) for r in agg.sessions_builtin(df, "ts", "2 hours", ["k"]).collect())
            assert a == b and len(a) == 4, zone
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_resample_across_days(spark):
    df = spark.createDataFrame([("2024-01-01 22:10:00",), ("2024-01-03 01:50:00",), ("2024-01-03 01:55:00",)], "ts string") \
        .withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    out = sorted((str(r.bucket), r.n) for r in agg.resample(df, "ts", "hour", [F.count(F.lit(1)).alias("n")]).collect())
    assert len(out) == 28 and out[0] == ("2024-01-01 22:00:00", 1) and out[-1] == ("2024-01-03 01:00:00", 2)
    assert all(n is None for _, n in out[1:-1])


def test_profile_counts_all_null_columns(spark):
    from tidepool.operators import profile
    df = spark.createDataFrame([(1, None), (2, None), (2, None)], "a int, b string")
    got = {r.column_name: (r.nulls, r.distinct_values, r.rows) for r in profile.summarize(df, approx=False).collect()}
    assert got == {"a": (0, 2, 3), "b": (3, 0, 3)}


def test_bucketed_sessions_equal_builtin(spark):
    import random
    rnd = random.Random(7)
    rows, t = [], 0
    for i in range(4000):
        k = 0 if i % 3 == 0 else rnd.randint(1, 40)
        t += rnd.choice([1, 5, 30, 90, 200, 3000])  # bursts and long silences (seconds)
        rows.append((k, t))
    df = spark.createDataFrame(rows, "k int, s long").select(
        "k", F.timestamp_seconds("s").alias("ts"))
    for gap, fanout in (("10 minutes", 1024), ("1 hour", 2), ("5 minutes", 3), ("90 seconds", 1)):
        a = sorted(tuple(r) for r in agg.sessions(df, "ts", gap, ["k"], fanout=fanout).collect())
        b = sorted(tuple(r) for r in agg.sessions_builtin(df, "ts", gap, ["k"]).collect())
        assert a == b, (gap, fanout)


def test_dedup_matches_window_with_nulls_and_ties(spark):
    import random
    rnd = random.Random(3)
    rows = []
    for i in range(3000):
        k = 0 if i % 3 == 0 else rnd.randint(1, 200)
        ts = None if rnd.random() < 0.1 else rnd.randint(0, 50)
        x = None if rnd.random() < 0.2 else rnd.choice(["a", "b", None])
        y = rnd.choice([None, 1.5, -2.0, 3.25])
        rows.append((k, ts, x, y))
    df = spark.createDataFrame(rows, "k int, ts int, x string, y double")
    for keep_cols in (["ts"], ["ts", "y"]):
        a = sorted((tuple(r) for r in clean.dedup(df, ["k"], keep_cols).collect()), key=repr)
        b = sorted((tuple(r) for r in aggregate_form(df, ["k"], keep_cols).collect()), key=repr)
        assert a == b, keep_cols


def test_aqe_splits_a_hot_join_key(spark):
    """The star joins rely on AQE's skew join: a customer holding a third of
    the orders must be split across tasks, with unchanged results."""
    keys = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            # both sides are tiny here: keep AQE from broadcasting instead
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        facts = spark.range(300_000).select(
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000).alias("cust"),
            (F.col("id") % 97).cast("double").alias("amount"))
        dims = spark.range(5000).select(F.col("id").alias("cust"), (F.col("id") % 5).alias("seg"))
        j = facts.join(dims, "cust").groupBy("seg").agg(F.sum("amount").alias("s"), F.count(F.lit(1)).alias("n"))
        rows = sorted(tuple(r) for r in j.collect())
        final = explain_text(j, "formatted")
        assert "skew=true" in final
        assert sum(r[2] for r in rows) == 300_000
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_resample_fills_gaps(spark):
    df = spark.createDataFrame(
        [("2024-01-01 00:10:00", 1.0), ("2024-01-01 00:50:00", 2.0),
         ("2024-01-01 03:05:00", 4.0), ("2024-01-01 04:59:59", 8.0)], "ts string, v double") \
        .withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    out = agg.resample(df, "ts", "hour", [F.count(F.lit(1)).alias("n"), F.sum("v").alias("s")])
    got = sorted((str(r.bucket), r.n, r.s) for r in out.collect())
    assert got == [("2024-01-01 00:00:00", 2, 3.0), ("2024-01-01 01:00:00", None, None),
                   ("2024-01-01 02:00:00", None, None), ("2024-01-01 03:00:00", 1, 4.0),
                   ("2024-01-01 04:00:00", 1, 8.0)]


def test_sessions_ignore_null_times_like_builtin(spark):
    df = spark.createDataFrame([(1, 0), (1, None), (2, None), (1, 300)], "k int, s long") \
        .select("k", F.timestamp_seconds("s").alias("ts"))
    a = sorted(tuple(r) for r in agg.sessions(df, "ts", "10 minutes", ["k"]).collect())
    b = sorted(tuple(r) for r in agg.sessions_builtin(df, "ts", "10 minutes", ["k"]).collect())
    assert a == b and len(a) == 1
