"""Queries over total orders, keyed tables, regression, late events and user
state; they add themselves to the suite's registry."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.operators import ranking
from tidepool.plans.suite import register
from tidepool.plans.surface import _SILVER_SQL, _raw_orders
from tidepool.session import scratch_path
from tidepool.sources import read_table
from tidepool.sources.sinks import write_csv


def _fresh(spark: SparkSession, kind: str) -> str:
    return scratch_path(spark, f"{kind}-{uuid.uuid4().hex[:12]}")


@register("ranked_lineitem", """
SELECT l_orderkey, l_linenumber, l_extendedprice,
       row_number() OVER (ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS rank
FROM lineitem
""")
def ranked_lineitem(spark: SparkSession, d: str) -> DataFrame:
    """O1: the place of every line item in the total order by price, without a
    one-task window."""
    items = read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return ranking.row_numbers(items, [("l_extendedprice", False), ("l_orderkey", True), ("l_linenumber", True)])


@register("ranked_quantities", """
SELECT l_orderkey, l_linenumber, l_quantity, rank() OVER (ORDER BY l_quantity DESC) AS rank,
       dense_rank() OVER (ORDER BY l_quantity DESC) AS dense
FROM lineitem
""")
def ranked_quantities(spark: SparkSession, d: str) -> DataFrame:
    """O1: ranks with heavy ties (fifty quantities, all line items)."""
    items = read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    order = [("l_quantity", False)]
    return ranking.ranks(ranking.ranks(items, order), order, name="dense", dense=True)


_KEYED_SQL = """
WITH merged AS (
  SELECT c_custkey, c_nationkey,
         CASE WHEN c_custkey % 7 = 0 THEN c_acctbal + 1000 ELSE c_acctbal END AS c_acctbal FROM customer
  UNION ALL SELECT c_custkey + 10000000, c_nationkey, 0.0 FROM customer WHERE c_custkey % 11 = 0)
SELECT c_custkey, c_nationkey, CASE WHEN c_nationkey = 3 THEN -c_acctbal ELSE c_acctbal END AS c_acctbal
FROM merged WHERE NOT (c_nationkey = 5)
"""


@register("keyed_changes", _KEYED_SQL)
def keyed_changes(spark: SparkSession, d: str) -> DataFrame:
    """Load, MERGE (updates and inserts), UPDATE and DELETE on a table
    of key buckets; each writes the buckets it touches."""
    from tidepool.tables import keyed
    base = read_table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    t = keyed.create(spark, _fresh(spark, "keyed"), base.schema, ["c_custkey"], 8)
    t.append(base)
    t.merge(base.where("c_custkey % 7 = 0").withColumn("c_acctbal", F.col("c_acctbal") + 1000)
            .unionByName(base.where("c_custkey % 11 = 0").select(
                (F.col("c_custkey") + 10000000).alias("c_custkey"), "c_nationkey", F.lit(0.0).alias("c_acctbal"))))
    t.update("c_nationkey = 3", {"c_acctbal": "-c_acctbal"})
    t.delete("c_nationkey = 5")
    return t.read()


@register("keyed_before_delete", _KEYED_SQL.replace("WHERE NOT (c_nationkey = 5)", ""))
def keyed_before_delete(spark: SparkSession, d: str) -> DataFrame:
    """The same table as of the change before the DELETE."""
    from tidepool.tables import keyed
    base = read_table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    t = keyed.create(spark, _fresh(spark, "keyed"), base.schema, ["c_custkey"], 8)
    t.append(base)
    t.merge(base.where("c_custkey % 7 = 0").withColumn("c_acctbal", F.col("c_acctbal") + 1000)
            .unionByName(base.where("c_custkey % 11 = 0").select(
                (F.col("c_custkey") + 10000000).alias("c_custkey"), "c_nationkey", F.lit(0.0).alias("c_acctbal"))))
    t.update("c_nationkey = 3", {"c_acctbal": "-c_acctbal"})
    t.delete("c_nationkey = 5")
    return t.read(batch=3)


@register("price_regression", """
WITH v AS (SELECT l_quantity AS a, l_discount AS b, l_tax AS c, l_extendedprice AS y FROM lineitem
           WHERE l_quantity IS NOT NULL AND l_discount IS NOT NULL AND l_tax IS NOT NULL AND l_extendedprice IS NOT NULL),
s AS (SELECT COUNT(*) AS n, AVG(a) AS ma, AVG(b) AS mb, AVG(c) AS mc, AVG(y) AS my, covar_samp(a, a) AS aa, covar_samp(a, b) AS ab,
             covar_samp(a, c) AS ac, covar_samp(b, b) AS bb, covar_samp(b, c) AS bc, covar_samp(c, c) AS cc,
             covar_samp(a, y) AS ay, covar_samp(b, y) AS by_, covar_samp(c, y) AS cy, covar_samp(y, y) AS yy FROM v),
d AS (SELECT *, aa * (bb * cc - bc * bc) - ab * (ab * cc - bc * ac) + ac * (ab * bc - bb * ac) AS det FROM s),
i AS (SELECT *, (bb * cc - bc * bc) / det AS iaa, (ac * bc - ab * cc) / det AS iab, (ab * bc - ac * bb) / det AS iac,
             (aa * cc - ac * ac) / det AS ibb, (ab * ac - aa * bc) / det AS ibc, (aa * bb - ab * ab) / det AS icc FROM d),
f AS (SELECT *, iaa * ay + iab * by_ + iac * cy AS fa, iab * ay + ibb * by_ + ibc * cy AS fb,
             iac * ay + ibc * by_ + icc * cy AS fc FROM i),
e AS (SELECT *, (yy - fa * ay - fb * by_ - fc * cy) * (n - 1) / (n - 4) AS v FROM f)
SELECT term, ROUND(estimate, 4) AS estimate, ROUND(std_error, 4) AS std_error FROM (
  SELECT 'intercept' AS term, my - fa * ma - fb * mb - fc * mc AS estimate,
         sqrt(v * (1.0::DOUBLE / n + (iaa * ma * ma + ibb * mb * mb + icc * mc * mc
                                      + 2 * (iab * ma * mb + iac * ma * mc + ibc * mb * mc)) / (n - 1))) AS std_error FROM e
  UNION ALL SELECT 'l_quantity', fa, sqrt(v * iaa / (n - 1)) FROM e
  UNION ALL SELECT 'l_discount', fb, sqrt(v * ibb / (n - 1)) FROM e
  UNION ALL SELECT 'l_tax', fc, sqrt(v * icc / (n - 1)) FROM e)
""")
def price_regression(spark: SparkSession, d: str) -> DataFrame:
    """Least squares of price on quantity, discount and tax, with standard errors."""
    from tidepool.ml import least_squares
    fit = least_squares(read_table(spark, d, "lineitem"), "l_extendedprice", ["l_quantity", "l_discount", "l_tax"])
    return fit.select("term", F.round("estimate", 4).alias("estimate"), F.round("std_error", 4).alias("std_error"))


@register("stream_late_events", """
WITH mid AS (SELECT min(ts) + (max(ts) - min(ts)) / 2 AS m FROM events),
fed AS (
  SELECT e.*, CASE WHEN event_id % 50 = 1 THEN 2 WHEN ts >= m OR event_id % 50 = 0 THEN 1 ELSE 0 END AS batch
  FROM events e, mid),
marks AS (SELECT max(ts) FILTER (batch = 0) AS a, max(ts) FILTER (batch <= 1) AS b FROM fed)
SELECT batch, CASE WHEN batch = 1 AND ts < a - INTERVAL 1 HOUR OR batch = 2 AND ts < b - INTERVAL 1 HOUR THEN 'late'
                   ELSE 'on_time' END AS status,
       event_type, COUNT(*) AS events
FROM fed, marks GROUP BY ALL
""")
def stream_late_events(spark: SparkSession, d: str) -> DataFrame:
    """Three micro-batches, of which the second and third bring events that
    were held back; none vanishes: on time + late = input."""
    from tidepool.streaming import late
    base = _fresh(spark, "late")
    e = read_table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    lo, hi = e.agg(F.min("ts"), F.max("ts")).first()
    batch = (F.when(F.col("event_id") % 50 == 1, 2)
             .when((F.col("ts") >= F.lit(lo + (hi - lo) / 2)) | (F.col("event_id") % 50 == 0), 1).otherwise(0))
    fed = e.withColumn("feed", batch)
    for n in range(3):
        fed.where(F.col("feed") == n).drop("feed").write.parquet(f"{base}/in/{n}")
        stream = spark.readStream.schema(e.schema).parquet(f"{base}/in/*")
        late.run_split(spark, stream, "ts", "1 HOUR", f"{base}/out", f"{base}/checkpoint", available_now=True).awaitTermination()
    return late.read_split(spark, f"{base}/out").groupBy("batch", "status", "event_type").agg(F.count(F.lit(1)).alias("events"))


@register("stream_journeys", """
WITH RECURSIVE e AS (SELECT user_id AS k, ts, event_id, event_type FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL),
j(k, started, ended, reached, last_id) AS (
  SELECT s.k, s.ts, coalesce(p.ts, s.ts + INTERVAL 6 HOUR), p.ts IS NOT NULL, p.event_id
  FROM (SELECT k, arg_min(ts, (ts, event_id)) AS ts, arg_min(event_id, (ts, event_id)) AS event_id FROM e
        WHERE event_type = 'view' GROUP BY k) s
  LEFT JOIN LATERAL (SELECT q.ts, q.event_id FROM e q WHERE q.k = s.k AND q.event_type = 'purchase'
                     AND (q.ts, q.event_id) > (s.ts, s.event_id) AND q.ts <= s.ts + INTERVAL 6 HOUR
                     ORDER BY q.ts, q.event_id LIMIT 1) p ON true
  UNION ALL
  SELECT s.k, s.ts, coalesce(p.ts, s.ts + INTERVAL 6 HOUR), p.ts IS NOT NULL, p.event_id
  FROM (SELECT j.k, arg_min(v.ts, (v.ts, v.event_id)) AS ts, arg_min(v.event_id, (v.ts, v.event_id)) AS event_id
        FROM j JOIN e v ON v.k = j.k AND v.event_type = 'view'
             AND (CASE WHEN j.reached THEN (v.ts, v.event_id) > (j.ended, j.last_id) ELSE v.ts > j.ended END)
        GROUP BY j.k) s
  LEFT JOIN LATERAL (SELECT q.ts, q.event_id FROM e q WHERE q.k = s.k AND q.event_type = 'purchase'
                     AND (q.ts, q.event_id) > (s.ts, s.event_id) AND q.ts <= s.ts + INTERVAL 6 HOUR
                     ORDER BY q.ts, q.event_id LIMIT 1) p ON true)
SELECT k AS key, started, ended, reached FROM j
""")
def stream_journeys(spark: SparkSession, d: str) -> DataFrame:
    """From a user's first view to the next purchase within six hours; open
    ones are flushed by their timer (a closing event of no user moves the
    watermark past all of them)."""
    import datetime as dt

    from tidepool.streaming.journeys import journeys
    from tidepool.streaming.windows import run_to_files
    base = _fresh(spark, "journeys")
    e = (read_table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type"))
    e.write.parquet(f"{base}/in/0")
    ends = e.agg(F.max("ts").alias("ts")).select(
        F.lit(-1).cast("long").alias("event_id"), (F.col("ts") + F.expr("INTERVAL 30 DAYS")).alias("ts"),
        F.lit(-1).cast("long").alias("user_id"), F.lit("end").alias("event_type"))
    for part in (None, ends):
        if part is not None:
            part.write.parquet(f"{base}/in/1")
        stream = spark.readStream.schema(e.schema).parquet(f"{base}/in/*")
        out = journeys(stream, "user_id", "ts", "event_type", "event_id", "view", "purchase", dt.timedelta(hours=6))
        run_to_files(out, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    got = spark.read.parquet(f"{base}/out")
    return got.select("key", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("started", "ended")], "reached")


@register("asof_purchases", """
WITH p AS (SELECT user_id, ts, max(event_id) AS event_id, arg_max(value, event_id) AS value FROM events
           WHERE event_type = 'purchase' AND user_id IS NOT NULL AND ts IS NOT NULL GROUP BY ALL)
SELECT e.event_id, e.user_id, e.ts, p.ts AS last_ts, p.value AS last_value
FROM events e ASOF LEFT JOIN p ON e.user_id = p.user_id AND e.ts > p.ts
""")
def asof_purchases(spark: SparkSession, d: str) -> DataFrame:
    """Of every event its user's last purchase strictly before it: a
    point-in-time feature that never looks ahead."""
    from tidepool.operators.asof import asof_join
    e = read_table(spark, d, "events")
    return asof_join(e.select("event_id", "user_id", "ts"),
                     e.where("event_type = 'purchase'").select("event_id", "user_id", "ts", "value"),
                     "user_id", "ts", ["value"], tie="event_id")


_PROFILED = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@register("profile_quantiles", " UNION ALL ".join(f"""
SELECT '{c}' AS column_name, COUNT({c}) AS n, ROUND(AVG({c}), 4) AS mean, ROUND(STDDEV_SAMP({c}), 4) AS deviation,
       true AS q25_in_bound, true AS q50_in_bound, true AS q75_in_bound FROM lineitem""" for c in _PROFILED))
def profile_quantiles(spark: SparkSession, d: str) -> DataFrame:
    """Mean, deviation and quartiles; each quartile's true rank is counted
    over the whole table and must lie within the sketch's stated error."""
    from tidepool.operators.profile import RANK_ERROR, distribution
    items = read_table(spark, d, "lineitem").select(*_PROFILED)
    found = distribution(items, _PROFILED).select("*", F.array("q25", "q50", "q75").alias("q"))
    long = items.unpivot([], list(_PROFILED), "column_name", "v").where("v IS NOT NULL")
    marks = F.broadcast(found.select("column_name", "q"))  # one row a column
    counts = long.join(marks, "column_name").groupBy("column_name").agg(
        *[F.count(F.when(F.col("v") < F.col("q")[i], 1)).alias(f"below{i}") for i in range(3)],
        *[F.count(F.when(F.col("v") <= F.col("q")[i], 1)).alias(f"upto{i}") for i in range(3)])
    within = [((F.col(f"below{i}") <= F.col("n") * (p + RANK_ERROR)) & (F.col(f"upto{i}") >= F.col("n") * (p - RANK_ERROR)))
              .alias(f"q{int(p * 100)}_in_bound") for i, p in enumerate((0.25, 0.5, 0.75))]
    return found.join(counts, "column_name").select("column_name", "n", F.round("mean", 4).alias("mean"),
                                                    F.round("deviation", 4).alias("deviation"), *within)


@register("frequent_parts", """
SELECT l_quantity AS value, COUNT(*) AS n FROM lineitem GROUP BY 1 HAVING COUNT(*) >= 0.02 * (SELECT COUNT(*) FROM lineitem)
""")
def frequent_parts(spark: SparkSession, d: str) -> DataFrame:
    """The quantities that hold at least 2 % of all line items."""
    from tidepool.operators.profile import frequent
    return frequent(read_table(spark, d, "lineitem").select("l_quantity"), "l_quantity", 0.02)


@register("sliding_panes_events", """
SELECT to_timestamp((floor(epoch(ts) / 300) - k) * 300)::TIMESTAMP AS window_start, event_type, COUNT(*) AS n
FROM events, range(288) r(k) WHERE ts IS NOT NULL GROUP BY ALL
""")
def sliding_panes_events(spark: SparkSession, d: str) -> DataFrame:
    """Counts per event type over 24 hours, every 5 minutes, from panes."""
    from tidepool.operators.aggregates import sliding_panes
    out = sliding_panes(read_table(spark, d, "events").select("ts", "event_type"), "ts", 86400, 300, ["event_type"])
    return out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@register("reconcile_orders", """
SELECT o_orderkey, CASE WHEN o_orderkey % 97 = 0 THEN 'lost' ELSE 'changed' END AS status
FROM orders WHERE o_orderkey % 97 = 0 OR o_orderkey % 101 = 0
UNION ALL SELECT o_orderkey + 1000000000, 'added' FROM orders WHERE o_orderkey % 103 = 0
""")
def reconcile_orders(spark: SparkSession, d: str) -> DataFrame:
    """A copy of the orders with rows lost, changed and added is compared by
    content; exactly those keys are listed."""
    from tidepool.operators.reconcile import differences
    o = read_table(spark, d, "orders")
    copy = (o.where("o_orderkey % 97 <> 0")
            .withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 101 == 0, None).otherwise(F.col("o_orderstatus")))
            .unionByName(o.where("o_orderkey % 103 = 0").withColumn("o_orderkey", F.col("o_orderkey") + 1000000000)))
    return differences(o, copy, ["o_orderkey"])


@register("variant_props", """
WITH e AS (SELECT event_id, CASE WHEN event_id % 10 = 0 THEN substr(props, 1, length(props) - 1)
                                 WHEN event_id % 10 = 1 THEN '{"k": "text", "more": [1, 2]}' ELSE props END AS props FROM events)
SELECT event_id, event_id % 10 = 0 AND props IS NOT NULL AS malformed,
       CASE WHEN event_id % 10 > 1 THEN CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k,
       CASE WHEN event_id % 10 = 1 THEN 2 END AS second
FROM e
""")
def variant_props(spark: SparkSession, d: str) -> DataFrame:
    """event properties whose fields drift: some are cut off (kept, and
    marked as malformed), some hold another type and a new field."""
    from tidepool.operators import variant
    e = read_table(spark, d, "events").select("event_id", "props")
    n = F.col("event_id") % 10
    drifted = e.withColumn("props", F.when(n == 0, F.expr("substr(props, 1, length(props) - 1)"))
                           .when(n == 1, F.lit('{"k": "text", "more": [1, 2]}')).otherwise(F.col("props")))
    got = variant.fields(variant.parse(drifted, "props"), {"k": ("$.k", "int"), "second": ("$.more[1]", "int")})
    return got.select("event_id", "malformed", "k", "second")


def _versions(spark: SparkSession, d: str) -> tuple[str, DataFrame]:
    """A snapshot table of two versions of the customers: all, then half of them."""
    from tidepool.tables import snapshots as T
    path = _fresh(spark, "versions")
    base = read_table(spark, d, "customer").select("c_custkey", "c_acctbal")
    T.write(base, path)
    T.write(base.where("c_custkey % 2 = 0"), path)
    return path, base


@register("versioned_as_of", "SELECT c_custkey, c_acctbal FROM customer")
def versioned_as_of(spark: SparkSession, d: str) -> DataFrame:
    """The table as of the time its first version was written."""
    from tidepool.tables import snapshots as T
    path, _ = _versions(spark, d)
    first = T.history(spark, path).where("version = 0").selectExpr("CAST(timestamp AS string) AS t").first().t
    return T.read(spark, path, as_of=first)


@register("versioned_rejects_columns", """
SELECT c_custkey, c_acctbal, true AS rejected FROM customer WHERE c_custkey % 2 = 0
""")
def versioned_rejects_columns(spark: SparkSession, d: str) -> DataFrame:
    """An append with a column the table lacks is refused; the table stays."""
    from tidepool.tables import snapshots as T
    path, base = _versions(spark, d)
    try:
        T.write(base.withColumn("extra", F.lit(1)), path, "append")
        rejected = False
    except T.SchemaMismatch:
        rejected = True
    return T.read(spark, path).withColumn("rejected", F.lit(rejected))


@register("versioned_merge_schema", """
SELECT c_custkey, c_acctbal, CAST(NULL AS VARCHAR) AS note FROM customer WHERE c_custkey % 2 = 0
UNION ALL SELECT c_custkey, NULL, 'added' FROM customer WHERE c_custkey % 2 = 1
""")
def versioned_merge_schema(spark: SparkSession, d: str) -> DataFrame:
    """An append that brings a new column and lacks another."""
    from tidepool.tables import snapshots as T
    path, base = _versions(spark, d)
    T.write(base.where("c_custkey % 2 = 1").select("c_custkey", F.lit("added").alias("note")), path, "append", merge_schema=True)
    return T.read(spark, path)


@register("versioned_expired", """
SELECT CAST(1 AS BIGINT) AS version, 'WRITE' AS operation, COUNT(*) AS num_rows FROM customer WHERE c_custkey % 2 = 0
""")
def versioned_expired(spark: SparkSession, d: str) -> DataFrame:
    """The history after all but the newest version have expired."""
    from tidepool.tables import snapshots as T
    path, _ = _versions(spark, d)
    T.expire(spark, path, 1)
    return T.history(spark, path).drop("timestamp")


@register("catalog_registered", """
SELECT c_nationkey, COUNT(*) AS customers, true AS listed, true AS dropped FROM customer GROUP BY 1
""")
def catalog_registered(spark: SparkSession, d: str) -> DataFrame:
    """Files that exist already become a named table of a new
    database, are listed and queried; dropping the name leaves the files."""
    from tidepool.sources import catalog
    base, db = _fresh(spark, "registered"), f"tidepool_{uuid.uuid4().hex[:12]}"
    read_table(spark, d, "customer").select("c_custkey", "c_nationkey").write.parquet(f"{base}/customers")
    catalog.create_database(spark, db, f"{base}/db")
    catalog.register_location(spark, f"{db}.customers", f"{base}/customers")
    # SHOW TABLES also lists the session's temporary views
    own = "tableName = 'customers' AND NOT isTemporary"
    listed = catalog.list_tables(spark, db).where(own).count() == 1
    rows = spark.table(f"{db}.customers").count()
    catalog.drop_table(spark, f"{db}.customers")
    dropped = catalog.list_tables(spark, db).where(own).count() == 0
    left = spark.read.parquet(f"{base}/customers")
    return (left.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("customers"))
            .withColumn("listed", F.lit(listed and rows == left.count())).withColumn("dropped", F.lit(dropped)))


@register("medallion_rerun", f"SELECT COUNT(*) AS silver_rows, CAST(0 AS BIGINT) AS differing FROM ({_SILVER_SQL}) s")
def medallion_rerun(spark: SparkSession, d: str) -> DataFrame:
    """M5: the whole chain run twice over the same raw files: rows of Silver, and
    keys whose Silver rows differ between the runs."""
    from tidepool import medallion
    from tidepool.operators.reconcile import differences
    from tidepool.session import cut_lineage
    base = _fresh(spark, "rerun")
    write_csv(_raw_orders(spark, d), f"{base}/raw")
    paths = medallion.run(spark, f"{base}/raw", f"{base}/lake")
    first = cut_lineage(spark.read.parquet(paths["silver"]))  # the second run overwrites the files
    medallion.run(spark, f"{base}/raw", f"{base}/lake")
    again = spark.read.parquet(paths["silver"])
    differing = cut_lineage(differences(first, again, ["order_id"]))
    return again.agg(F.count(F.lit(1)).alias("silver_rows")).withColumn("differing", F.lit(differing.count()).cast("long"))


@register("kmeans_nearest", """
SELECT COUNT(*) AS vectors, CAST(0 AS BIGINT) AS not_nearest, CAST(8 AS BIGINT) AS clusters, true AS tighter_than_one
FROM embeddings
""")
def kmeans_nearest(spark: SparkSession, d: str) -> DataFrame:
    """K-means proves its fit: every vector lies in the cluster of its nearest
    centre, every cluster is used, and the squared distances to the centres are
    smaller in sum than those to the mean of all (the vectors given here hardly
    cluster, so no margin is asked for)."""
    from tidepool.ml import kmeans
    model, scored = kmeans(read_table(spark, d, "embeddings"), "embedding", k=8)
    v = F.col("v")

    def to(centre) -> F.Column:
        gaps = F.zip_with(v, F.array(*[F.lit(float(c)) for c in centre]), lambda a, b: (a - b) * (a - b))
        return F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g)
    from pyspark.ml.functions import vector_to_array
    rows = scored.select("cluster", vector_to_array("embedding").alias("v"))
    mean = rows.select(*[F.avg(F.col("v")[i]).alias(f"m{i}") for i in range(len(model.clusterCenters()[0]))]).first()
    far = rows.select("cluster", F.array(*[to(c) for c in model.clusterCenters()]).alias("to"), to(list(mean)).alias("whole"))
    own = F.element_at("to", F.col("cluster") + 1)
    return far.agg(F.count(F.lit(1)).alias("vectors"),
                   F.count(F.when(own > F.array_min("to") + 1e-9, 1)).alias("not_nearest"),
                   F.count_distinct("cluster").alias("clusters"),
                   (F.sum(own) < F.sum("whole")).alias("tighter_than_one"))


@register("pca_axes", """
SELECT CAST(i AS INTEGER) AS component, true AS unit_length, true AS orthogonal, true AS falling, true AS variance_explained
FROM range(1, 6) r(i)
""")
def pca_axes(spark: SparkSession, d: str) -> DataFrame:
    """The first five principal components prove their fit: unit length,
    orthogonal, with falling variance, and the projections' variances are the
    shares of the total that the model states."""
    import numpy as np
    from pyspark.ml.functions import vector_to_array

    from tidepool.ml import pca
    e = read_table(spark, d, "embeddings")
    model, scored = pca(e, "embedding", k=5)
    axes = model.pc.toArray()
    stated = model.explainedVariance.toArray()
    total = e.select(F.posexplode("embedding").alias("i", "x")).groupBy("i").agg(F.var_samp("x").alias("v")).agg(F.sum("v")).first()[0]
    got = scored.select(vector_to_array("pca").alias("p")).agg(*[F.var_samp(F.col("p")[i]).alias(f"v{i}") for i in range(5)]).first()
    gram = axes.T @ axes
    out = [(i + 1, bool(abs(gram[i, i] - 1) < 1e-6), bool(np.abs(np.delete(gram[i], i)).max() < 1e-6),
            i == 0 or bool(stated[i] <= stated[i - 1] + 1e-12), bool(abs(got[i] / total - stated[i]) < 1e-6)) for i in range(5)]
    return spark.createDataFrame(out, "component int, unit_length boolean, orthogonal boolean, falling boolean, "
                                      "variance_explained boolean")
