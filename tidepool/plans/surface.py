"""More queries over the driver tables: the medallion chain from raw CSV, other
sources and sinks, SQL forms, alerts and stream joins. Registered beside those
of :mod:`tidepool.plans.suite`, each with its DuckDB twin."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool import medallion
from tidepool.functions import scalars, udfs
from tidepool.operators import aggregates as agg
from tidepool.operators import clean
from tidepool.plans.suite import _run_stream, _stream_source, register
from tidepool.session import scratch_path
from tidepool.sources import catalog, files, read_table
from tidepool.sources.sinks import write_csv, write_parquet
from tidepool.streaming import windows
from tidepool.streaming.events import to_event_time


def _folder(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"surface/{name}-{uuid.uuid4().hex[:12]}")


# --- medallion (M2-M5, G2, G3, G10) ------------------------------------------
# Orders are published as raw CSV with faults: pending orders carry a bad field
# each, named by their priority, and finished ones are sent again a day later.

_RAW_SQL = """
SELECT o_orderkey AS order_id, o_orderstatus AS status, o_orderpriority AS product,
       CASE o_orderstatus WHEN 'O' THEN 'EU' WHEN 'F' THEN 'APAC' ELSE 'US' END AS region,
       o_orderdate AS order_ts, o_totalprice AS amount, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS quantity
FROM orders
"""
_FAULTS = {"1-URGENT": "invalid_amount", "2-HIGH": "invalid_quantity", "3-MEDIUM": "invalid_order_ts",
           "4-NOT SPECIFIED": "null_product"}
_SILVER_SQL = f"""
SELECT order_id, product, region, order_ts, amount, quantity,
       CAST(ROUND(amount * quantity, 2) AS DECIMAL(18,2)) AS total_amount
FROM ({_RAW_SQL}) r WHERE NOT (status = 'P' AND product IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED'))
"""


def _raw_orders(spark: SparkSession, d: str) -> DataFrame:
    o = read_table(spark, d, "orders")
    p, pending = F.col("o_orderpriority"), F.col("o_orderstatus") == "P"

    def unless(priority, good, bad):
        return F.when(pending & (p == priority), F.lit(bad)).otherwise(good)
    raw = o.select(
        F.col("o_orderstatus").alias("status"), F.col("o_orderkey").cast("string").alias("order_id"),
        unless("3-MEDIUM", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"), "yesterday").alias("order_ts"),
        unless("4-NOT SPECIFIED", p, None).alias("product"),
        F.when(F.col("o_orderstatus") == "O", " eu").when(F.col("o_orderstatus") == "F", "Apac ")
        .otherwise("us").alias("region"),
        unless("1-URGENT", F.col("o_totalprice").cast("string"), "n/a").alias("amount"),
        unless("2-HIGH", F.substring(p, 1, 1), "0").alias("quantity"))
    again = (raw.filter("status = 'F'")
             .withColumn("order_ts", F.date_format(F.to_timestamp("order_ts") + F.expr("INTERVAL 1 DAY"),
                                                   "yyyy-MM-dd HH:mm:ss"))
             .withColumn("amount", F.lit("1.0")))
    return raw.unionByName(again).select(*medallion.RAW_COLUMNS)


def _layers(spark: SparkSession, d: str) -> tuple[str, dict[str, str]]:
    base = _folder(spark, "medallion")
    write_csv(_raw_orders(spark, d), f"{base}/raw")
    return f"{base}/raw", medallion.run(spark, f"{base}/raw", f"{base}/lake")


@register("medallion_silver", f"""
SELECT order_id, product, region, order_ts, amount, quantity, total_amount, CAST(order_ts AS DATE) AS order_date,
       CAST(year(order_ts) AS INTEGER) AS order_year, CAST(month(order_ts) AS INTEGER) AS order_month
FROM ({_SILVER_SQL}) s
""")
def medallion_silver(spark: SparkSession, d: str) -> DataFrame:
    """M3: typed, cleaned, deduplicated (the earliest event of an order stays)."""
    _, paths = _layers(spark, d)
    return (spark.read.parquet(paths["silver"])
            .withColumn("order_ts", F.col("order_ts").cast("timestamp_ntz"))
            .withColumn("total_amount", F.col("total_amount").cast("decimal(18,2)")))


@register("medallion_rejected", """
SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'invalid_amount' WHEN '2-HIGH' THEN 'invalid_quantity'
            WHEN '3-MEDIUM' THEN 'invalid_order_ts' ELSE 'null_product' END AS rule, COUNT(*) AS rows
FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority <> '5-LOW' GROUP BY 1
""")
def medallion_rejected(spark: SparkSession, d: str) -> DataFrame:
    """The quarantine, by the rule that sent each row there."""
    _, paths = _layers(spark, d)
    return (spark.read.parquet(paths["quarantine"]).groupBy(F.col("_rejected_by").alias("rule"))
            .agg(F.count(F.lit(1)).alias("rows")))


@register("medallion_daily_revenue", f"""
SELECT CAST(order_ts AS DATE) AS order_date, region, CAST(SUM(total_amount) AS DECIMAL(38,2)) AS total_revenue,
       COUNT(*) AS order_count,
       CAST((CAST(SUM(total_amount) * 100 AS BIGINT) * 2 + COUNT(*)) // (COUNT(*) * 2) AS DECIMAL(38,2)) / 100
         AS avg_order_value
FROM ({_SILVER_SQL}) s GROUP BY 1, 2
""")
def medallion_daily_revenue(spark: SparkSession, d: str) -> DataFrame:
    """The first Gold table."""
    _, paths = _layers(spark, d)
    return spark.read.parquet(paths["gold_daily_revenue"])


@register("medallion_product_summary", f"""
SELECT product, CAST(SUM(quantity) AS BIGINT) AS total_units_sold,
       CAST(SUM(total_amount) AS DECIMAL(38,2)) AS total_revenue,
       CAST((CAST(SUM(CAST(amount AS DECIMAL(18,2))) * 100 AS BIGINT) * 2 + COUNT(*)) // (COUNT(*) * 2)
         AS DECIMAL(38,2)) / 100 AS avg_unit_price,
       COUNT(*) AS order_count
FROM ({_SILVER_SQL}) s GROUP BY 1
""")
def medallion_product_summary(spark: SparkSession, d: str) -> DataFrame:
    """The second Gold table."""
    _, paths = _layers(spark, d)
    return spark.read.parquet(paths["gold_product_summary"])


@register("medallion_reconcile", f"""
WITH raw AS (SELECT COUNT(*) + COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS n FROM orders)
SELECT 'raw' AS layer, n AS rows FROM raw UNION ALL SELECT 'bronze', n FROM raw
UNION ALL SELECT 'silver', (SELECT COUNT(*) FROM ({_SILVER_SQL}) s)
UNION ALL SELECT 'gold_daily_revenue', (SELECT COUNT(DISTINCT (CAST(order_ts AS DATE), region)) FROM ({_SILVER_SQL}) s)
UNION ALL SELECT 'gold_product_summary', (SELECT COUNT(DISTINCT product) FROM ({_SILVER_SQL}) s)
UNION ALL SELECT 'quarantine', (SELECT COUNT(*) FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority <> '5-LOW')
""")
def medallion_reconcile(spark: SparkSession, d: str) -> DataFrame:
    """Rows of every layer; valid plus rejected rows are the input."""
    raw, paths = _layers(spark, d)
    return medallion.reconcile(spark, paths, raw)


@register("gold_region_summary", """
SELECT o_orderstatus AS region, COUNT(*) AS orders,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS revenue
FROM orders GROUP BY 1
""")
def gold_region_summary(spark: SparkSession, d: str) -> DataFrame:
    """G4 through the library's own operator."""
    o = read_table(spark, d, "orders").withColumnRenamed("o_orderstatus", "region")
    return agg.region_summary(o, "o_totalprice")


# --- events: quarantine, alerts, stream join, stream dedup --------------------

@register("stream_quarantine", """
SELECT CAST(COUNT(*) AS BIGINT) AS valid, CAST(COUNT(*) FILTER (WHERE o_orderstatus = 'P') AS BIGINT) AS rejected
FROM orders
""")
def stream_quarantine(spark: SparkSession, d: str) -> DataFrame:
    """Every event ends in the table or in the quarantine, over two runs
    on one checkpoint (the second one finds the files of the first done)."""
    from tidepool.plans.suite import _order_events
    from tidepool.streaming.events import read_event_files
    from tidepool.streaming.ingest import read_ingested, rejected_path, run_ingest
    base = _folder(spark, "quarantine")
    o = read_table(spark, d, "orders")
    broken = o.filter("o_orderstatus = 'P'").select(F.concat(F.lit('{"order_id": "'), "o_orderpriority").alias("value"))
    for name, lines in (("a", _order_events(o)), ("b", broken)):
        lines.write.text(f"{base}/in/{name}")
        run_ingest(spark, read_event_files(spark, f"{base}/in/*"), f"{base}/table", f"{base}/checkpoint",
                   available_now=True).awaitTermination()
    good = read_ingested(spark, f"{base}/table").select(F.lit(1).alias("ok"))
    bad = read_ingested(spark, rejected_path(f"{base}/table")).select(F.lit(0).alias("ok"))
    return good.unionByName(bad).agg(F.sum("ok").alias("valid"), F.sum(1 - F.col("ok")).alias("rejected"))


@register("alerts_errors", """
SELECT CAST(user_id AS VARCHAR) AS key, n FROM (
  SELECT user_id, COUNT(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1) c WHERE n >= 3
""")
def alerts_errors(spark: SparkSession, d: str) -> DataFrame:
    """X11/K8: users over an error threshold as key/value records; the value's
    JSON is read back."""
    counts = agg.count_by(read_table(spark, d, "events").filter("event_type = 'error'"), "user_id", name="n")
    out = windows.alerts(counts, 3, key_col="user_id")
    return out.select("key", F.from_json("value", "n BIGINT").getField("n").alias("n"))


@register("stream_join_events", """
SELECT a.event_id AS first_id, b.event_id AS second_id
FROM events a JOIN events b ON a.user_id = b.user_id AND b.ts >= a.ts AND b.ts <= a.ts + INTERVAL '30 minutes'
WHERE a.event_type = 'view' AND b.event_type = 'purchase'
""")
def stream_join_events(spark: SparkSession, d: str) -> DataFrame:
    """Views joined to purchases of the same user within 30 minutes, both
    streams with watermarks."""
    def side(kind: str, names: list[str]) -> DataFrame:
        ev = to_event_time(_stream_source(spark, d, "events"), "ts").filter(F.col("event_type") == kind)
        return ev.select("event_id", "user_id", "ts").toDF(*names)
    views = side("view", ["first_id", "user_id", "viewed"])
    bought = side("purchase", ["second_id", "user_id", "bought"])
    joined = windows.interval_join(views, bought, "user_id", "viewed", "bought", "30 MINUTES")
    return _run_stream(spark, joined.select("first_id", "second_id"), "join")


@register("stream_dedup_events", "SELECT event_id FROM events")
def stream_dedup_events(spark: SparkSession, d: str) -> DataFrame:
    """An event stream that repeats every event, deduplicated by id
    within the watermark."""
    ev = to_event_time(_stream_source(spark, d, "events"), "ts").select(
        F.explode(F.array("event_id", "event_id")).alias("event_id"), "ts")
    return _run_stream(spark, windows.dedup_events(ev, ["event_id"], "ts").select("event_id"), "dedup")


# --- SQL forms and functions -----------------------------------------------------

@register("ordered_priorities", """
SELECT o_orderpriority, ROUND(SUM(CAST(o_totalprice AS DECIMAL(18,2))), 1) AS revenue,
       CAST(row_number() OVER (ORDER BY SUM(CAST(o_totalprice AS DECIMAL(18,2))) DESC, o_orderpriority) AS INTEGER) AS place
FROM orders GROUP BY 1
""")
def ordered_priorities(spark: SparkSession, d: str) -> DataFrame:
    """SQL ``ROUND(SUM)`` with an order, the place in it as a column."""
    return spark.sql("""
        SELECT *, CAST(row_number() OVER (ORDER BY exact DESC, o_orderpriority) AS INT) AS place FROM (
          SELECT o_orderpriority, ROUND(SUM(CAST(o_totalprice AS DECIMAL(18,2))), 1) AS revenue,
                 SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS exact
          FROM {orders} GROUP BY o_orderpriority)
        ORDER BY place""", orders=read_table(spark, d, "orders")).drop("exact")


@register("part_flags", """
SELECT p_partkey, upper(trim(p_brand)) AS brand, contains(p_type, 'STEEL') AS steel,
       coalesce(p_size > 25, false) AS large
FROM part
""")
def part_flags(spark: SparkSession, d: str) -> DataFrame:
    """Contains, a conditional flag, upper and trim."""
    return read_table(spark, d, "part").select(
        "p_partkey", clean.normalize_code("p_brand").alias("brand"), F.col("p_type").contains("STEEL").alias("steel"),
        scalars.flag(F.col("p_size") > 25).alias("large"))


@register("calendar_orders", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date, CAST(year(o_orderdate) AS INTEGER) AS order_year,
       CAST(month(o_orderdate) AS INTEGER) AS order_month, CAST(day(o_orderdate) AS INTEGER) AS order_day,
       ROUND(CAST(o_totalprice AS DECIMAL(38,10)), 1) AS price
FROM orders
""")
def calendar_orders(spark: SparkSession, d: str) -> DataFrame:
    """Calendar parts and rounded money."""
    parts = [c.alias(n) for n, c in scalars.calendar("o_orderdate").items()]
    return read_table(spark, d, "orders").select("o_orderkey", *parts, scalars.round_money("o_totalprice", 1).alias("price"))


@register("struct_map_events", """
SELECT user_id, MAX(value) FILTER (WHERE event_type = 'view') AS best_view, COUNT(DISTINCT event_type) AS kinds
FROM events GROUP BY 1
""")
def struct_map_events(spark: SparkSession, d: str) -> DataFrame:
    """STRUCT and MAP values built per user and taken apart again."""
    best = read_table(spark, d, "events").groupBy("user_id", "event_type").agg(F.max("value").alias("best"))
    maps = best.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "best"))).alias("m"))
    return maps.select("user_id", F.expr("m['view']").alias("best_view"),
                       F.size(F.map_keys("m")).cast("bigint").alias("kinds"))


@register("folded_segments", """
SELECT lower(c_mktsegment) AS folded, lower(c_mktsegment) AS plain, COUNT(*) AS customers FROM customer GROUP BY 1, 2
""")
def folded_segments(spark: SparkSession, d: str) -> DataFrame:
    """The two vectorised functions, after the rows are aggregated."""
    c = agg.count_by(read_table(spark, d, "customer"), "c_mktsegment", name="customers")
    return c.select(udfs.nfkc_casefold("c_mktsegment").alias("folded"),
                    F.lower(udfs.strip_accents("c_mktsegment")).alias("plain"), "customers")


# --- other sources, catalog -------------------------------------------------------

@register("formats_round_trip", """
SELECT 'orc' AS kind, COUNT(*) AS rows, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS amount FROM orders
UNION ALL SELECT 'partitioned', COUNT(*), CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) FROM orders
UNION ALL SELECT 'text', COUNT(*), CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) FROM orders
""")
def formats_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Orders written and read as ORC, as Parquet
    partitioned by status, and as text lines."""
    base, o = _folder(spark, "formats"), read_table(spark, d, "orders")
    o.write.orc(f"{base}/orc")
    write_parquet(o, f"{base}/partitioned", partition_by=["o_orderstatus"])
    o.select(F.col("o_totalprice").cast("string")).write.text(f"{base}/text")
    read = {"orc": files.read_orc(spark, f"{base}/orc"),
            "partitioned": files.read_partitioned(spark, f"{base}/partitioned"),
            "text": files.read_text(spark, f"{base}/text").select(F.col("value").cast("double").alias("o_totalprice"))}
    parts = [df.agg(F.count(F.lit(1)).alias("rows"), agg.money_sum("o_totalprice").alias("amount"))
             .select(F.lit(kind).alias("kind"), "rows", "amount") for kind, df in read.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("catalog_insert", """
SELECT r_regionkey AS id, r_name AS name FROM region UNION ALL SELECT 100, 'it''s new' UNION ALL SELECT 101, NULL
""")
def catalog_insert(spark: SparkSession, d: str) -> DataFrame:
    """A catalog table from DDL, an append, a SQL ``INSERT INTO
    ... VALUES``, read back by name. The table lives in the shared folder."""
    name = f"regions_{uuid.uuid4().hex[:12]}"
    catalog.create_table(spark, name, "id BIGINT, name STRING", location=_folder(spark, "catalog"))
    region = read_table(spark, d, "region")
    catalog.append(region.select(F.col("r_regionkey").cast("bigint").alias("id"), F.col("r_name").alias("name")), name)
    catalog.insert_rows(spark, name, [(100, "it's new"), (101, None)])
    assert catalog.list_tables(spark).filter(F.col("tableName") == name).count() == 1
    return spark.table(name)
