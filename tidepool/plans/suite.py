"""The query suite over the driver tables, with a DuckDB twin for each query.

Each query takes ``(spark, base_dir)`` and returns a lazy DataFrame built
from the library's operators; every one reads whole tables. ``ORACLE``
holds the equivalent SQL (DuckDB dialect) with the same output column names.
Money is summed as DECIMAL so both engines give the same digits (D8);
averages of doubles are compared rounded to whole units.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.operators import aggregates as agg
from tidepool.operators import clean, joins, profile, text
from tidepool.sources import read_table
from tidepool.tables import rows as table_rows

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def wrap(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle.strip()
        return fn
    return wrap


# ---------------------------------------------------------------------------
# Shared building blocks
# ---------------------------------------------------------------------------

def geography(spark: SparkSession, d: str) -> DataFrame:
    """nation ⋈ region → (n_nationkey, region)."""
    n = read_table(spark, d, "nation")
    r = read_table(spark, d, "region")
    return (n.join(r, n.n_regionkey == r.r_regionkey)
             .select("n_nationkey", F.col("r_name").alias("region")))


def customer_region(spark: SparkSession, d: str) -> DataFrame:
    """(c_custkey, region)."""
    c = read_table(spark, d, "customer").select("c_custkey", "c_nationkey")
    return c.join(geography(spark, d), c.c_nationkey == F.col("n_nationkey")).select("c_custkey", "region")


def regional(spark: SparkSession, d: str, by: dict[str, Column] | None = None,
             orders: DataFrame | None = None) -> DataFrame:
    """orders ⋈ customer ⋈ (nation ⋈ region), summed per region and ``by``:
    region, by..., revenue, orders. Orders are summed per customer (and ``by``)
    first, with map-side combine: a customer with a third of all orders meets the
    customer table as one row per ``by`` value."""
    o = read_table(spark, d, "orders") if orders is None else orders
    names = list(by or {})
    per = (o.select("o_custkey", "o_totalprice", *[c.alias(n) for n, c in (by or {}).items()])
            .groupBy("o_custkey", *names)
            .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("s"), F.count(F.lit(1)).alias("n")))
    return (per.join(customer_region(spark, d), F.col("o_custkey") == F.col("c_custkey"))
               .groupBy("region", *names)
               .agg(F.sum("s").cast(agg.MONEY).alias("revenue"), F.sum("n").alias("orders")))


_GEO_SQL = """orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey"""


# ---------------------------------------------------------------------------
# Gold aggregates
# ---------------------------------------------------------------------------

@register("gold_daily_revenue", f"""
SELECT CAST(o.o_orderdate AS DATE) AS order_date, r.r_name AS region,
       CAST(SUM(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_revenue,
       COUNT(o.o_orderkey) AS order_count,
       (CAST(SUM(CAST(o.o_totalprice AS DECIMAL(18,2))) * 100 AS BIGINT) * 2 + COUNT(*))
         // (COUNT(*) * 2) AS avg_order_cents
FROM {_GEO_SQL}
GROUP BY 1, 2
""")
def gold_daily_revenue(spark: SparkSession, d: str) -> DataFrame:
    g = (regional(spark, d, {"order_date": F.to_date("o_orderdate")})
         .select("order_date", "region", F.col("revenue").alias("total_revenue"),
                 F.col("orders").alias("order_count")))
    return g.withColumn("avg_order_cents",
                        agg.avg_cents(F.col("total_revenue"), F.col("order_count")))


@register("gold_product_summary", """
SELECT p.p_brand AS product,
       CAST(SUM(l.l_quantity) AS BIGINT) AS total_units_sold,
       CAST(SUM(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_revenue,
       CAST(ROUND(AVG(l.l_extendedprice / l.l_quantity)) AS BIGINT) AS avg_unit_price,
       COUNT(l.l_orderkey) AS order_count
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY 1
""")
def gold_product_summary(spark: SparkSession, d: str) -> DataFrame:
    """Per-brand summary. Line items are first aggregated per part (a partial
    aggregate on the map side, so even a part holding a third of all lines
    crosses the shuffle as one row per task), and only those per-part rows
    meet the part table; the result is already partitioned by part key, so
    the join adds no second shuffle of the fact side."""
    li = read_table(spark, d, "lineitem")
    unit = F.try_divide("l_extendedprice", "l_quantity")  # null without units
    per_part = (li.groupBy("l_partkey")
                  .agg(F.sum("l_quantity").alias("qty"),
                       F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("rev"),
                       F.sum(unit).alias("unit_sum"), F.count(unit).alias("units"),
                       F.count("l_orderkey").alias("lines")))
    p = read_table(spark, d, "part").select("p_partkey", "p_brand")
    j = per_part.join(p, per_part.l_partkey == p.p_partkey)
    return (j.groupBy(F.col("p_brand").alias("product"))
             .agg(F.sum("qty").cast("bigint").alias("total_units_sold"),
                  F.sum("rev").cast(agg.MONEY).alias("total_revenue"),
                  F.round(F.try_divide(F.sum("unit_sum"), F.sum("units"))).cast("bigint").alias("avg_unit_price"),
                  F.sum("lines").alias("order_count")))


@register("region_summary", f"""
SELECT r.r_name AS region, COUNT(*) AS orders,
       CAST(SUM(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS revenue
FROM {_GEO_SQL}
GROUP BY 1
""")
def region_summary(spark: SparkSession, d: str) -> DataFrame:
    return regional(spark, d)


@register("monthly_revenue", f"""
SELECT CAST(year(o.o_orderdate) AS INTEGER) AS order_year,
       CAST(month(o.o_orderdate) AS INTEGER) AS order_month, r.r_name AS region,
       CAST(SUM(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS revenue,
       COUNT(*) AS orders
FROM {_GEO_SQL}
GROUP BY 1, 2, 3
""")
def monthly_revenue(spark: SparkSession, d: str) -> DataFrame:
    return regional(spark, d, {"order_year": F.year("o_orderdate"), "order_month": F.month("o_orderdate")})


@register("customer_spend", """
SELECT c.c_name AS c_name,
       CAST(SUM(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS spend,
       COUNT(*) AS orders
FROM customer c JOIN orders o ON c.c_custkey = o.o_custkey
GROUP BY 1
""")
def customer_spend(spark: SparkSession, d: str) -> DataFrame:
    """``JOIN … USING (customer_id)`` then SUM by name. Orders are
    pre-aggregated per customer key before meeting the customer table."""
    o = (read_table(spark, d, "orders")
         .groupBy(F.col("o_custkey").alias("c_custkey"))
         .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("s"),
              F.count(F.lit(1)).alias("n")))
    c = read_table(spark, d, "customer").select("c_custkey", "c_name")
    return (c.join(o, "c_custkey")
             .groupBy("c_name")
             .agg(F.sum("s").cast(agg.MONEY).alias("spend"), F.sum("n").alias("orders")))


@register("dict_aggregate", """
SELECT l_returnflag, SUM(l_quantity) AS total_quantity, COUNT(l_orderkey) AS line_count
FROM lineitem GROUP BY 1
""")
def dict_aggregate(spark: SparkSession, d: str) -> DataFrame:
    """``agg({"col": "fn"})`` with the generated names renamed."""
    li = read_table(spark, d, "lineitem")
    return agg.dict_agg(li, ["l_returnflag"], {"l_quantity": "sum", "l_orderkey": "count"},
                        {"sum(l_quantity)": "total_quantity", "count(l_orderkey)": "line_count"})


@register("file_glob_sql", """
SELECT o_orderstatus, COUNT(*) AS orders,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS revenue
FROM orders GROUP BY 1
""")
def file_glob_sql(spark: SparkSession, d: str) -> DataFrame:
    """SQL straight on files through a glob, no table registered."""
    return spark.sql(f"""
        SELECT o_orderstatus, COUNT(*) AS orders,
               CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS revenue
        FROM parquet.`{d.rstrip('/')}/order*.parquet`
        GROUP BY o_orderstatus""")


# ---------------------------------------------------------------------------
# Cleaning: dedup, rules
# ---------------------------------------------------------------------------

_LI_COLS = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, "
            "l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate")


@register("dedup_lineitem", f"""
SELECT {_LI_COLS} FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
               l_returnflag, l_linestatus) AS rn
  FROM lineitem) t
WHERE rn = 1
""")
def dedup_lineitem(spark: SparkSession, d: str) -> DataFrame:
    li = read_table(spark, d, "lineitem")
    return clean.dedup(li, ["l_orderkey", "l_linenumber"],
                       ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity",
                        "l_extendedprice", "l_discount", "l_tax"])


LINEITEM_RULES_SQL = """
SELECT rule, COUNT(*) AS rows FROM (
  SELECT CASE WHEN l_discount >= 0.1 THEN 'max_discount'
              WHEN l_quantity >= 50 THEN 'max_quantity'
              ELSE 'valid' END AS rule
  FROM lineitem) t
GROUP BY 1
"""


@register("rule_counts", LINEITEM_RULES_SQL)
def rule_counts(spark: SparkSession, d: str) -> DataFrame:
    li = read_table(spark, d, "lineitem")
    rules = [clean.Rule("max_discount", F.col("l_discount") >= 0.1),
             clean.Rule("max_quantity", F.col("l_quantity") >= 50)]
    return clean.apply_rules(li, rules).counts


# ---------------------------------------------------------------------------
# Joins (J1, J2, J5)
# ---------------------------------------------------------------------------

@register("anti_orders_without_items", """
SELECT * FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
""")
def anti_orders_without_items(spark: SparkSession, d: str) -> DataFrame:
    o = read_table(spark, d, "orders")
    li = read_table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.anti(o, li, "o_orderkey")


@register("kept_filtered", """
SELECT o.o_orderkey, o.o_orderstatus,
       CASE WHEN k.o_orderkey IS NULL THEN 'FILTERED' ELSE 'KEPT' END AS status
FROM orders o
LEFT JOIN (SELECT DISTINCT l_orderkey AS o_orderkey FROM lineitem) k ON o.o_orderkey = k.o_orderkey
""")
def kept_filtered(spark: SparkSession, d: str) -> DataFrame:
    o = read_table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    li = read_table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.keep_status(o, li, "o_orderkey")


@register("enrich_events", """
SELECT r.r_name AS region, COUNT(*) AS events,
       CAST(SUM(CAST(json_extract_string(e.props, '$.k') AS INTEGER)) AS BIGINT) AS k_total,
       CAST(SUM(CAST(e.value AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS value_total
FROM events e JOIN customer c ON e.user_id = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY 1
""")
def enrich_events(spark: SparkSession, d: str) -> DataFrame:
    """JSON logs ⋈ customers, aggregated by region. Events are first
    reduced per user (partial aggregate), so only one row per user and task
    crosses into the customer join."""
    ev = read_table(spark, d, "events")
    per_user = (ev.select("user_id", "value",
                          F.from_json("props", "k INT").getField("k").alias("k"))
                  .groupBy("user_id")
                  .agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("k"),
                       F.sum(F.col("value").cast("decimal(18,2)")).alias("v")))
    c = read_table(spark, d, "customer").select("c_custkey", "c_nationkey")
    cg = c.join(geography(spark, d), c.c_nationkey == F.col("n_nationkey"))
    j = per_user.join(cg, per_user.user_id == cg.c_custkey)
    return (j.groupBy("region")
             .agg(F.sum("n").alias("events"), F.sum("k").cast("bigint").alias("k_total"),
                  F.sum("v").cast(agg.MONEY).alias("value_total")))


# ---------------------------------------------------------------------------
# Events: logs, windows, sessions, JSON
# ---------------------------------------------------------------------------

@register("errors_per_user", """
SELECT user_id, COUNT(*) AS errors FROM events WHERE event_type = 'error' GROUP BY 1
""")
def errors_per_user(spark: SparkSession, d: str) -> DataFrame:
    ev = read_table(spark, d, "events")
    return agg.count_by(ev.filter(F.col("event_type") == "error"), "user_id", name="errors")


@register("json_props", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
""")
def json_props(spark: SparkSession, d: str) -> DataFrame:
    ev = read_table(spark, d, "events")
    return ev.select("event_id", F.from_json("props", "k INT").getField("k").alias("k"))


@register("tumbling_events", """
SELECT time_bucket(INTERVAL '5 minutes', ts) AS window_start,
       time_bucket(INTERVAL '5 minutes', ts) + INTERVAL '5 minutes' AS window_end,
       user_id, COUNT(*) AS n
FROM events GROUP BY 1, 2, 3
""")
def tumbling_events(spark: SparkSession, d: str) -> DataFrame:
    ev = read_table(spark, d, "events")
    return agg.tumbling(ev, "ts", "5 minutes", ["user_id"])


@register("sliding_events", """
SELECT ws AS window_start, ws + INTERVAL '10 minutes' AS window_end, COUNT(*) AS n FROM (
  SELECT time_bucket(INTERVAL '5 minutes', ts) AS ws FROM events
  UNION ALL
  SELECT time_bucket(INTERVAL '5 minutes', ts) - INTERVAL '5 minutes' AS ws FROM events) t
GROUP BY 1, 2
""")
def sliding_events(spark: SparkSession, d: str) -> DataFrame:
    ev = read_table(spark, d, "events")
    return agg.sliding(ev, "ts", "10 minutes", "5 minutes")


@register("session_windows", """
WITH marked AS (
  SELECT user_id, ts,
         CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL
                OR ts > lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL '2 hours'
              THEN 1 ELSE 0 END AS new_session
  FROM events),
numbered AS (
  SELECT user_id, ts,
         SUM(new_session) OVER (PARTITION BY user_id ORDER BY ts
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid
  FROM marked)
SELECT user_id, MIN(ts) AS session_start, MAX(ts) + INTERVAL '2 hours' AS session_end,
       COUNT(*) AS n
FROM numbered GROUP BY user_id, sid
""")
def session_windows(spark: SparkSession, d: str) -> DataFrame:
    ev = read_table(spark, d, "events")
    return agg.sessions(ev, "ts", "2 hours", ["user_id"])


@register("hourly_resample", """
WITH a AS (
  SELECT date_trunc('hour', ts) AS bucket, COUNT(*) AS n,
         CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_value
  FROM events GROUP BY 1),
g AS (
  SELECT unnest(generate_series((SELECT MIN(bucket) FROM a), (SELECT MAX(bucket) FROM a),
                                INTERVAL '1 hour')) AS bucket)
SELECT g.bucket, a.n, a.total_value FROM g LEFT JOIN a ON g.bucket = a.bucket
""")
def hourly_resample(spark: SparkSession, d: str) -> DataFrame:
    ev = read_table(spark, d, "events")
    return agg.resample(ev, "ts", "hour",
                        [F.count(F.lit(1)).alias("n"), agg.money_sum("value").alias("total_value")])


# ---------------------------------------------------------------------------
# Reshape, distinct, sort, profile
# ---------------------------------------------------------------------------

_PIVOT_ORACLE = """
SELECT o_orderpriority,
       COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS F,
       COUNT(*) FILTER (WHERE o_orderstatus = 'O') AS O,
       COUNT(*) FILTER (WHERE o_orderstatus = 'P') AS P
FROM orders GROUP BY 1
"""


@register("pivot_status", _PIVOT_ORACLE)
def pivot_status(spark: SparkSession, d: str) -> DataFrame:
    """G13 in SQL: Spark's ``PIVOT`` clause over the file."""
    return spark.sql("""
        SELECT * FROM (SELECT o_orderpriority, o_orderstatus FROM {orders})
        PIVOT (COUNT(1) FOR o_orderstatus IN ('F' AS F, 'O' AS O, 'P' AS P))""",
                     orders=read_table(spark, d, "orders"))


@register("pivot_status_df", _PIVOT_ORACLE)
def pivot_status_df(spark: SparkSession, d: str) -> DataFrame:
    """G13 in the DataFrame API with the value list given up front."""
    o = read_table(spark, d, "orders")
    return agg.pivot_count(o, "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


@register("unpivot_lineitem", """
SELECT l_orderkey, l_linenumber, 'l_quantity' AS measure, l_quantity AS value FROM lineitem
UNION ALL
SELECT l_orderkey, l_linenumber, 'l_extendedprice' AS measure, l_extendedprice AS value FROM lineitem
""")
def unpivot_lineitem(spark: SparkSession, d: str) -> DataFrame:
    li = read_table(spark, d, "lineitem")
    return agg.unpivot(li, ["l_orderkey", "l_linenumber"], ["l_quantity", "l_extendedprice"])


@register("distinct_status_priority", """
SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders
""")
def distinct_status_priority(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "orders").select("o_orderstatus", "o_orderpriority").distinct()


@register("top_orders", """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders
ORDER BY o_totalprice DESC, o_orderkey ASC LIMIT 10
""")
def top_orders(spark: SparkSession, d: str) -> DataFrame:
    """A top-10 report (the limit is the feature), tie-broken by key."""
    return (read_table(spark, d, "orders")
            .select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
            .orderBy(F.col("o_totalprice").desc(), F.col("o_orderkey").asc())
            .limit(10))


@register("profile_lineitem", """
SELECT column_name, nulls, distinct_values, min_value, max_value, rows FROM (
  SELECT 'l_orderkey' AS column_name, COUNT(*) - COUNT(l_orderkey) AS nulls,
         COUNT(DISTINCT l_orderkey) AS distinct_values,
         CAST(MIN(l_orderkey) AS VARCHAR) AS min_value, CAST(MAX(l_orderkey) AS VARCHAR) AS max_value,
         COUNT(*) AS rows FROM lineitem
  UNION ALL
  SELECT 'l_returnflag', COUNT(*) - COUNT(l_returnflag), COUNT(DISTINCT l_returnflag),
         MIN(l_returnflag), MAX(l_returnflag), COUNT(*) FROM lineitem
  UNION ALL
  SELECT 'l_quantity', COUNT(*) - COUNT(l_quantity), COUNT(DISTINCT l_quantity),
         CAST(MIN(l_quantity) AS VARCHAR), CAST(MAX(l_quantity) AS VARCHAR), COUNT(*) FROM lineitem
  UNION ALL
  SELECT 'l_shipdate', COUNT(*) - COUNT(l_shipdate), COUNT(DISTINCT l_shipdate),
         CAST(MIN(l_shipdate) AS VARCHAR), CAST(MAX(l_shipdate) AS VARCHAR), COUNT(*) FROM lineitem
) t
""")
def profile_lineitem(spark: SparkSession, d: str) -> DataFrame:
    """G12 with exact distinct counts (so the twin can check them)."""
    li = read_table(spark, d, "lineitem")
    return profile.summarize(li, ["l_orderkey", "l_returnflag", "l_quantity", "l_shipdate"],
                             approx=False)


# ---------------------------------------------------------------------------
# Text (M1)
# ---------------------------------------------------------------------------

@register("word_count", """
SELECT word, COUNT(*) AS count FROM (
  SELECT unnest(string_split(lower(text), ' ')) AS word FROM documents) t
GROUP BY 1
""")
def word_count(spark: SparkSession, d: str) -> DataFrame:
    return text.word_count(read_table(spark, d, "documents"), "text")


@register("top_words", """
SELECT word, COUNT(*) AS count FROM (
  SELECT unnest(string_split(lower(text), ' ')) AS word FROM documents) t
GROUP BY 1 ORDER BY count DESC, word ASC LIMIT 20
""")
def top_words(spark: SparkSession, d: str) -> DataFrame:
    return text.top_words(read_table(spark, d, "documents"), "text", 20)


# ---------------------------------------------------------------------------
# Row-level table changes (T2, T3, T4, T6) as pure DataFrame transforms.
# The same functions drive the file-level copy-on-write in tidepool.tables.
# ---------------------------------------------------------------------------

_ORDER_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


@register("update_orders", """
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN o_orderstatus = 'F' THEN o_totalprice * CAST(1.1 AS DOUBLE) ELSE o_totalprice END
         AS o_totalprice,
       o_orderdate, o_orderpriority
FROM orders
""")
def update_orders(spark: SparkSession, d: str) -> DataFrame:
    o = read_table(spark, d, "orders")
    return table_rows.updated(o, F.col("o_orderstatus") == "F",
                              {"o_totalprice": F.col("o_totalprice") * F.lit(1.1)})


@register("delete_orders", f"""
SELECT {_ORDER_COLS} FROM orders
WHERE NOT coalesce(o_orderpriority = '5-LOW' AND o_totalprice < 100000, false)
""")
def delete_orders(spark: SparkSession, d: str) -> DataFrame:
    o = read_table(spark, d, "orders")
    return table_rows.deleted(o, (F.col("o_orderpriority") == "5-LOW") & (F.col("o_totalprice") < 100000))


_MERGE_T = ("SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer "
            "WHERE c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE')")
_MERGE_S = ("SELECT c_custkey, c_name, c_acctbal + 100.0 AS c_acctbal, c_mktsegment FROM customer "
            "WHERE c_mktsegment IN ('FURNITURE', 'HOUSEHOLD', 'MACHINERY')")


@register("merge_accounts", f"""
WITH t AS ({_MERGE_T}), s AS ({_MERGE_S})
SELECT COALESCE(s.c_custkey, t.c_custkey) AS c_custkey,
       CASE WHEN s.c_custkey IS NOT NULL THEN s.c_name ELSE t.c_name END AS c_name,
       CASE WHEN s.c_custkey IS NOT NULL THEN s.c_acctbal ELSE t.c_acctbal END AS c_acctbal,
       CASE WHEN s.c_custkey IS NOT NULL THEN s.c_mktsegment ELSE t.c_mktsegment END AS c_mktsegment
FROM t FULL OUTER JOIN s ON t.c_custkey = s.c_custkey
""")
def merge_accounts(spark: SparkSession, d: str) -> DataFrame:
    """Upsert (update all on match, insert all otherwise). Target: the
    account snapshot of three segments; source: a change feed for three
    segments with new balances — one segment overlaps (updates), two are new
    (inserts), two are untouched."""
    c = read_table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    target = c.filter(F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING", "FURNITURE"))
    source = (c.filter(F.col("c_mktsegment").isin("FURNITURE", "HOUSEHOLD", "MACHINERY"))
               .withColumn("c_acctbal", F.col("c_acctbal") + F.lit(100.0)))
    return table_rows.merged(target, source, ["c_custkey"])


@register("append_orders", f"""
SELECT {_ORDER_COLS} FROM orders
UNION ALL
SELECT o_orderkey, o_custkey, 'O' AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM orders WHERE o_orderstatus = 'P'
""")
def append_orders(spark: SparkSession, d: str) -> DataFrame:
    """T2 as rows: the table plus an appended batch (pending orders re-sent
    as open), schema-checked against the table before the union."""
    o = read_table(spark, d, "orders").select(*[c.strip() for c in _ORDER_COLS.split(",")])
    batch = (o.filter(F.col("o_orderstatus") == "P")
              .withColumn("o_orderstatus", F.lit("O")))
    return table_rows.appended(o, batch)


# ---------------------------------------------------------------------------
# Streaming twins (X1-X7, X13): real Structured Streaming queries over the
# driver tables as a file source, run to completion with availableNow into a
# file sink in the shared checkpoint folder, then read back. Append mode
# emits a window/session only once the watermark (max event time − 10 min)
# has passed its end; when a finished input ends, the windows still open are
# counted by the batch form and added, so the result is whole.
# ---------------------------------------------------------------------------

def _stream_source(spark: SparkSession, d: str, name: str) -> DataFrame:
    schema = read_table(spark, d, name).schema
    # A file stream source needs a directory or a glob; the bracket glob
    # matches exactly the one table file.
    return spark.readStream.schema(schema).parquet(f"{d.rstrip('/')}/{name[:-1]}[{name[-1]}].parquet")


def _run_stream(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    import uuid

    from tidepool.session import scratch_path
    from tidepool.streaming.windows import run_to_files
    base = scratch_path(spark, f"streams/{name}-{uuid.uuid4().hex[:12]}")
    q = run_to_files(df, f"{base}/out", f"{base}/checkpoint")
    q.awaitTermination()
    out = spark.read.schema(df.schema).parquet(f"{base}/out")
    ts_cols = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
    return out.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c in ts_cols else F.col(c)
                        for c in out.columns])


def _with_open(closed: DataFrame, batch: DataFrame, events: DataFrame, end: str) -> DataFrame:
    """What the stream emitted, and of the batch form the windows that end
    behind the stream's last watermark (latest event − 10 minutes)."""
    last = events.agg(F.max("ts")).first()[0]
    still = batch.filter(F.col(end) > F.lit(last).cast("timestamp_ntz") - F.expr("INTERVAL 10 MINUTES"))
    return closed.unionByName(still.select(closed.columns))


@register("stream_tumbling_events", ORACLE["tumbling_events"])
def stream_tumbling_events(spark: SparkSession, d: str) -> DataFrame:
    from tidepool.streaming.events import to_event_time
    from tidepool.streaming.windows import windowed_counts
    ev = to_event_time(_stream_source(spark, d, "events"), "ts")
    closed = _run_stream(spark, windowed_counts(ev, "ts", "5 minutes", ["user_id"]), "tumbling")
    return _with_open(closed, QUERIES["tumbling_events"](spark, d), read_table(spark, d, "events"), "window_end")


@register("stream_sliding_events", ORACLE["sliding_events"])
def stream_sliding_events(spark: SparkSession, d: str) -> DataFrame:
    from tidepool.streaming.events import to_event_time
    from tidepool.streaming.windows import windowed_counts
    ev = to_event_time(_stream_source(spark, d, "events"), "ts")
    closed = _run_stream(spark, windowed_counts(ev, "ts", "10 minutes", slide="5 minutes"), "sliding")
    return _with_open(closed, QUERIES["sliding_events"](spark, d), read_table(spark, d, "events"), "window_end")


@register("stream_session_windows", ORACLE["session_windows"])
def stream_session_windows(spark: SparkSession, d: str) -> DataFrame:
    from tidepool.streaming.events import to_event_time
    from tidepool.streaming.windows import session_counts
    ev = to_event_time(_stream_source(spark, d, "events"), "ts")
    closed = _run_stream(spark, session_counts(ev, "ts", "2 hours", ["user_id"]), "sessions")
    return _with_open(closed, QUERIES["session_windows"](spark, d), read_table(spark, d, "events"), "session_end")


@register("stream_json_props", ORACLE["json_props"])
def stream_json_props(spark: SparkSession, d: str) -> DataFrame:
    ev = _stream_source(spark, d, "events")
    out = ev.select("event_id", F.from_json("props", "k INT").getField("k").alias("k"))
    return _run_stream(spark, out, "json_props")


@register("stream_error_counts", """
SELECT * FROM (
  SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start,
         time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS window_end,
         user_id, COUNT(*) AS n
  FROM events WHERE event_type = 'error' GROUP BY 1, 2, 3) w
""")
def stream_error_counts(spark: SparkSession, d: str) -> DataFrame:
    """M9 as a stream: hourly error counts per user (the alerting input)."""
    from tidepool.streaming.events import to_event_time
    from tidepool.streaming.windows import windowed_counts
    ev = to_event_time(_stream_source(spark, d, "events"), "ts").filter(F.col("event_type") == "error")
    closed = _run_stream(spark, windowed_counts(ev, "ts", "1 hour", ["user_id"]), "errors")
    errors = read_table(spark, d, "events").filter("event_type = 'error'")
    batch = agg.tumbling(errors, "ts", "1 hour", ["user_id"])
    batch = batch.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c.startswith("window_") else c
                           for c in batch.columns])
    return _with_open(closed, batch, errors, "window_end")


@register("stream_ingest_orders", """
SELECT o_orderkey AS order_id, o_orderdate AS order_ts, o_orderpriority AS product,
       o_orderstatus AS region, o_totalprice AS amount,
       CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS quantity,
       ROUND(o_totalprice * CAST(substr(o_orderpriority, 1, 1) AS INTEGER), 2) AS total_amount
FROM orders
""")
def stream_ingest_orders(spark: SparkSession, d: str) -> DataFrame:
    """M6 end to end: orders are published as JSON order events (one line
    per order, several files), a Structured Streaming job decodes them
    (X2) and appends each micro-batch to a Parquet table through
    ``foreachBatch`` with one folder per batch id (X4, X5); the result is the
    table read back (X10) without the ingest time stamp."""
    import uuid

    from tidepool.session import scratch_path
    from tidepool.streaming.events import read_event_files
    from tidepool.streaming.ingest import read_ingested, run_ingest
    base = scratch_path(spark, f"streams/ingest-{uuid.uuid4().hex[:12]}")
    o = read_table(spark, d, "orders")
    payload = F.to_json(F.struct(
        F.col("o_orderkey").alias("order_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("order_ts"),
        F.col("o_orderpriority").alias("product"),
        F.col("o_orderstatus").alias("region"),
        F.col("o_totalprice").alias("amount"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("quantity")))
    o.select(payload.alias("value")).write.text(f"{base}/in")
    q = run_ingest(spark, read_event_files(spark, f"{base}/in"), f"{base}/table",
                   f"{base}/checkpoint", available_now=True)
    q.awaitTermination()
    t = read_ingested(spark, f"{base}/table")
    return t.select("order_id", F.col("order_ts").cast("timestamp_ntz").alias("order_ts"),
                    "product", "region", "amount", "quantity", "total_amount")


# ---------------------------------------------------------------------------
# SQL surface: views, CTEs, functions, federated sources (S17, S18, F13, F14,
# G15, P16), enrichment pipeline (M8), salted join (J8), features.
# ---------------------------------------------------------------------------

@register("region_sales_since", f"""
SELECT r.r_name AS region,
       CAST(SUM(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS amount
FROM {_GEO_SQL}
WHERE o.o_orderdate >= TIMESTAMP '1998-01-01 00:00:00'
GROUP BY 1
""")
def region_sales_since(spark: SparkSession, d: str) -> DataFrame:
    """G15 + P16: ``df[df.order_date >= '…'].groupby('region')['amount'].sum()``.
    The date bound reaches the Parquet scan as a pushed filter."""
    o = read_table(spark, d, "orders").filter(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
    return regional(spark, d, orders=o).select("region", F.col("revenue").alias("amount"))


@register("view_over_filter", """
SELECT o_orderpriority, COUNT(*) AS orders,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS amount
FROM orders WHERE o_orderstatus = 'O' AND o_orderdate >= TIMESTAMP '1999-01-01 00:00:00'
GROUP BY 1
""")
def view_over_filter(spark: SparkSession, d: str) -> DataFrame:
    """A temp view defined as a filter, then an aggregate over it."""
    import uuid

    from tidepool.sources.catalog import create_view
    tag = uuid.uuid4().hex[:12]
    read_table(spark, d, "orders").createOrReplaceTempView(f"orders_src_{tag}")
    create_view(spark, f"open_recent_orders_{tag}",
                f"SELECT * FROM orders_src_{tag} WHERE o_orderstatus = 'O' "
                "AND o_orderdate >= TIMESTAMP_NTZ '1999-01-01 00:00:00'")
    return spark.sql(f"""
        SELECT o_orderpriority, COUNT(*) AS orders,
               CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS amount
        FROM open_recent_orders_{tag} GROUP BY o_orderpriority""")


@register("cte_segment_spend", """
WITH spend AS (
  SELECT o_custkey, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS s, COUNT(*) AS n
  FROM orders GROUP BY o_custkey)
SELECT c.c_mktsegment, COUNT(*) AS customers, CAST(SUM(spend.n) AS BIGINT) AS orders,
       CAST(SUM(spend.s) AS DECIMAL(38,2)) AS spend
FROM spend JOIN customer c ON spend.o_custkey = c.c_custkey
GROUP BY 1
""")
def cte_segment_spend(spark: SparkSession, d: str) -> DataFrame:
    """a ``WITH`` query in Spark SQL, aggregating before the join."""
    return spark.sql("""
        WITH spend AS (
          SELECT o_custkey, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS s, COUNT(*) AS n
          FROM {orders} GROUP BY o_custkey)
        SELECT c.c_mktsegment, COUNT(*) AS customers, CAST(SUM(spend.n) AS BIGINT) AS orders,
               CAST(SUM(spend.s) AS DECIMAL(38,2)) AS spend
        FROM spend JOIN {customer} c ON spend.o_custkey = c.c_custkey
        GROUP BY c.c_mktsegment""", orders=read_table(spark, d, "orders"),
                     customer=read_table(spark, d, "customer"))


@register("regex_dates_json", """
SELECT CAST(date_trunc('day', ts) AS DATE) AS day,
       regexp_extract(event_type, '^([a-z])', 1) AS type_initial,
       COUNT(*) AS events,
       CAST(SUM(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS BIGINT) AS k_total
FROM events GROUP BY 1, 2
""")
def regex_dates_json(spark: SparkSession, d: str) -> DataFrame:
    """a regex, a date function and a JSON path in one aggregate."""
    ev = read_table(spark, d, "events")
    return (ev.groupBy(F.to_date(F.date_trunc("day", "ts")).alias("day"),
                       F.regexp_extract("event_type", r"^([a-z])", 1).alias("type_initial"))
              .agg(F.count(F.lit(1)).alias("events"),
                   F.sum(F.get_json_object("props", "$.k").cast("int")).cast("bigint").alias("k_total")))


@register("doc_token_stats", """
SELECT lang, COUNT(*) AS docs,
       CAST(SUM(len(string_split(text, ' '))) AS BIGINT) AS tokens,
       CAST(SUM(CASE WHEN list_contains(string_split(lower(text), ' '), 'the') THEN 1 ELSE 0 END) AS BIGINT)
         AS docs_with_the
FROM documents GROUP BY 1
""")
def doc_token_stats(spark: SparkSession, d: str) -> DataFrame:
    """F13 arrays: ``size`` and ``array_contains`` over ``split`` of the whole
    text, per language."""
    docs = read_table(spark, d, "documents").select("lang", "text")
    # one split per text: lower-casing never adds or removes a space, so the
    # lower-cased tokens count the same as the original ones
    toks = docs.select("lang", F.split(F.lower("text"), " ").alias("toks"))
    return (toks.groupBy("lang")
                .agg(F.count(F.lit(1)).alias("docs"),
                     F.sum(F.size("toks")).cast("bigint").alias("tokens"),
                     F.sum(F.array_contains("toks", "the").cast("int")).cast("bigint")
                      .alias("docs_with_the")))


@register("federated_sql", """
SELECT c.c_mktsegment, r.r_name AS region, COUNT(*) AS orders,
       CAST(SUM(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS amount
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY 1, 2
""")
def federated_sql(spark: SparkSession, d: str) -> DataFrame:
    """One SQL statement over three formats — orders from Parquet
    (queried in place), customers from CSV and nations from JSON, both
    exported by Spark into the shared folder first (the reference's
    Parquet + CSV + JDBC join, with files standing in for the database)."""
    import uuid

    from tidepool.session import scratch_path
    from tidepool.sources import read_csv, write_csv
    base = scratch_path(spark, f"federated/{uuid.uuid4().hex[:12]}")
    write_csv(read_table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment"),
              f"{base}/customer_csv")
    (read_table(spark, d, "nation").join(read_table(spark, d, "region"),
                                        F.col("n_regionkey") == F.col("r_regionkey"))
     .select("n_nationkey", "r_name").write.json(f"{base}/nation_json"))
    customers = read_csv(spark, f"{base}/customer_csv",
                         schema="c_custkey bigint, c_nationkey int, c_mktsegment string")
    nations = spark.read.schema("n_nationkey int, r_name string").json(f"{base}/nation_json")
    orders_path = f"{d.rstrip('/')}/orders.parquet"
    return spark.sql("""
        SELECT c.c_mktsegment, n.r_name AS region, SUM(o.n) AS orders,
               CAST(SUM(o.s) AS DECIMAL(38,2)) AS amount
        FROM (SELECT o_custkey, COUNT(*) AS n, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS s
              FROM parquet.`""" + orders_path + """` GROUP BY o_custkey) o
          JOIN {customers} c ON o.o_custkey = c.c_custkey
          JOIN {nations} n ON c.c_nationkey = n.n_nationkey
        GROUP BY c.c_mktsegment, n.r_name""", customers=customers, nations=nations)


@register("nightly_etl_events", """
SELECT r.r_name AS region, COUNT(*) AS events,
       CAST(SUM(CAST(e.value AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS value_total
FROM events e JOIN customer c ON e.user_id = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY 1
""")
def nightly_etl_events(spark: SparkSession, d: str) -> DataFrame:
    """M8: raw JSON logs (events exported as JSON lines) ⋈ customer
    dimension → totals per region → Parquet, read back."""
    import uuid

    from tidepool.medallion import nightly_etl
    from tidepool.session import scratch_path
    base = scratch_path(spark, f"nightly/{uuid.uuid4().hex[:12]}")
    read_table(spark, d, "events").select("user_id", "event_type", "value", "props") \
        .write.json(f"{base}/logs")
    c = read_table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"), "c_nationkey")
    cust = c.join(geography(spark, d), c.c_nationkey == F.col("n_nationkey")).select("user_id", "region")
    out = nightly_etl(spark, f"{base}/logs", "user_id bigint, event_type string, value double, props string",
                      cust, "user_id", f"{base}/by_region", amount_col="value")
    return out.withColumnRenamed("amount", "value_total")


@register("salted_join_events", """
SELECT c.c_mktsegment, COUNT(*) AS events,
       CAST(SUM(CAST(e.value AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS value_total
FROM events e JOIN customer c ON e.user_id = c.c_custkey
GROUP BY 1
""")
def salted_join_events(spark: SparkSession, d: str) -> DataFrame:
    """Events ⋈ customer with the hot users' keys spread over 8 salts, for
    when one user holds a large share of the events."""
    ev = read_table(spark, d, "events").select("user_id", "value")
    c = read_table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"), "c_mktsegment")
    j = joins.salted_join(ev, c, "user_id", salts=8)
    return j.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("events"),
                                         agg.money_sum("value").alias("value_total"))


@register("user_features", """
SELECT user_id,
       COUNT(*) FILTER (WHERE event_type IS NULL OR event_type NOT IN
                        ('click', 'error', 'purchase', 'signup', 'view')) AS other,
       COUNT(*) FILTER (WHERE event_type = 'click') AS click,
       COUNT(*) FILTER (WHERE event_type = 'error') AS error,
       COUNT(*) FILTER (WHERE event_type = 'purchase') AS purchase,
       COUNT(*) FILTER (WHERE event_type = 'signup') AS signup,
       COUNT(*) FILTER (WHERE event_type = 'view') AS view,
       CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS value_total,
       COUNT(DISTINCT CAST(ts AS DATE)) AS active_days
FROM events GROUP BY 1
""")
def user_features(spark: SparkSession, d: str) -> DataFrame:
    """Per-user feature table (event-type counts via pivot, spend,
    active days) — the input of ``tidepool.ml.assemble``."""
    from tidepool.ml import user_feature_table
    return user_feature_table(read_table(spark, d, "events"))


@register("kmeans_embeddings", """
SELECT COUNT(*) AS vectors, CAST(10 AS BIGINT) AS clusters, true AS tighter_than_one_cluster
FROM embeddings
""")
def kmeans_embeddings(spark: SparkSession, d: str) -> DataFrame:
    """K-means (k=10, fixed seed) over all embedding vectors. The fit
    itself is iterative; what must hold of it is compared: every vector gets a
    cluster, no cluster is empty, and the cost is below that of one cluster."""
    from tidepool.ml import kmeans
    vectors = read_table(spark, d, "embeddings")
    model, scored = kmeans(vectors, "embedding", k=10)
    spread = _total_variance(vectors, "embedding") * (vectors.count() - 1)
    return scored.agg(F.count("cluster").alias("vectors"), F.count_distinct("cluster").alias("clusters"),
                      F.lit(bool(model.summary.trainingCost < spread)).alias("tighter_than_one_cluster"))


def _total_variance(df: DataFrame, column: str) -> float:
    """Sum over dimensions of the sample variance of an ``array`` column."""
    parts = df.select(F.posexplode(column).alias("i", "x")).groupBy("i").agg(F.var_samp("x").alias("v"))
    return parts.agg(F.sum("v")).first()[0]


# ---------------------------------------------------------------------------
# Snapshot tables end to end (T1-T5, T7, T10): the orders table is written
# as a table of whole versions in the shared folder, changed by an append, an
# UPDATE and a DELETE, then read at a past or current version.
# ---------------------------------------------------------------------------

def _orders_table(spark: SparkSession, d: str) -> str:
    """The orders table with four versions."""
    import uuid

    from tidepool.session import scratch_path
    from tidepool.tables import snapshots as T
    path = scratch_path(spark, f"tables/orders-{uuid.uuid4().hex[:12]}")
    o = read_table(spark, d, "orders").select(*[c.strip() for c in _ORDER_COLS.split(",")])
    T.write(o, path)                                                                      # v0
    T.write(o.filter(F.col("o_orderstatus") == "P").withColumn("o_orderstatus", F.lit("O")), path, "append")  # v1
    T.update(spark, path, F.col("o_orderstatus") == "F", {"o_totalprice": F.col("o_totalprice") * F.lit(1.1)})  # v2
    T.delete(spark, path, (F.col("o_orderpriority") == "5-LOW") & (F.col("o_totalprice") < 100000))  # v3
    return path


@register("versioned_time_travel", ORACLE["append_orders"])
def versioned_time_travel(spark: SparkSession, d: str) -> DataFrame:
    """After four commits, version 1 (the append) still reads as it was."""
    from tidepool.tables import snapshots as T
    return T.read(spark, _orders_table(spark, d), version=1)


@register("versioned_current", f"""
WITH v1 AS ({ORACLE['append_orders']}),
v2 AS (
  SELECT o_orderkey, o_custkey, o_orderstatus,
         CASE WHEN o_orderstatus = 'F' THEN o_totalprice * CAST(1.1 AS DOUBLE) ELSE o_totalprice END
           AS o_totalprice,
         o_orderdate, o_orderpriority
  FROM v1)
SELECT * FROM v2 WHERE NOT coalesce(o_orderpriority = '5-LOW' AND o_totalprice < 100000, false)
""")
def versioned_current(spark: SparkSession, d: str) -> DataFrame:
    """The current version after append, UPDATE and DELETE."""
    from tidepool.tables import snapshots as T
    return T.read(spark, _orders_table(spark, d))


@register("versioned_history", f"""
SELECT CAST(0 AS BIGINT) AS version, 'WRITE' AS operation, (SELECT COUNT(*) FROM orders) AS num_rows
UNION ALL
SELECT 1, 'APPEND', (SELECT COUNT(*) FROM ({ORACLE['append_orders']}) a)
UNION ALL
SELECT 2, 'UPDATE', (SELECT COUNT(*) FROM ({ORACLE['append_orders']}) a)
UNION ALL
SELECT 3, 'DELETE', (SELECT COUNT(*) FROM ({ORACLE['versioned_current']}) c)
""")
def versioned_history(spark: SparkSession, d: str) -> DataFrame:
    """The commit history of that table (operation and row count per
    version; timestamps are not compared)."""
    from tidepool.tables import snapshots as T
    return T.history(spark, _orders_table(spark, d)).select("version", "operation", "num_rows")


@register("versioned_add_column", f"""
SELECT {_ORDER_COLS},
       CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(0.1 AS DOUBLE) END AS discount
FROM orders
""")
def versioned_add_column(spark: SparkSession, d: str) -> DataFrame:
    """``ADD COLUMNS discount`` (a new version, null in every row), then
    an UPDATE fills it for urgent orders."""
    import uuid

    from tidepool.session import scratch_path
    from tidepool.tables import snapshots as T
    path = scratch_path(spark, f"tables/orders-ac-{uuid.uuid4().hex[:12]}")
    o = read_table(spark, d, "orders").select(*[c.strip() for c in _ORDER_COLS.split(",")])
    T.write(o, path, "overwrite")
    T.add_columns(spark, path, {"discount": "double"})
    T.update(spark, path, F.col("o_orderpriority") == "1-URGENT", {"discount": F.lit(0.1)})
    return T.read(spark, path)


@register("versioned_merge", ORACLE["merge_accounts"])
def versioned_merge(spark: SparkSession, d: str) -> DataFrame:
    """T6 on a table: the change feed is merged into the account snapshot
    and the new version read back."""
    import uuid

    from tidepool.session import scratch_path
    from tidepool.tables import snapshots as T
    path = scratch_path(spark, f"tables/accounts-{uuid.uuid4().hex[:12]}")
    c = read_table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    target = c.filter(F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING", "FURNITURE"))
    source = (c.filter(F.col("c_mktsegment").isin("FURNITURE", "HOUSEHOLD", "MACHINERY"))
               .withColumn("c_acctbal", F.col("c_acctbal") + F.lit(100.0)))
    T.write(target, path)
    T.merge(spark, path, source, ["c_custkey"])
    return T.read(spark, path)


def _order_events(o: DataFrame) -> DataFrame:
    """Orders as JSON order events (one line each), the stream payload."""
    return o.select(F.to_json(F.struct(
        F.col("o_orderkey").alias("order_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("order_ts"),
        F.col("o_orderpriority").alias("product"),
        F.col("o_orderstatus").alias("region"),
        F.col("o_totalprice").alias("amount"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("quantity"))).alias("value"))


@register("stream_upsert_orders", """
SELECT o_orderkey AS order_id,
       CASE WHEN o_orderstatus = 'O' THEN o_orderdate + INTERVAL '1 day' ELSE o_orderdate END AS order_ts,
       o_orderpriority AS product,
       CASE WHEN o_orderstatus = 'O' THEN 'F' ELSE o_orderstatus END AS region,
       o_totalprice AS amount,
       CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS quantity,
       ROUND(o_totalprice * CAST(substr(o_orderpriority, 1, 1) AS INTEGER), 2) AS total_amount
FROM orders
""")
def stream_upsert_orders(spark: SparkSession, d: str) -> DataFrame:
    """Incremental MERGE from a stream, over three micro-batches: the
    orders, then a correction feed (open orders closed a day later), then old
    events of finished orders that arrive late and must not overwrite the newer
    ones. Each batch rewrites the key buckets it has rows of."""
    import uuid

    from tidepool.session import scratch_path
    from tidepool.streaming.events import read_event_files
    from tidepool.streaming.ingest import run_upsert
    from tidepool.tables import keyed
    base = scratch_path(spark, f"streams/upsert-{uuid.uuid4().hex[:12]}")
    o = read_table(spark, d, "orders")
    corrections = (o.filter(F.col("o_orderstatus") == "O")
                    .withColumn("o_orderdate", F.col("o_orderdate") + F.expr("INTERVAL 1 DAY"))
                    .withColumn("o_orderstatus", F.lit("F")))
    late = (o.filter(F.col("o_orderstatus") != "P")
             .withColumn("o_orderdate", F.col("o_orderdate") - F.expr("INTERVAL 3 DAYS"))
             .withColumn("o_orderstatus", F.lit("X")))
    # availableNow reads what is there, so each feed is one run on the same checkpoint
    for name, feed in (("a", o), ("b", corrections), ("c", late)):
        _order_events(feed).write.text(f"{base}/in/{name}")
        run_upsert(spark, read_event_files(spark, f"{base}/in/*"), f"{base}/table", f"{base}/checkpoint",
                   ["order_id"], ["order_ts"], buckets=8, available_now=True).awaitTermination()
    t = keyed.open_table(spark, f"{base}/table").read()
    return t.select("order_id", F.col("order_ts").cast("timestamp_ntz").alias("order_ts"),
                    "product", "region", "amount", "quantity", "total_amount")


@register("pca_embeddings", """
SELECT CAST(64 AS INTEGER) AS components, ROUND(SUM(v), 2) AS total_variance
FROM (SELECT i, var_samp(x) AS v
      FROM (SELECT unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings) e GROUP BY i) g
""")
def pca_embeddings(spark: SparkSession, d: str) -> DataFrame:
    """All 64 principal components of all embeddings. A rotation keeps
    the total variance, so the projected rows must have the same one as the raw
    vectors, which SQL can sum."""
    from pyspark.ml.functions import vector_to_array
    from tidepool.ml import pca
    _, scored = pca(read_table(spark, d, "embeddings"), "embedding", k=64)
    parts = (scored.select(F.posexplode(vector_to_array("pca")).alias("i", "x"))
                   .groupBy("i").agg(F.var_samp("x").alias("v")))
    return parts.agg(F.count(F.lit(1)).cast("int").alias("components"), F.round(F.sum("v"), 2).alias("total_variance"))


_LABEL_MODEL_SQL = """
SELECT COUNT(*) AS documents, COUNT(*) AS scored FROM documents
"""


def _label_model(spark: SparkSession, d: str, kind: str) -> DataFrame:
    from tidepool.ml import fit_label_model
    _, scored = fit_label_model(read_table(spark, d, "documents"), read_table(spark, d, "labels"), "quality", kind=kind)
    return scored.agg(F.count(F.lit(1)).alias("documents"),
                      F.count(F.when(F.col("prediction").isin(0.0, 1.0), 1)).alias("scored"))


@register("quality_tree", _LABEL_MODEL_SQL)
def quality_tree(spark: SparkSession, d: str) -> DataFrame:
    """A decision tree on whole-text features, learned from the labelled
    documents; every document gets a prediction of 0 or 1."""
    return _label_model(spark, d, "tree")


@register("quality_logistic", _LABEL_MODEL_SQL)
def quality_logistic(spark: SparkSession, d: str) -> DataFrame:
    return _label_model(spark, d, "logistic")


@register("quality_forest", _LABEL_MODEL_SQL)
def quality_forest(spark: SparkSession, d: str) -> DataFrame:
    return _label_model(spark, d, "forest")


@register("quality_gbt", _LABEL_MODEL_SQL)
def quality_gbt(spark: SparkSession, d: str) -> DataFrame:
    return _label_model(spark, d, "gbt")


@register("als_events", """
SELECT COUNT(DISTINCT user_id) AS users, COUNT(DISTINCT (user_id, event_type)) AS scored FROM events
""")
def als_events(spark: SparkSession, d: str) -> DataFrame:
    """Implicit-feedback recommendations of event types to users; every
    user has factors, and every observed pair a score."""
    from tidepool.ml import implicit_als
    pairs = (read_table(spark, d, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
             .select(F.col("user_id").cast("int").alias("user"), F.col("n").cast("float").alias("n"),
                     F.pmod(F.xxhash64("event_type"), F.lit(1 << 30)).cast("int").alias("item")))
    model = implicit_als(pairs, "user", "item", "n")
    scored = model.transform(pairs).select(F.lit(0).alias("u"), (~F.isnan("prediction")).cast("int").alias("s"))
    both = scored.unionByName(model.userFactors.select(F.lit(1).alias("u"), F.lit(0).alias("s")))
    return both.agg(F.sum("u").alias("users"), F.sum("s").alias("scored"))


@register("stream_region_summary", """
SELECT o_orderstatus AS region, COUNT(*) AS orders,
       CAST(SUM(CAST(ROUND(o_totalprice * CAST(substr(o_orderpriority, 1, 1) AS INTEGER), 2)
                     AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS revenue
FROM orders GROUP BY 1
""")
def stream_region_summary(spark: SparkSession, d: str) -> DataFrame:
    """X10 + G4: the streamed order table, read as a batch table while the
    stream owns it, summarised per region (orders, revenue)."""
    import uuid

    from tidepool.session import scratch_path
    from tidepool.streaming.events import read_event_files
    from tidepool.streaming.ingest import read_ingested, run_ingest
    base = scratch_path(spark, f"streams/region-{uuid.uuid4().hex[:12]}")
    _order_events(read_table(spark, d, "orders")).write.text(f"{base}/in")
    q = run_ingest(spark, read_event_files(spark, f"{base}/in"), f"{base}/table",
                   f"{base}/checkpoint", available_now=True)
    q.awaitTermination()
    t = read_ingested(spark, f"{base}/table")
    return t.groupBy("region").agg(F.count(F.lit(1)).alias("orders"),
                                   agg.money_sum("total_amount").alias("revenue"))
