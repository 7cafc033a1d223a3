"""Bronze → Silver → Gold.

Each layer is written as Parquet and the next layer re-reads it
from storage, so lineage never spans layers: a lost executor recomputes at
most one layer, and every layer is a restart point.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidepool.operators import aggregates as agg
from tidepool.operators import clean, joins
from tidepool.sources import read_csv, read_json

# Bronze keeps every field as text, exactly as received (D2): typing happens
# in Silver, where a bad value is rejected by a rule instead of failing a cast.
# The raw order columns, in file order.
RAW_COLUMNS = ("order_id", "order_ts", "product", "region", "amount", "quantity")
BRONZE_SCHEMA = StructType([StructField(c, StringType(), True) for c in RAW_COLUMNS])

SILVER_RULES = (
    ("invalid_order_id", "order_id IS NULL"),
    ("invalid_order_ts", "order_ts IS NULL"),
    ("null_product", "product IS NULL"),
    ("invalid_amount", "amount IS NULL OR amount <= 0"),
    ("invalid_quantity", "quantity IS NULL OR quantity <= 0"),
)


def bronze_frame(raw: DataFrame) -> DataFrame:
    """M2: every row kept, plus when and from which file it arrived (D3)."""
    return (raw.withColumn("_ingested_at", F.current_timestamp())
               .withColumn("_source_file", F.col("_metadata.file_path")))


def _write(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def bronze(spark: SparkSession, raw_dir: str, bronze_path: str) -> None:
    raw = read_csv(spark, raw_dir, schema=BRONZE_SCHEMA, header=True, keep_whitespace=True)
    _write(bronze_frame(raw), bronze_path)


def typed(bronze_df: DataFrame) -> DataFrame:
    """Silver steps 1-2: normalize region, parse the text columns. Parsing
    never fails the job (ANSI mode): a bad value becomes NULL."""
    return bronze_df.select(
        clean.parse_number("order_id", "bigint").alias("order_id"),
        clean.parse_timestamp("order_ts").alias("order_ts"),
        F.col("product"),
        clean.normalize_code("region").alias("region"),
        clean.parse_number("amount", "double").alias("amount"),
        clean.parse_number("quantity", "int").alias("quantity"),
    )


def rules() -> list[clean.Rule]:
    return [clean.Rule(name, F.expr(cond)) for name, cond in SILVER_RULES]


def derive(df: DataFrame) -> DataFrame:
    """Silver step 5: the computed columns of the Silver contract."""
    return (df.withColumn("total_amount", F.round(F.col("amount") * F.col("quantity"), 2))
              .withColumn("order_date", F.col("order_ts").cast("date"))
              .withColumn("order_year", F.year("order_ts"))
              .withColumn("order_month", F.month("order_ts")))


@dataclass
class SilverResult:
    silver: DataFrame
    rejected: DataFrame
    rule_counts: DataFrame
    tagged: DataFrame


def silver_frame(bronze_df: DataFrame) -> SilverResult:
    """M3 in the reference's order: normalize → parse → reject → dedup →
    derive → drop metadata. Rules run before dedup (D5), so the earliest
    *valid* row of an order id is the one kept; ties at the same timestamp
    are broken by the other columns (D4)."""
    res = clean.apply_rules(typed(bronze_df), rules())
    deduped = clean.dedup(res.valid, ["order_id"], ["order_ts"])
    return SilverResult(derive(deduped), res.rejected, res.counts, res.tagged)


def silver(spark: SparkSession, bronze_path: str, silver_path: str,
           quarantine_path: str | None = None) -> None:
    """Writes Silver and the quarantine (``<silver>_rejected`` unless named). Both come from one tagged pass
    over Bronze, which is persisted (memory, then disk) while the two writes
    run, so Bronze is parsed once; a lost block is recomputed from Bronze."""
    from pyspark import StorageLevel
    res = silver_frame(spark.read.parquet(bronze_path))
    res.tagged.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        _write(res.rejected, quarantine_path or f"{silver_path.rstrip('/')}_rejected")
        _write(res.silver, silver_path)
    finally:
        res.tagged.unpersist()


def gold(spark: SparkSession, silver_path: str, daily_path: str, product_path: str) -> None:
    """M4: the two Gold tables, unsorted on disk."""
    s = spark.read.parquet(silver_path)
    _write(agg.daily_revenue(s), daily_path)
    _write(agg.product_summary(s), product_path)


def reconcile(spark: SparkSession, layers: dict[str, str], raw_dir: str | None = None) -> DataFrame:
    """Row count per layer as one small DataFrame (one job)."""
    parts = []
    if raw_dir:
        raw = read_csv(spark, raw_dir, schema=BRONZE_SCHEMA, header=True)
        parts.append(raw.agg(F.count(F.lit(1)).alias("rows")).select(F.lit("raw").alias("layer"), "rows"))
    for name, path in layers.items():
        parts.append(spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows"))
                     .select(F.lit(name).alias("layer"), "rows"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def run(spark: SparkSession, raw_dir: str, root: str) -> dict[str, str]:
    """The whole chain; rerunning it gives the same tables (M5)."""
    root = root.rstrip("/")
    paths = {"bronze": f"{root}/bronze", "silver": f"{root}/silver",
             "gold_daily_revenue": f"{root}/gold_daily_revenue",
             "gold_product_summary": f"{root}/gold_product_summary",
             "quarantine": f"{root}/quarantine"}
    bronze(spark, raw_dir, paths["bronze"])
    silver(spark, paths["bronze"], paths["silver"], paths["quarantine"])
    gold(spark, paths["silver"], paths["gold_daily_revenue"], paths["gold_product_summary"])
    return paths


def nightly_etl(spark: SparkSession, json_dir: str, json_schema: StructType | str,
                customers: DataFrame, key: str, out_path: str,
                region_col: str = "region", amount_col: str = "amount") -> DataFrame:
    """M8: raw JSON logs ⋈ customer dimension → totals per region → Parquet.

    Logs are reduced per customer key before the join (partial aggregate),
    so the join sees one row per key and task instead of every log line.
    """
    logs = read_json(spark, json_dir, json_schema)
    per_key = logs.groupBy(key).agg(F.count(F.lit(1)).alias("events"),
                                    agg.money_sum(amount_col).alias("amount"))
    out = (joins.enrich(per_key, customers.select(key, region_col), key)
           .groupBy(region_col)
           .agg(F.sum("events").alias("events"), F.sum("amount").cast(agg.MONEY).alias("amount")))
    out.write.mode("overwrite").parquet(out_path)
    return spark.read.parquet(out_path)
