"""Event sources and the order-event parser.

The reference reads Kafka. Without a broker the same row shape comes from
a directory of JSON-lines files, so everything downstream of the source is
identical: ``value`` is the JSON payload as binary, as Kafka delivers it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType)

from tidepool.operators.clean import parse_timestamp

# The Kafka record as Spark's Kafka source produces it.
KAFKA_ENVELOPE = ("key binary, value binary, topic string, partition int, offset bigint, "
                  "timestamp timestamp, timestampType int")

# Payload fields of one order event, in the reference's order.
ORDER_EVENT_SCHEMA = StructType([
    StructField("order_id", LongType(), True),
    StructField("order_ts", StringType(), True),
    StructField("product", StringType(), True),
    StructField("region", StringType(), True),
    StructField("amount", DoubleType(), True),
    StructField("quantity", IntegerType(), True),
])


def read_kafka(spark: SparkSession, servers: str, topic: str, starting: str = "earliest",
               max_offsets_per_trigger: int | None = None) -> DataFrame:
    """The reference's source, for clusters that ship the Kafka
    connector. Bounded micro-batches via ``maxOffsetsPerTrigger``."""
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic)
         .option("startingOffsets", starting))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return r.load()


def read_event_files(spark: SparkSession, path: str, topic: str = "orders",
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """X1 on files: each line of each new file is one record, shaped like a
    Kafka record (``value`` binary, arrival time from the file). The source
    remembers processed files in the checkpoint, so a restart resumes."""
    r = spark.readStream
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = r.text(path)
    return lines.select(
        F.lit(None).cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        F.lit(None).cast("bigint").alias("offset"),
        F.col("_metadata.file_modification_time").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def read_events(spark: SparkSession, *, path: str | None = None, kafka_servers: str | None = None,
                topic: str = "orders", starting: str = "earliest",
                max_per_trigger: int | None = None) -> DataFrame:
    """One entry point: Kafka when servers are given, else the file form."""
    if kafka_servers:
        return read_kafka(spark, kafka_servers, topic, starting, max_per_trigger)
    if not path:
        raise ValueError("give a path or kafka_servers")
    return read_event_files(spark, path, topic, max_per_trigger)


def decode(df: DataFrame, schema: StructType = ORDER_EVENT_SCHEMA) -> DataFrame:
    """``CAST(value AS STRING)`` → ``from_json`` → columns (P5, P6, F10);
    the raw text is kept as ``_raw`` for the quarantine."""
    return (df.selectExpr("CAST(value AS STRING) AS _raw")
              .select(F.from_json("_raw", schema).alias("data"), "_raw")
              .select("data.*", "_raw"))


def parse_orders(df: DataFrame) -> DataFrame:
    """The stateless projection of the reference, shared by batch and
    stream: typed columns, ``total_amount``, ``_ingested_at``. A bad
    timestamp becomes NULL instead of failing the query (D6)."""
    return (decode(df)
            .withColumn("order_ts", parse_timestamp("order_ts"))
            .withColumn("total_amount", F.round(F.col("amount") * F.col("quantity"), 2))
            .withColumn("_ingested_at", F.current_timestamp()))


def is_valid_order() -> Column:
    """Rows without a key or time are quarantined: malformed JSON parses to
    all-NULL fields, a wrong-typed id to a NULL id (D6)."""
    return F.col("order_id").isNotNull() & F.col("order_ts").isNotNull()


def to_event_time(df: DataFrame, col: str) -> DataFrame:
    """Watermarks need ``timestamp``; test Parquet reads as
    ``timestamp_ntz``. With the session in UTC the cast keeps wall time."""
    return df.withColumn(col, F.col(col).cast("timestamp"))
