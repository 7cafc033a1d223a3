import json
import os

from pyspark.sql import functions as F

from tidepool.streaming import events as E
from tidepool.streaming import ingest as I
from tidepool.streaming import windows as W
from tidepool.tables import keyed

# The three example events of the streaming lab.
LAB_EVENTS = [
    {"order_id": 2000, "order_ts": "2026-04-01 10:00:00", "product": "keyboard", "region": "US",
     "amount": 440.43, "quantity": 1},
    {"order_id": 2001, "order_ts": "2026-04-01 10:01:00", "product": "phone", "region": "EU",
     "amount": 1385.18, "quantity": 5},
    {"order_id": 2002, "order_ts": "2026-04-01 10:02:00", "product": "tablet", "region": "EU",
     "amount": 971.59, "quantity": 4},
]


def put(dirname, name, records, mtime):
    os.makedirs(dirname, exist_ok=True)
    p = os.path.join(dirname, name)
    with open(p, "w") as f:
        for r in records:
            f.write(r if isinstance(r, str) else json.dumps(r))
            f.write("\n")
    os.utime(p, (mtime, mtime))  # distinct, increasing mtimes order the files


def event(i, ts, amount=10.0, qty=1, region="US"):
    return {"order_id": i, "order_ts": ts, "product": "phone", "region": region,
            "amount": amount, "quantity": qty}


def ingest(spark, tmp, per_trigger=1):
    src = E.read_events(spark, path=f"{tmp}/in", max_per_trigger=per_trigger)
    q = I.run_ingest(spark, src, f"{tmp}/table", f"{tmp}/ckpt",
                     quarantine_path=f"{tmp}/quarantine", available_now=True)
    q.awaitTermination()


def test_ingest_one_version_per_batch_and_restart(spark, tmp):
    put(f"{tmp}/in", "a.json", LAB_EVENTS[:1], 1_000_000)
    put(f"{tmp}/in", "b.json", LAB_EVENTS[1:], 1_000_100)
    ingest(spark, tmp)
    t = I.read_ingested(spark, f"{tmp}/table")
    assert sorted(r.order_id for r in t.collect()) == [2000, 2001, 2002]
    assert spark.read.parquet(f"{tmp}/table").select("batch").distinct().count() == 2  # a folder per micro-batch
    totals = {r.order_id: r.total_amount for r in t.collect()}
    assert totals == {2000: 440.43, 2001: 6925.9, 2002: 3886.36}
    ingest(spark, tmp)  # restart, nothing new
    assert I.read_ingested(spark, f"{tmp}/table").count() == 3
    put(f"{tmp}/in", "c.json", [event(2003, "2026-04-01 10:03:00")], 1_000_200)
    ingest(spark, tmp)
    assert sorted(r.order_id for r in I.read_ingested(spark, f"{tmp}/table").collect()) == [2000, 2001, 2002, 2003]


def test_bad_records_go_to_quarantine(spark, tmp):
    bad = ['{"order_id": 3000, "order_ts": "2026-04-01 10:00:00", "amount": ',   # malformed
           '{"order_id": "abc", "order_ts": "2026-04-01 10:00:00", "amount": 1.0}',  # wrong type
           json.dumps(event(3001, "yesterday"))]                                  # bad time
    put(f"{tmp}/in", "a.json", LAB_EVENTS + bad, 1_000_000)
    ingest(spark, tmp)
    assert I.read_ingested(spark, f"{tmp}/table").count() == 3
    q = I.read_ingested(spark, f"{tmp}/quarantine")
    assert q.count() == 3 and q.filter(F.col("_raw").isNull()).count() == 0


def test_stream_equals_batch_projection(spark, tmp):
    put(f"{tmp}/in", "a.json", LAB_EVENTS, 1_000_000)
    ingest(spark, tmp)
    cols = ["order_id", "order_ts", "product", "region", "amount", "quantity", "total_amount"]
    streamed = sorted(tuple(r) for r in I.read_ingested(spark, f"{tmp}/table").select(*cols).collect())
    lines = spark.read.text(f"{tmp}/in")
    batch = E.parse_orders(lines.select(F.col("value").cast("binary").alias("value")))
    assert sorted(tuple(r) for r in batch.select(*cols).collect()) == streamed


def test_late_file_dropped_by_watermark(spark, tmp):
    # Spark drops a row when it is older than the watermark in force at the
    # *previous* batch, so the late file comes two batches after the jump.
    put(f"{tmp}/in", "1.json", [event(1, "2026-04-01 10:01:00"), event(2, "2026-04-01 10:02:00")], 1_000_000)
    put(f"{tmp}/in", "2.json", [event(3, "2026-04-01 11:00:00")], 1_000_100)
    put(f"{tmp}/in", "3.json", [event(4, "2026-04-01 11:01:00")], 1_000_200)
    put(f"{tmp}/in", "4.json", [event(5, "2026-04-01 10:03:00")], 1_000_300)  # an hour late
    put(f"{tmp}/in", "5.json", [event(6, "2026-04-01 12:00:00")], 1_000_400)
    src = E.parse_orders(E.read_events(spark, path=f"{tmp}/in", max_per_trigger=1))
    counts = W.windowed_counts(src.select("order_ts", "region"), "order_ts", "5 minutes",
                               ["region"], watermark="10 minutes")
    q = W.run_to_files(counts, f"{tmp}/out", f"{tmp}/ckpt")
    q.awaitTermination()
    got = {(str(r.window_start), r.n) for r in spark.read.parquet(f"{tmp}/out").collect()}
    # 10:00 keeps its two on-time rows; 11:00 is closed by the 12:00 event;
    # the 12:00 window is still open and not emitted
    assert got == {("2026-04-01 10:00:00", 2), ("2026-04-01 11:00:00", 2)}
    dropped = sum(s.get("numRowsDroppedByWatermark", 0)
                  for p in q.recentProgress for s in p["stateOperators"])
    assert dropped == 1


def test_streaming_upsert_keeps_latest_per_key(spark, tmp):
    put(f"{tmp}/in", "1.json", [event(1, "2026-04-01 10:00:00", 5.0), event(2, "2026-04-01 10:00:00", 7.0)], 1_000_000)
    put(f"{tmp}/in", "2.json", [event(1, "2026-04-01 10:05:00", 6.0), event(1, "2026-04-01 10:09:00", 9.0),
                                event(3, "2026-04-01 10:06:00", 1.0)], 1_000_100)
    src = E.read_events(spark, path=f"{tmp}/in", max_per_trigger=1)
    q = I.run_upsert(spark, src, f"{tmp}/acc", f"{tmp}/ckpt", ["order_id"], ["order_ts"], available_now=True)
    q.awaitTermination()
    table = keyed.open_table(spark, f"{tmp}/acc")
    assert {r.order_id: r.amount for r in table.read().collect()} == {1: 9.0, 2: 7.0, 3: 1.0}
    assert {r.order_id: r.amount for r in table.read(batch=1).collect()} == {1: 5.0, 2: 7.0}
    assert [r.operation for r in table.history().orderBy("batch").collect()] == ["MERGE", "MERGE"]


def test_upsert_ignores_late_events_and_keeps_bad_ones(spark, tmp):
    put(f"{tmp}/in", "1.json", [event(1, "2026-01-02 10:00:00", 5.0)], 1_000_000)
    put(f"{tmp}/in", "2.json", [event(1, "2026-01-01 10:00:00", 1.0), event("no id", "2026-01-01 10:00:00"), "{broken"], 1_000_100)
    src = E.read_events(spark, path=f"{tmp}/in", max_per_trigger=1)
    q = I.run_upsert(spark, src, f"{tmp}/acc", f"{tmp}/ckpt", ["order_id"], ["order_ts"], available_now=True)
    q.awaitTermination()
    assert [(r.order_id, r.amount) for r in keyed.open_table(spark, f"{tmp}/acc").read().collect()] == [(1, 5.0)]
    assert I.read_ingested(spark, I.rejected_path(f"{tmp}/acc")).count() == 2


def test_ingest_loses_no_event_by_default(spark, tmp):
    put(f"{tmp}/in", "a.json", LAB_EVENTS + ["{broken"], 1_000_000)
    q = I.run_ingest(spark, E.read_events(spark, path=f"{tmp}/in"), f"{tmp}/table", f"{tmp}/ckpt", available_now=True)
    q.awaitTermination()
    assert I.read_ingested(spark, f"{tmp}/table").count() == 3
    assert I.read_ingested(spark, f"{tmp}/table_rejected").count() == 1


def test_alerts_are_kafka_shaped(spark):
    counts = spark.createDataFrame([("u1", 7), ("u2", 2)], "user string, n long")
    out = W.alerts(counts, 5, key_col="user").collect()
    assert len(out) == 1 and out[0].key == "u1" and json.loads(out[0].value) == {"user": "u1", "n": 7}


def test_interval_join_semantics(spark):
    left = spark.createDataFrame([(1, "2026-04-01 10:00:00")], "k int, t string") \
        .withColumn("t", F.col("t").cast("timestamp"))
    right = spark.createDataFrame([(1, "2026-04-01 10:03:00"), (1, "2026-04-01 10:30:00")],
                                  "k int, u string").withColumn("u", F.col("u").cast("timestamp"))
    j = W.interval_join(left, right, "k", "t", "u", "10 minutes")
    assert j.count() == 1


def test_dedup_within_watermark(spark, tmp):
    put(f"{tmp}/in", "1.json", [event(1, "2026-04-01 10:00:00"), event(1, "2026-04-01 10:01:00"),
                                event(2, "2026-04-01 10:02:00")], 1_000_000)
    src = E.parse_orders(E.read_events(spark, path=f"{tmp}/in")).select("order_id", "order_ts")
    q = W.run_to_files(W.dedup_events(src, ["order_id"], "order_ts"), f"{tmp}/out", f"{tmp}/ckpt")
    q.awaitTermination()
    assert sorted(r.order_id for r in spark.read.parquet(f"{tmp}/out").collect()) == [1, 2]


def test_processing_time_trigger_and_clean_stop(spark, tmp):
    # A continuously running query (5 s trigger) is stopped cleanly
    put(f"{tmp}/in", "a.json", LAB_EVENTS, 1_000_000)
    src = E.read_events(spark, path=f"{tmp}/in")
    q = I.run_ingest(spark, src, f"{tmp}/table", f"{tmp}/ckpt", processing_time="1 second")
    q.processAllAvailable()
    I.await_or_stop(q, timeout_s=1)
    assert not q.isActive
    assert I.read_ingested(spark, f"{tmp}/table").count() == 3


def test_stream_stream_interval_join(spark, tmp):
    # Each order event joined to payment events of the same order within
    # 10 minutes, both sides streams with watermarks (state is evicted)
    put(f"{tmp}/orders", "1.json", [event(1, "2026-04-01 10:00:00"), event(2, "2026-04-01 10:05:00")], 1_000_000)
    put(f"{tmp}/pays", "1.json", [event(1, "2026-04-01 10:04:00"), event(2, "2026-04-01 10:30:00"),
                                  event(1, "2026-04-01 10:09:59")], 1_000_000)
    left = E.parse_orders(E.read_events(spark, path=f"{tmp}/orders")).select(
        "order_id", F.col("order_ts").alias("ordered_at"))
    right = E.parse_orders(E.read_events(spark, path=f"{tmp}/pays")).select(
        F.col("order_id").alias("pay_id"), F.col("order_ts").alias("paid_at"))
    right = right.withColumnRenamed("pay_id", "order_id")
    j = W.interval_join(left, right, "order_id", "ordered_at", "paid_at", "10 minutes")
    out = j.select(F.col("l.order_id").alias("order_id"), "ordered_at", "paid_at")
    q = W.run_to_files(out, f"{tmp}/out", f"{tmp}/ckpt")
    q.awaitTermination()
    got = sorted((r.order_id, str(r.paid_at)) for r in spark.read.parquet(f"{tmp}/out").collect())
    assert got == [(1, "2026-04-01 10:04:00"), (1, "2026-04-01 10:09:59")]
