import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F

from fixtures import SALES_APPEND, SALES_MERGE, SALES_SCHEMA, SALES_V0
from tidepool.tables import rows as R
from tidepool.tables import snapshots as T


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture()
def sales(spark, tmp):
    path = f"{tmp}/sales"
    T.write(spark.createDataFrame(SALES_V0, SALES_SCHEMA).repartition(3), path)
    T.write(spark.createDataFrame(SALES_APPEND, SALES_SCHEMA), path, "append")
    T.update(spark, path, "region = 'EU'", {"amount": F.col("amount") * 1.1})
    T.delete(spark, path, "amount < 500")
    T.merge(spark, path, spark.createDataFrame(SALES_MERGE, SALES_SCHEMA), ["order_id"])
    return path


def test_crud_walk_golden(spark, sales):
    counts = [T.read(spark, sales, version=v).count() for v in range(5)]
    assert counts == [6, 8, 8, 6, 7]
    v2 = {r.order_id: r.amount for r in T.read(spark, sales, version=2).collect()}
    assert v2[1] == pytest.approx(1099.989) and v2[3] == pytest.approx(493.9)
    assert v2[6] == pytest.approx(824.989)
    cur = {r.order_id: r.amount for r in T.read(spark, sales).collect()}
    assert sorted(cur) == [1, 2, 4, 5, 6, 7, 9]
    assert cur[1] == 1200.0 and cur[6] == pytest.approx(824.989)
    log = T.history(spark, sales).orderBy("version").collect()
    assert [r.operation for r in log] == ["WRITE", "APPEND", "UPDATE", "DELETE", "MERGE"]
    assert [r.num_rows for r in log] == counts


def test_schema_enforcement_leaves_table_unchanged(spark, sales):
    before = T.latest_version(spark, sales)
    bad = spark.createDataFrame([(10, "US", "laptop", 999.0, 0.15)], SALES_SCHEMA + ", discount double")
    with pytest.raises(T.SchemaMismatch):
        T.write(bad, sales, "append")
    with pytest.raises(T.SchemaMismatch):  # a missing column does not become null unasked
        T.write(spark.createDataFrame([(10, "US")], "order_id long, region string"), sales, "append")
    assert T.latest_version(spark, sales) == before
    assert T.read(spark, sales).count() == 7


def test_add_columns_then_update(spark, sales):
    T.add_columns(spark, sales, {"discount": "double"})
    assert T.read(spark, sales).filter("discount IS NULL").count() == 7
    T.update(spark, sales, "region = 'EU'", {"discount": F.lit(0.10)})
    eu = sorted(r.order_id for r in T.read(spark, sales).filter("discount = 0.10").collect())
    assert eu == [1, 6]
    with pytest.raises(T.SchemaMismatch):
        T.add_columns(spark, sales, {"discount": "double"})


def test_merge_schema_append(spark, sales):
    extra = spark.createDataFrame([(11, "US", "phone", 10.0, "web")], SALES_SCHEMA + ", channel string")
    T.write(extra, sales, "append", merge_schema=True)
    df = T.read(spark, sales)
    assert "channel" in df.columns and df.filter("channel IS NULL").count() == 7


def test_null_condition_matches_nothing(spark, tmp):
    path = f"{tmp}/n"
    T.write(spark.createDataFrame([(1, None), (2, 5.0)], "id long, x double"), path)
    T.update(spark, path, "x > 1", {"x": F.lit(0.0)})
    T.delete(spark, path, "x < 100")
    assert rows(T.read(spark, path)) == [(1, None)]


def test_merge_is_idempotent_and_rejects_duplicate_keys(spark, sales):
    src = spark.createDataFrame(SALES_MERGE, SALES_SCHEMA)
    T.merge(spark, sales, src, ["order_id"])
    assert T.read(spark, sales).count() == 7
    dup = spark.createDataFrame(SALES_MERGE + [(9, "EU", "x", 1.0)], SALES_SCHEMA)
    with pytest.raises(T.DuplicateSourceKeys):
        T.merge(spark, sales, dup, ["order_id"])


def test_merge_replay_writes_the_same_version(spark, tmp):
    path = f"{tmp}/replay"
    T.write(spark.createDataFrame([(1, 1.0)], "id long, v double"), path)
    for _ in range(2):  # the second run is a replay of batch 0
        T.merge(spark, path, spark.createDataFrame([(1, 2.0), (2, 5.0)], "id long, v double"), ["id"], version=1)
    assert T.latest_version(spark, path) == 1 and rows(T.read(spark, path)) == [(1, 2.0), (2, 5.0)]


def test_merge_with_missing_columns_is_refused(spark):
    target = spark.createDataFrame([(1, "a", 1)], "k int, s string, v int")
    with pytest.raises(R.SchemaMismatch):
        R.merged(target, spark.createDataFrame([(1, 2)], "k int, v int"), ["k"])


def test_merge_keeps_newer_rows(spark):
    target = spark.createDataFrame([(1, 5, "new"), (2, 5, "old"), (3, None, "none")], "k int, t int, v string")
    source = spark.createDataFrame([(1, 4, "late"), (2, 6, "newer"), (3, 1, "some"), (4, 1, "insert")],
                                   "k int, t int, v string")
    assert rows(R.merged(target, source, ["k"], order_by="t")) == [
        (1, 5, "new"), (2, 6, "newer"), (3, 1, "some"), (4, 1, "insert")]


def test_time_travel_by_timestamp(spark, tmp):
    path = f"{tmp}/tt"
    T.write(spark.range(3), path)
    time.sleep(1.1)
    mid = dt.datetime.now(dt.timezone.utc)
    time.sleep(1.1)
    T.write(spark.range(3, 5), path, "append")
    assert T.read(spark, path, as_of=mid).count() == 3
    assert T.read(spark, path).count() == 5
    with pytest.raises(T.VersionNotFound):
        T.read(spark, path, as_of="2000-01-01T00:00:00")


def test_a_failed_write_is_not_read(spark, tmp):
    import glob
    import os
    path = f"{tmp}/failed"
    T.write(spark.range(3), path)
    T.write(spark.range(9), path)
    os.unlink(glob.glob(f"{path}/version=1/operation=*/_SUCCESS")[0])  # as if the writer had died
    assert T.read(spark, path).count() == 3
    T.write(spark.range(5), path)
    assert T.latest_version(spark, path) == 1 and T.read(spark, path).count() == 5


def test_create_then_insert(spark, tmp):
    path = f"{tmp}/created"
    T.create(spark, path, SALES_SCHEMA)
    assert T.read(spark, path).count() == 0
    T.write(spark.createDataFrame(SALES_V0, SALES_SCHEMA), path, "append")
    assert [r.operation for r in T.history(spark, path).orderBy("version").collect()] == ["CREATE", "APPEND"]
    with pytest.raises(T.TableError):
        T.create(spark, path, SALES_SCHEMA)
    with pytest.raises(T.TableError):
        T.read(spark, f"{tmp}/nothing")


def test_expire(spark, sales):
    assert T.expire(spark, sales, keep_last=2) == [0, 1, 2]
    with pytest.raises(T.VersionNotFound):
        T.read(spark, sales, version=0)
    assert T.read(spark, sales).count() == 7


def test_merge_with_nondeterministic_source_is_consistent(spark, tmp):
    path = f"{tmp}/nd"
    T.write(spark.range(0, 100).withColumn("v", F.lit(0.0)), path)
    T.merge(spark, path, spark.range(50, 150).withColumn("v", F.rand(11)), ["id"])
    out = T.read(spark, path)
    assert out.count() == 150 and out.filter("id >= 50 AND v = 0.0").count() == 0


def test_merge_updates_every_matched_copy(spark):
    target = spark.createDataFrame([(1, "a"), (1, "b"), (1, "c"), (2, "d"), (None, "n")], "k int, v string")
    source = spark.createDataFrame([(1, "X"), (3, "Y")], "k int, v string")
    assert rows(R.merged(target, source, ["k"])) == sorted(
        [(1, "X"), (1, "X"), (1, "X"), (2, "d"), (None, "n"), (3, "Y")], key=repr)
    assert rows(R.merged(target, source, ["k"], update=False, insert=False)) == rows(target)
    assert rows(R.merged(target, source, ["k"], delete_matched=True)) == sorted(
        [(2, "d"), (None, "n"), (3, "Y")], key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_changes_match_plain_python(spark, tmp, seed):
    """Random appends, updates, deletes and merges against lists; every
    version keeps reading as it was."""
    rnd = random.Random(seed)
    path, schema = f"{tmp}/model", "id long, g string, v double"
    model = [(i, rnd.choice("abc"), float(rnd.randint(0, 9))) for i in range(40)]
    T.write(spark.createDataFrame(model, schema), path)
    versions = [sorted(model)]
    for _ in range(5):
        op = rnd.choice(["append", "update", "delete", "merge"])
        if op == "append":
            new = [(rnd.randint(0, 60), rnd.choice("abcd"), float(rnd.randint(0, 9))) for _ in range(5)]
            T.write(spark.createDataFrame(new, schema), path, "append")
            model = model + new
        elif op == "update":
            g = rnd.choice("abcd")
            T.update(spark, path, F.col("g") == g, {"v": F.col("v") + 100})
            model = [(i, x, v + 100) if x == g else (i, x, v) for i, x, v in model]
        elif op == "delete":
            least = float(rnd.randint(0, 9))
            T.delete(spark, path, F.col("v") < least)
            model = [r for r in model if r[2] >= least]
        else:
            keys = rnd.sample(range(0, 80), 8)
            T.merge(spark, path, spark.createDataFrame([(k, "m", float(k)) for k in keys], schema), ["id"])
            had = {r[0] for r in model}
            model = ([(i, "m", float(i)) if i in keys else (i, g, v) for i, g, v in model]
                     + [(k, "m", float(k)) for k in keys if k not in had])
        versions.append(sorted(model))
    for v, expected in enumerate(versions):
        assert sorted(tuple(r) for r in T.read(spark, path, version=v).collect()) == expected
