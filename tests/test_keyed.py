"""Tables of key buckets: changes write only the buckets they touch."""
import os
import re

import pytest

from tidepool.tables import keyed, rows


def folders(path, batch):
    found = set()
    for folder, _, names in os.walk(f"{path}/rows"):
        if any(n.endswith(".parquet") for n in names) and f"batch={batch}" in folder:
            found.add(int(re.search(r"bucket=(\d+)", folder)[1]))
    return found


@pytest.fixture()
def table(spark, tmp):
    df = spark.range(1000).selectExpr("id AS k", "id * 2 AS v", "CAST('2026-01-01' AS DATE) AS at")
    t = keyed.create(spark, f"{tmp}/t", df.schema, ["k"], 32)
    t.merge(df)
    return t


def test_ten_keys_rewrite_at_most_ten_buckets(spark, table):
    change = spark.createDataFrame([(k, -1, None) for k in range(5)] + [(2000 + k, -2, None) for k in range(5)],
                                   table.schema)
    touched = table.merge(change)
    assert len(touched) <= 10 and folders(table.path, 2) == set(touched)
    got = {r.k: r.v for r in table.read().collect()}
    assert len(got) == 1005 and all(got[k] == -1 for k in range(5)) and got[2003] == -2 and got[500] == 1000
    assert table.read(batch=1).count() == 1000  # the state before stays readable


def test_replay_starts_from_the_same_state(spark, table):
    change = spark.createDataFrame([(7, 70, None), (3000, 1, None)], table.schema)
    table.merge(change, batch=2)
    first = sorted(map(str, table.read().collect()))
    table.merge(change, batch=2)
    assert sorted(map(str, table.read().collect())) == first and table.last_batch() == 2


def test_failed_attempt_is_not_read(spark, table):
    before = sorted(map(str, table.read().collect()))
    # rows written, commit not: what a writer that died leaves behind
    (spark.createDataFrame([(7, 7, None)], table.schema).selectExpr("*", "0 AS bucket", "2 AS batch", "'dead' AS attempt")
     .write.mode("append").partitionBy("bucket", "batch", "attempt").parquet(f"{table.path}/rows"))
    assert sorted(map(str, table.read().collect())) == before
    touched = table.delete("k = 7")
    assert len(touched) == 1 and table.read().count() == 999


def test_update_delete_append(spark, table):
    assert len(table.update("k IN (1, 2)", {"v": "v + 100"})) <= 2
    assert sorted(r.v for r in table.read().where("k IN (1, 2)").collect()) == [102, 104]
    assert len(table.delete("k = 3")) == 1 and table.read().count() == 999
    touched = table.append(spark.createDataFrame([(5000, 1, None)], table.schema))
    assert folders(table.path, 4) == set(touched) and table.read().count() == 1000
    assert table.delete("v IS NULL") == [] and table.read().count() == 1000  # nothing matches
    table.delete("true")
    assert table.read().count() == 0
    with pytest.raises(rows.SchemaMismatch):
        table.update("true", {"k": "k + 1"})
    with pytest.raises(rows.SchemaMismatch):
        table.append(spark.range(1).selectExpr("id AS k", "1 AS other"))


def test_older_rows_do_not_win_and_keys_are_unique(spark, table):
    table.merge(spark.createDataFrame([(1, 5, None)], table.schema).selectExpr("k", "v", "CAST('2025-01-01' AS DATE) AS at"),
                order_by="at")
    assert table.read().where("k = 1").first().v == 2
    twice = spark.createDataFrame([(1, 5, None), (1, 6, None)], table.schema)
    with pytest.raises(rows.DuplicateSourceKeys):
        table.merge(twice)


def test_open_and_empty(spark, tmp, table):
    again = keyed.open_table(spark, table.path)
    assert again.keys == ["k"] and again.buckets == 32 and again.read().count() == 1000
    t = keyed.create(spark, f"{tmp}/empty", table.schema, ["k"], 4)
    assert t.read().count() == 0 and t.history().count() == 0
    t.merge(table.read().limit(0))
    assert t.read().count() == 0
    assert keyed.exists(spark, t.path) and not keyed.exists(spark, f"{tmp}/none")
