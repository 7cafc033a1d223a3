import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF01
from tidepool.sources import catalog, read_partitioned, sql_on_files, to_pandas, write_parquet
from tidepool.plans.inspect import explain_text


def test_range_even_count(spark):
    # The hands-on chapter's first job
    assert spark.range(1_000_000).filter("id % 2 = 0").count() == 500_000


def test_partitioned_write_and_pruning(spark, tmp):
    o = spark.read.parquet(f"{SF01}/orders.parquet")
    write_parquet(o, f"{tmp}/orders_p", partition_by=["o_orderstatus"])
    df = read_partitioned(spark, f"{tmp}/orders_p").filter(F.col("o_orderstatus") == "F")
    assert "PartitionFilters: [isnotnull(o_orderstatus" in explain_text(df)
    assert df.count() == o.filter("o_orderstatus = 'F'").count()


def test_orc_round_trip(spark, tmp):
    o = spark.read.parquet(f"{SF01}/region.parquet")
    o.write.orc(f"{tmp}/r_orc")
    assert sorted(spark.read.orc(f"{tmp}/r_orc").collect()) == sorted(o.collect())


def test_sql_on_files_glob(spark):
    n = sql_on_files(spark, f"{SF01}/regio*.parquet", select="count(*) AS n").first().n
    assert n == 5


def test_catalog_ddl(spark, tmp):
    catalog.create_database(spark, "lab", location=f"{tmp}/lab.db")
    catalog.drop_table(spark, "lab.sales")
    catalog.create_table(spark, "lab.sales", "order_id BIGINT, region STRING, amount DOUBLE",
                         partitioned_by=["region"])
    catalog.insert_rows(spark, "lab.sales", [(1, 10.0, "EU"), (2, 20.0, "US")])
    catalog.append(spark.createDataFrame([(3, 5.0, "EU")], spark.table("lab.sales").schema), "lab.sales")
    assert spark.sql("SELECT COUNT(*) AS n FROM lab.sales WHERE region = 'EU'").first().n == 2
    assert "sales" in [r.tableName for r in catalog.list_tables(spark, "lab").collect()]
    spark.range(3).write.parquet(f"{tmp}/ext")
    assert catalog.register_location(spark, "lab.ext", f"{tmp}/ext").count() == 3
    v = catalog.create_view(spark, "eu_sales", "SELECT * FROM lab.sales WHERE region = 'EU'")
    assert v.count() == 2
    catalog.drop_table(spark, "lab.sales")


def test_to_pandas_guard(spark):
    df = spark.range(10)
    assert isinstance(to_pandas(df, 10), pd.DataFrame)
    with pytest.raises(ValueError):
        to_pandas(df, 9)


def test_query_result_as_csv_and_contains(spark, tmp):
    # A query's result written as CSV with header; P15: substring test
    from tidepool.sources import read_csv, write_csv
    lines = spark.createDataFrame([("INFO start",), ("ERROR disk full",), ("ERROR timeout",)], ["line"])
    errors = lines.filter(F.col("line").contains("ERROR"))
    write_csv(errors, f"{tmp}/errors_csv")
    back = read_csv(spark, f"{tmp}/errors_csv", schema="line string")
    assert sorted(r.line for r in back.collect()) == ["ERROR disk full", "ERROR timeout"]


def test_bucketed_tables_join_without_exchange(spark, tmp):
    from tidepool.operators.partitioning import write_bucketed
    from tidepool.plans.inspect import explain_text
    o = spark.read.parquet(f"{SF01}/orders.parquet").select("o_orderkey", "o_totalprice")
    li = spark.read.parquet(f"{SF01}/lineitem.parquet").select("l_orderkey", "l_quantity")
    write_bucketed(o, "b_orders", ["o_orderkey"], 8, path=f"{tmp}/b_orders")
    write_bucketed(li, "b_lineitem", ["l_orderkey"], 8, path=f"{tmp}/b_lineitem")
    j = spark.table("b_orders").join(spark.table("b_lineitem"),
                                      F.col("o_orderkey") == F.col("l_orderkey"))
    plan = explain_text(j, "simple")
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert j.count() == o.join(li, F.col("o_orderkey") == F.col("l_orderkey")).count()


def test_scale_conf_sizes_partitions():
    from tidepool.session import scale_conf
    c = scale_conf(100 * 1024 ** 4)
    assert c["spark.sql.shuffle.partitions"] == "204800"
    assert c["spark.sql.files.maxPartitionBytes"] == str(256 * 1024 * 1024)
    assert scale_conf(10 * 1024 ** 3)["spark.sql.shuffle.partitions"] == "20"


def test_read_text_lines_and_whole(spark, tmp):
    # Text lines (one row per line) and whole files (one row per file)
    from tidepool.sources import read_text
    import os
    os.makedirs(f"{tmp}/logs", exist_ok=True)
    with open(f"{tmp}/logs/a.txt", "w") as f:
        f.write("INFO up\nERROR down\nERROR again\n")
    lines = read_text(spark, f"{tmp}/logs")
    assert lines.filter(F.col("value").contains("ERROR")).count() == 2
    assert read_text(spark, f"{tmp}/logs", whole_text=True).count() == 1
