"""Plan properties the design relies on."""
from tidepool.plans import extended, suite, surface  # noqa: F401  (extended and surface add their queries to suite)
from tidepool.plans.inspect import explain_text, uses_python
from conftest import SF01


def plan(df):
    return explain_text(df, "simple")


def formatted(df):
    return explain_text(df, "formatted")


def test_filter_and_projection_reach_the_scan(spark):
    df = suite.errors_per_user(spark, SF01)
    f = formatted(df)
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,error)]" in f
    assert "ReadSchema: struct<user_id:bigint,event_type:string>" in f


def test_no_job_runs_while_a_batch_query_is_built(spark):
    """Building a star query starts no Spark job but Parquet footer reads."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build", "build")
    for name in ("gold_daily_revenue", "region_summary", "enrich_events", "merge_accounts", "dedup_lineitem"):
        suite.QUERIES[name](spark, SF01)
    stages = [s for j in tracker.getJobIdsForGroup("build") for s in tracker.getJobInfo(j).stageIds]
    spark.sparkContext.setJobGroup("rest", "rest")
    names = {tracker.getStageInfo(s).name for s in stages if tracker.getStageInfo(s)}
    assert all(n.startswith("parquet at") for n in names), names


def test_star_queries_sum_per_customer_before_the_join(spark):
    for name in ("gold_daily_revenue", "region_summary", "monthly_revenue"):
        f = plan(suite.QUERIES[name](spark, SF01))
        assert "partial_sum" in f.split("Join")[-1] or f.count("partial_sum") >= 2, name
        assert "RoundRobin" not in f, name


def test_dedup_limits_each_key_before_the_shuffle(spark):
    p = plan(suite.dedup_lineitem(spark, SF01))
    assert "Partial" in p and "WindowGroupLimit" in p and "RoundRobin" not in p


# these run jobs while being built; covered by their answers
RUNS = ("stream_", "versioned_", "federated_sql", "nightly_etl_events", "kmeans_", "pca_", "quality_", "als_",
        "medallion_", "formats_", "catalog_", "ranked_", "keyed_", "asof_", "reconcile_", "price_regression",
        "frequent_")


def test_no_python_in_suite(spark):
    for name, fn in suite.QUERIES.items():
        if not name.startswith(RUNS) and name != "folded_segments":  # that one shows the vectorised functions
            assert not uses_python(fn(spark, SF01)), name


def test_product_summary_preaggregates_before_join(spark):
    f = formatted(suite.gold_product_summary(spark, SF01))
    # a partial aggregate on the line-item scan side precedes the join
    assert f.index("HashAggregate") < f.index("Join") or "partial_sum" in f


def test_no_cross_or_nested_loop_joins(spark):
    """No registered query pairs rows without an equi-key (no cartesian
    products, no nested-loop joins)."""
    for name, fn in suite.QUERIES.items():
        if name.startswith(RUNS):
            continue
        p = plan(fn(spark, SF01))
        assert "CartesianProduct" not in p and "NestedLoopJoin" not in p, name


def test_filters_reach_the_scan_through_joins_and_views(spark):
    joined = formatted(suite.region_sales_since(spark, SF01))
    assert "GreaterThanOrEqual(o_orderdate,1998-01-01T00:00)" in joined
    viewed = formatted(suite.view_over_filter(spark, SF01))
    assert "EqualTo(o_orderstatus,O)" in viewed
    assert "GreaterThanOrEqual(o_orderdate,1999-01-01T00:00)" in viewed
    assert "ReadSchema: struct<o_orderstatus:string,o_totalprice:double,o_orderdate:timestamp_ntz,o_orderpriority:string>" in viewed
