"""What Spark makes of the queries: pushdown, pruning, exchanges, skew."""

import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators import checks, history
from tidemark.operators.sales import enrich, sales_transactions
from tidemark.plans import gold
from tidemark.plans.reports import QUERIES
from tidemark.plans.star import Star


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def star(spark):
    return Star(spark, "/root/testdata/sf0.001")


def test_filters_and_columns_reach_the_scan(star):
    changes = star.table("orders").filter("o_totalprice > 1000 AND o_custkey IS NOT NULL").select("o_orderkey")
    plan = executed(changes)
    assert "GreaterThan(o_totalprice,1000.0)" in plan
    plan = executed(gold.product_performance(sales_transactions(star.sales()), star.products()))
    columns = ",".join(re.findall(r"FileScan parquet \[(.*?)\]", plan))
    assert "l_extendedprice" in columns and "p_name" in columns
    for unread in ("l_linestatus", "l_linenumber", "o_totalprice", "o_orderdate", "p_brand", "p_retailprice"):
        assert unread not in columns


def test_names_are_looked_up_after_aggregation(spark, star):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = executed(gold.customer_value(star.web_sales(), star.customers()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The join is above the aggregate, and the sales go through no join of their own.
    assert plan.index("SortMergeJoin") < plan.index("HashAggregate")
    assert plan.count("SortMergeJoin") == 1


def test_distinct_count_is_spread_by_counted_value(star):
    plan = executed(gold.daily_store_sales(star.web_sales(), star.stores()))
    exchanges = re.findall(r"Exchange hashpartitioning\((.*?)\)", plan)
    assert any("customer_id" in e and "store_id" in e for e in exchanges)


def test_latest_keeps_one_row_per_key_before_the_shuffle(star):
    plan = executed(history.latest(star.customer_changes(), ["customer_id"], "changed_at", ["change_id"]))
    assert plan.count("WindowGroupLimit") == 2


def test_current_versions_need_no_history(star):
    plan = executed(QUERIES["dim_current"](star.spark, "/root/testdata/sf0.001"))
    assert plan.count("WindowGroupLimit") == 2 and plan.count("Exchange hashpartitioning") == 1
    assert "lead(" not in plan


def test_missing_keys_are_counted_per_key_first(spark, star):
    """With a small dimension the join is broadcast and goes first, which needs no shuffle either."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = executed(checks.missing_key_count(star.web_sales(), star.customers(), "customer_id"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.index("LeftAnti") < plan.rindex("HashAggregate(keys=[customer_id")


def test_all_metrics_of_a_frame_need_one_scan(star):
    sales = star.sales(with_order=False)
    metrics = checks.measure(
        sales, rows=checks.count_rows(), stores=F.count_distinct("store_id"), units=F.sum("quantity"),
        products=F.count_distinct("product_id"),
    )
    lines = [checks.Check("rows", "rows", 1, ">="), checks.Check("stores", "stores", 1, ">="),
             checks.Check("units", "units", "products", ">=")]
    report = checks.reconcile([metrics], lines)
    assert executed(report).count("FileScan parquet") == 1
    assert [r["label"] for r in report.collect()] == ["rows", "stores", "units"]


def test_reconciliation_reads_a_frame_once(star):
    """Facts and sales are two frames of the report, each over lineitem; the gold table is a third."""
    for name, scans in (("reconcile_counts", 2), ("reconcile_metrics", 3)):
        plan = executed(QUERIES[name](star.spark, star.directory))
        assert len(re.findall(r"FileScan parquet .*lineitem\.parquet", plan)) == scans


def test_every_change_history_has_one_window_and_one_exchange(star):
    plan = executed(
        history.history_of_every_change(star.customer_changes(), ["customer_id"], "changed_at", ["change_id"])
    )
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Window [") == 1


def test_no_python_and_no_cross_join(star):
    for df in (
        enrich(sales_transactions(star.sales()), star.stores(), star.customers(), star.products()),
        gold.customer_value(star.sales(), star.customers()),
        checks.health_check(star.sales(), star.customers(), star.products(), star.stores()),
    ):
        plan = executed(df)
        for operator in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert operator not in plan


def test_hot_customer_is_split_by_the_join(spark, star):
    """Nine tenths of the sales are of one customer; neither side may be broadcast."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.shuffle.partitions": "8",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        sales = spark.range(0, 60_000, 1, 8).select(
            F.col("id").alias("transaction_id"),
            F.when(F.rand(1) < 0.9, 7).otherwise((F.rand(2) * 150).cast("int")).alias("customer_id"),
            F.rand(3).alias("total_amount"),
        )
        facts = enrich(sales, customers=star.customers())
        rows = facts.groupBy("customer_id", "customer_name").agg(F.sum("total_amount"), F.count("*").alias("n"))
        assert sum(row["n"] for row in rows.collect()) == 60_000
        assert "skew=true" in executed(rows)
    finally:
        for key in settings:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", "2")
