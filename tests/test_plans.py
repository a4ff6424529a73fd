"""Physical plans: what a query must not need at scale."""

import re

import pytest
from pyspark.sql import functions as F

from tillwork.operators import merchant
from tillwork.plans.queries import BUILDS, TestData


@pytest.fixture(scope="module")
def plans(spark, sf_dir):
    """Plans of all queries with every table too large to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        built = {name: build(TestData(spark, sf_dir)) for name, build in BUILDS.items()}
        return {
            name: df._jdf.queryExecution().executedPlan().toString() for name, df in built.items()
        }
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", BUILDS)
def test_no_cross_join_and_no_python(plans, name):
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "Arrow"):
        assert node not in plans[name]


@pytest.mark.parametrize("name", BUILDS)
def test_windows_are_partitioned(plans, name):
    for line in plans[name].splitlines():
        if re.search(r"[-:+ ]Window \[", line):
            partition = re.search(r" AS \w+#\d+L?\], \[([^\]]*)\]", line)
            assert partition and not re.search(r" (ASC|DESC) ", partition[1]), line


@pytest.mark.parametrize("name", BUILDS)
def test_nothing_is_broadcast_by_hint(plans, name):
    assert "BroadcastHashJoin" not in plans[name]


@pytest.mark.parametrize(
    "name, scans",
    [
        ("a3_top_customers", 1),
        ("a5_fraud_by_segment", 1),
        ("c5_sla_breach_summary", 1),
        ("e4_cohort_matrix", 1),
        ("f8_segmented_cohort", 1),
        ("f11_monthly_sales", 1),
    ],
)
def test_the_large_table_is_read_once(plans, name, scans):
    assert plans[name].count("lineitem.parquet") == scans


@pytest.mark.parametrize(
    "name, key",
    [
        ("a3_top_customers", "account_id"),
        ("a5_fraud_by_segment", "account_id"),
        ("e1_customer_active_months", "account_id"),
        ("d5_merchant_health", "account_id"),
        ("f1_order_fact_day", "SalesOrderID"),
    ],
)
def test_rows_are_combined_before_they_are_shuffled(plans, name, key):
    """Below the join, the large table's rows meet a partial aggregate first."""
    lines = plans[name].splitlines()
    scan = max(
        i for i, text in enumerate(lines) if "FileScan" in text and "lineitem.parquet" in text
    )
    above = lines[:scan]
    exchange = max(i for i, text in enumerate(above) if "Exchange hashpartitioning" in text)
    assert any("HashAggregate" in text and key in text for text in above[exchange:])


def test_year_ranges_and_columns_reach_the_scan(plans):
    plan = plans["f10_year_over_year_cohorts"]
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz>" in plan
    assert "GreaterThanOrEqual(o_orderdate" in plan


def test_unpivot_reads_once(plans):
    assert "Expand" in plans["c2_kpi_long"]
    assert plans["c2_kpi_long"].count("FileScan") == 1


def test_top_reports_use_a_bounded_sort(plans):
    for name in ("a3_top_customers", "a6_merchant_risk_top"):
        assert "TakeOrderedAndProject" in plans[name]


def test_retained_months_are_counted_without_distinct_expansion(plans):
    for name in ("e3_cohort_retention", "f7_order_retention", "f8_segmented_cohort"):
        assert "Expand" not in plans[name]
        assert "count(distinct" not in plans[name]


def test_churn_shares_the_line_totals(spark, sf_dir):
    df = BUILDS["f5_churn_flags"](TestData(spark, sf_dir))
    df.collect()
    assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("hot", ["account_id", "merchant_id"])
def test_a_hot_key_is_split_in_the_row_level_join(spark, sf_dir, hot):
    """Enriched rows cannot be combined first; a key with half of them is dealt out, without adaptive execution."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.enabled": "false",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        d = TestData(spark, sf_dir)
        one = d.transactions().agg(F.min(hot)).first()[0]
        key = F.when(F.col("txn_id") % 2 == 0, F.lit(one)).otherwise(F.col(hot))
        txns = d.transactions().withColumn(hot, key).repartition(6)
        df = merchant.merchant_base(txns, d.accounts(), d.merchants())
        plan = df._jdf.queryExecution().executedPlan().toString()
        rows = df.groupBy(F.spark_partition_id()).count().collect()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert re.search(rf"SortMergeJoin \[{hot}#\d+L, _piece#", plan)
    sizes = sorted(r["count"] for r in rows)
    assert sizes[-1] < 2 * sizes[len(sizes) // 2]


@pytest.mark.parametrize("name", ["g2_plan_mix", "g10_gen_payments"])
def test_plans_too_large_to_broadcast(spark, sf_dir, name):
    """Four plan ids are four hot keys where the plans are shuffled; the rows stay the same."""
    wanted = sorted(map(tuple, BUILDS[name](TestData(spark, sf_dir)).collect()))
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        df = BUILDS[name](TestData(spark, sf_dir))
        assert sorted(map(tuple, df.collect())) == wanted
        assert "BroadcastHashJoin" not in df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, before)
