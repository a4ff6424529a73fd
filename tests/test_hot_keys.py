"""Joins in which few keys hold most rows."""

import pytest
from pyspark.sql import functions as F

from tests.compare import assert_same, spark_rows
from tillwork.operators import hot_keys, merchant
from tillwork.plans.queries import BUILDS, TestData


@pytest.fixture
def plainly_planned(spark):
    """No broadcast, and nothing that adaptive execution could mend."""
    names = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.enabled": "false",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def spread(df) -> list[int]:
    rows = df.groupBy(F.spark_partition_id().alias("p")).count().collect()
    return sorted(r["count"] for r in rows)


@pytest.fixture
def tables(spark):
    """A third of the rows on key 7, a quarter on key 8, the rest on keys of their own; some keys unknown or NULL."""
    n = 48_000
    row = F.col("id")
    key = F.when(row % 3 == 0, 7).when(row % 4 == 1, 8).when(row % 50 == 2, None).otherwise(100 + row)
    facts = spark.range(n).select(row.alias("row_id"), key.cast("long").alias("key"), (row % 11).alias("v"))
    details = spark.range(n // 2).select(F.col("id").alias("key"), F.concat(F.lit("n"), "id").alias("name"))
    return facts, details


@pytest.mark.parametrize("how", ["inner", "left"])
def test_same_rows_as_the_plain_join(spark, plainly_planned, tables, how):
    facts, details = tables
    got = hot_keys.split_join(facts, details, "key", how, ["row_id"])
    wanted = facts.join(details, "key", how)
    assert got.columns == wanted.columns
    assert got.exceptAll(wanted).count() == wanted.exceptAll(got).count() == 0
    assert got.count() == wanted.count() > 20_000


def test_repeated_details_multiply_rows_as_they_do_plainly(spark, plainly_planned, tables):
    facts, details = tables
    twice = details.unionByName(details.where("key in (7, 150)"))
    got = hot_keys.split_join(facts, twice, "key", "left", ["row_id"])
    assert got.exceptAll(facts.join(twice, "key", "left")).count() == 0
    assert got.count() == facts.join(twice, "key", "left").count()


def test_no_task_gets_a_frequent_key_whole(spark, plainly_planned, tables):
    facts, details = tables
    plain = spread(facts.join(details, "key"))
    split = spread(hot_keys.split_join(facts, details, "key", "inner", ["row_id"]))
    assert plain[-1] > 3 * plain[len(plain) // 2]
    assert split[-1] < 1.7 * split[len(split) // 2]


def test_only_frequent_keys_are_repeated(spark, plainly_planned, tables):
    facts, _ = tables
    numbers = facts.select("key", hot_keys._pieces(facts, "key").alias("pieces")).distinct()
    several = {r.key: r.pieces for r in numbers.where("pieces > 1").collect()}
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert set(several) == {7, 8}
    assert several[7] >= hot_keys.PIECES * tasks / 3 - 1


def test_small_details_are_joined_plainly(spark, tables):
    facts, details = tables
    text = hot_keys.split_join(facts, details, "key")._jdf.queryExecution().executedPlan().toString()
    assert "approx_top_k" not in text and "_piece" not in text


def test_other_kinds_of_join_are_refused(tables):
    with pytest.raises(ValueError):
        hot_keys.split_join(*tables, "key", "full")


def test_empty_facts(spark, plainly_planned, tables):
    facts, details = tables
    assert hot_keys.split_join(facts.where("row_id < 0"), details, "key", "left", ["row_id"]).count() == 0


def test_enriched_rows_are_spread_without_adaptive_skew_join(spark, plainly_planned, skewed_dir):
    """One supplier has two thirds of the lines, one order a third."""
    data = TestData(spark, skewed_dir)
    base = merchant.merchant_base(data.transactions(), data.accounts(), data.merchants())
    sizes = spread(base)
    assert sizes[-1] < 1.7 * sizes[len(sizes) // 2]
    got = spark_rows(BUILDS["d2_merchant_base"](data))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    assert_same(got, spark_rows(BUILDS["d2_merchant_base"](data)))
