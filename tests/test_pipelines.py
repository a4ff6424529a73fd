"""Views, stored tables and report order."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.compare import assert_same, spark_rows
from tillwork.operators import cohort, merchant, payments, sla, weekly
from tillwork.plans import pipelines, reports
from tillwork.plans.queries import BUILDS, TestData
from tillwork.sources import tables
from tillwork.sources.contracts import schema_of


def test_published_views(spark, sf_dir):
    d = TestData(spark, sf_dir)
    pipelines.publish_payment_views(d.transactions(), d.accounts(), d.customers())
    for view, name in {
        "v_weekly_kpi_channel": "b2_weekly_kpi_channel",
        "v_weekly_kpi_channel_trend": "b3_weekly_trend",
        "v_customer_txn_month": "e1_customer_active_months",
    }.items():
        assert_same(spark_rows(spark.table(view)), spark_rows(BUILDS[name](d)))


def test_sla_chain(spark, sf_dir):
    d = TestData(spark, sf_dir)
    expected = spark_rows(BUILDS["c5_sla_breach_summary"](d))
    assert_same(spark_rows(pipelines.sla_breaches(d.transactions())), expected)


def test_subscription_tables(spark, tmp_path):
    directory = str(tmp_path)
    for _ in range(2):  # loading again replaces the rows
        pipelines.write_subscription_tables(spark, directory, 300, 5, dt.date(2024, 1, 1))
    for relation, at_least in {"plans": 4, "users": 300, "subscriptions": 300, "payments": 1}.items():
        df = tables.read_relation(spark, f"{directory}/{relation}", relation)
        assert df.columns == schema_of(relation).names
        assert df.count() >= at_least
    assert spark.read.parquet(f"{directory}/users").count() == 300


def test_stored_rules(spark, tmp_path):
    path = str(tmp_path / "rules")
    rules = sla.default_sla_rules(spark)
    tables.create_if_absent(rules, path)
    tables.create_if_absent(rules, path)
    assert spark.read.parquet(path).count() == 3
    tables.append_rows(rules, path)
    assert spark.read.parquet(path).count() == 6
    tables.reload_table(rules, path)
    assert spark.read.parquet(path).count() == 3


def test_partitioned_layout_prunes(spark, sf_dir, tmp_path):
    path = str(tmp_path / "txns")
    txns = TestData(spark, sf_dir).transactions()
    tables.append_rows(txns, path, ["txn_month"])
    stored = tables.read_relation(spark, path, "transactions")
    kept = merchant.trailing_months(stored, 3, newest=dt.date(1999, 6, 1))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(txn_month" in plan
    expected = merchant.trailing_months(txns, 3, newest=dt.date(1999, 6, 1))
    assert_same(spark_rows(kept), spark_rows(expected))


def test_report_order(spark, sf_dir):
    d = TestData(spark, sf_dir)
    rows = reports.present(payments.fraud_by_channel(d.transactions()), "fraud_by_channel")
    rates = [(r.fraud_rate_pct, r.txns) for r in rows.collect()]
    assert rates == sorted(rates, reverse=True)
    alerts = reports.present(
        weekly.weekly_alerts(weekly.weekly_trend(weekly.weekly_kpi_channel(d.transactions()))),
        "weekly_alerts",
    ).collect()
    weeks = [r.week_start for r in alerts]
    assert weeks == sorted(weeks, reverse=True)


def test_missing_score_is_listed_first(spark):
    df = spark.createDataFrame(
        [(1, 5.0, 60), (2, None, 50), (3, 5.0, 70)],
        "merchant_id int, quality_score double, attempted_txns int",
    )
    rows = reports.present(df, "merchant_health").collect()
    assert [r.merchant_id for r in rows] == [2, 3, 1]


def test_every_order_names_columns_of_its_report(spark, sf_dir):
    d = TestData(spark, sf_dir)
    built = {name.split("_", 1)[1]: build for name, build in BUILDS.items()}
    built["weekly_kpi"] = BUILDS["b2_weekly_kpi_channel"]
    for report, keys in reports.ORDER.items():
        columns = built[report](d).columns
        assert {k.lstrip("-") for k in keys} <= set(columns), report


def files(path) -> dict:
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in path.rglob("*.parquet")}


def failing(df):
    """Rows whose last task fails after others have written."""
    bad = F.when(F.col("merchant_id").isNull(), F.raise_error(F.lit("broken row"))).otherwise(F.col("channel"))
    return df.withColumn("channel", bad)


def test_reload_of_one_month_leaves_the_others(spark, sf_dir, tmp_path):
    path = tmp_path / "txns"
    txns = TestData(spark, sf_dir).transactions().where("txn_month >= '1998-01-01'")
    tables.reload_partitions(txns, str(path), ["txn_month"])
    before = files(path)
    month = dt.date(1998, 3, 1)
    part = txns.where(F.col("txn_month") == month).withColumn("channel", F.lit("NEW"))
    tables.reload_partitions(part, str(path), ["txn_month"])
    after = files(path)
    inside = f"txn_month={month}"
    assert {f: t for f, t in before.items() if inside not in f} == {f: t for f, t in after.items() if inside not in f}
    assert not {f for f in before if inside in f} & {f for f in after if inside in f}
    stored = spark.read.parquet(str(path))
    assert stored.where(F.col("txn_month") == month).select("channel").distinct().collect() == [("NEW",)]
    assert stored.count() == txns.count()
    with pytest.raises(PySparkException, match="broken row"):
        tables.reload_partitions(failing(txns), str(path), ["txn_month"])
    assert files(path) == after
    with pytest.raises(ValueError):
        tables.reload_partitions(txns, str(path), [])


def test_a_failed_reload_leaves_the_old_rows(spark, sf_dir, tmp_path):
    path = tmp_path / "txns"
    txns = TestData(spark, sf_dir).transactions()
    tables.reload_table(txns, str(path))
    before = files(path)
    with pytest.raises(PySparkException, match="broken row"):
        tables.reload_table(failing(txns), str(path))
    assert files(path) == before
    # from the table itself
    tables.reload_table(spark.read.parquet(str(path)).where("channel = 'POS'"), str(path))
    assert spark.read.parquet(str(path)).count() == txns.where("channel = 'POS'").count()
    assert [p.name for p in tmp_path.iterdir()] == ["txns"]


def test_weekly_state_by_increments(spark, sf_dir, tmp_path):
    """Two increments, with late rows of old weeks in the second, equal one full run; a repeated one counts once."""
    txns = TestData(spark, sf_dir).transactions()
    late = (F.col("txn_ts_parsed") >= "1996-01-01") | (F.col("txn_id") % 17 == 0) | F.col("txn_ts_parsed").isNull()
    path = str(tmp_path / "state")
    pipelines.add_to_weekly_state(txns.where(~late), path, "to-1995")
    old = files(tmp_path / "state")
    for _ in range(2):
        pipelines.add_to_weekly_state(txns.where(late), path, "since-1996")
    assert old.items() <= files(tmp_path / "state").items()
    state = pipelines.read_weekly_state(spark, path)
    assert_same(spark_rows(state), spark_rows(weekly.weekly_state(txns)))
    assert state.schema["attempted_usd"] == weekly.weekly_state(txns).schema["attempted_usd"]
    kpi, full = weekly.kpi_from_state(state), weekly.weekly_kpi_channel(txns)
    assert_same(spark_rows(weekly.weekly_alerts(weekly.weekly_trend(kpi))), spark_rows(weekly.weekly_alerts(weekly.weekly_trend(full))))
    summary = pipelines.sla_breaches_from_state(spark, path)
    assert_same(spark_rows(summary), spark_rows(pipelines.sla_breaches(txns)))
    plan = summary._jdf.queryExecution().executedPlan().toString()
    assert "lineitem" not in plan and plan.count("FileScan") == 1
    pipelines.compact_weekly_state(spark, path, "to-1998")
    assert len(files(tmp_path / "state")) == 1
    assert_same(spark_rows(pipelines.sla_breaches_from_state(spark, path)), spark_rows(pipelines.sla_breaches(txns)))


@pytest.fixture
def bucketed(spark, sf_dir, tmp_path):
    """The provided tables with headers and lines stored by order; nothing is broadcast."""
    data = TestData(spark, sf_dir)
    header, detail = pipelines.bucket_order_tables(data.order_header(), data.order_detail(), "test_orders", 8, str(tmp_path))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")

    class Bucketed(TestData):
        def order_header(self):
            return spark.table(header)

        def order_detail(self):
            return spark.table(detail)

    yield Bucketed(spark, sf_dir)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    for name in (header, detail):
        spark.sql(f"drop table {name}")


def test_bucketed_orders_are_summed_and_joined_without_a_shuffle(spark, sf_dir, bucketed):
    for name, build in BUILDS.items():
        if name.startswith("f"):
            df = build(bucketed)
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "hashpartitioning(SalesOrderID" not in plan, name
            assert_same(spark_rows(df), spark_rows(build(TestData(spark, sf_dir))))
    for name in ("f1_order_fact_day", "f2_order_fact_month"):
        plan = BUILDS[name](bucketed)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
        assert "Bucketed: true" in plan
    # files of the plain tables are shuffled
    plain = BUILDS["f1_order_fact_day"](TestData(spark, sf_dir))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in plain


def test_newest_month_from_footers(spark, sf_dir, tmp_path):
    path = str(tmp_path / "txns")
    data = TestData(spark, sf_dir)
    dated = data.transactions().where("txn_month is not null")
    dated.repartition(4).write.parquet(path)
    wanted = dated.agg(F.max("txn_month")).first()[0]
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    assert tables.newest_value(spark, path, "txn_month") == wanted
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
    # what is read in between
    spark.conf.set("spark.sql.sources.useV1SourceList", "")
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    try:
        plan = tables._newest(spark, path, "txn_month")._jdf.queryExecution().executedPlan().toString()
        assert "PushedAggregation: [MAX(txn_month)]" in plan
    finally:
        spark.conf.set("spark.sql.sources.useV1SourceList", before)
        spark.conf.unset("spark.sql.parquet.aggregatePushdown")
    score = pipelines.merchant_scorecard(spark, path, data.accounts(), data.merchants(), months_back=12, min_txns=1)
    full = merchant.merchant_health(data.transactions(), data.accounts(), data.merchants(), 12, min_txns=1)
    assert_same(spark_rows(score), spark_rows(full))
    assert score._jdf.queryExecution().executedPlan().toString().count("FileScan") < full._jdf.queryExecution().executedPlan().toString().count("FileScan")


def test_newest_value_without_statistics(spark, tmp_path):
    """Columns and files whose footers do not tell are read."""
    frame = spark.sql("select date'2024-01-01' as day, 'b' as name, timestamp_ntz'2024-05-05 00:00:00' as at, cast(null as date) as none")
    frame.unionByName(frame.withColumn("name", F.lit("c"))).write.parquet(str(tmp_path / "t"))
    frame.where("name = 'x'").write.mode("append").parquet(str(tmp_path / "t"))
    path = str(tmp_path / "t")
    assert tables.newest_value(spark, path, "day") == dt.date(2024, 1, 1)
    assert tables.newest_value(spark, path, "name") == "c"
    assert tables.newest_value(spark, path, "at") == dt.datetime(2024, 5, 5)
    assert tables.newest_value(spark, path, "none") is None


def test_collated_status(spark, sf_dir, tmp_path):
    """'settled ' counts in every report that compares a status, and the comparison is shown at the scan."""
    data, path = TestData(spark, sf_dir), str(tmp_path / "txns")
    txns = data.transactions()
    odd = F.when(F.col("txn_id") % 3 == 0, F.concat(F.lower("status"), F.lit("  "))).when(F.col("txn_id") % 3 == 1, F.initcap("status"))
    txns.withColumn("status", F.coalesce(odd, "status")).write.parquet(path)
    got = tables.read_relation(spark, path, "transactions", collated_status=True)
    accounts, customers, merchants = data.accounts(), data.customers(), data.merchants()

    def reports_of(t):
        return {
            "a1": payments.monthly_trend(t),
            "a2": payments.channel_type_mix(t),
            "b2": weekly.weekly_kpi_channel(t),
            "d4": merchant.merchant_agg(merchant.merchant_customers(t, accounts), merchants),
            "e1": cohort.customer_active_months(t, accounts, customers),
        }

    plain = tables.read_relation(spark, path, "transactions", clean_status=False)
    for name, df in reports_of(got).items():
        assert_same(spark_rows(df), spark_rows(reports_of(txns)[name]))
    assert reports_of(plain)["a1"].agg(F.sum("txn_count")).first()[0] < reports_of(got)["a1"].agg(F.sum("txn_count")).first()[0]
    for name in ("a1", "e1"):
        plan = reports_of(got)[name]._jdf.queryExecution().executedPlan().toString()
        assert "CollatedEqualTo(status,SETTLED" in plan, name
