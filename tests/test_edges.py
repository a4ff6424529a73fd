"""Edges of the reports that the given tables do not show: whole inputs, exact types, rounding, NULL keys, noisy statuses."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException

from tests.test_projection import account, loop
from tillwork.operators import checks, cohort, merchant, orders, payments, projection, weekly
from tillwork.plans.queries import BUILDS, TestData
from tillwork.sources.contracts import conform

#: Column types that every operator returns, in order.
TYPES = {
    "a1_monthly_trend": "date, bigint, decimal(22,2), decimal(16,6)",
    "a2_channel_type_mix": "date, string, string, bigint, decimal(22,2)",
    "a3_top_customers": "bigint, string, string, bigint, decimal(32,2)",
    "a4_fraud_by_channel": "string, bigint, bigint, decimal(10,3)",
    "a5_fraud_by_segment": "string, bigint, bigint, decimal(10,3)",
    "a6_merchant_risk_top": "string, string, bigint, bigint, decimal(10,3)",
    "b1_weekly_kpi_report": "date, string, bigint, bigint, bigint, decimal(10,2), bigint, decimal(10,2), decimal(22,2)",
    "b2_weekly_kpi_channel": "date, string, bigint, bigint, bigint, decimal(10,2), bigint, decimal(10,2), decimal(22,2)",
    "b3_weekly_trend": "date, string, bigint, decimal(22,2), decimal(10,2), decimal(10,2), bigint, decimal(22,2), decimal(10,2), decimal(10,2)",
    "b4_weekly_alerts": "date, string, bigint, decimal(10,2), decimal(10,2), string",
    "b5_merged_weekly_state": "date, string, bigint, bigint, bigint, bigint, decimal(22,2)",
    "c2_kpi_long": "date, string, string, decimal(10,2)",
    "c3_match_rules": "date, string, string, decimal(10,2), string, decimal(10,2), string, string, string",
    "c4_sla_scoreboard": "date, string, string, decimal(10,2), string, decimal(10,2), string, string, string, decimal(10,2)",
    "c5_sla_breach_summary": "string, string, string, bigint, bigint, decimal(10,2)",
    "d1_trailing_months": "bigint, bigint, bigint, timestamp_ntz, date, string, string, string, decimal(12,2), boolean, bigint",
    "d2_merchant_base": "date, bigint, bigint, bigint, bigint, string, string, string, string, decimal(12,2), boolean, bigint",
    "d3_repeat_customers": "bigint, bigint, bigint",
    "d4_merchant_agg": "bigint, string, string, string, bigint, decimal(38,2), bigint, decimal(38,2), bigint, decimal(38,2), bigint, decimal(38,2), bigint, decimal(38,2), bigint, decimal(18,6)",
    "d5_merchant_health": "bigint, string, string, string, bigint, decimal(38,2), bigint, decimal(38,2), bigint, decimal(10,2), bigint, decimal(20,2), bigint, decimal(10,2), bigint, int, decimal(10,2), decimal(12,2), decimal(24,2), decimal(20,2), string",
    "e1_customer_active_months": "bigint, date",
    "e2_cohort_sizes": "date, bigint",
    "e3_cohort_retention": "date, int, bigint, bigint, decimal(10,2)",
    "e4_cohort_matrix": "date, decimal(10,2), decimal(10,2), decimal(10,2), decimal(10,2), decimal(10,2), decimal(10,2), decimal(10,2)",
    "f1_order_fact_day": "bigint, bigint, date, decimal(28,4)",
    "f2_order_fact_month": "bigint, bigint, date, int, boolean, decimal(28,4), decimal(7,6)",
    "f3_customer_type": "bigint, string",
    "f4_order_gaps": "bigint, double",
    "f5_churn_flags": "bigint, string, date, date, int, bigint, decimal(38,4), decimal(20,2), decimal(12,2), int",
    "f6_first_month": "bigint, date",
    "f7_order_retention": "date, int, bigint, bigint, decimal(10,4)",
    "f8_segmented_cohort": "date, string, int, bigint, bigint, bigint, decimal(38,4), decimal(10,4), decimal(20,4), decimal(20,2), decimal(20,4), decimal(10,4), decimal(10,4)",
    "f9_rfm_segments": "bigint, date, int, bigint, decimal(38,4), string",
    "f10_year_over_year_cohorts": "bigint, string",
    "f11_monthly_sales": "date, string, string, int, bigint, bigint, decimal(38,4), decimal(24,6), decimal(10,6), decimal(10,6)",
    "g1_subscription_status": "string, bigint",
    "g2_plan_mix": "string, bigint",
    "g3_payment_status": "string, bigint",
    "g4_mrr": "date, decimal(22,2)",
    "g5_subscription_churn": "date, bigint",
    "g6_active_subscribers": "bigint",
    "g8_gen_users": "bigint, date, string, string",
    "g9_gen_subscriptions": "bigint, bigint, int, date, date, string",
    "g10_gen_payments": "bigint, bigint, date, decimal(10,2), string",
    "g11_contract_checks": "string, string, string, bigint",
    "h1_project_balances": "bigint, int, double, double, double, double, double",
    "h2_project_real_balances": "bigint, int, double, double, double, double, double, double, double, double",
    "h3_time_to_goal": "bigint, double",
    "h4_projection_summary": "bigint, double, double, double, double, double",
}


@pytest.mark.parametrize("name", BUILDS)
def test_exact_types(spark, sf_dir, name):
    schema = BUILDS[name](TestData(spark, sf_dir)).schema
    assert ", ".join(f.dataType.simpleString() for f in schema) == TYPES[name]


@pytest.mark.parametrize(
    ("relation", "table"),
    [
        ("transactions", "lineitem"),
        ("accounts", "orders"),
        ("customers", "customer"),
        ("merchants", "supplier"),
        ("order_header", "orders"),
        ("order_detail", "lineitem"),
        ("order_customer", "customer"),
        ("users", "customer"),
        ("subscriptions", "orders"),
        ("projection_accounts", "customer"),
    ],
)
def test_adapters_keep_every_row(spark, sf_dir, relation, table):
    data = TestData(spark, sf_dir)
    assert getattr(data, relation)().count() == data.table(table).count()


def test_ticket_is_rounded_once(spark, table):
    # 10,001 settled transactions of 100,060.00 together: 10.00499950...
    day = dt.datetime(2024, 3, 5)
    row = {
        "account_id": 1, "merchant_id": 5, "txn_ts_parsed": day, "txn_month": dt.date(2024, 3, 1),
        "status": "SETTLED", "is_fraud": False,
    }
    txns = table("transactions", {**row, "txn_id": 0, "amount_usd": Decimal("60.00")})
    many = spark.range(1, 10_001).selectExpr("id as txn_id").crossJoin(txns.drop("txn_id", "amount_usd"))
    many = many.selectExpr("*", "cast(10 as decimal(12,2)) as amount_usd").select(txns.columns)
    got = merchant.merchant_health(
        txns.unionByName(many),
        table("accounts", {"account_id": 1, "customer_id": 1}),
        table("merchants", {"merchant_id": 5, "merchant_name": "m"}),
    ).first()
    assert got.settled_txns == 10_001
    assert got.avg_ticket_usd == Decimal("10.00")


def test_orders_without_customer(spark, table):
    jan, feb = dt.datetime(2024, 1, 5), dt.datetime(2024, 2, 5)
    heads = [(1, 7, jan), (2, None, jan), (3, None, feb), (4, 7, feb)]
    header = table(
        "order_header",
        *[
            {"SalesOrderID": i, "CustomerID": c, "OrderDate": d, "TerritoryID": 1, "OnlineOrderFlag": True}
            for i, c, d in heads
        ],
    )
    detail = table(
        "order_detail",
        *[{"SalesOrderID": i, "LineTotal": Decimal(10), "UnitPriceDiscount": Decimal(0)} for i, *_ in heads],
    )
    customer = table("order_customer", {"CustomerID": 7, "PersonID": 7})
    by_month = orders.order_retention(header, detail).orderBy("MonthIndex").collect()
    assert [(r.MonthIndex, r.ActiveCustomers, r.CohortCustomers) for r in by_month] == [(0, 1, 1), (1, 1, 1)]
    # a join with the customers drops the others; gaps and recency keep one row for the orders without customer
    assert {r.CustomerID for r in orders.churn_flags(header, detail, customer).collect()} == {7}
    assert sum(r.ActiveCustomers for r in orders.segmented_cohort(header, detail, customer).collect()) == 2
    assert sum(r.Orders for r in orders.monthly_sales(header, detail, customer).collect()) == 2
    gaps = orders.order_gaps(orders.order_fact(header, detail))
    assert {r.CustomerID for r in gaps.collect()} == {7, None}
    assert {r.CustomerID for r in orders.rfm_segments(header, detail).collect()} == {7, None}


def test_noisy_statuses_count_alike(spark, table):
    day, month = dt.datetime(2024, 3, 5), dt.date(2024, 3, 1)
    raw = table(
        "transactions",
        {
            "txn_id": 1, "account_id": 1, "merchant_id": 5, "txn_ts_parsed": day, "txn_month": month,
            "channel": "POS", "txn_type": "PURCHASE", "status": "settled ", "amount_usd": Decimal(5), "is_fraud": False,
        },
    )
    accounts = table("accounts", {"account_id": 1, "customer_id": 1})
    customers = table("customers", {"customer_id": 1, "risk_segment": "LOW", "country": "US"})
    clean = conform(raw, "transactions")
    assert conform(raw, "transactions", clean_status=False).first().status == "settled "
    for txns, n in ((clean, 1), (raw, 0)):
        assert payments.monthly_trend(txns).count() == n
        assert payments.channel_type_mix(txns).count() == n
        assert payments.top_customers(txns, accounts, customers).count() == n
        assert cohort.customer_active_months(txns, accounts, customers).count() == n
        assert weekly.weekly_kpi_channel(txns).first().settled_txns == n
    assert merchant.merchant_customers(clean, accounts).first().settled_txns == 1


@pytest.mark.parametrize("timing", ["start", "end"])
def test_small_rates_keep_their_digits(spark, timing):
    returns = [0.0, *[s * 10.0**-e for e in range(3, 13) for s in (1, -1)], -1.0, -0.02, 0.15]
    rows = [
        account(
            k, principal=0.0, annual_return=r, years=1.0, compounding=c, contribution_timing=timing, goal=1e12
        )
        for k, (r, c) in enumerate((r, c) for r in returns for c in ("daily", "monthly", "yearly"))
    ]
    got = projection.project_balances(spark.createDataFrame(rows)).collect()
    wanted = {(a["account_key"], s["period"]): s for a in rows for s in loop(a)}
    assert len(got) == len(wanted)
    for r in got:
        step = wanted[r.account_key, r.period]
        for column in ("start_balance", "end_balance"):
            assert r[column] == pytest.approx(step[column], rel=1e-9, abs=1e-12)


def test_years_must_be_known(spark):
    known = spark.createDataFrame([account()])
    with pytest.raises(PySparkException, match="years"):
        projection.projection_summary(known.selectExpr("* except (years)", "cast(null as double) years"), 1.0).collect()


def _plan(spark, sf_dir, name):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        return BUILDS[name](TestData(spark, sf_dir))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, before)


def test_projections_shuffle_no_periods(spark, sf_dir):
    """Schedules deal narrow ranges out before they become rows; goals and summaries move nothing."""
    for name in ("h1_project_balances", "h2_project_real_balances"):
        plan = _plan(spark, sf_dir, name)
        plan = plan[: plan.find("Subquery")] if "Subquery" in plan else plan
        rows = plan.index("explode(sequence(first")
        assert plan.count("Exchange") == 1 and plan.index("Exchange RoundRobinPartitioning") > rows
    for name in ("h3_time_to_goal", "h4_projection_summary"):
        assert "Exchange" not in _plan(spark, sf_dir, name)


def test_cohort_sizes_need_seven_shuffles_at_most(spark, sf_dir):
    assert _plan(spark, sf_dir, "e2_cohort_sizes").count("Exchange hash") <= 7


def test_contract_reads_transactions_twice_at_most(spark, sf_dir):
    assert _plan(spark, sf_dir, "g11_contract_checks").count("lineitem.parquet") <= 2


def test_rules_of_every_kind_in_one_pass(spark):
    child = spark.createDataFrame([(1, "a", 1), (1, "a", None), (2, None, 9), (None, "a", 9)], "id int, name string, up int")
    up = spark.createDataFrame([(1,), (1,), (None,)], "id int")
    rules = [
        checks.Unique("child", ("id", "name")),
        checks.ForeignKey("child", "up", "up", "id"),
        checks.Unique("up", ("id",)),
        checks.NotNull("child", "name"),
    ]
    for tables, wanted in (({"child": child, "up": up}, [1, 2, 1, 1]), ({"child": child.limit(0), "up": up.limit(0)}, [0] * 4)):
        found = {(r.table_name, r.rule): r.violations for r in checks.check_contract(tables, rules).collect()}
        assert list(found.values()) and [
            found["child", "unique"], found["child", "foreign_key"], found["up", "unique"], found["child", "not_null"]
        ] == wanted
    with pytest.raises(ValueError, match="rules"):
        checks.check_contract({}, [])
