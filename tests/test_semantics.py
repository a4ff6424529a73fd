"""Small hand-computed cases for rules that are easy to get wrong."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tillwork.operators import cohort, merchant, orders, payments, saas, sla, weekly
from tillwork.sources.contracts import SCHEMAS, conform


def day(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def txn(account=1, when="2024-03-05", **fields) -> dict:
    moment = day(when) if when else None
    row = {
        "txn_id": 1,
        "account_id": account,
        "merchant_id": 1,
        "txn_ts_parsed": moment,
        "txn_month": moment.date().replace(day=1) if moment else None,
        "channel": "POS",
        "status": "SETTLED",
        "amount_usd": D("10.00"),
        "is_fraud": False,
    }
    return {**row, **fields}


def by(df, *keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


# payments


def test_null_month_is_a_group(table):
    got = by(payments.monthly_trend(table("transactions", txn(), txn(when=None))), "txn_month")
    assert {k[0] for k in got} == {dt.date(2024, 3, 1), None}


def test_null_fraud_flag_is_not_fraud(table):
    txns = table("transactions", txn(is_fraud=None), txn(is_fraud=True), txn())
    row = payments.fraud_by_channel(txns).first()
    assert (row.txns, row.fraud_txns, row.fraud_rate_pct) == (3, 1, D("33.333"))


def test_top_customers_break_ties_by_id(table):
    txns = table("transactions", *[txn(account=a) for a in (1, 2, 3)])
    accounts = table(
        "accounts", *[{"account_id": a, "customer_id": 10 - a} for a in (1, 2, 3)]
    )
    customers = table("customers", *[{"customer_id": c} for c in (7, 8, 9)])
    got = payments.top_customers(txns, accounts, customers, n=2)
    assert [r.customer_id for r in got.collect()] == [7, 8]


def test_leaderboard_uses_the_unrounded_rate(table):
    rows = [txn(merchant_id=m, is_fraud=i == 0) for m, n in ((1, 3001), (2, 3000)) for i in range(n)]
    merchants = table(
        "merchants", *[{"merchant_id": m, "merchant_name": f"m{m}"} for m in (1, 2)]
    )
    got = payments.merchant_risk_top(table("transactions", *rows), merchants).collect()
    assert [r.merchant_name for r in got] == ["m2", "m1"]
    assert got[0].fraud_rate_pct == got[1].fraud_rate_pct == D("0.033")


def test_leaderboard_drops_small_unknown_and_missing_merchants(table):
    rows = [txn(merchant_id=m) for m, n in ((1, 50), (2, 49), (3, 60), (None, 60)) for _ in range(n)]
    merchants = table(
        "merchants", *[{"merchant_id": m, "merchant_name": f"m{m}"} for m in (1, 2)]
    )
    got = payments.merchant_risk_top(table("transactions", *rows), merchants).collect()
    assert [r.merchant_name for r in got] == ["m1"]


# weekly KPIs


def kpis(spark, *rows):
    return spark.createDataFrame(
        [
            (dt.date.fromisoformat(w), c, n, D("0"), D(declined), D(fraud))
            for w, c, n, declined, fraud in rows
        ],
        "week_start date, channel string, attempted_txns long, attempted_usd decimal(22,2), "
        "declined_rate_pct decimal(10,2), fraud_rate_pct decimal(10,2)",
    )


def test_trend_looks_back_one_row_not_one_week(spark):
    kpi = kpis(
        spark,
        ("2024-01-01", "POS", 60, "1", "1"),
        ("2024-01-22", "POS", 70, "2", "2"),
        ("2024-01-22", "ATM", 80, "3", "3"),
    )
    got = by(weekly.weekly_trend(kpi), "channel", "week_start")
    assert got["POS", dt.date(2024, 1, 22)].prev_attempted_txns == 60
    assert got["ATM", dt.date(2024, 1, 22)].prev_attempted_txns is None


def test_alert_order_and_limits(spark):
    kpi = kpis(
        spark,
        ("2024-01-01", "POS", 60, "1.00", "1.00"),
        ("2024-01-08", "POS", 60, "9.00", "1.50"),  # both jump: fraud first
        ("2024-01-15", "POS", 60, "11.00", "1.99"),  # 0.49 fraud, 2.00 declines
        ("2024-01-22", "POS", 49, "90.00", "90.00"),
        ("2024-01-29", "POS", 50, "90.00", "90.00"),
    )
    got = weekly.weekly_alerts(weekly.weekly_trend(kpi)).orderBy("week_start")
    flags = [r.alert_flag for r in got.collect()]
    assert flags == ["OK", "FRAUD_SPIKE", "DECLINE_SPIKE", "LOW_VOLUME", "OK"]


def test_weeks_without_timestamp_are_left_out(table):
    got = weekly.weekly_kpi_report(table("transactions", txn(), txn(when=None))).collect()
    assert [r.attempted_txns for r in got] == [1]
    assert got[0].week_start == dt.date(2024, 3, 3)
    assert "decline_rate_pct" in got[0].asDict()


# SLA


def long_rows(spark, *rows):
    return spark.createDataFrame(
        [(dt.date(2024, 1, 1), c, k, v if v is None else D(v)) for c, k, v in rows],
        "week_start date, channel string, kpi_name string, actual_value decimal(10,2)",
    )


def rule(kpi="k", scope="GLOBAL", channel=None, target="1", comparator="<=", **fields):
    row = {
        "kpi_name": kpi,
        "scope": scope,
        "channel": channel,
        "owner_team": "Risk",
        "target_value": D(target),
        "comparator": comparator,
        "severity": "HIGH",
        "is_active": True,
    }
    return {**row, **fields}


def test_channel_rule_wins_over_global(spark, table):
    long = long_rows(
        spark,
        ("ONLINE", "fraud_rate_pct", "1.00"),
        ("POS", "fraud_rate_pct", "1.00"),
        (None, "fraud_rate_pct", "1.00"),
        ("POS", "no_rule", "1.00"),
    )
    matched = sla.match_rules(long, sla.default_sla_rules(spark))
    got = by(sla.sla_scoreboard(matched), "channel")
    assert set(got) == {("ONLINE",), ("POS",), (None,)}
    assert got[("ONLINE",)].target_value == D("0.90")
    assert got[("ONLINE",)].sla_status == "FAIL"
    assert got[("ONLINE",)].breach_amount == D("0.10")
    for channel in ("POS", None):
        assert got[(channel,)].target_value == D("1.20")
        assert got[(channel,)].sla_status == "PASS"
        assert got[(channel,)].breach_amount == D("-0.20")


def test_inactive_rules_and_ties(spark, table):
    rules = table(
        "kpi_sla_rules",
        rule(scope="CHANNEL", channel="POS", target="9", is_active=False),
        rule(scope="CHANNEL", channel="POS", target="7", severity="LOW"),
        rule(scope="CHANNEL", channel="POS", target="8", severity="HIGH"),
        rule(target="5"),
    )
    matched = sla.match_rules(long_rows(spark, ("POS", "k", "1")), rules)
    assert [r.target_value for r in matched.collect()] == [D("8")]


@pytest.mark.parametrize(
    "comparator, actual, status, breach",
    [
        ("<=", "1.00", "PASS", D("0.00")),
        (">=", "1.00", "PASS", D("0.00")),
        (">=", "0.25", "FAIL", D("0.75")),
        ("=", "1.00", "FAIL", None),
        ("<=", None, "FAIL", None),
    ],
)
def test_comparators(spark, table, comparator, actual, status, breach):
    matched = sla.match_rules(
        long_rows(spark, ("POS", "k", actual)), table("kpi_sla_rules", rule(comparator=comparator))
    )
    row = sla.sla_scoreboard(matched).first()
    assert (row.sla_status, row.breach_amount) == (status, breach)


def test_breach_summary(spark, table):
    long = long_rows(spark, ("POS", "k", "1"), ("ATM", "k", "2"), ("WEB", "k", "3"))
    board = sla.sla_scoreboard(sla.match_rules(long, table("kpi_sla_rules", rule())))
    row = sla.sla_breach_summary(board).first()
    assert (row.total_rows, row.breaches, row.breach_rate_pct) == (3, 2, D("66.67"))


# merchants


def health(table, rows, accounts=None, merchants=(), **options):
    accounts = accounts or {1: 1}
    return merchant.merchant_health(
        table("transactions", *rows),
        table("accounts", *[{"account_id": a, "customer_id": c} for a, c in accounts.items()]),
        table("merchants", *merchants),
        **{"min_txns": 1, **options},
    )


def test_merchant_without_settled_transactions_has_no_score(table):
    rows = [txn(merchant_id=1, status="DECLINED") for _ in range(50)]
    rows += [txn(merchant_id=2, status=" settled ") for _ in range(50)]
    got = by(health(table, rows, min_txns=50), "merchant_id")
    assert got[(1,)].quality_score is None
    assert got[(1,)].reversal_rate_pct is None
    assert got[(1,)].primary_flag == "HIGH_DECLINE"
    assert got[(1,)].repeat_customers == 0
    assert got[(1,)].repeat_customer_rate_pct is None
    assert got[(2,)].settled_txns == 50
    assert got[(2,)].quality_score == D("100.00")


def test_unknown_reversal_rate_is_not_high(table):
    rows = [txn(status="REVERSED")] + [txn(status="PENDING") for _ in range(9)]
    row = health(table, rows).first()
    assert (row.reversed_txns, row.settled_txns, row.primary_flag) == (1, 0, "OK")


def test_flags_keep_their_order(table):
    both = [txn(status="DECLINED", is_fraud=True), txn()]
    assert health(table, both).first().primary_flag == "HIGH_FRAUD"


def test_settled_reversal_counts_twice(table):
    rows = [txn(reversal_of_txn_id=9), txn()]
    row = health(table, rows).first()
    assert (row.settled_txns, row.reversed_txns) == (2, 1)
    assert row.net_settled_usd == D("10.00")
    assert row.quality_score == D("50.00")


def test_missing_customer_is_settled_but_not_unique(table):
    rows = [txn(account=1), txn(account=1), txn(account=2)]
    row = health(table, rows, accounts={1: None, 2: 5}).first()
    assert row.unique_customers == 1
    assert row.repeat_customers == 1
    assert row.repeat_customer_rate_pct == D("50.00")


def test_accounts_of_one_customer_add_up(table):
    rows = [txn(account=1), txn(account=2)]
    row = health(table, rows, accounts={1: 5, 2: 5}).first()
    assert (row.unique_customers, row.repeat_customers) == (1, 1)


def test_transactions_without_account_drop(table):
    row = health(table, [txn(account=1), txn(account=99)]).first()
    assert row.attempted_txns == 1


def test_merchant_name_fallback(table):
    rows = [txn(merchant_id=m) for m in (1, 2, 3)]
    merchants = [
        {"merchant_id": 1, "merchant_name": "Shop", "city": "X", "country": "Y"},
        {"merchant_id": 2, "city": "X"},
    ]
    got = by(health(table, rows, merchants=merchants), "merchant_id")
    assert got[(1,)].merchant_name == "Shop"
    assert (got[(2,)].merchant_name, got[(2,)].city) == ("merchant_id=2", "X")
    assert (got[(3,)].merchant_name, got[(3,)].city) == ("merchant_id=3", None)


def test_average_ticket_ignores_unpriced_transactions(table):
    rows = [txn(amount_usd=D("10")), txn(amount_usd=None), txn(amount_usd=D("20"))]
    row = health(table, rows).first()
    assert row.settled_txns == 3
    assert row.avg_ticket_usd == D("15.00")


def test_trailing_months_counts_back_from_the_newest(table):
    txns = table(
        "transactions", *[txn(when=w) for w in ("2024-01-31", "2024-02-01", "2024-03-09")]
    )
    kept = merchant.trailing_months(txns, 2).select("txn_month").collect()
    assert sorted(r[0] for r in kept) == [dt.date(2024, 2, 1), dt.date(2024, 3, 1)]
    early = merchant.trailing_months(txns, 1, newest=dt.date(2024, 1, 1))
    assert early.count() == 1


# cohorts


def test_retention_and_matrix(spark):
    months = {1: ["2024-01-01", "2024-03-01"], 2: ["2024-01-01"], 3: ["2023-12-01", "2024-12-01"]}
    active = spark.createDataFrame(
        [(c, dt.date.fromisoformat(m)) for c, ms in months.items() for m in ms],
        "customer_id long, txn_month date",
    )
    retention = cohort.cohort_retention(active)
    got = by(retention, "cohort_month", "month_number")
    january, december = dt.date(2024, 1, 1), dt.date(2023, 12, 1)
    assert set(got) == {(january, 0), (january, 2), (december, 0), (december, 12)}
    assert got[january, 2].retention_pct == D("50.00")
    assert got[january, 2].cohort_size == 2
    matrix = by(cohort.cohort_matrix(retention), "cohort_month")
    assert matrix[(january,)].m0 == D("100.00")
    assert matrix[(january,)].m1 is None
    assert matrix[(january,)].m2 == D("50.00")
    assert matrix[(december,)].m6 is None


# orders


def order(number, customer=1, when="2024-01-10", territory=1, online=False):
    return {
        "SalesOrderID": number,
        "CustomerID": customer,
        "OrderDate": day(when),
        "TerritoryID": territory,
        "OnlineOrderFlag": online,
    }


def line(number, total="10", discount="0"):
    return {"SalesOrderID": number, "LineTotal": D(total), "UnitPriceDiscount": D(discount)}


def people(table, *ids):
    return table("order_customer", *[{"CustomerID": i, "PersonID": i} for i in ids])


def test_customer_type(table):
    customers = table(
        "order_customer",
        {"CustomerID": 1, "PersonID": 1, "StoreID": 1},
        {"CustomerID": 2, "StoreID": 1},
        {"CustomerID": 3},
    )
    got = by(orders.customer_type(customers), "CustomerID")
    assert [got[(i,)].CustomerType for i in (1, 2, 3)] == ["Individual", "Store", "Unknown"]


def test_recency_anchors_differ(table):
    header = table("order_header", order(1, when="2024-01-01"), order(2, when="2024-01-31"))
    detail = table("order_detail", line(1))
    assert orders.churn_flags(header, detail, people(table, 1)).first().RecencyDays == 0
    assert orders.rfm_segments(header, detail).first().RecencyDays == 30


def test_churn_needs_more_than_90_days(table):
    header = table(
        "order_header",
        order(1, 1, "2024-01-01"),
        order(2, 2, "2024-01-02"),
        order(3, 3, "2024-04-01"),
    )
    detail = table("order_detail", line(1), line(2), line(3))
    got = by(orders.churn_flags(header, detail, people(table, 1, 2, 3)), "CustomerID")
    assert [(got[(i,)].RecencyDays, got[(i,)].ChurnFlag_90d) for i in (1, 2, 3)] == [
        (91, 1),
        (90, 0),
        (0, 0),
    ]


def test_gaps(table):
    header = table(
        "order_header",
        order(1, 1, "2024-01-01"),
        order(2, 1, "2024-01-01"),
        order(3, 1, "2024-01-08"),
        order(4, 2, "2024-01-05"),
    )
    detail = table("order_detail", *[line(i) for i in (1, 2, 3, 4)])
    gaps = by(orders.order_gaps(orders.order_fact(header, detail)), "CustomerID")
    assert set(gaps) == {(1,)}
    assert gaps[(1,)].AvgDaysBetweenOrders == 3.5
    churn = by(orders.churn_flags(header, detail, people(table, 1, 2)), "CustomerID")
    assert churn[(1,)].AvgDaysBetweenOrders == D("3.50")
    assert churn[(2,)].AvgDaysBetweenOrders is None


def test_order_without_lines_drops(table):
    header = table("order_header", order(1), order(2))
    fact = orders.order_fact(header, table("order_detail", line(1), line(1)), "month")
    row = fact.collect()
    assert [(r.SalesOrderID, r.OrderRevenue) for r in row] == [(1, D("20.0000"))]


def test_unknown_grain_is_an_error(table):
    with pytest.raises(ValueError):
        orders.order_fact(table("order_header"), table("order_detail"), "week")


def test_discount_share_is_a_mean_of_order_shares(table):
    header = table("order_header", order(1), order(2))
    detail = table(
        "order_detail", line(1, discount="0.1"), line(2), line(2), line(2), line(2, discount="0.2")
    )
    row = orders.monthly_sales(header, detail, people(table, 1)).first()
    assert row.AvgDiscountedLinePct == D("0.625000")
    assert row.AOV == D("25.000000")
    assert (row.Customers, row.Orders) == (1, 2)


def test_all_orders_of_the_first_month_are_new(table):
    header = table(
        "order_header",
        order(1, when="2024-01-02"),
        order(2, when="2024-01-30", territory=2),
        order(3, when="2024-02-01"),
    )
    detail = table("order_detail", line(1), line(2), line(3))
    got = by(orders.monthly_sales(header, detail, people(table, 1)), "OrderMonth", "TerritoryID")
    assert {k[1]: r.CustomerStage for k, r in got.items() if k[0].month == 1} == {
        1: "New",
        2: "New",
    }
    assert got[dt.date(2024, 2, 1), 1].CustomerStage == "Returning"


def test_segmented_cohort(table):
    header = table(
        "order_header",
        order(1, 1, "2024-01-31", online=True),
        order(2, 2, "2024-01-01"),
        order(3, 1, "2024-02-01"),
        order(4, 1, "2024-02-20", online=True),
        order(5, 1, "2025-02-01"),
    )
    detail = table("order_detail", *[line(i, "10") for i in range(1, 6)])
    got = by(orders.segmented_cohort(header, detail, people(table, 1, 2)), "MonthIndex")
    assert set(got) == {(0,), (1,)}
    row = got[(1,)]
    assert (row.ActiveCustomers, row.CohortCustomers, row.ActiveOrders) == (1, 2, 2)
    assert row.CustomerRetentionRate == D("0.5000")
    assert row.RevenueRetentionRate == D("1.0000")
    assert row.OrdersPerCustomer == D("2.0000")
    assert row.OnlineOrderPct == D("0.5000")


def test_order_retention_stops_at_max_month(table):
    header = table(
        "order_header", order(1, when="2023-01-05"), order(2, when="2024-01-05"),
        order(3, when="2024-02-05"),
    )
    detail = table("order_detail", line(1), line(2), line(3))
    got = by(orders.order_retention(header, detail), "MonthIndex")
    assert set(got) == {(0,), (12,)}


@pytest.mark.parametrize(
    "recency, count, segment",
    [
        (30, 5, "Champions"),
        (30, 4, "Loyal"),
        (31, 5, "Loyal"),
        (60, 2, "Warm"),
        (61, 9, "Warm"),
        (91, 9, "At Risk"),
        (180, 1, "At Risk"),
        (181, 9, "Lost"),
    ],
)
def test_rfm_limits(table, recency, count, segment):
    newest = day("2024-12-31")
    last = newest - dt.timedelta(days=recency)
    header = table(
        "order_header",
        order(100, 2, newest.isoformat()),
        *[order(i, 1, last.isoformat()) for i in range(count)],
    )
    detail = table("order_detail", *[line(i) for i in range(count)], line(100))
    got = by(orders.rfm_segments(header, detail), "CustomerID")
    assert (got[(1,)].Orders, got[(1,)].RecencyDays) == (count, recency)
    assert got[(1,)].Segment == segment


def test_year_over_year(table):
    header = table(
        "order_header",
        order(1, 1, "2013-12-31T23:59:59"),
        order(2, 1, "2014-01-01"),
        order(3, 2, "2014-06-01"),
        order(4, 3, "2013-06-01"),
        order(5, 4, "2015-01-01"),
    )
    got = {r.CustomerID: r.Cohort for r in orders.year_over_year_cohorts(header).collect()}
    assert got == {1: "Both years", 2: "New in 2014", 3: "Churned after 2013"}


# subscriptions


def test_failed_month_has_zero_revenue(table):
    rows = [("2024-01-15", "PAID", 19), ("2024-02-15", "FAILED", 49), ("2024-02-16", "REFUNDED", 9)]
    payments_ = table(
        "payments",
        *[{"payment_date": day(d).date(), "status": s, "amount": D(a)} for d, s, a in rows],
    )
    got = by(saas.mrr(payments_), "revenue_month")
    assert got[(dt.date(2024, 1, 1),)].mrr == 19
    assert got[(dt.date(2024, 2, 1),)].mrr == 0


def test_churn_needs_status_and_end_date(table):
    end = dt.date(2024, 5, 20)
    subs = table(
        "subscriptions",
        {"status": "CANCELLED", "end_date": end},
        {"status": "CANCELLED"},
        {"status": "ACTIVE", "end_date": end},
    )
    got = saas.subscription_churn(subs).collect()
    assert [tuple(r) for r in got] == [(dt.date(2024, 5, 1), 1)]
    assert saas.active_subscribers(subs).first()[0] == 1


def test_unused_plan_is_absent(spark, table):
    subs = table("subscriptions", {"plan_id": 1}, {"plan_id": 1}, {"plan_id": 3})
    got = {r.plan_name: r.n for r in saas.plan_mix(subs, saas.plans_df(spark)).collect()}
    assert got == {"Free": 2, "pro": 1}


def test_generated_users(spark):
    as_of = dt.date(2024, 1, 1)
    users = saas.gen_users(saas.user_ids(spark), 1, as_of)
    rows = users.collect()
    assert len(rows) == 500
    assert {r.country for r in rows} == set(saas.COUNTRIES)
    assert {r.acquisition_channel for r in rows} == set(saas.CHANNELS)
    assert all(0 <= (r.signup_date - as_of).days <= 364 for r in rows)
    past = saas.gen_users(saas.user_ids(spark), 1, as_of, direction=-1)
    assert past.where(F.col("signup_date") > F.lit(as_of)).count() == 0


def test_generated_plan_shares(spark):
    users = saas.gen_users(saas.user_ids(spark, 20000), 1, dt.date(2024, 1, 1))
    subs = saas.gen_subscriptions(users, 1)
    shares = {r.plan_id: r.n / 20000 for r in subs.groupBy("plan_id").agg(F.count("*").alias("n")).collect()}
    for plan, expected in {1: 0.40, 2: 0.42, 3: 0.162, 4: 0.018}.items():
        assert abs(shares[plan] - expected) < 0.015
    ended = subs.where("end_date is not null")
    days = [(r.end_date - r.start_date).days for r in ended.collect()]
    assert 0.28 < len(days) / 20000 < 0.32
    assert (min(days), max(days)) == (30, 149)
    both = subs.where("end_date is not null and status = 'CANCELLED'").count() / 20000
    assert abs(both - 0.09) < 0.01


def test_generated_payments(spark):
    users = saas.gen_users(saas.user_ids(spark, 5000), 1, dt.date(2024, 1, 1))
    subs = saas.gen_subscriptions(users, 1)
    paid = saas.gen_payments(subs, saas.plans_df(spark), 1)
    assert paid.count() == subs.where("plan_id > 1").count()
    failed = paid.where("status = 'FAILED'").count() / paid.count()
    assert 0.035 < failed < 0.065


# input contracts


def test_conform_reports_missing_columns(spark):
    with pytest.raises(ValueError, match="customer_id"):
        conform(spark.range(1).withColumnRenamed("id", "account_id"), "accounts")


def test_conform_turns_flags_and_status_into_shape(table):
    raw = table("transactions", txn(status=" settled "), txn(is_fraud=True)).withColumn(
        "is_fraud", F.col("is_fraud").cast("int")
    )
    got = conform(raw, "transactions", clean_status=True)
    assert dict(got.dtypes)["is_fraud"] == "boolean"
    assert got.where("is_fraud and status = 'SETTLED'").count() == 1
    assert got.where("status = 'SETTLED'").count() == 2


def test_every_schema_parses(spark):
    for ddl in SCHEMAS.values():
        assert spark.createDataFrame([], ddl).columns
