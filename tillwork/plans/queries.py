"""Every operator as a query over a directory of the provided tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType

from tillwork.operators import (
    checks,
    cohort,
    merchant,
    orders,
    payments,
    projection,
    saas,
    sla,
    weekly,
)
from tillwork.sources.testdata import TestData

SEED = 7
AS_OF = date(2024, 1, 1)
# The test data spans few transactions per merchant and month, and other years.
MONTHS_BACK = 12
YEARS = (1996, 1997)

CONTRACT = [
    *checks.USER_RULES,
    *checks.PLAN_RULES,
    *checks.SLA_RULES,
    *checks.KEY_RULES,
    *checks.SUBSCRIPTION_RULES,
    *checks.PAYMENT_RULES,
    *checks.USAGE_RULES,
    checks.Unique("transactions", ("txn_id",)),
    checks.NotNull("transactions", "txn_ts_parsed"),
    checks.NotNull("transactions", "merchant_id"),
    checks.Accepted("transactions", "channel", ("ONLINE", "POS", "ATM")),
    checks.ForeignKey("transactions", "account_id", "accounts", "account_id"),
    checks.ForeignKey("transactions", "merchant_id", "merchants", "merchant_id"),
]

Build = Callable[[TestData], DataFrame]


def _kpi(d: TestData) -> DataFrame:
    return weekly.weekly_kpi_channel(d.transactions(), datefirst=1)


def _merged_state(d: TestData) -> DataFrame:
    """The weekly state of all transactions from those of two parts, in which weeks overlap."""
    txns = d.transactions()
    parts = [weekly.weekly_state(txns.where(part)) for part in (F.col("txn_id") % 3 == 0, F.col("txn_id") % 3 != 0)]
    return weekly.merge_states(parts[0].unionByName(parts[1]))


def _trend(d: TestData) -> DataFrame:
    return weekly.weekly_trend(_kpi(d))


def _matched(d: TestData) -> DataFrame:
    return sla.match_rules(sla.kpi_long(_kpi(d)), sla.default_sla_rules(d.spark))


def _scoreboard(d: TestData) -> DataFrame:
    return sla.sla_scoreboard(_matched(d))


def _breach_summary(d: TestData) -> DataFrame:
    return sla.sla_breach_summary(_scoreboard(d))


def _merchant_customers(d: TestData) -> DataFrame:
    recent = merchant.trailing_months(d.transactions(), MONTHS_BACK)
    return merchant.merchant_customers(recent, d.accounts())


def _active(d: TestData) -> DataFrame:
    return cohort.customer_active_months(d.transactions(), d.accounts(), d.customers())


def _retention(d: TestData) -> DataFrame:
    return cohort.cohort_retention(_active(d))


def _gen_users(d: TestData) -> DataFrame:
    return saas.gen_users(d.user_ids(), SEED, AS_OF)


def _gen_subscriptions(d: TestData) -> DataFrame:
    return saas.gen_subscriptions(_gen_users(d), SEED)


def _contract_tables(d: TestData) -> dict[str, DataFrame]:
    names = ["users", "plans", "subscriptions", "payments", "feature_usage"]
    names += ["transactions", "accounts", "customers", "merchants"]
    names += ["order_header", "order_customer", "projection_accounts"]
    tables = {name: getattr(d, name)() for name in names}
    return tables | {"kpi_sla_rules": sla.default_sla_rules(d.spark)}


BUILDS: dict[str, Build] = {
    "a1_monthly_trend": lambda d: payments.monthly_trend(d.transactions()),
    "a2_channel_type_mix": lambda d: payments.channel_type_mix(d.transactions()),
    "a3_top_customers": lambda d: payments.top_customers(
        d.transactions(), d.accounts(), d.customers()
    ),
    "a4_fraud_by_channel": lambda d: payments.fraud_by_channel(d.transactions()),
    "a5_fraud_by_segment": lambda d: payments.fraud_by_segment(
        d.transactions(), d.accounts(), d.customers()
    ),
    "a6_merchant_risk_top": lambda d: payments.merchant_risk_top(
        d.transactions(), d.merchants()
    ),
    "b1_weekly_kpi_report": lambda d: weekly.weekly_kpi_report(d.transactions()),
    "b2_weekly_kpi_channel": _kpi,
    "b3_weekly_trend": _trend,
    "b4_weekly_alerts": lambda d: weekly.weekly_alerts(_trend(d)),
    "b5_merged_weekly_state": _merged_state,
    "c2_kpi_long": lambda d: sla.kpi_long(_kpi(d)),
    "c3_match_rules": _matched,
    "c4_sla_scoreboard": _scoreboard,
    "c5_sla_breach_summary": _breach_summary,
    "d1_trailing_months": lambda d: merchant.trailing_months(d.transactions(), MONTHS_BACK),
    "d2_merchant_base": lambda d: merchant.merchant_base(
        merchant.trailing_months(d.transactions(), MONTHS_BACK), d.accounts(), d.merchants()
    ),
    "d3_repeat_customers": lambda d: merchant.repeat_customers(_merchant_customers(d)),
    "d4_merchant_agg": lambda d: merchant.merchant_agg(_merchant_customers(d), d.merchants()),
    "d5_merchant_health": lambda d: merchant.merchant_health(
        d.transactions(), d.accounts(), d.merchants(), MONTHS_BACK
    ),
    "e1_customer_active_months": _active,
    "e2_cohort_sizes": lambda d: cohort.cohort_sizes(
        cohort.first_active_months(d.transactions(), d.accounts(), d.customers())
    ),
    "e3_cohort_retention": _retention,
    "e4_cohort_matrix": lambda d: cohort.cohort_matrix(_retention(d)),
    "f1_order_fact_day": lambda d: orders.order_fact(d.order_header(), d.order_detail()),
    "f2_order_fact_month": lambda d: orders.order_fact(
        d.order_header(), d.order_detail(), "month"
    ),
    "f3_customer_type": lambda d: orders.customer_type(d.order_customer()),
    "f4_order_gaps": lambda d: orders.order_gaps(
        orders.order_fact(d.order_header(), d.order_detail())
    ),
    "f5_churn_flags": lambda d: orders.churn_flags(
        d.order_header(), d.order_detail(), d.order_customer()
    ),
    "f6_first_month": lambda d: orders.first_month(
        orders.order_fact(d.order_header(), d.order_detail(), "month")
    ),
    "f7_order_retention": lambda d: orders.order_retention(d.order_header(), d.order_detail()),
    "f8_segmented_cohort": lambda d: orders.segmented_cohort(
        d.order_header(), d.order_detail(), d.order_customer()
    ),
    "f9_rfm_segments": lambda d: orders.rfm_segments(d.order_header(), d.order_detail()),
    "f10_year_over_year_cohorts": lambda d: orders.year_over_year_cohorts(
        d.order_header(), *YEARS
    ),
    "f11_monthly_sales": lambda d: orders.monthly_sales(
        d.order_header(), d.order_detail(), d.order_customer()
    ),
    "g1_subscription_status": lambda d: saas.status_counts(d.subscriptions()),
    "g2_plan_mix": lambda d: saas.plan_mix(d.subscriptions(), d.plans()),
    "g3_payment_status": lambda d: saas.status_counts(d.payments()),
    "g4_mrr": lambda d: saas.mrr(d.payments()),
    "g5_subscription_churn": lambda d: saas.subscription_churn(d.subscriptions()),
    "g6_active_subscribers": lambda d: saas.active_subscribers(d.subscriptions()),
    "g8_gen_users": _gen_users,
    "g9_gen_subscriptions": _gen_subscriptions,
    "g10_gen_payments": lambda d: saas.gen_payments(_gen_subscriptions(d), d.plans(), SEED),
    "g11_contract_checks": lambda d: checks.check_contract(_contract_tables(d), CONTRACT),
    "h1_project_balances": lambda d: projection.project_balances(d.projection_accounts()),
    "h2_project_real_balances": lambda d: projection.project_real_balances(
        d.projection_accounts()
    ),
    "h3_time_to_goal": lambda d: projection.goal_years(
        d.projection_accounts(), F.col("goal")
    ),
    "h4_projection_summary": lambda d: projection.projection_summary(
        d.projection_accounts(), F.col("goal"), use_real=True
    ),
}
FLAGSHIP = "c5_sla_breach_summary"


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Build one query over a directory of the provided tables."""
    return portable(BUILDS[name](TestData(spark, sf_dir)), rounded=name.startswith("h"))


def portable(result: DataFrame, rounded: bool = False) -> DataFrame:
    """Decimals as doubles; ``rounded`` also cuts doubles to 3 decimals.

    The operators return exact decimals.  The value check compares two engines,
    and a double of the same decimal is the same number in both.  Powers may differ in the last bits:
    a cut after three decimals would then split values that are whole thousandths, as many balances are, and rounding
    those that are halves of them.  The shift by 0.3714 thousandths, no round part of one, moves the cuts away from either.
    The balances themselves are held to 1e-9 against a loop in ``tests/test_projection.py``.
    """
    columns = []
    for field in result.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, DecimalType):
            column = column.cast("double").alias(field.name)
        elif rounded and isinstance(field.dataType, DoubleType):
            column = (F.floor(column * 1000 + 0.3714) / 1000).alias(field.name)
        columns.append(column)
    return result.select(*columns)
