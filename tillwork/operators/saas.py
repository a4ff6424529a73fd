"""Subscription metrics and seeded generation of subscription data."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.functions import month_start, seeded_draw
from tillwork.sources.tables import constant_rows

# The plans on offer.
PLANS = [
    (1, "Free", Decimal("0.00")),
    (2, "Basic", Decimal("19.00")),
    (3, "pro", Decimal("49.00")),
    (4, "Business", Decimal("99.00")),
]
# Countries and acquisition channels of generated users.
COUNTRIES = ["US", "UK", "IN", "CA", "DE"]
CHANNELS = ["Organic", "Paid Search", "Referral", "outbound"]
# Odds in tenths that a generated subscription takes plan 1, else
# plan 2, else plan 3.  Every plan has its own draw, so the effective shares are
# .40 / .42 / .162 / .018.
PLAN_ODDS = (4, 7, 9)


def status_counts(rows: DataFrame) -> DataFrame:
    """Rows per status, of subscriptions or payments."""
    return rows.groupBy("status").agg(F.count("*").alias("n"))


def plan_mix(subs: DataFrame, plans: DataFrame) -> DataFrame:
    """Subscriptions per plan name; a plan nobody uses is absent."""
    per_plan = subs.groupBy("plan_id").agg(F.count("*").alias("n"))
    return (
        per_plan.join(plans.select("plan_id", "plan_name"), "plan_id")
        .groupBy("plan_name")
        .agg(F.sum("n").alias("n"))
    )


def mrr(payments: DataFrame) -> DataFrame:
    """Paid revenue per month; a month with failures only gives 0."""
    paid = F.when(F.col("status") == "PAID", F.col("amount")).otherwise(0)
    return payments.groupBy(month_start(F.col("payment_date")).alias("revenue_month")).agg(
        F.sum(paid).alias("mrr")
    )


def subscription_churn(subs: DataFrame) -> DataFrame:
    """Cancelled subscriptions per month of their end date."""
    return (
        subs.where((F.col("status") == "CANCELLED") & F.col("end_date").isNotNull())
        .groupBy(month_start(F.col("end_date")).alias("churn_month"))
        .agg(F.count("*").alias("churned_subscriptions"))
    )


def active_subscribers(subs: DataFrame) -> DataFrame:
    """Number of active subscriptions, as one row."""
    return subs.where(F.col("status") == "ACTIVE").agg(
        F.count("*").alias("active_subscribers")
    )


def plans_df(spark: SparkSession) -> DataFrame:
    return constant_rows(spark, PLANS, "plans")


def user_ids(spark: SparkSession, n: int = 500) -> DataFrame:
    """Ids 1 to ``n`` for ``gen_users``."""
    return spark.range(1, n + 1).withColumnRenamed("id", "user_id")


def gen_users(ids: DataFrame, seed: int, as_of: date, direction: int = 1) -> DataFrame:
    """One generated user per row of ``ids`` (column ``user_id``).

    Sign-up lies up to 364 days from ``as_of``: after it by default, before it
    with ``direction=-1``.
    """
    user = F.col("user_id")
    offset = seeded_draw(user, "day", seed, 365).cast("int") * direction
    return ids.select(
        "user_id",
        F.date_add(F.lit(as_of), offset).alias("signup_date"),
        _pick(COUNTRIES, seeded_draw(user, "country", seed, len(COUNTRIES))).alias("country"),
        _pick(CHANNELS, seeded_draw(user, "channel", seed, len(CHANNELS))).alias(
            "acquisition_channel"
        ),
    )


def gen_subscriptions(
    users: DataFrame, seed: int, plan_odds: Sequence[int] = PLAN_ODDS
) -> DataFrame:
    """One generated subscription per user, from sign-up on.

    ``plan_odds`` are tenths, tried in plan order with a draw each; the plan after
    the last takes the rest.  Ending and cancellation are drawn independently.
    """
    user = F.col("user_id")
    plan = F.lit(len(plan_odds) + 1)
    for number, odds in reversed(list(enumerate(plan_odds, start=1))):
        chosen = seeded_draw(user, f"plan{number}", seed, 10) < odds
        plan = F.when(chosen, number).otherwise(plan)
    lasts = 30 + seeded_draw(user, "end_days", seed, 120).cast("int")
    return users.select(
        user.cast("bigint").alias("subscription_id"),
        "user_id",
        plan.alias("plan_id"),
        F.col("signup_date").alias("start_date"),
        F.when(
            seeded_draw(user, "ends", seed, 10) < 3, F.date_add("signup_date", lasts)
        ).alias("end_date"),
        F.when(seeded_draw(user, "cancelled", seed, 10) < 3, "CANCELLED")
        .otherwise("ACTIVE")
        .alias("status"),
    )


def gen_payments(subs: DataFrame, plans: DataFrame, seed: int) -> DataFrame:
    """One payment, 30 days in, for each subscription to a paid plan; 5% fail."""
    sub = F.col("subscription_id")
    priced = plans.where(F.col("monthly_price") > 0).select("plan_id", "monthly_price")
    return subs.join(priced, "plan_id").select(
        sub.alias("payment_id"),
        "subscription_id",
        F.date_add("start_date", 30).alias("payment_date"),
        F.col("monthly_price").alias("amount"),
        F.when(seeded_draw(sub, "payment", seed, 20) == 0, "FAILED")
        .otherwise("PAID")
        .alias("status"),
    )


def _pick(values: Sequence[str], position: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (position + 1).cast("int"))
