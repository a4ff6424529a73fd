"""Cohorts by month of first activity."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwork.functions import month_index, pct


def customer_active_months(
    txns: DataFrame, accounts: DataFrame, customers: DataFrame, status: str = "SETTLED"
) -> DataFrame:
    """The months in which each known customer had a settled, dated transaction.

    Duplicates are removed per account before the join and per customer after
    it, so no key carries more rows than there are months.
    """
    account_months = (
        txns.where((F.col("status") == status) & F.col("txn_ts_parsed").isNotNull())
        .select("account_id", "txn_month")
        .distinct()
    )
    return (
        account_months.join(accounts.select("account_id", "customer_id"), "account_id")
        .select("customer_id", "txn_month")
        .distinct()
        .join(customers.select("customer_id"), "customer_id", "left_semi")
    )


def first_active_months(
    txns: DataFrame, accounts: DataFrame, customers: DataFrame, status: str = "SETTLED"
) -> DataFrame:
    """The first month in which each known customer had a settled, dated transaction.

    A minimum per account, then per customer: nothing is made distinct on the way.
    """
    per_account = (
        txns.where((F.col("status") == status) & F.col("txn_ts_parsed").isNotNull())
        .groupBy("account_id")
        .agg(F.min("txn_month").alias("txn_month"))
    )
    return (
        per_account.join(accounts.select("account_id", "customer_id"), "account_id")
        .groupBy("customer_id")
        .agg(F.min("txn_month").alias("txn_month"))
        .join(customers.select("customer_id"), "customer_id", "left_semi")
    )


def with_cohort(
    activity: DataFrame, customer: str, month: str, cohort: str, index: str
) -> DataFrame:
    """Add each customer's first month and the distance from it in months.

    Expects rows at customer-month grain: the window then holds at most one row
    per month of a customer (times any low-cardinality dimension in the grain).
    """
    first = F.min(month).over(Window.partitionBy(customer))
    return activity.withColumn(cohort, first).withColumn(
        index, month_index(F.col(cohort), F.col(month))
    )


def cohort_sizes(active: DataFrame) -> DataFrame:
    """Customers per month of first activity; takes active months, or the first one of each."""
    return (
        active.groupBy("customer_id")
        .agg(F.min("txn_month").alias("cohort_month"))
        .groupBy("cohort_month")
        .agg(F.count("*").alias("cohort_size"))
    )


def cohort_retention(active: DataFrame) -> DataFrame:
    """Share of each cohort active in every later month, without a month cap."""
    counted = (
        with_cohort(active, "customer_id", "txn_month", "cohort_month", "month_number")
        .where(F.col("cohort_month").isNotNull())
        .groupBy("cohort_month", "month_number")
        .agg(F.count("*").alias("active_customers"))
    )
    # every customer is active in month 0 of the own cohort
    size = F.max(F.when(F.col("month_number") == 0, F.col("active_customers"))).over(
        Window.partitionBy("cohort_month")
    )
    return counted.withColumn("cohort_size", size).select(
        "cohort_month",
        "month_number",
        "cohort_size",
        "active_customers",
        pct(F.col("active_customers"), F.col("cohort_size")).alias("retention_pct"),
    )


def cohort_matrix(retention: DataFrame, months: int = 7) -> DataFrame:
    """Retention with one column per month, m0 up to ``months`` - 1."""
    cells = (
        retention.groupBy("cohort_month")
        .pivot("month_number", list(range(months)))
        .agg(F.max("retention_pct"))
    )
    return cells.select("cohort_month", *[F.col(str(m)).alias(f"m{m}") for m in range(months)])
