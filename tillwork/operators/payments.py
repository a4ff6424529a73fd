"""Transaction volume and fraud reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.functions import pct, ratio

SETTLED = "SETTLED"


def monthly_trend(txns: DataFrame, status: str = SETTLED) -> DataFrame:
    """Count, total and average amount per month; a NULL month is a group."""
    return (
        txns.where(F.col("status") == status)
        .groupBy("txn_month")
        .agg(
            F.count("*").alias("txn_count"),
            F.sum("amount_usd").alias("total_usd"),
            F.avg("amount_usd").alias("avg_usd"),
        )
    )


def channel_type_mix(txns: DataFrame, status: str = SETTLED) -> DataFrame:
    """Count and total per month, channel and transaction type."""
    return (
        txns.where(F.col("status") == status)
        .groupBy("txn_month", "channel", "txn_type")
        .agg(F.count("*").alias("txn_count"), F.sum("amount_usd").alias("total_usd"))
    )


def top_customers(
    txns: DataFrame, accounts: DataFrame, customers: DataFrame, n: int = 50, status: str = SETTLED
) -> DataFrame:
    """The ``n`` customers with the highest total; ties go to the lower id."""
    per_account = (
        txns.where(F.col("status") == status)
        .groupBy("account_id")
        .agg(F.count("*").alias("txn_count"), F.sum("amount_usd").alias("total_usd"))
    )
    per_customer = _roll_up_to_customer(per_account, accounts, "txn_count", "total_usd")
    return (
        per_customer.join(
            customers.select("customer_id", "risk_segment", "country"), "customer_id"
        )
        .select("customer_id", "risk_segment", "country", "txn_count", "total_usd")
        .orderBy(F.desc("total_usd"), F.asc("customer_id"))
        .limit(n)
    )


def fraud_by_channel(txns: DataFrame) -> DataFrame:
    """Transactions, fraud count and fraud rate per channel, all statuses."""
    counted = txns.groupBy("channel").agg(*_fraud_counts())
    return counted.select("channel", "txns", "fraud_txns", _fraud_rate())


def fraud_by_segment(
    txns: DataFrame, accounts: DataFrame, customers: DataFrame
) -> DataFrame:
    """Fraud rate per customer risk segment."""
    per_account = txns.groupBy("account_id").agg(*_fraud_counts())
    per_customer = _roll_up_to_customer(per_account, accounts, "txns", "fraud_txns")
    per_segment = (
        per_customer.join(customers.select("customer_id", "risk_segment"), "customer_id")
        .groupBy("risk_segment")
        .agg(F.sum("txns").alias("txns"), F.sum("fraud_txns").alias("fraud_txns"))
    )
    return per_segment.select("risk_segment", "txns", "fraud_txns", _fraud_rate())


def merchant_risk_top(
    txns: DataFrame, merchants: DataFrame, min_txns: int = 50, n: int = 20
) -> DataFrame:
    """The ``n`` known merchants with the highest unrounded fraud rate.

    Merchants below ``min_txns`` are left out.  Equal rates go to the larger
    volume, then to the lower merchant id.
    """
    busy = (
        txns.where(F.col("merchant_id").isNotNull())
        .groupBy("merchant_id")
        .agg(*_fraud_counts())
        .where(F.col("txns") >= min_txns)
    )
    exact_rate = ratio(F.col("fraud_txns"), F.col("txns"), "decimal(38,18)")
    return (
        busy.join(merchants.select("merchant_id", "merchant_name", "country"), "merchant_id")
        .withColumns({"exact_rate": exact_rate, "fraud_rate_pct": _fraud_rate()})
        .orderBy(F.desc("exact_rate"), F.desc("txns"), F.asc("merchant_id"))
        .limit(n)
        .select("merchant_name", "country", "txns", "fraud_txns", "fraud_rate_pct")
    )


def _fraud_counts() -> list[Column]:
    return [
        F.count("*").alias("txns"),
        F.count_if(F.col("is_fraud")).alias("fraud_txns"),
    ]


def _fraud_rate() -> Column:
    return pct(F.col("fraud_txns"), F.col("txns"), scale=3).alias("fraud_rate_pct")


def _roll_up_to_customer(
    per_account: DataFrame, accounts: DataFrame, *measures: str
) -> DataFrame:
    """Sum per-account measures to the owning customer.

    Both join inputs hold one row per account, and the second grouping combines
    on the map side, so neither a busy account nor a customer with many accounts
    lands on one task.
    """
    return (
        per_account.join(accounts.select("account_id", "customer_id"), "account_id")
        .groupBy("customer_id")
        .agg(*[F.sum(m).alias(m) for m in measures])
    )
