"""Merchant health: enriched transactions, repeat customers, scorecard."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.functions import average, pct, ratio
from tillwork.operators.hot_keys import split_join
from tillwork.operators.weekly import DECLINED


def trailing_months(
    txns: DataFrame, months_back: int = 6, newest: date | None = None
) -> DataFrame:
    """Transactions of the ``months_back`` months up to the newest one.

    The newest month is read from all transactions unless it is given.
    """
    newest = txns.agg(F.max("txn_month")).scalar() if newest is None else F.lit(newest)
    return txns.where(
        F.col("txn_month").between(F.add_months(newest, 1 - months_back), newest)
    )


def merchant_base(txns: DataFrame, accounts: DataFrame, merchants: DataFrame) -> DataFrame:
    """Dated merchant transactions with their customer and merchant details.

    A merchant that is unknown, or known without a name, is named after its id.  The rows of a busy
    account or merchant are joined in many tasks, see ``hot_keys``.
    """
    customers = accounts.select("account_id", "customer_id")
    details = merchants.select("merchant_id", "merchant_name", "city", "country")
    owned = split_join(_dated_merchant_txns(txns), customers, "account_id", spread_by=["txn_id"])
    return (
        split_join(owned, details, "merchant_id", "left", spread_by=["txn_id"])
        .select(
            "txn_month",
            "txn_id",
            "account_id",
            "customer_id",
            "merchant_id",
            _merchant_label().alias("merchant_name"),
            "city",
            "country",
            _clean_status().alias("status_norm"),
            "amount_usd",
            "is_fraud",
            "reversal_of_txn_id",
        )
    )


def merchant_customers(txns: DataFrame, accounts: DataFrame) -> DataFrame:
    """Additive measures per merchant and customer.

    Everything the merchant reports need is read off these rows, so the
    transactions are scanned once.  They are first reduced to one row per
    merchant, account and outcome: a busy account or merchant is combined on the
    map side and only then meets the accounts.
    """
    outcome = (
        F.when(_clean_status() == "SETTLED", "S")
        .when(_clean_status().isin(*DECLINED), "D")
        .when(_clean_status() == "REVERSED", "R")
    )
    reduced = (
        _dated_merchant_txns(txns)
        .groupBy(
            "merchant_id",
            "account_id",
            outcome.alias("outcome"),
            F.col("reversal_of_txn_id").isNotNull().alias("refers_back"),
            F.coalesce("is_fraud", F.lit(False)).alias("is_fraud"),
        )
        .agg(
            F.count("*").alias("txns"),
            F.sum("amount_usd").alias("usd"),
            F.count("amount_usd").alias("priced"),
        )
    )
    settled = F.col("outcome") == "S"
    measures = [F.sum("txns").alias("attempted_txns"), F.sum("usd").alias("attempted_usd")]
    for name, holds in {
        "settled": settled,
        "declined": F.col("outcome") == "D",
        "reversed": (F.col("outcome") == "R") | F.col("refers_back"),
        "fraud": F.col("is_fraud"),
    }.items():
        measures.append(_sum_where(holds, "txns").alias(f"{name}_txns"))
        measures.append(_sum_where(holds, "usd").alias(f"{name}_usd"))
    return (
        reduced.join(accounts.select("account_id", "customer_id"), "account_id")
        .groupBy("merchant_id", "customer_id")
        .agg(*measures, _sum_where(settled, "priced").alias("settled_priced"))
    )


def repeat_customers(per_customer: DataFrame, min_txns: int = 2) -> DataFrame:
    """Customers with settled transactions per merchant, and those that came back.

    ``per_customer`` is the output of ``merchant_customers``; transactions whose
    account has no customer count as one customer here.
    """
    return (
        per_customer.groupBy("merchant_id")
        .agg(*_repeat_counts(min_txns))
        .where(F.col("customers_with_settled") > 0)
    )


def merchant_agg(
    per_customer: DataFrame, merchants: DataFrame, min_repeat: int = 2
) -> DataFrame:
    """Totals per merchant, with its details; see ``merchant_customers``.

    ``reversed`` takes reversals and transactions that point back to another one,
    so it overlaps with ``settled``.
    """
    return _merchant_totals(per_customer, merchants, min_repeat).drop(
        "customers_with_settled", "repeat_customers", "settled_priced"
    )


def merchant_health(
    txns: DataFrame,
    accounts: DataFrame,
    merchants: DataFrame,
    months_back: int = 6,
    min_txns: int = 50,
    weights: tuple[str, str, str] = ("2", "1", "1"),
    thresholds: tuple[str, str, str] = ("0.02", "0.15", "0.05"),
    min_repeat: int = 2,
    newest: date | None = None,
) -> DataFrame:
    """Scorecard per merchant with at least ``min_txns`` attempts.

    ``weights`` and ``thresholds`` are for fraud, declines and reversals.  The
    score and the flag use unrounded rates; reversals are measured against
    settled transactions, so a merchant without any has a NULL score.
    """
    recent = trailing_months(txns, months_back, newest)
    totals = _merchant_totals(
        merchant_customers(recent, accounts), merchants, min_repeat
    ).where(F.col("attempted_txns") >= min_txns)

    attempted, settled = F.col("attempted_txns"), F.col("settled_txns")
    shares = [
        _share(F.col("fraud_txns"), attempted),
        _share(F.col("declined_txns"), attempted),
        _share(F.col("reversed_txns"), settled),
    ]
    score = F.lit(Decimal(100))
    for weight, share in zip(weights, shares, strict=True):
        score = score - F.lit(Decimal(weight)) * 100 * share
    limits = [F.lit(Decimal(t)) for t in thresholds]
    flag = (
        F.when(shares[0] >= limits[0], "HIGH_FRAUD")
        .when(shares[1] >= limits[1], "HIGH_DECLINE")
        .when(shares[2] >= limits[2], "HIGH_REVERSAL")
        .otherwise("OK")
    )
    return totals.select(
        "merchant_id",
        "merchant_name",
        "city",
        "country",
        "attempted_txns",
        "attempted_usd",
        "settled_txns",
        "settled_usd",
        "declined_txns",
        pct(F.col("declined_txns"), attempted).alias("decline_rate_pct"),
        "reversed_txns",
        pct(F.col("reversed_txns"), settled, precision=20).alias("reversal_rate_pct"),
        "fraud_txns",
        pct(F.col("fraud_txns"), attempted).alias("fraud_rate_pct"),
        "unique_customers",
        F.col("repeat_customers").cast("int").alias("repeat_customers"),
        pct(F.col("repeat_customers"), F.col("customers_with_settled")).alias(
            "repeat_customer_rate_pct"
        ),
        average(F.col("settled_usd"), F.col("settled_priced"), "decimal(12,2)").alias(
            "avg_ticket_usd"
        ),
        (F.col("settled_usd") - F.col("reversed_usd"))
        .cast("decimal(24,2)")
        .alias("net_settled_usd"),
        score.cast("decimal(20,2)").alias("quality_score"),
        flag.alias("primary_flag"),
    )


def _dated_merchant_txns(txns: DataFrame) -> DataFrame:
    return txns.where(F.col("merchant_id").isNotNull() & F.col("txn_ts_parsed").isNotNull())


def _clean_status() -> Column:
    return F.upper(F.trim("status"))


def _merchant_label() -> Column:
    fallback = F.concat(F.lit("merchant_id="), F.col("merchant_id").cast("string"))
    return F.coalesce(F.col("merchant_name"), fallback)


def _sum_where(condition: Column, measure: str) -> Column:
    """Total over the rows that meet a condition, 0 where none does."""
    return F.sum(F.when(condition, F.col(measure)).otherwise(0))


def _repeat_counts(min_txns: int) -> list[Column]:
    return [
        F.count_if(F.col("settled_txns") > 0).alias("customers_with_settled"),
        F.count_if(F.col("settled_txns") >= min_txns).alias("repeat_customers"),
    ]


def _merchant_totals(
    per_customer: DataFrame, merchants: DataFrame, min_repeat: int
) -> DataFrame:
    sums = [
        "attempted_txns",
        "attempted_usd",
        "settled_txns",
        "settled_usd",
        "declined_txns",
        "declined_usd",
        "reversed_txns",
        "reversed_usd",
        "fraud_txns",
        "fraud_usd",
        "settled_priced",
    ]
    totals = per_customer.groupBy("merchant_id").agg(
        *[F.sum(c).alias(c) for c in sums],
        F.count("customer_id").alias("unique_customers"),
        *_repeat_counts(min_repeat),
    )
    details = merchants.select("merchant_id", "merchant_name", "city", "country")
    return totals.join(details, "merchant_id", "left").select(
        "merchant_id",
        _merchant_label().alias("merchant_name"),
        "city",
        "country",
        *sums,
        "unique_customers",
        average(F.col("settled_usd"), F.col("settled_priced"), "decimal(18,6)").alias(
            "avg_ticket_usd"
        ),
        "customers_with_settled",
        "repeat_customers",
    )


def _share(num: Column, den: Column) -> Column:
    return ratio(num, den, "decimal(34,16)")
