"""Weekly channel KPIs, their trend and the alerts drawn from it."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwork.functions import pct, week_start

DECLINED = ("DECLINED", "FAILED")


#: What a week's state holds: numbers that add up over any parts of the transactions.
STATE = ["attempted_txns", "settled_txns", "declined_txns", "fraud_txns", "attempted_usd"]


def weekly_state(txns: DataFrame, datefirst: int = 1) -> DataFrame:
    """Counts and amounts per week and channel; transactions without a timestamp are left out.

    States of different transactions add up to the state of all of them, see ``merge_states``.
    """
    return (
        txns.where(F.col("txn_ts_parsed").isNotNull())
        .groupBy(week_start(F.col("txn_ts_parsed"), datefirst).alias("week_start"), "channel")
        .agg(
            F.count("*").alias("attempted_txns"),
            F.count_if(F.col("status") == "SETTLED").alias("settled_txns"),
            F.count_if(F.col("status").isin(*DECLINED)).alias("declined_txns"),
            F.count_if(F.col("is_fraud")).alias("fraud_txns"),
            F.sum("amount_usd").alias("attempted_usd"),
        )
    )


def merge_states(states: DataFrame) -> DataFrame:
    """One row per week and channel from the states of several parts of the transactions, stacked."""
    amount = states.schema["attempted_usd"].dataType
    total = [F.sum(c).alias(c) for c in STATE[:-1]]
    total.append(F.sum("attempted_usd").cast(amount).alias("attempted_usd"))
    return states.groupBy("week_start", "channel").agg(*total)


def kpi_from_state(state: DataFrame, declined_rate_name: str = "declined_rate_pct") -> DataFrame:
    """The KPIs of a state that has one row per week and channel."""
    attempted = F.col("attempted_txns")
    return state.select(
        "week_start",
        "channel",
        "attempted_txns",
        "settled_txns",
        "declined_txns",
        pct(F.col("declined_txns"), attempted).alias(declined_rate_name),
        "fraud_txns",
        pct(F.col("fraud_txns"), attempted).alias("fraud_rate_pct"),
        "attempted_usd",
    )


def weekly_kpi_channel(
    txns: DataFrame, datefirst: int = 1, declined_rate_name: str = "declined_rate_pct"
) -> DataFrame:
    """KPIs per week and channel; transactions without a timestamp are left out."""
    return kpi_from_state(weekly_state(txns, datefirst), declined_rate_name)


def weekly_kpi_report(txns: DataFrame, datefirst: int = 7) -> DataFrame:
    """The same KPIs as printed in the report: Sunday weeks, ``decline_rate_pct``."""
    return weekly_kpi_channel(txns, datefirst, declined_rate_name="decline_rate_pct")


def weekly_trend(kpi: DataFrame) -> DataFrame:
    """Put each channel's previous reported week beside the current one.

    Runs on the aggregated KPI, at most one row per week in each channel.  A
    week without rows is skipped, not treated as zero.
    """
    by_channel = Window.partitionBy("channel").orderBy("week_start")
    measures = ["attempted_txns", "attempted_usd", "declined_rate_pct", "fraud_rate_pct"]
    return kpi.select(
        "week_start",
        "channel",
        *measures,
        *[F.lag(m).over(by_channel).alias(f"prev_{m}") for m in measures],
    )


def weekly_alerts(
    trend: DataFrame,
    min_txns: int = 50,
    fraud_pp: str = "0.50",
    decline_pp: str = "2.00",
) -> DataFrame:
    """Flag low volume, else a fraud jump, else a decline jump (percentage points).

    Jumps compare the rounded rates; a channel's first week cannot spike.
    """
    fraud_jump = F.col("fraud_rate_pct") - F.col("prev_fraud_rate_pct")
    decline_jump = F.col("declined_rate_pct") - F.col("prev_declined_rate_pct")
    flag = (
        F.when(F.col("attempted_txns") < min_txns, "LOW_VOLUME")
        .when(fraud_jump >= F.lit(Decimal(fraud_pp)), "FRAUD_SPIKE")
        .when(decline_jump >= F.lit(Decimal(decline_pp)), "DECLINE_SPIKE")
        .otherwise("OK")
    )
    return trend.select(
        "week_start",
        "channel",
        "attempted_txns",
        "declined_rate_pct",
        "fraud_rate_pct",
        flag.alias("alert_flag"),
    )
