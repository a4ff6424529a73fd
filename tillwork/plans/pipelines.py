"""Multi-step jobs: the published views, the SLA chain, the subscription tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.operators import cohort, merchant, saas, sla, weekly
from tillwork.sources.tables import (
    newest_value,
    publish_view,
    read_relation,
    reload_partitions,
    reload_table,
    write_bucketed,
)


def publish_payment_views(
    txns: DataFrame, accounts: DataFrame, customers: DataFrame, datefirst: int = 1
) -> None:
    """Create or replace the three payment views for use from SQL."""
    kpi = weekly.weekly_kpi_channel(txns, datefirst)
    publish_view(kpi, "v_weekly_kpi_channel")
    publish_view(weekly.weekly_trend(kpi), "v_weekly_kpi_channel_trend")
    publish_view(
        cohort.customer_active_months(txns, accounts, customers), "v_customer_txn_month"
    )


def sla_breaches(
    txns: DataFrame, rules: DataFrame | None = None, datefirst: int = 1
) -> DataFrame:
    """From transactions to the breach summary, under the shipped rules by default."""
    return _breaches(weekly.weekly_kpi_channel(txns, datefirst), rules)


def _breaches(kpi: DataFrame, rules: DataFrame | None) -> DataFrame:
    if rules is None:
        rules = sla.default_sla_rules(kpi.sparkSession)
    return sla.sla_breach_summary(sla.sla_scoreboard(sla.match_rules(sla.kpi_long(kpi), rules)))


def add_to_weekly_state(txns: DataFrame, path: str, increment: str, datefirst: int = 1) -> None:
    """Count new transactions into the stored weekly state, under the increment's name.

    An increment is any part of the transactions, such as a day's partition; late rows of old weeks are counted like others.  The same
    increment loaded again replaces itself, so a job that is run twice counts once.  No earlier transaction is read.
    ``datefirst`` must be that of all other increments.
    """
    state = weekly.weekly_state(txns, datefirst).withColumn("increment", F.lit(increment))
    reload_partitions(state.coalesce(1), path, ["increment"])


def read_weekly_state(spark: SparkSession, path: str) -> DataFrame:
    """The weekly state of all increments: one row per week and channel."""
    return weekly.merge_states(spark.read.parquet(path))


def compact_weekly_state(spark: SparkSession, path: str, increment: str) -> None:
    """Put all increments into one of that name.  Those in it can then no longer be replaced one by one."""
    state = read_weekly_state(spark, path).withColumn("increment", F.lit(increment))
    reload_table(state.coalesce(1), path, ["increment"])


def sla_breaches_from_state(
    spark: SparkSession, path: str, rules: DataFrame | None = None
) -> DataFrame:
    """The breach summary of all weeks from the stored state; no transaction is read."""
    return _breaches(weekly.kpi_from_state(read_weekly_state(spark, path)), rules)


def bucket_order_tables(
    header: DataFrame, detail: DataFrame, prefix: str, buckets: int, directory: str | None = None
) -> tuple[str, str]:
    """Store order headers and lines bucketed by order; gives the tables' names.

    All order reports over them sum lines and meet headers without a shuffle.
    """
    names = f"{prefix}_header", f"{prefix}_detail"
    for df, name in zip((header, detail), names, strict=True):
        path = None if directory is None else f"{directory}/{name}"
        write_bucketed(df, name, ["SalesOrderID"], buckets, path)
    return names


def merchant_scorecard(
    spark: SparkSession, txns_path: str, accounts: DataFrame, merchants: DataFrame, **settings
) -> DataFrame:
    """The scorecard over a stored transactions table, whose newest month is told by the files' footers.

    With a table partitioned by month, only the months that count are then read.
    """
    newest = newest_value(spark, txns_path, "txn_month")
    txns = read_relation(spark, txns_path, "transactions")
    return merchant.merchant_health(txns, accounts, merchants, newest=newest, **settings)


def write_subscription_tables(
    spark: SparkSession, directory: str, n_users: int, seed: int, as_of: date
) -> None:
    """Generate the subscription tables and load them afresh under ``directory``.

    Each table is generated from the one just written, so its rows are read back
    and not drawn again.
    """
    reload_table(saas.plans_df(spark), f"{directory}/plans")
    plans = spark.read.parquet(f"{directory}/plans")
    reload_table(
        saas.gen_users(saas.user_ids(spark, n_users), seed, as_of), f"{directory}/users"
    )
    users = spark.read.parquet(f"{directory}/users")
    reload_table(saas.gen_subscriptions(users, seed), f"{directory}/subscriptions")
    subs = spark.read.parquet(f"{directory}/subscriptions")
    reload_table(saas.gen_payments(subs, plans, seed), f"{directory}/payments")
