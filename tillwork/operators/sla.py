"""SLA rules, the scoreboard against weekly KPIs and the breach summary."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.functions import pct
from tillwork.sources.tables import constant_rows

# The shipped SLA rules, percent targets.
# (kpi_name, scope, channel, owner_team, target_value, comparator, severity, is_active)
DEFAULT_RULES = [
    ("fraud_rate_pct", "GLOBAL", None, "Risk", Decimal("1.20"), "<=", "HIGH", True),
    ("declined_rate_pct", "GLOBAL", None, "Payments", Decimal("8.00"), "<=", "MED", True),
    ("fraud_rate_pct", "CHANNEL", "ONLINE", "Risk", Decimal("0.90"), "<=", "HIGH", True),
]

_RULE_FIELDS = ["owner_team", "target_value", "comparator", "severity", "scope"]


def default_sla_rules(spark: SparkSession) -> DataFrame:
    return constant_rows(spark, DEFAULT_RULES, "kpi_sla_rules")


def kpi_long(
    kpi: DataFrame, kpis: Sequence[str] = ("fraud_rate_pct", "declined_rate_pct")
) -> DataFrame:
    """One row per week, channel and KPI, from a single pass over the wide rows."""
    typed = kpi.select(
        "week_start", "channel", *[F.col(k).cast("decimal(10,2)").alias(k) for k in kpis]
    )
    return typed.unpivot(["week_start", "channel"], list(kpis), "kpi_name", "actual_value")


def match_rules(long: DataFrame, rules: DataFrame) -> DataFrame:
    """Give each KPI row its channel's active rule, else the global one.

    Rules are reduced to one per target first, so the KPI rows need only two
    equality joins and no ranking.  Between rules of the same target the highest
    severity wins, then the remaining fields in order.  KPIs without a rule drop;
    a NULL channel can take a global rule only.
    """
    active = rules.where(F.col("is_active"))
    by_channel = _one_rule(
        active.where((F.col("scope") == "CHANNEL") & F.col("channel").isNotNull()),
        ["kpi_name", "channel"],
        "channel_rule",
    )
    by_kpi = _one_rule(active.where(F.col("scope") == "GLOBAL"), ["kpi_name"], "global_rule")
    return (
        long.join(by_channel, ["kpi_name", "channel"], "left")
        .join(by_kpi, "kpi_name", "left")
        .withColumn("rule", F.coalesce("channel_rule", "global_rule"))
        .where(F.col("rule").isNotNull())
        .select("week_start", "channel", "kpi_name", "actual_value", "rule.*")
    )


def sla_scoreboard(matched: DataFrame) -> DataFrame:
    """PASS or FAIL per KPI row, and by how much the target is missed.

    The breach is negative while the target holds.  An unknown comparator or a
    missing value counts as FAIL with a NULL breach.
    """
    actual, target = F.col("actual_value"), F.col("target_value")
    at_most, at_least = F.col("comparator") == "<=", F.col("comparator") == ">="
    passed = (at_most & (actual <= target)) | (at_least & (actual >= target))
    breach = F.when(at_most, actual - target).when(at_least, target - actual)
    return matched.select(
        "week_start",
        "channel",
        "kpi_name",
        "actual_value",
        "comparator",
        "target_value",
        "owner_team",
        "severity",
        F.when(passed, "PASS").otherwise("FAIL").alias("sla_status"),
        breach.cast("decimal(10,2)").alias("breach_amount"),
    )


def sla_breach_summary(scoreboard: DataFrame) -> DataFrame:
    """Rows, breaches and breach rate per KPI, owning team and severity."""
    counted = scoreboard.groupBy("kpi_name", "owner_team", "severity").agg(
        F.count("*").alias("total_rows"),
        F.count_if(F.col("sla_status") == "FAIL").alias("breaches"),
    )
    return counted.withColumn(
        "breach_rate_pct", pct(F.col("breaches"), F.col("total_rows"))
    )


def _one_rule(rules: DataFrame, keys: list[str], name: str) -> DataFrame:
    severity_rank = (
        F.when(F.col("severity") == "HIGH", 1)
        .when(F.col("severity") == "MED", 2)
        .when(F.col("severity") == "LOW", 3)
        .otherwise(4)
    )
    order = F.struct(severity_rank, "target_value", "owner_team", "comparator", "severity")
    return rules.groupBy(*keys).agg(F.min_by(F.struct(*_RULE_FIELDS), order).alias(name))
