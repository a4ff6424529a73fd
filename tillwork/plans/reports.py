"""Order of presentation of the printed reports.

Operators return unsorted rows, so that a result that feeds another step pays
for no sort.  ``present`` adds the order a reader expects.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sort columns of each report; a leading "-" means descending.
# NULLs come first ascending and last descending.
ORDER = {
    "monthly_trend": ["txn_month"],
    "channel_type_mix": ["txn_month", "-total_usd"],
    "top_customers": ["-total_usd", "customer_id"],
    "fraud_by_channel": ["-fraud_rate_pct", "-txns"],
    "fraud_by_segment": ["-fraud_rate_pct"],
    "weekly_kpi": ["week_start", "channel"],
    "weekly_trend": ["week_start", "channel"],
    "weekly_alerts": ["-week_start", "-alert_flag", "channel"],
    "sla_scoreboard": ["-week_start", "channel", "kpi_name"],
    "sla_breach_summary": ["-breaches", "-breach_rate_pct"],
    "merchant_health": ["quality_score", "-attempted_txns"],
    "cohort_sizes": ["cohort_month"],
    "cohort_retention": ["cohort_month", "month_number"],
    "cohort_matrix": ["cohort_month"],
    "churn_flags": ["-LifetimeRevenue"],
    "order_retention": ["CohortMonth", "MonthIndex"],
    "segmented_cohort": ["CohortMonth", "CustomerType", "MonthIndex"],
    "rfm_segments": ["-Revenue"],
    "monthly_sales": ["OrderMonth", "CustomerType", "CustomerStage", "TerritoryID"],
    "mrr": ["revenue_month"],
    "subscription_churn": ["churn_month"],
    "project_balances": ["account_key", "period"],
}


def present(df: DataFrame, report: str) -> DataFrame:
    """The report's rows in their printed order."""
    return df.orderBy(*[_sort_key(key) for key in ORDER[report]])


def _sort_key(key: str) -> Column:
    return F.desc(key[1:]) if key.startswith("-") else F.asc(key)
