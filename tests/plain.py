"""The reports restated step by step, without the operators' shortcuts.

Row-level joins come before any grouping, distinct values are counted as such,
gaps come from ordered windows, and firsts are joined back.  Used as a second
opinion on small data and as the yardstick of the benchmark.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwork.functions import MONEY, average, month_index, month_start, pct, ratio
from tillwork.operators import checks, projection, sla, weekly
from tillwork.plans.queries import CONTRACT, MONTHS_BACK, YEARS, _contract_tables, portable
from tillwork.sources.testdata import TestData

SETTLED = "SETTLED"


def _flag(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0))


def _customer_txns(d: TestData) -> DataFrame:
    return d.transactions().join(d.accounts(), "account_id").join(d.customers(), "customer_id")


def _fraud(df: DataFrame, key: str) -> DataFrame:
    counted = df.groupBy(key).agg(F.count("*").alias("txns"), _flag(F.col("is_fraud")).alias("f"))
    return counted.select(
        key,
        "txns",
        F.col("f").alias("fraud_txns"),
        pct(F.col("f"), F.col("txns"), 3).alias("fraud_rate_pct"),
    )


def top_customers(d: TestData) -> DataFrame:
    return (
        _customer_txns(d)
        .where(F.col("status") == SETTLED)
        .groupBy("customer_id", "risk_segment", "country")
        .agg(F.count("*").alias("txn_count"), F.sum("amount_usd").alias("total_usd"))
        .orderBy(F.desc("total_usd"), "customer_id")
        .limit(50)
    )


def kpi_long(d: TestData) -> DataFrame:
    kpi = weekly.weekly_kpi_channel(d.transactions())
    parts = [
        kpi.select(
            "week_start", "channel", F.lit(k).alias("kpi_name"), F.col(k).alias("actual_value")
        )
        for k in ("fraud_rate_pct", "declined_rate_pct")
    ]
    return parts[0].unionAll(parts[1])


def match_rules(d: TestData) -> DataFrame:
    long = kpi_long(d).alias("m")
    rules = sla.default_sla_rules(d.spark).alias("r")
    applies = (F.col("r.scope") == "GLOBAL") | (
        (F.col("r.scope") == "CHANNEL") & (F.col("r.channel") == F.col("m.channel"))
    )
    best = Window.partitionBy("m.week_start", "m.channel", "m.kpi_name").orderBy("r.scope")
    return (
        long.join(rules, (F.col("r.kpi_name") == F.col("m.kpi_name")) & applies)
        .withColumn("rn", F.row_number().over(best))
        .where("rn = 1 and is_active")
        .select("m.*", "owner_team", "target_value", "comparator", "severity", "scope")
    )


def merchant_base(d: TestData) -> DataFrame:
    txns = d.transactions()
    newest = txns.agg(F.max("txn_month").alias("newest"))
    return (
        txns.crossJoin(newest)
        .where(F.col("txn_month") >= F.add_months("newest", 1 - MONTHS_BACK))
        .where("merchant_id is not null and txn_ts_parsed is not null")
        .join(d.accounts(), "account_id")
        .join(d.merchants(), "merchant_id", "left")
        .withColumn(
            "merchant_name",
            F.coalesce("merchant_name", F.concat(F.lit("merchant_id="), "merchant_id")),
        )
        .withColumn("status_norm", F.upper(F.trim("status")))
        .drop("newest", "status", "txn_ts_parsed", "channel", "txn_type")
    )


def repeat_customers(d: TestData) -> DataFrame:
    return (
        merchant_base(d)
        .where(F.col("status_norm") == SETTLED)
        .groupBy("merchant_id", "customer_id")
        .count()
        .groupBy("merchant_id")
        .agg(
            F.count("*").alias("customers_with_settled"),
            _flag(F.col("count") >= 2).alias("repeat_customers"),
        )
    )


def merchant_agg(d: TestData) -> DataFrame:
    status = F.col("status_norm")
    kinds = {
        "settled": status == SETTLED,
        "declined": status.isin("DECLINED", "FAILED"),
        "reversed": (status == "REVERSED") | F.col("reversal_of_txn_id").isNotNull(),
        "fraud": F.col("is_fraud"),
    }
    measures = [F.max(c).alias(c) for c in ("merchant_name", "city", "country")]
    measures += [F.count("*").alias("attempted_txns"), F.sum("amount_usd").alias("attempted_usd")]
    for name, holds in kinds.items():
        measures.append(_flag(holds).alias(f"{name}_txns"))
        measures.append(
            F.sum(F.when(holds, F.col("amount_usd")).otherwise(0)).alias(f"{name}_usd")
        )
    measures.append(F.countDistinct("customer_id").alias("unique_customers"))
    measures.append(F.avg(F.when(status == SETTLED, F.col("amount_usd"))).alias("avg_ticket_usd"))
    return merchant_base(d).groupBy("merchant_id").agg(*measures)


def merchant_health(d: TestData) -> DataFrame:
    m = merchant_agg(d).join(repeat_customers(d), "merchant_id", "left").where("attempted_txns >= 50")
    tried, settled = F.col("attempted_txns"), F.col("settled_txns")

    def share(num: str, den: Column) -> Column:
        return ratio(F.col(num), den, "decimal(34,16)")

    fraud, declined = share("fraud_txns", tried), share("declined_txns", tried)
    reversed_ = share("reversed_txns", settled)
    repeats = F.coalesce("repeat_customers", F.lit(0))
    return m.select(
        "merchant_id",
        "merchant_name",
        "city",
        "country",
        "attempted_txns",
        "attempted_usd",
        "settled_txns",
        "settled_usd",
        "declined_txns",
        pct(F.col("declined_txns"), tried).alias("decline_rate_pct"),
        "reversed_txns",
        pct(F.col("reversed_txns"), settled, precision=20).alias("reversal_rate_pct"),
        "fraud_txns",
        pct(F.col("fraud_txns"), tried).alias("fraud_rate_pct"),
        "unique_customers",
        repeats.cast("int").alias("repeat_customers"),
        pct(repeats, F.coalesce("customers_with_settled", F.lit(0))).alias(
            "repeat_customer_rate_pct"
        ),
        F.col("avg_ticket_usd").cast("decimal(12,2)").alias("avg_ticket_usd"),
        (F.col("settled_usd") - F.col("reversed_usd")).alias("net_settled_usd"),
        (100 - 200 * fraud - 100 * declined - 100 * reversed_)
        .cast("decimal(20,2)")
        .alias("quality_score"),
        F.expr(
            """case when fraud_txns >= 0.02 * attempted_txns then 'HIGH_FRAUD'
                    when declined_txns >= 0.15 * attempted_txns then 'HIGH_DECLINE'
                    when settled_txns > 0 and reversed_txns >= 0.05 * settled_txns
                        then 'HIGH_REVERSAL' else 'OK' end"""
        ).alias("primary_flag"),
    )


def active_months(d: TestData) -> DataFrame:
    return (
        _customer_txns(d)
        .where((F.col("status") == SETTLED) & F.col("txn_ts_parsed").isNotNull())
        .select("customer_id", "txn_month")
        .distinct()
    )


def _cohorts(d: TestData) -> DataFrame:
    return active_months(d).groupBy("customer_id").agg(F.min("txn_month").alias("cohort_month"))


def cohort_sizes(d: TestData) -> DataFrame:
    return _cohorts(d).groupBy("cohort_month").agg(F.count("*").alias("cohort_size"))


def cohort_retention(d: TestData) -> DataFrame:
    return (
        active_months(d)
        .join(_cohorts(d), "customer_id")
        .withColumn("month_number", month_index(F.col("cohort_month"), F.col("txn_month")))
        .groupBy("cohort_month", "month_number")
        .agg(F.countDistinct("customer_id").alias("active_customers"))
        .join(cohort_sizes(d), "cohort_month")
        .withColumn("retention_pct", pct(F.col("active_customers"), F.col("cohort_size")))
    )


def cohort_matrix(d: TestData) -> DataFrame:
    return (
        cohort_retention(d)
        .groupBy("cohort_month")
        .agg(
            *[
                F.max(F.when(F.col("month_number") == m, F.col("retention_pct"))).alias(f"m{m}")
                for m in range(7)
            ]
        )
    )


def order_fact(d: TestData, *extra: str) -> DataFrame:
    day = F.col("OrderDate").cast("date")
    return (
        d.order_header()
        .withColumn("OrderMonth", month_start(day))
        .withColumn("OrderDate", day)
        .join(d.order_detail(), "SalesOrderID")
        .groupBy("SalesOrderID", "CustomerID", *extra)
        .agg(
            F.sum("LineTotal").alias("OrderRevenue"),
            ratio(_flag(F.col("UnitPriceDiscount") > 0), F.count("*"), "decimal(7,6)").alias(
                "DiscountedLinePct"
            ),
        )
    )


def _month_fact(d: TestData) -> DataFrame:
    return order_fact(d, "OrderMonth", "TerritoryID", "OnlineOrderFlag")


def order_gaps(d: TestData) -> DataFrame:
    previous = F.lag("OrderDate").over(Window.partitionBy("CustomerID").orderBy("OrderDate"))
    return (
        order_fact(d, "OrderDate")
        .withColumn("gap", F.datediff("OrderDate", previous))
        .where("gap is not null")
        .groupBy("CustomerID")
        .agg(F.avg(F.col("gap").cast("double")).alias("AvgDaysBetweenOrders"))
    )


def _types(d: TestData) -> DataFrame:
    return d.order_customer().selectExpr(
        "CustomerID",
        "case when PersonID is not null then 'Individual'"
        " when StoreID is not null then 'Store' else 'Unknown' end as CustomerType",
    )


def churn_flags(d: TestData) -> DataFrame:
    fact = order_fact(d, "OrderDate")
    life = fact.groupBy("CustomerID").agg(
        F.min("OrderDate").alias("FirstOrderDate"),
        F.max("OrderDate").alias("LastOrderDate"),
        F.countDistinct("SalesOrderID").alias("LifetimeOrders"),
        F.sum("OrderRevenue").alias("LifetimeRevenue"),
    )
    newest = fact.agg(F.max("OrderDate").alias("newest"))
    return (
        life.join(_types(d), "CustomerID")
        .crossJoin(newest)
        .join(order_gaps(d), "CustomerID", "left")
        .withColumn("RecencyDays", F.datediff("newest", "LastOrderDate"))
        .withColumn(
            "LifetimeAOV", average(F.col("LifetimeRevenue"), F.col("LifetimeOrders"), "decimal(20,2)")
        )
        .withColumn("AvgDaysBetweenOrders", F.col("AvgDaysBetweenOrders").cast("decimal(12,2)"))
        .withColumn("ChurnFlag_90d", F.when(F.col("RecencyDays") > 90, 1).otherwise(0))
        .drop("newest")
    )


def first_month(d: TestData) -> DataFrame:
    return _month_fact(d).groupBy("CustomerID").agg(F.min("OrderMonth").alias("CohortMonth"))


def _activity(d: TestData) -> DataFrame:
    return (
        _month_fact(d)
        .join(first_month(d), "CustomerID")
        .withColumn("MonthIndex", month_index(F.col("CohortMonth"), F.col("OrderMonth")))
    )


def order_retention(d: TestData) -> DataFrame:
    activity = _activity(d)
    counts = activity.groupBy("CohortMonth", "MonthIndex").agg(
        F.countDistinct("CustomerID").alias("ActiveCustomers")
    )
    size = (
        activity.where("MonthIndex = 0")
        .groupBy("CohortMonth")
        .agg(F.countDistinct("CustomerID").alias("CohortCustomers"))
    )
    return (
        counts.join(size, "CohortMonth")
        .where("MonthIndex between 0 and 12")
        .withColumn(
            "RetentionRate",
            ratio(F.col("ActiveCustomers"), F.col("CohortCustomers"), "decimal(10,4)"),
        )
    )


def _order_metrics(customers: str, orders: str) -> list[Column]:
    return [
        F.countDistinct("CustomerID").alias(customers),
        F.countDistinct("SalesOrderID").alias(orders),
        F.sum("OrderRevenue").alias("Revenue"),
        _flag(F.col("OnlineOrderFlag")).alias("online"),
        F.sum("DiscountedLinePct").alias("shares"),
    ]


def segmented_cohort(d: TestData) -> DataFrame:
    cell = ["CohortMonth", "CustomerType"]
    metrics = (
        _activity(d)
        .join(_types(d), "CustomerID")
        .where("MonthIndex between 0 and 12")
        .groupBy(*cell, "MonthIndex")
        .agg(*_order_metrics("ActiveCustomers", "ActiveOrders"))
    )
    base = metrics.groupBy(*cell).agg(
        F.max(F.expr("if(MonthIndex = 0, ActiveCustomers, null)")).alias("CohortCustomers"),
        F.max(F.expr("if(MonthIndex = 0, Revenue, null)")).alias("CohortRevenue"),
    )
    c = F.col
    return metrics.join(base, cell).select(
        *cell,
        "MonthIndex",
        "ActiveCustomers",
        "CohortCustomers",
        "ActiveOrders",
        "Revenue",
        ratio(c("ActiveCustomers"), c("CohortCustomers"), "decimal(10,4)").alias(
            "CustomerRetentionRate"
        ),
        ratio(c("Revenue"), c("CohortRevenue"), "decimal(20,4)", MONEY, MONEY).alias(
            "RevenueRetentionRate"
        ),
        average(c("Revenue"), c("ActiveOrders"), "decimal(20,2)").alias("AOV"),
        ratio(c("ActiveOrders"), c("ActiveCustomers"), "decimal(20,4)").alias("OrdersPerCustomer"),
        ratio(c("online"), c("ActiveOrders"), "decimal(10,4)").alias("OnlineOrderPct"),
        ratio(c("shares"), c("ActiveOrders"), "decimal(10,4)", "decimal(24,6)").alias(
            "AvgDiscountedLinePct"
        ),
    )


def rfm_segments(d: TestData) -> DataFrame:
    newest = d.order_header().agg(F.max(F.col("OrderDate").cast("date")).alias("newest"))
    return (
        d.order_header()
        .join(d.order_detail(), "SalesOrderID")
        .groupBy("CustomerID")
        .agg(
            F.max(F.col("OrderDate").cast("date")).alias("LastOrderDate"),
            F.countDistinct("SalesOrderID").alias("Orders"),
            F.sum("LineTotal").alias("Revenue"),
        )
        .crossJoin(newest)
        .withColumn("RecencyDays", F.datediff("newest", "LastOrderDate"))
        .withColumn(
            "Segment",
            F.expr(
                """case when RecencyDays <= 30 and Orders >= 5 then 'Champions'
                        when RecencyDays <= 60 and Orders >= 3 then 'Loyal'
                        when RecencyDays <= 90 then 'Warm'
                        when RecencyDays <= 180 then 'At Risk' else 'Lost' end"""
            ),
        )
        .drop("newest")
    )


def year_over_year(d: TestData) -> DataFrame:
    first, second = [
        d.order_header().where(F.year("OrderDate") == y).select("CustomerID").distinct()
        for y in YEARS
    ]
    return (
        first.intersect(second)
        .withColumn("Cohort", F.lit("Both years"))
        .unionAll(second.subtract(first).withColumn("Cohort", F.lit(f"New in {YEARS[1]}")))
        .unionAll(first.subtract(second).withColumn("Cohort", F.lit(f"Churned after {YEARS[0]}")))
    )


def monthly_sales(d: TestData) -> DataFrame:
    group = ["OrderMonth", "CustomerType", "CustomerStage", "TerritoryID"]
    sales = (
        _month_fact(d)
        .join(first_month(d), "CustomerID")
        .join(_types(d), "CustomerID")
        .withColumn(
            "CustomerStage", F.expr("if(OrderMonth = CohortMonth, 'New', 'Returning')")
        )
        .groupBy(*group)
        .agg(*_order_metrics("Customers", "Orders"))
    )
    return sales.select(
        *group,
        "Customers",
        "Orders",
        "Revenue",
        average(F.col("Revenue"), F.col("Orders"), "decimal(24,6)").alias("AOV"),
        ratio(F.col("online"), F.col("Orders"), "decimal(10,6)").alias("OnlineOrderPct"),
        ratio(F.col("shares"), F.col("Orders"), "decimal(10,6)", "decimal(24,6)").alias(
            "AvgDiscountedLinePct"
        ),
    )


def _schedule(d: TestData) -> DataFrame:
    """Every account fanned out to its periods where it lies."""
    terms = projection._terms(d.projection_accounts(), ["goal"])
    return projection._with_balances(terms.withColumn("period", F.explode(F.sequence(F.lit(1), "periods"))))


REAL = "end_balance / power(1 + inflation_rate, period)"
SCHEDULE = ["account_key", "period", "year", "start_balance", "interest", "contribution", "end_balance"]


def real_balances(d: TestData) -> DataFrame:
    """Running totals from ordered windows."""
    running = Window.partitionBy("account_key").orderBy("period")
    return _schedule(d).select(
        *SCHEDULE,
        F.expr(REAL).alias("real_end_balance"),
        F.sum("contribution").over(running).alias("total_contrib"),
        F.sum("interest").over(running).alias("total_interest"),
    )


def time_to_goal(d: TestData) -> DataFrame:
    reached = F.when(F.col("end_balance") >= F.col("goal"), F.col("year"))
    return _schedule(d).groupBy("account_key").agg(F.min(reached).alias("goal_year"))


def projection_summary(d: TestData) -> DataFrame:
    """Last periods and first periods that reach the goal, out of all of them."""
    last = {
        "final_nominal": F.col("end_balance"),
        "final_real": F.expr(REAL),
        "total_contrib": F.col("contribution") * F.col("period"),
        "total_interest": F.col("end_balance") - F.col("principal") - F.col("contribution") * F.col("period"),
    }
    return _schedule(d).groupBy("account_key").agg(
        *[F.max_by(value, "period").alias(name) for name, value in last.items()],
        F.min(F.when(F.expr(f"{REAL} >= goal"), F.col("year"))).alias("goal_year"),
    )


def contract_checks(d: TestData) -> DataFrame:
    """A query for each rule: rows in surplus, rows without a parent, rows outside."""
    tables, parts = _contract_tables(d), []
    for rule in CONTRACT:
        df = tables[rule.table]
        column = ",".join(rule.columns) if isinstance(rule, checks.Unique) else rule.column
        if isinstance(rule, checks.Unique):
            kind, found = "unique", df.groupBy(*rule.columns).count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("n"))
        elif isinstance(rule, checks.ForeignKey):
            parents = tables[rule.parent].select(F.col(rule.parent_column).alias("parent"))
            orphans = df.select(F.col(rule.column).alias("ref")).where("ref is not null")
            kind, found = "foreign_key", orphans.join(parents, F.col("ref") == F.col("parent"), "left_anti").agg(F.count("*").alias("n"))
        elif isinstance(rule, checks.NotNull):
            kind, found = "not_null", df.where(F.col(column).isNull()).agg(F.count("*").alias("n"))
        else:
            kind, found = "accepted_values", df.where(~F.col(column).isin(*rule.values)).agg(F.count("*").alias("n"))
        names = {"table_name": rule.table, "rule": kind, "column_name": column}
        parts.append(found.select(*[F.lit(v).alias(k) for k, v in names.items()], F.col("n").alias("violations")))
    return reduce(DataFrame.unionAll, parts)


PLAIN: dict[str, Callable[[TestData], DataFrame]] = {
    "a3_top_customers": top_customers,
    "a5_fraud_by_segment": lambda d: _fraud(_customer_txns(d), "risk_segment"),
    "c2_kpi_long": kpi_long,
    "c3_match_rules": match_rules,
    "c4_sla_scoreboard": lambda d: sla.sla_scoreboard(match_rules(d)),
    "c5_sla_breach_summary": lambda d: sla.sla_breach_summary(sla.sla_scoreboard(match_rules(d))),
    "d2_merchant_base": merchant_base,
    "d3_repeat_customers": repeat_customers,
    "d4_merchant_agg": merchant_agg,
    "d5_merchant_health": merchant_health,
    "e1_customer_active_months": active_months,
    "e2_cohort_sizes": cohort_sizes,
    "e3_cohort_retention": cohort_retention,
    "e4_cohort_matrix": cohort_matrix,
    "f1_order_fact_day": lambda d: order_fact(d, "OrderDate").drop("DiscountedLinePct"),
    "f2_order_fact_month": _month_fact,
    "f4_order_gaps": order_gaps,
    "f5_churn_flags": churn_flags,
    "f6_first_month": first_month,
    "f7_order_retention": order_retention,
    "f8_segmented_cohort": segmented_cohort,
    "f9_rfm_segments": rfm_segments,
    "f10_year_over_year_cohorts": year_over_year,
    "f11_monthly_sales": monthly_sales,
    "g2_plan_mix": lambda d: d.subscriptions()
    .join(d.plans(), "plan_id")
    .groupBy("plan_name")
    .agg(F.count("*").alias("n")),
    "g11_contract_checks": contract_checks,
    "h1_project_balances": lambda d: _schedule(d).select(*SCHEDULE),
    "h2_project_real_balances": real_balances,
    "h3_time_to_goal": time_to_goal,
    "h4_projection_summary": projection_summary,
}


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(PLAIN[name](TestData(spark, sf_dir)), name.startswith("h"))


def queries() -> dict:
    return {name: partial(run, name) for name in PLAIN}
