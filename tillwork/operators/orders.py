"""Order sales: cohorts, churn, segments and the monthly dashboard."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwork.functions import MONEY, average, month_start, ratio
from tillwork.operators.cohort import with_cohort

# Segment, longest recency in days, fewest orders; first match wins.
RFM_SEGMENTS = [
    ("Champions", 30, 5),
    ("Loyal", 60, 3),
    ("Warm", 90, None),
    ("At Risk", 180, None),
]
RFM_OTHERWISE = "Lost"


def order_fact(header: DataFrame, detail: DataFrame, grain: str = "day") -> DataFrame:
    """One row per order that has lines, with its revenue.

    ``grain='month'`` gives OrderMonth in place of OrderDate and adds territory,
    online flag and the share of discounted lines.  Lines are summed per order
    before the join; the join reuses that partitioning.
    """
    if grain not in ("day", "month"):
        raise ValueError("grain must be day or month")
    revenue = F.sum("LineTotal").alias("OrderRevenue")
    if grain == "day":
        lines = detail.groupBy("SalesOrderID").agg(revenue)
        orders = header.select(
            "SalesOrderID", "CustomerID", F.col("OrderDate").cast("date").alias("OrderDate")
        )
        return orders.join(lines, "SalesOrderID")
    discounted = ratio(
        F.count_if(F.col("UnitPriceDiscount") > 0), F.count("*"), "decimal(7,6)"
    )
    lines = detail.groupBy("SalesOrderID").agg(revenue, discounted.alias("DiscountedLinePct"))
    orders = header.select(
        "SalesOrderID",
        "CustomerID",
        month_start(F.col("OrderDate")).alias("OrderMonth"),
        "TerritoryID",
        "OnlineOrderFlag",
    )
    return orders.join(lines, "SalesOrderID")


def customer_type(customer: DataFrame) -> DataFrame:
    """Individual if a person is set, else Store if a store is, else Unknown."""
    kind = (
        F.when(F.col("PersonID").isNotNull(), "Individual")
        .when(F.col("StoreID").isNotNull(), "Store")
        .otherwise("Unknown")
    )
    return customer.select("CustomerID", kind.alias("CustomerType"))


def order_gaps(fact: DataFrame) -> DataFrame:
    """Average days between a customer's consecutive orders (two orders at least).

    Consecutive gaps add up to last minus first date, so their mean needs no
    ordering of the orders.
    """
    spans = fact.groupBy("CustomerID").agg(*_order_span())
    return spans.where(F.col("DatedOrders") > 1).select(
        "CustomerID",
        (_span_days().cast("double") / (F.col("DatedOrders") - 1)).alias(
            "AvgDaysBetweenOrders"
        ),
    )


def churn_flags(
    header: DataFrame, detail: DataFrame, customer: DataFrame, churn_days: int = 90
) -> DataFrame:
    """Lifetime value, recency and churn flag per customer.

    Recency counts from the newest order that has lines.
    """
    fact = order_fact(header, detail)
    # The newest order is picked together with its revenue: the lines are then summed
    # as in the main query, and Spark shares that shuffle instead of reading them twice.
    newest = fact.agg(F.max(F.struct("OrderDate", "OrderRevenue"))).scalar()["OrderDate"]
    lifetime = fact.groupBy("CustomerID").agg(
        *_order_span(),
        F.count("*").alias("LifetimeOrders"),
        F.sum("OrderRevenue").alias("LifetimeRevenue"),
    )
    recency = F.datediff(newest, F.col("LastOrderDate"))
    gap = F.when(
        F.col("DatedOrders") > 1,
        ratio(_span_days(), F.col("DatedOrders") - 1, "decimal(12,2)"),
    )
    return (
        lifetime.join(customer_type(customer), "CustomerID")
        .withColumn("RecencyDays", recency)
        .select(
            "CustomerID",
            "CustomerType",
            "FirstOrderDate",
            "LastOrderDate",
            "RecencyDays",
            "LifetimeOrders",
            "LifetimeRevenue",
            average(F.col("LifetimeRevenue"), F.col("LifetimeOrders"), "decimal(20,2)").alias(
                "LifetimeAOV"
            ),
            gap.alias("AvgDaysBetweenOrders"),
            F.when(F.col("RecencyDays") > churn_days, 1)
            .otherwise(0)
            .alias(f"ChurnFlag_{churn_days}d"),
        )
    )


def first_month(fact: DataFrame, name: str = "CohortMonth") -> DataFrame:
    """Month of each customer's first order."""
    return fact.groupBy("CustomerID").agg(F.min("OrderMonth").alias(name))


def order_retention(header: DataFrame, detail: DataFrame, max_month: int = 12) -> DataFrame:
    """Customers of each cohort that order again, by month since the first order.

    Orders without a customer belong to no cohort.
    """
    fact = order_fact(header, detail, "month").where(F.col("CustomerID").isNotNull())
    active = fact.select("CustomerID", "OrderMonth").distinct()
    counted = (
        with_cohort(active, "CustomerID", "OrderMonth", "CohortMonth", "MonthIndex")
        .where(F.col("MonthIndex").between(0, max_month))
        .groupBy("CohortMonth", "MonthIndex")
        .agg(F.count("*").alias("ActiveCustomers"))
    )
    return counted.withColumn(
        "CohortCustomers", _month_zero("ActiveCustomers", "CohortMonth")
    ).select(
        "CohortMonth",
        "MonthIndex",
        "ActiveCustomers",
        "CohortCustomers",
        ratio(F.col("ActiveCustomers"), F.col("CohortCustomers"), "decimal(10,4)").alias(
            "RetentionRate"
        ),
    )


def segmented_cohort(
    header: DataFrame, detail: DataFrame, customer: DataFrame, max_month: int = 12
) -> DataFrame:
    """Retention, revenue and order mix per cohort, customer type and month.

    Orders are added up per customer and month, which turns both distinct counts
    into plain ones and keeps every later step free of order-level rows.
    """
    monthly = _customer_months(order_fact(header, detail, "month"))
    cell = ["CohortMonth", "CustomerType"]
    metrics = (
        with_cohort(monthly, "CustomerID", "OrderMonth", "CohortMonth", "MonthIndex")
        .where(F.col("MonthIndex").between(0, max_month))
        .join(customer_type(customer), "CustomerID")
        .groupBy(*cell, "MonthIndex")
        .agg(F.count("*").alias("ActiveCustomers"), *_roll_up_orders("ActiveOrders"))
        .withColumn("CohortCustomers", _month_zero("ActiveCustomers", *cell))
        .withColumn("CohortRevenue", _month_zero("Revenue", *cell))
    )
    orders, customers = F.col("ActiveOrders"), F.col("ActiveCustomers")
    return metrics.select(
        *cell,
        "MonthIndex",
        "ActiveCustomers",
        "CohortCustomers",
        "ActiveOrders",
        "Revenue",
        ratio(customers, F.col("CohortCustomers"), "decimal(10,4)").alias(
            "CustomerRetentionRate"
        ),
        ratio(
            F.col("Revenue"), F.col("CohortRevenue"), "decimal(20,4)", MONEY, MONEY
        ).alias("RevenueRetentionRate"),
        average(F.col("Revenue"), orders, "decimal(20,2)").alias("AOV"),
        ratio(orders, customers, "decimal(20,4)").alias("OrdersPerCustomer"),
        *_order_mix("decimal(10,4)", "ActiveOrders"),
    )


def rfm_segments(
    header: DataFrame,
    detail: DataFrame,
    segments: Sequence[tuple[str, int, int | None]] = RFM_SEGMENTS,
    otherwise: str = RFM_OTHERWISE,
) -> DataFrame:
    """Recency, frequency and revenue per customer and the segment they give.

    Recency counts from the newest order of all, with or without lines.
    """
    newest = header.agg(F.max(F.col("OrderDate").cast("date"))).scalar()
    scored = (
        order_fact(header, detail)
        .groupBy("CustomerID")
        .agg(
            F.max("OrderDate").alias("LastOrderDate"),
            F.count("*").alias("Orders"),
            F.sum("OrderRevenue").alias("Revenue"),
        )
        .withColumn("RecencyDays", F.datediff(newest, F.col("LastOrderDate")))
    )
    segment = F.lit(otherwise)
    for name, longest, fewest in reversed(segments):
        fits = F.col("RecencyDays") <= longest
        if fewest is not None:
            fits = fits & (F.col("Orders") >= fewest)
        segment = F.when(fits, name).otherwise(segment)
    return scored.select(
        "CustomerID",
        "LastOrderDate",
        "RecencyDays",
        "Orders",
        "Revenue",
        segment.alias("Segment"),
    )


def year_over_year_cohorts(header: DataFrame, y1: int = 2013, y2: int = 2014) -> DataFrame:
    """Customers who ordered in both years, only in the second, or only in the first.

    One pass over the orders of the two years; the date ranges reach the scan.
    """
    in_y1, in_y2 = _in_year(F.col("OrderDate"), y1), _in_year(F.col("OrderDate"), y2)
    seen = (
        header.where(in_y1 | in_y2)
        .groupBy("CustomerID")
        .agg(F.max(in_y1).alias("in_y1"), F.max(in_y2).alias("in_y2"))
    )
    cohort = (
        F.when(F.col("in_y1") & F.col("in_y2"), "Both years")
        .when(F.col("in_y2"), f"New in {y2}")
        .otherwise(f"Churned after {y1}")
    )
    return seen.select("CustomerID", cohort.alias("Cohort"))


def monthly_sales(header: DataFrame, detail: DataFrame, customer: DataFrame) -> DataFrame:
    """Sales per month, customer type, stage and territory.

    All orders of a customer's first month are New, later ones Returning.
    """
    monthly = _customer_months(order_fact(header, detail, "month"), "TerritoryID")
    first = F.min("OrderMonth").over(Window.partitionBy("CustomerID"))
    stage = F.when(F.col("OrderMonth") == first, "New").otherwise("Returning")
    group = ["OrderMonth", "CustomerType", "CustomerStage", "TerritoryID"]
    sales = (
        monthly.withColumn("CustomerStage", stage)
        .join(customer_type(customer), "CustomerID")
        .groupBy(*group)
        .agg(F.count("*").alias("Customers"), *_roll_up_orders("Orders"))
    )
    return sales.select(
        *group,
        "Customers",
        "Orders",
        "Revenue",
        average(F.col("Revenue"), F.col("Orders"), "decimal(24,6)").alias("AOV"),
        *_order_mix("decimal(10,6)", "Orders"),
    )


def _order_span() -> list[Column]:
    return [
        F.min("OrderDate").alias("FirstOrderDate"),
        F.max("OrderDate").alias("LastOrderDate"),
        F.count("OrderDate").alias("DatedOrders"),
    ]


def _span_days() -> Column:
    return F.datediff("LastOrderDate", "FirstOrderDate")


def _customer_months(fact: DataFrame, *dimensions: str) -> DataFrame:
    """Add up a customer's orders per month; bounded by the calendar per customer."""
    return fact.groupBy("CustomerID", "OrderMonth", *dimensions).agg(
        F.count("*").alias("Orders"),
        F.sum("OrderRevenue").alias("Revenue"),
        F.count_if(F.col("OnlineOrderFlag")).alias("OnlineOrders"),
        F.sum("DiscountedLinePct").alias("DiscountShares"),
    )


def _roll_up_orders(orders_name: str) -> list[Column]:
    return [
        F.sum("Orders").alias(orders_name),
        F.sum("Revenue").alias("Revenue"),
        F.sum("OnlineOrders").alias("OnlineOrders"),
        F.sum("DiscountShares").alias("DiscountShares"),
    ]


def _order_mix(dtype: str, orders_name: str) -> list[Column]:
    """Online share of orders and the mean of the per-order discount shares."""
    orders = F.col(orders_name)
    return [
        ratio(F.col("OnlineOrders"), orders, dtype).alias("OnlineOrderPct"),
        ratio(F.col("DiscountShares"), orders, dtype, "decimal(24,6)").alias(
            "AvgDiscountedLinePct"
        ),
    ]


def _month_zero(measure: str, *group: str) -> Column:
    """A cohort's value in its first month, beside every month of the cohort."""
    return F.max(F.when(F.col("MonthIndex") == 0, F.col(measure))).over(
        Window.partitionBy(*group)
    )


def _in_year(moment: Column, year: int) -> Column:
    return (moment >= F.lit(date(year, 1, 1))) & (moment < F.lit(date(year + 1, 1, 1)))
