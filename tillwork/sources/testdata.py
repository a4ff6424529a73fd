"""The provided star-schema Parquet tables read as the input relations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.functions import month_start
from tillwork.operators.saas import plans_df


# The provided tables' schemas; stating them saves a footer read per table.
TABLES = {
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": (
        "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"
    ),
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
        "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
        "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"
    ),
    "events": (
        "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
    ),
}


class TestData:
    """Lazy views of one scale-factor directory, named after the relations."""

    __test__ = False

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    def transactions(self) -> DataFrame:
        line = F.col("l_linenumber")
        moment = F.when(F.col("l_quantity") != 50, F.col("l_shipdate"))
        tax = _hundredths(F.col("l_tax"))
        return self.table("lineitem").select(
            _txn_id(line).alias("txn_id"),
            F.col("l_orderkey").alias("account_id"),
            F.when(~((line == 7) & (F.col("l_suppkey") % 10 == 0)), F.col("l_suppkey")).alias(
                "merchant_id"
            ),
            moment.alias("txn_ts_parsed"),
            month_start(moment).alias("txn_month"),
            _case(line % 4, {0: "ONLINE", 1: "POS", 2: "ATM"}, "MOBILE").alias("channel"),
            _case(
                F.col("l_returnflag"),
                {"A": "PURCHASE", "N": "TRANSFER", "R": "WITHDRAWAL"},
                None,
            ).alias("txn_type"),
            _case(tax, {0: "DECLINED", 1: "FAILED", 2: "REVERSED"}, "SETTLED").alias("status"),
            F.col("l_extendedprice").cast("decimal(12,2)").alias("amount_usd"),
            ((F.col("l_orderkey") * 31 + F.col("l_partkey") * 7 + line) % 50 == 0).alias(
                "is_fraud"
            ),
            F.when((F.col("l_returnflag") == "R") & (line == 7), _txn_id(F.lit(1))).alias(
                "reversal_of_txn_id"
            ),
        )

    def accounts(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").alias("account_id"), F.col("o_custkey").alias("customer_id")
        )

    def customers(self) -> DataFrame:
        return (
            self.table("customer")
            .join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("c_custkey").alias("customer_id"),
                F.col("c_mktsegment").alias("risk_segment"),
                F.col("n_name").alias("country"),
            )
        )

    def merchants(self) -> DataFrame:
        """All suppliers; every seventh has no name, for the name fallback."""
        return (
            self.table("supplier")
            .join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("s_suppkey").alias("merchant_id"),
                F.when(F.col("s_suppkey") % 7 != 0, F.col("s_name")).alias("merchant_name"),
                F.concat(F.lit("CITY_"), F.col("s_nationkey").cast("string")).alias("city"),
                F.col("n_name").alias("country"),
            )
        )

    def order_header(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").alias("SalesOrderID"),
            F.col("o_custkey").alias("CustomerID"),
            F.col("o_orderdate").alias("OrderDate"),
            (F.col("o_custkey") % 10 + 1).cast("int").alias("TerritoryID"),
            F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").alias("OnlineOrderFlag"),
        )

    def order_detail(self) -> DataFrame:
        price = F.col("l_extendedprice").cast("decimal(12,2)")
        discount = F.col("l_discount").cast("decimal(4,2)")
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("SalesOrderID"),
            (price * (1 - discount)).cast("decimal(18,4)").alias("LineTotal"),
            F.when(_hundredths(F.col("l_discount")) > 5, discount)
            .otherwise(0)
            .cast("decimal(4,2)")
            .alias("UnitPriceDiscount"),
        )

    def order_customer(self) -> DataFrame:
        segment = F.col("c_mktsegment")
        return self.table("customer").select(
            F.col("c_custkey").alias("CustomerID"),
            F.when(segment.isin("HOUSEHOLD", "AUTOMOBILE"), F.col("c_custkey")).alias("PersonID"),
            F.when(segment.isin("BUILDING", "MACHINERY", "HOUSEHOLD"), F.col("c_custkey")).alias(
                "StoreID"
            ),
        )

    def users(self) -> DataFrame:
        first_order = (
            self.table("orders")
            .groupBy("o_custkey")
            .agg(F.min("o_orderdate").cast("date").alias("signup_date"))
        )
        return (
            self.customers()
            .join(first_order, F.col("customer_id") == F.col("o_custkey"), "left")
            .select(
                F.col("customer_id").alias("user_id"),
                "signup_date",
                "country",
                F.lower("risk_segment").alias("acquisition_channel"),
            )
        )

    def user_ids(self) -> DataFrame:
        return self.table("customer").select(F.col("c_custkey").alias("user_id"))

    def plans(self) -> DataFrame:
        return plans_df(self.spark)

    def subscriptions(self) -> DataFrame:
        key = F.col("o_orderkey")
        started = F.col("o_orderdate").cast("date")
        return self.table("orders").select(
            key.alias("subscription_id"),
            F.col("o_custkey").alias("user_id"),
            (key % 4 + 1).cast("int").alias("plan_id"),
            started.alias("start_date"),
            F.when(key % 10 < 3, F.date_add(started, (30 + key % 120).cast("int"))).alias(
                "end_date"
            ),
            _case(
                F.col("o_orderstatus"),
                {"F": "CANCELLED", "O": "ACTIVE", "P": "PAST_DUE"},
                None,
            ).alias("status"),
        )

    def payments(self) -> DataFrame:
        sub = F.col("subscription_id")
        status = F.when(sub % 19 == 0, "FAILED").when(sub % 23 == 0, "REFUNDED").otherwise("PAID")
        return (
            self.subscriptions()
            .join(self.plans().where(F.col("monthly_price") > 0), "plan_id")
            .select(
                sub.alias("payment_id"),
                "subscription_id",
                F.date_add("start_date", 30).alias("payment_date"),
                F.col("monthly_price").alias("amount"),
                status.alias("status"),
            )
        )

    def feature_usage(self) -> DataFrame:
        return self.table("events").select(
            F.col("event_id").alias("usage_id"),
            "user_id",
            F.col("event_type").alias("feature_name"),
            F.col("ts").cast("date").alias("usage_date"),
            F.floor("value").cast("int").alias("usage_count"),
        )

    def projection_accounts(self) -> DataFrame:
        key = F.col("c_custkey")
        principal = F.abs("c_acctbal")
        return self.table("customer").select(
            key.alias("account_key"),
            principal.alias("principal"),
            ((key % 11 - 2).cast("double") * 0.01).alias("annual_return"),
            (key % 5 + 1).cast("double").alias("years"),
            ((key % 7) * 50).cast("double").alias("contribution"),
            _case(key % 2, {0: "monthly"}, "yearly").alias("contrib_frequency"),
            _case(key % 3, {0: "daily", 1: "monthly"}, "yearly").alias("compounding"),
            ((key % 13).cast("double") * 0.005).alias("inflation"),
            _case(F.floor(key / 2) % 2, {0: "start"}, "end").alias("contribution_timing"),
            (principal * 1.5).alias("goal"),
        )


def _hundredths(fraction: Column) -> Column:
    """A non-negative fraction with two decimals as a whole number."""
    return F.floor(fraction * 100 + 0.5)


def _txn_id(line: Column) -> Column:
    return F.col("l_orderkey") * 10 + line


def _case(value: Column, labels: dict, otherwise: str | None) -> Column:
    column = F.lit(otherwise)
    for key, label in labels.items():
        column = F.when(value == key, label).otherwise(column)
    return column
