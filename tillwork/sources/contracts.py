"""Schemas of the input relations and conforming of incoming tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructType

# Column types as a Spark schema string.  Ids may be INT or BIGINT, and any date
# or timestamp type does for moments; what is checked is that columns exist.
SCHEMAS = {
    "transactions": (
        "txn_id BIGINT, account_id BIGINT, merchant_id BIGINT, txn_ts_parsed TIMESTAMP_NTZ, "
        "txn_month DATE, channel STRING, txn_type STRING, status STRING, "
        "amount_usd DECIMAL(12,2), is_fraud BOOLEAN, reversal_of_txn_id BIGINT"
    ),
    "accounts": "account_id BIGINT, customer_id BIGINT",
    "customers": "customer_id BIGINT, risk_segment STRING, country STRING",
    "merchants": "merchant_id BIGINT, merchant_name STRING, city STRING, country STRING",
    "order_header": (
        "SalesOrderID BIGINT, CustomerID BIGINT, OrderDate TIMESTAMP_NTZ, TerritoryID INT, "
        "OnlineOrderFlag BOOLEAN"
    ),
    "order_detail": (
        "SalesOrderID BIGINT, LineTotal DECIMAL(18,4), UnitPriceDiscount DECIMAL(4,2)"
    ),
    "order_customer": "CustomerID BIGINT, PersonID BIGINT, StoreID BIGINT",
    "users": "user_id BIGINT, signup_date DATE, country STRING, acquisition_channel STRING",
    "plans": "plan_id INT, plan_name STRING, monthly_price DECIMAL(10,2)",
    "subscriptions": (
        "subscription_id BIGINT, user_id BIGINT, plan_id INT, start_date DATE, end_date DATE, "
        "status STRING"
    ),
    "payments": (
        "payment_id BIGINT, subscription_id BIGINT, payment_date DATE, amount DECIMAL(10,2), "
        "status STRING"
    ),
    "feature_usage": (
        "usage_id BIGINT, user_id BIGINT, feature_name STRING, usage_date DATE, usage_count INT"
    ),
    "kpi_sla_rules": (
        "kpi_name STRING, scope STRING, channel STRING, owner_team STRING, "
        "target_value DECIMAL(10,2), comparator STRING, severity STRING, is_active BOOLEAN"
    ),
    "projection_accounts": (
        "account_key BIGINT, principal DOUBLE, annual_return DOUBLE, years DOUBLE, "
        "contribution DOUBLE, contrib_frequency STRING, compounding STRING, inflation DOUBLE, "
        "contribution_timing STRING, goal DOUBLE"
    ),
}
# Columns that some sources store as 0/1.
FLAGS = {
    "transactions": ["is_fraud"],
    "order_header": ["OnlineOrderFlag"],
    "kpi_sla_rules": ["is_active"],
}


def schema_of(relation: str) -> StructType:
    return StructType.fromDDL(SCHEMAS[relation])


def conform(df: DataFrame, relation: str, clean_status: bool = True) -> DataFrame:
    """The relation's columns, in order, with 0/1 flags as booleans.

    Raises if a column is missing.  The status is trimmed and upper-cased, so that
    all reports read it alike; ``clean_status=False`` leaves a status alone that is
    stored clean, and filters on it then reach the scan.
    """
    wanted = schema_of(relation).names
    missing = [name for name in wanted if name not in df.columns]
    if missing:
        raise ValueError(f"{relation} lacks columns: {', '.join(missing)}")
    columns = []
    for name in wanted:
        column = F.col(name)
        is_flag = name in FLAGS.get(relation, [])
        if is_flag and not isinstance(df.schema[name].dataType, BooleanType):
            column = (column == 1).alias(name)
        elif name == "status" and clean_status:
            column = F.upper(F.trim(column)).alias(name)
        columns.append(column)
    return df.select(*columns)
