"""Contract checks: how many rows break each declared table rule."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegralType,
    LongType,
    NumericType,
    StringType,
    TimestampNTZType,
    TimestampType,
)


@dataclass(frozen=True)
class NotNull:
    table: str
    column: str


@dataclass(frozen=True)
class Accepted:
    """Only the listed values; NULL passes."""

    table: str
    column: str
    values: tuple


@dataclass(frozen=True)
class Unique:
    """No two rows share the columns; every surplus row is a violation."""

    table: str
    columns: tuple[str, ...]


@dataclass(frozen=True)
class ForeignKey:
    """Every value occurs in the parent; NULL passes."""

    table: str
    column: str
    parent: str
    parent_column: str


Rule = NotNull | Accepted | Unique | ForeignKey

# Domains of the coded columns.
SUBSCRIPTION_STATUSES = ("TRIAL", "ACTIVE", "CANCELLED", "PAST_DUE")
PAYMENT_STATUSES = ("PAID", "FAILED", "REFUNDED")
RULE_SCOPES = ("GLOBAL", "CHANNEL")
RULE_COMPARATORS = ("<=", ">=")
RULE_SEVERITIES = ("LOW", "MED", "HIGH")

USER_RULES: list[Rule] = [
    Unique("users", ("user_id",)),
    *[
        NotNull("users", c)
        for c in ("user_id", "signup_date", "country", "acquisition_channel")
    ],
]
PLAN_RULES: list[Rule] = [
    Unique("plans", ("plan_id",)),
    Unique("plans", ("plan_name",)),
    *[NotNull("plans", c) for c in ("plan_id", "plan_name", "monthly_price")],
]
SUBSCRIPTION_RULES: list[Rule] = [
    Unique("subscriptions", ("subscription_id",)),
    *[
        NotNull("subscriptions", c)
        for c in ("subscription_id", "user_id", "plan_id", "start_date", "status")
    ],
    Accepted("subscriptions", "status", SUBSCRIPTION_STATUSES),
    ForeignKey("subscriptions", "user_id", "users", "user_id"),
    ForeignKey("subscriptions", "plan_id", "plans", "plan_id"),
]
PAYMENT_RULES: list[Rule] = [
    Unique("payments", ("payment_id",)),
    *[
        NotNull("payments", c)
        for c in ("payment_id", "subscription_id", "payment_date", "amount", "status")
    ],
    Accepted("payments", "status", PAYMENT_STATUSES),
    ForeignKey("payments", "subscription_id", "subscriptions", "subscription_id"),
]
USAGE_RULES: list[Rule] = [
    Unique("feature_usage", ("usage_id",)),
    *[
        NotNull("feature_usage", c)
        for c in ("usage_id", "user_id", "feature_name", "usage_date", "usage_count")
    ],
    ForeignKey("feature_usage", "user_id", "users", "user_id"),
]
SLA_RULES: list[Rule] = [
    *[
        NotNull("kpi_sla_rules", c)
        for c in (
            "kpi_name",
            "scope",
            "owner_team",
            "target_value",
            "comparator",
            "severity",
            "is_active",
        )
    ],
    Accepted("kpi_sla_rules", "scope", RULE_SCOPES),
    Accepted("kpi_sla_rules", "comparator", RULE_COMPARATORS),
    Accepted("kpi_sla_rules", "severity", RULE_SEVERITIES),
]


#: One table's key is unique: of the tables whose duplicates would multiply rows in the reports.
KEY_RULES: list[Rule] = [
    Unique("accounts", ("account_id",)),
    Unique("customers", ("customer_id",)),
    Unique("merchants", ("merchant_id",)),
    Unique("order_header", ("SalesOrderID",)),
    Unique("order_customer", ("CustomerID",)),
    Unique("projection_accounts", ("account_key",)),
]


def check_contract(tables: Mapping[str, DataFrame], rules: Sequence[Rule]) -> DataFrame:
    """One row per rule with the number of violating rows.

    A table is read once for all its row rules and once for all its keys.  Keys, references and the parents' keys
    are laid out as rows of one width and counted together, in one shuffle and without a join: a
    whole number stands for itself, any other key for a 128-bit digest.  A reference and its parent are compared in
    the wider of their types.  A frequent value is one row of each map task.
    """
    if not rules:
        raise ValueError("no rules given")
    numbered = list(enumerate(rules))
    parts = []
    for table in dict.fromkeys(rule.table for rule in rules):
        mine = [(i, r) for i, r in numbered if r.table == table]
        row_rules = [(i, r) for i, r in mine if isinstance(r, NotNull | Accepted)]
        if row_rules:
            parts.append(_row_rules(tables[table], row_rules))
    keys = [(i, r) for i, r in numbered if isinstance(r, Unique | ForeignKey)]
    if keys:
        parts.append(_key_rules(tables, keys))
    counts = reduce(DataFrame.unionByName, parts)
    labels = pa.table(
        {
            "id": pa.array(range(len(rules)), pa.int32()),
            "table_name": [r.table for r in rules],
            "rule": [_KINDS[type(r)] for r in rules],
            "column_name": [",".join(r.columns) if isinstance(r, Unique) else r.column for r in rules],
        }
    )
    # a rule that nothing breaks has no count
    named = tables[rules[0].table].sparkSession.createDataFrame(labels)
    return named.join(counts, "id", "left").select(
        "table_name", "rule", "column_name", F.coalesce("violations", F.lit(0)).alias("violations")
    )


_KINDS = {
    NotNull: "not_null",
    Accepted: "accepted_values",
    Unique: "unique",
    ForeignKey: "foreign_key",
}


# Rules are written as SQL: a table's rules are one text, and one call to Spark.


def _name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _row_rules(df: DataFrame, rules: Sequence[tuple[int, NotNull | Accepted]]) -> DataFrame:
    nulls = {i: f"count_if({_name(r.column)} is null)" for i, r in rules if isinstance(r, NotNull)}
    counts = [F.expr(text).alias(f"n{i}") for i, text in nulls.items()]
    counts += [F.count_if(~F.col(r.column).isin(*r.values)).alias(f"n{i}") for i, r in rules if isinstance(r, Accepted)]
    found = ", ".join(f"named_struct('id', {i}, 'violations', n{i})" for i, _ in rules)
    return df.agg(*counts).select(F.expr(f"inline(array({found}))"))


def _key_rules(
    tables: Mapping[str, DataFrame], rules: Sequence[tuple[int, Unique | ForeignKey]]
) -> DataFrame:
    """Surplus rows of each key, and rows of each reference that has no parent."""
    wanted: dict[str, list[str]] = {}
    for i, rule in rules:
        if isinstance(rule, Unique):
            kinds = [_type(tables, rule.table, c) for c in rule.columns]
            key = _key([_name(c) for c in rule.columns], kinds)
            wanted.setdefault(rule.table, []).append(_entry(i, key, False))
        else:
            kind = _wider(_type(tables, rule.table, rule.column), _type(tables, rule.parent, rule.parent_column))
            for table, column, is_parent in (
                (rule.table, rule.column, False),
                (rule.parent, rule.parent_column, True),
            ):
                key = _key([f"cast({_name(column)} as {kind.simpleString()})"], [kind])
                wanted.setdefault(table, []).append(_entry(i, key, is_parent))
    laid_out = [tables[name].select(F.expr(f"inline(array({', '.join(entries)}))")) for name, entries in wanted.items()]
    counted = (
        reduce(DataFrame.unionByName, laid_out)
        .groupBy("id", "high", "low")
        .agg(F.sum("used").alias("n"), F.max("known").alias("known"))
    )
    references = [i for i, r in rules if isinstance(r, ForeignKey)]
    is_reference = F.col("id").isin(*references) if references else F.lit(False)
    orphan = is_reference & F.col("low").isNotNull() & ~F.col("known")
    broken = F.when(orphan, F.col("n")).when(~is_reference, F.col("n") - 1).otherwise(0)
    return counted.groupBy("id").agg(F.sum(broken).alias("violations"))


def _type(tables: Mapping[str, DataFrame], table: str, column: str) -> DataType:
    return tables[table].schema[column].dataType


def _entry(rule: int, key: tuple[str, str], is_parent: bool) -> str:
    """A row of one width: the rule, the key, and whether it is used or known."""
    used, known = (0, "true") if is_parent else (1, "false")
    return f"named_struct('id', {rule}, 'high', {key[0]}, 'low', {key[1]}, 'used', {used}L, 'known', {known})"


def _key(columns: Sequence[str], kinds: Sequence[DataType]) -> tuple[str, str]:
    """Two longs that are equal where all columns are; the second is NULL for one column that is."""
    if len(columns) == 1 and isinstance(kinds[0], IntegralType):
        return "0L", f"cast({columns[0]} as bigint)"
    # a hash passes over NULLs, so they are told apart by flags; 0.0 and -0.0 are one number
    values = [f"{c} + 0.0D" if isinstance(k, FloatType | DoubleType) else c for c, k in zip(columns, kinds, strict=True)]
    parts = ", ".join([*values, *[f"{c} is null" for c in columns]])
    digest = f"xxhash64({parts})", f"xxhash64('second half', {parts})"
    if len(columns) > 1:
        return digest
    return tuple(f"if({columns[0]} is null, cast(null as bigint), {half})" for half in digest)


def _wider(a: DataType, b: DataType) -> DataType:
    """The type in which values of both are compared; text, unless both are numbers or both are moments."""
    if a == b:
        return a
    if isinstance(a, NumericType) and isinstance(b, NumericType):
        exact = [_as_decimal(t) for t in (a, b)]
        if None in exact:
            return DoubleType()
        if isinstance(a, IntegralType) and isinstance(b, IntegralType):
            return LongType()
        scale = max(t.scale for t in exact)
        digits = max(t.precision - t.scale for t in exact)
        if digits + scale > 38:  # a decimal's digits
            raise ValueError(f"no type holds all of {a.simpleString()} and {b.simpleString()}")
        return DecimalType(digits + scale, scale)
    moments = (DateType, TimestampType, TimestampNTZType)
    if isinstance(a, moments) and isinstance(b, moments):
        return TimestampNTZType() if TimestampType() not in (a, b) else TimestampType()
    return StringType()


def _as_decimal(kind: DataType) -> DecimalType | None:
    if isinstance(kind, DecimalType):
        return kind
    return DecimalType(19, 0) if isinstance(kind, IntegralType) else None
