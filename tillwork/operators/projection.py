"""Balance projections over a table of accounts.

Each account row carries its own parameters.  Balances follow a closed form, so
every period is computed on its own, without UDF or running state:

    balance(t) = P * g + c * (g - 1) / r        with g = (1 + r) ^ t

for contributions at the end of a period; start-of-period contributions earn one
period more, and r = 0 leaves P + c * t.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Compounding periods per year.
PERIODS_PER_YEAR = {"daily": 252, "monthly": 12, "yearly": 1}
# Contributions per year by contribution frequency.
CONTRIBUTIONS_PER_YEAR = {"monthly": 12, "yearly": 1}
# Contribution timings.
TIMINGS = {"start": 1, "end": 0}


#: Pieces of a schedule for each output partition; with fewer, chance would deal the rows out unevenly.
PIECES = 32
#: Fewest periods of a piece.
SHORTEST = 64


def project_balances(
    accounts: DataFrame, carry: Sequence[str] = (), partitions: int | None = None
) -> DataFrame:
    """One row per account and period.

    Accounts are cut into ranges of periods, and these are dealt out evenly before they
    become rows, so that no task gets a long account whole and one input file is no one task:
    the ranges' length follows from the number of all periods.  ``partitions`` is the number of
    tasks, by default as many as run at once.  ``carry`` names account columns to keep, such as the goal.  An
    unknown compounding, frequency or timing and NULL years fail the query; an account whose
    horizon rounds to no period has no rows.
    """
    return _schedule(accounts, carry, partitions).select(*_SCHEDULE_COLUMNS, *carry)


def project_real_balances(
    accounts: DataFrame, carry: Sequence[str] = (), partitions: int | None = None
) -> DataFrame:
    """The schedule with inflation-adjusted balance and running totals."""
    return _schedule(accounts, carry, partitions).select(
        *_SCHEDULE_COLUMNS,
        F.expr(_real("end_balance", "period")).alias("real_end_balance"),
        _paid_in().alias("total_contrib"),
        _earned().alias("total_interest"),
        *carry,
    )


def time_to_goal(
    schedule: DataFrame, goal: Column | float, use_real: bool = False
) -> DataFrame:
    """Year in which each account of a schedule first reaches the goal; NULL if it never does.

    ``goal`` is a number or a column carried by the schedule.  For accounts, ``goal_years`` tells
    the same without their schedules.
    """
    balance = "real_end_balance" if use_real else "end_balance"
    reached = F.when(F.col(balance) >= goal, F.col("year"))
    return schedule.groupBy("account_key").agg(F.min(reached).alias("goal_year"))


def goal_years(accounts: DataFrame, goal: Column | float, use_real: bool = False) -> DataFrame:
    """Year in which each account first reaches the goal; NULL if it never does within its horizon.

    ``goal`` is a number or a column of the accounts.  No schedule is made: the first period is found on the
    closed form, row by row, without a shuffle.
    """
    terms = _terms(accounts.withColumn("goal", F.lit(goal)), ["goal"])
    return terms.select("account_key", _goal_year(use_real).alias("goal_year"))


def projection_summary(
    accounts: DataFrame, goal: Column | float, use_real: bool = False
) -> DataFrame:
    """Final balances, totals and the year the goal is reached, per account.

    ``goal`` is a number or a column of the accounts.  All values follow from the closed form; nothing is
    fanned out or shuffled.
    """
    terms = _terms(accounts.withColumn("goal", F.lit(goal)), ["goal"])
    return _with_balances(terms.withColumn("period", F.col("periods"))).select(
        "account_key",
        F.col("end_balance").alias("final_nominal"),
        F.expr(_real("end_balance", "period")).alias("final_real"),
        _paid_in().alias("total_contrib"),
        _earned().alias("total_interest"),
        _goal_year(use_real).alias("goal_year"),
    )


_SCHEDULE_COLUMNS = [
    "account_key",
    "period",
    "year",
    "start_balance",
    "interest",
    "contribution",
    "end_balance",
]


def _paid_in() -> Column:
    return F.col("contribution") * F.col("period")


def _earned() -> Column:
    return F.col("end_balance") - F.col("principal") - _paid_in()


def _schedule(
    accounts: DataFrame, carry: Sequence[str], partitions: int | None
) -> DataFrame:
    terms = _terms(accounts, carry)
    if partitions is None:
        partitions = accounts.sparkSession.sparkContext.defaultParallelism
    per_year = _option("compounding", PERIODS_PER_YEAR, strict=False)
    # what is wrong with an account is told where its rows are made
    total = accounts.agg(F.sum(F.greatest(F.bround(F.col("years") * per_year), F.lit(0.0)))).scalar()
    size = F.greatest(F.ceil(F.coalesce(total, F.lit(0.0)) / (PIECES * partitions)), F.lit(SHORTEST)).cast("int")
    pieces = F.explode(F.sequence(F.lit(0), F.floor((F.col("periods") - 1) / size).cast("int")))
    first = F.col("piece") * F.col("size") + 1
    last = F.least(F.col("periods"), F.col("piece") * F.col("size") + F.col("size"))
    cut = terms.withColumn("size", size).withColumn("piece", pieces)
    # rows are dealt in turn: of pieces of like size every task gets as many
    dealt = cut.select(*terms.columns, first.alias("first"), last.alias("last")).repartition(partitions)
    return _with_balances(dealt.withColumn("period", F.explode(F.sequence("first", "last"))))


def _terms(accounts: DataFrame, carry: Sequence[str]) -> DataFrame:
    """Each account's parameters per period."""
    per_year = _option("compounding", PERIODS_PER_YEAR)
    paid_per_year = F.col("contribution") * _option("contrib_frequency", CONTRIBUTIONS_PER_YEAR)
    no_horizon = F.raise_error(F.lit("years must not be NULL")).cast("int")
    periods = F.bround(F.col("years") * per_year).cast("int")
    return accounts.select(
        "account_key",
        "principal",
        per_year.alias("per_year"),
        F.when(F.col("years").isNull(), no_horizon).otherwise(periods).alias("periods"),
        _per_period(F.col("annual_return"), per_year).alias("rate"),
        _per_period(F.col("inflation"), per_year).alias("inflation_rate"),
        (paid_per_year / per_year).alias("contribution"),
        _option("contribution_timing", TIMINGS).alias("upfront"),
        *carry,
    ).where(F.col("periods") >= 1)


def _with_balances(terms: DataFrame) -> DataFrame:
    """Balances of the period that each row names."""
    return (
        terms.withColumn("year", F.col("period") / F.col("per_year"))
        .withColumn("start_balance", F.expr(_opening("period")))
        .withColumn("interest", F.expr(_interest("start_balance")))
        .withColumn("end_balance", F.expr("start_balance + contribution + interest"))
    )


# The formulas are written as SQL: the search for a goal uses them many times over, and one text is one call to Spark.


def _opening(period: str) -> str:
    """Balance before a period.

    (growth - 1) / rate loses its digits at small rates, hence expm1; a rate of -1 or less has no logarithm.
    """
    return f"""(case when rate = 0 then principal + contribution * ({period} - 1)
        else principal * power(1 + rate, {period} - 1) + contribution * (1 + upfront * rate) * (
            case when rate > -1 then expm1(({period} - 1) * log1p(rate)) / rate
            else (power(1 + rate, {period} - 1) - 1) / rate end) end)"""


def _interest(opening: str) -> str:
    return f"(({opening} + upfront * contribution) * rate)"


def _real(balance: str, period: str) -> str:
    return f"({balance} / power(1 + inflation_rate, {period}))"


def _reached(period: str, use_real: bool) -> str:
    """Whether the balance after a period, as the schedule has it, is at least the goal."""
    opening = _opening(period)
    balance = f"({opening} + contribution + {_interest(opening)})"
    return f"({_real(balance, period) if use_real else balance} >= goal)"


def _goal_year(use_real: bool) -> Column:
    """First year in which the balance of an account (see ``_terms``) is at least its goal.

    A balance after t periods is a sum of two exponentials of t: a nominal one rises or falls all the way, a real one has
    one peak or trough at most.  Where a base is negative (a loss of more than everything a year) the signs
    alternate, and every period is tried.
    """
    period = f"""case when rate < -1 {"or inflation_rate <= -1" if use_real else ""}
        then array_min(filter(sequence(1, periods), t -> {_reached("t", use_real)}))
        else {_first_real() if use_real else _first_nominal()} end"""
    return F.expr(period) / F.col("per_year")


def _first_nominal() -> str:
    """The inverse of the nominal balance, by logarithm, held against the balances around it.

    A curve that hardly rises has no sharp inverse, and is searched.
    """
    first_gain = "(principal * rate + contribution * (1 + upfront * rate))"
    wanted = f"((goal - principal) / nullif({first_gain}, 0))"
    inverse = f"""case when rate = 0 then {wanted}
        when rate > -1 and rate * {wanted} > -1 then log1p(rate * {wanted}) / log1p(rate) end"""
    # beyond the horizon it is out of reach anyhow
    guess = f"cast(ceil(least(greatest({inverse}, 1), periods + 1)) as int)"
    near = [f"least(greatest({guess} + {step}, 1), periods)" for step in (-1, 0, 1)]
    return f"""case when {_reached("1", False)} then 1
        when {_reached("periods", False)} is not true then null
        when {_reached(near[0], False)} then {_bisected("1", near[0], False)}
        when {_reached(near[1], False)} then {near[1]}
        when {_reached(near[2], False)} then {near[2]}
        else {_bisected("1", "periods", False)} end"""


def _first_real() -> str:
    """The first period on either side of the peak or trough of the real balance, or beside it."""
    prices = "nullif(log1p(inflation_rate), 0)"
    per_payment = "(principal / nullif(contribution * (1 + upfront * rate), 0))"
    both = f"(log1p(rate * {per_payment}) + log1p(-log1p(rate) / {prices}))"
    turn = f"case when rate = 0 then 1 / {prices} - {per_payment} when rate > -1 then -{both} / log1p(rate) end"
    # without a turning point any place will do
    at = f"cast(floor(least(greatest(coalesce(nanvl({turn}, 1), 1), 1), periods)) as int)"
    near = [f"least(greatest({at} + {step}, 1), periods)" for step in (-1, 0, 1, 2)]
    return f"""case when {_reached("1", True)} then 1
        when {_reached(near[0], True)} then {_bisected("1", near[0], True)}
        when {_reached(near[1], True)} then {near[1]}
        when {_reached(near[2], True)} then {near[2]}
        when {_reached(near[3], True)} then {near[3]}
        when {_reached("periods", True)} then {_bisected(near[3], "periods", True)} end"""


def _bisected(low: str, high: str, use_real: bool) -> str:
    """First period of a range, on which the balance rises, that reaches the goal; the last one does, the first one does not."""
    middle = "cast(floor((range.low + range.high) / 2) as int)"
    return f"""aggregate(
        sequence(1, cast(ceil(log2(greatest({high} - {low}, 1))) as int) + 1),
        named_struct('low', {low}, 'high', {high}),
        (range, _) -> if({_reached(middle, use_real)},
            named_struct('low', range.low, 'high', {middle}), named_struct('low', {middle}, 'high', range.high)),
        range -> range.high)"""


def _option(name: str, values: dict[str, int], strict: bool = True) -> Column:
    """Look a parameter up; any other value fails the query, or is NULL if not ``strict``."""
    allowed = ", ".join(values)
    chosen = F.lit(None).cast("int")
    if strict:
        chosen = F.raise_error(F.lit(f"{name} must be one of: {allowed}")).cast("int")
    for value, number in values.items():
        chosen = F.when(F.col(name) == value, F.lit(number)).otherwise(chosen)
    return chosen


def _per_period(annual: Column, per_year: Column) -> Column:
    return F.pow(1 + annual, F.lit(1.0) / per_year) - 1
