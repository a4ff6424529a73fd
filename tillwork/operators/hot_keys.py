"""Joins of row-level tables in which a few keys hold a large part of the rows.

Where rows cannot be combined before they meet their details, every row of a key would go to one task.  Here the
frequent keys are found first, by a mergeable sketch in one narrow pass; their rows are dealt out to as many tasks
as their number asks for, and only the details of those few keys are repeated there.  The sketch's error
changes where rows are joined, never what they are joined with.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Keys that the sketch follows, and those of them that may be split; no more can hold that share of the rows.
FOLLOWED, SPLIT = 4000, 500
#: Pieces of a key for each task's fair share of the rows: chance deals many small pieces out evenly.
PIECES = 16


def split_join(
    facts: DataFrame, details: DataFrame, key: str, how: str = "inner", spread_by: Sequence[str] = ()
) -> DataFrame:
    """``facts`` joined with ``details`` on ``key``, the rows of frequent keys in many tasks.

    ``spread_by`` names columns of ``facts`` that tell its rows apart, such as their id; they decide which piece a row
    goes to, so that a task run again deals its rows out alike.  ``details`` that Spark will broadcast are joined
    plainly: no rows move then.
    """
    if how not in ("inner", "left"):
        raise ValueError("only inner and left joins keep what they join when details are repeated")
    if will_broadcast(details):
        return facts.join(details, key, how)
    pieces = _pieces(facts, key)
    row = F.xxhash64(*(spread_by or facts.columns))
    dealt = facts.withColumn("_piece", F.pmod(row, pieces).cast("int"))
    copies = F.sequence(F.lit(0), pieces - 1)
    repeated = details.withColumn("_piece", F.explode(copies))
    return dealt.join(repeated, [key, "_piece"], how).drop("_piece")


def will_broadcast(df: DataFrame) -> bool:
    """Whether the planner takes a table for small enough to send it whole to every executor."""
    # neither the planner's estimate nor the limit in bytes has a public name
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= int(limit)


def _pieces(facts: DataFrame, key: str) -> Column:
    """Number of pieces of each key: 1 but for frequent keys."""
    tasks = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    top = F.call_function("approx_top_k", F.col(key), F.lit(SPLIT), F.lit(FOLLOWED))
    found = facts.where(F.col(key).isNotNull()).agg(top.alias("top"), F.count("*").alias("rows"))
    # a piece is a part of a task's fair share
    share = F.greatest(F.col("rows") / (PIECES * tasks), F.lit(1.0))
    frequent = F.filter("top", lambda x: x["count"] > PIECES * share)
    numbers = F.transform(
        frequent, lambda x: F.struct(x["item"].alias("key"), F.ceil(x["count"] / share).cast("int").alias("pieces"))
    )
    known = found.select(F.map_from_entries(numbers)).scalar()
    return F.coalesce(F.try_element_at(known, F.col(key)), F.lit(1))
