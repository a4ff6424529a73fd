"""Calendar, ratio and draw expressions."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillwork.functions import month_index, month_start, pct, ratio, seeded_draw, week_start

DAYS = [dt.date(2024, 2, 20) + dt.timedelta(days=i) for i in range(40)]


@pytest.mark.parametrize("datefirst", range(1, 8))
def test_week_start_is_the_last_opening_weekday(spark, datefirst):
    df = spark.createDataFrame([(d,) for d in DAYS], "d date")
    for row in df.select("d", week_start(F.col("d"), datefirst).alias("w")).collect():
        back = (row.d.isoweekday() - datefirst) % 7
        assert row.w == row.d - dt.timedelta(days=back)


def test_week_start_of_a_weekend(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 6, day, 23, 59),) for day in (1, 2, 3)], "t timestamp_ntz"
    )
    monday = [r[0] for r in df.select(week_start(F.col("t"), 1)).collect()]
    sunday = [r[0] for r in df.select(week_start(F.col("t"), 7)).collect()]
    assert monday == [dt.date(2024, 5, 27), dt.date(2024, 5, 27), dt.date(2024, 6, 3)]
    assert sunday == [dt.date(2024, 5, 26), dt.date(2024, 6, 2), dt.date(2024, 6, 2)]


def test_week_start_rejects_unknown_weekday():
    with pytest.raises(ValueError):
        week_start(F.lit(None), 0)


def test_month_index_counts_boundaries(spark):
    pairs = [
        (dt.date(2024, 1, 31), dt.date(2024, 2, 1), 1),
        (dt.date(2023, 12, 15), dt.date(2024, 1, 1), 1),
        (dt.date(2024, 3, 1), dt.date(2024, 3, 31), 0),
        (dt.date(2022, 11, 1), dt.date(2024, 2, 1), 15),
    ]
    df = spark.createDataFrame(pairs, "a date, b date, want int")
    for row in df.withColumn("got", month_index(F.col("a"), F.col("b"))).collect():
        assert row.got == row.want


def test_month_start(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 2, 29, 13),)], "t timestamp_ntz")
    assert df.select(month_start(F.col("t"))).first()[0] == dt.date(2024, 2, 1)


def test_rates_are_exact(spark):
    df = spark.createDataFrame([(23, 4000), (1, 8), (0, 0), (5, 3)], "n long, d long")
    got = [r[0] for r in df.select(pct(F.col("n"), F.col("d"))).collect()]
    assert got == [Decimal("0.58"), Decimal("12.50"), None, Decimal("166.67")]


def test_ratio_rounds_half_up(spark):
    df = spark.createDataFrame([(1, 32)], "n long, d long")
    assert df.select(ratio(F.col("n"), F.col("d"), "decimal(10,4)")).first()[0] == Decimal(
        "0.0313"
    )


def test_draws_do_not_depend_on_partitioning(spark):
    def draws(df):
        rows = df.select("id", seeded_draw(F.col("id"), "x", 3, 100).alias("v")).collect()
        return sorted(map(tuple, rows))

    assert draws(spark.range(500)) == draws(spark.range(500).repartition(13))


def test_draws_are_spread_evenly(spark):
    counts = (
        spark.range(20000)
        .groupBy(seeded_draw(F.col("id"), "x", 3, 10).alias("v"))
        .count()
        .collect()
    )
    assert len(counts) == 10
    assert all(1850 < r["count"] < 2150 for r in counts)
