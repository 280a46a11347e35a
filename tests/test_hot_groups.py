"""The path for groups too large for a task gives the same rows as the plain window."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import groups as G
from tidemark.operators import windows as W
from tidemark.operators.modeling import assign_keys


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows in one key, a NULL key, NULL values and tied values."""
    rng = random.Random(7)
    start = datetime(2024, 1, 1)
    data = []
    for i in range(240):
        key = "hot" if i % 3 == 0 else (None if i % 11 == 0 else rng.choice("abcde"))
        value = None if i % 13 == 0 else round(rng.choice([1.25, 2.5, 7.75, rng.random() * 100]), 2)
        data.append((i, key, start + timedelta(minutes=rng.randrange(300)), value))
    return spark.createDataFrame(data, "id int, key string, ts timestamp_ntz, value double").repartition(5).cache()


BY_TIME = ["ts", "id"]


def days(df):
    """Rows spread over days with gaps, several a day, some without one."""
    return df.withColumn("day", F.when(F.col("id") % 17 != 0, F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int") * 5 % 300)))


def both(spark, build):
    spark.conf.unset("spark.tidemark.maxGroupRows")
    plain = rows(build())
    spark.conf.set("spark.tidemark.maxGroupRows", "7")
    try:
        split = rows(build())
    finally:
        spark.conf.unset("spark.tidemark.maxGroupRows")
    return plain, split


@pytest.mark.parametrize("build", [
    lambda df: W.number_rows(df, ["key"], BY_TIME, "n"),
    lambda df: W.number_rows(df, [], BY_TIME, "n"),
    lambda df: W.running(df, ["key"], BY_TIME, {
        "s": ("sum", F.col("value").cast("decimal(18,2)")), "c": ("count", "value"), "hi": ("max", "value"),
        "lo": ("min", "value")}).withColumn("s", F.col("s").cast("double")),
    lambda df: W.running_mean(df, ["key"], BY_TIME, "value", "m", scale=2),
    lambda df: W.moving_mean(df, ["key"], BY_TIME, "value", 3, "m"),
    lambda df: W.moving_mean(df, ["key"], BY_TIME, "value", 20, "m", scale=2),
    lambda df: W.moving_mean(df.withColumn("v", F.col("value") / 7), ["key"], BY_TIME, "v", 20, "m", 12),
    lambda df: W.delta_prev(df, ["key"], BY_TIME, "value"),
    lambda df: W.delta_prev(df, ["key"], BY_TIME, "value", n=5),
    lambda df: W.rank_within(df, ["key"], "value", dense_name="dense"),
    lambda df: W.rank_within(df, ["key"], "value", ascending=True, dense_name="dense"),
    lambda df: W.rank_groups(df, ["ts"], F.count("value"), "n"),
    lambda df: W.number_rows(df, ["key"], [F.col("value").desc_nulls_last(), F.col("id").desc()], "n"),
    lambda df: W.rolling_periods(days(df), ["key"], "id", "value", 5, "m"),
    lambda df: W.rolling_periods(days(df), ["key"], "day", "value", 7, "m", mode="days", scale=2),
    lambda df: W.rolling_periods(days(df), ["key"], "day", "value", 30, "m", mode="days", digits=6),
    lambda df: W.period_over_period(days(df), ["key"], "id", "value"),
    lambda df: W.trend_report(days(df), ["key"], "id", "value"),
])
def test_split_equals_plain(spark, skewed, build):
    plain, split = both(spark, lambda: build(skewed))
    assert len(plain) in (240, skewed.select("ts").distinct().count())
    assert plain == split


def test_parts_are_bounded(spark, skewed, small_groups):
    parts = G.split_by_range(skewed, ["key"], BY_TIME)
    largest = parts.groupBy("key", G.PART).count().agg(F.max("count")).first()[0]
    assert parts.count() == 240
    assert largest < 30  # the hot key has 80 rows


def test_small_groups_are_not_split(spark, skewed):
    assert G.split_by_range(skewed, ["key"], BY_TIME) is None


def test_vouched_groups_are_not_measured(spark, skewed, small_groups):
    assert G.split_by_range(skewed, ["key"], BY_TIME, fits=True) is None


def test_keys_continue_after_the_highest(spark, frame, small_groups):
    existing = frame([(3, "x"), (9, "y")], "sk long, name string")
    new = frame([(f"n{i:02d}",) for i in range(20)], "name string")
    assert rows(assign_keys(new, existing, ["name"], "sk"), "sk", "name") == sorted(
        [(10 + i, f"n{i:02d}") for i in range(20)], key=repr)


def test_empty_input(spark, frame, small_groups):
    empty = frame([], "key string, ts timestamp_ntz, id int, value double")
    assert W.number_rows(empty, ["key"], BY_TIME).count() == 0
    assert W.running_mean(empty, ["key"], BY_TIME, "value", "m", scale=2).count() == 0


def test_a_tied_order_value_is_split(spark):
    from tidemark.operators.groups import PART, split_by_range

    rows = spark.range(4000).select(F.lit("a").alias("key"), F.lit(1).alias("at"), "id")
    spark.conf.set("spark.tidemark.maxGroupRows", "200")
    try:
        largest = split_by_range(rows, ["key"], ["at"]).groupBy(PART).count().agg(F.max("count")).first()[0]
    finally:
        spark.conf.unset("spark.tidemark.maxGroupRows")
    assert largest <= 400


def test_running_sums_of_doubles_are_refused(spark):
    rows = spark.range(3).select(F.lit("a").alias("key"), "id", F.lit(0.1).alias("v"))
    with pytest.raises(TypeError):
        W.running(rows, ["key"], ["id"], {"s": ("sum", "v")})
