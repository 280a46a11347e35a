"""Dimensions, facts, the daily serving mart and the gap report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import (
    bucket, date_key, day_of, is_weekend, iso_week, rounded_mean, short_day_name, short_month_name,
    surrogate_key, weekday_number,
)
from tidemark.operators.joins import SLOT, join_current, join_dim, join_on_time_bucket, lookup_key, rows_absent
from tidemark.operators.windows import number_rows

# Air quality limits (strictly above) and labels.
AIR_QUALITY_CUTS = [(75.0, "Unhealthy"), (35.0, "Moderate")]
AIR_QUALITY_DEFAULT = "Good"


def assign_keys(new: DataFrame, existing: DataFrame, natural: Sequence[str], key: str) -> DataFrame:
    """New rows numbered on from the highest existing key, in natural-key order."""
    highest = existing.agg(F.max(key)).first()[0] or 0
    numbered = number_rows(new, [], [F.col(c) for c in natural], key)
    return numbered.withColumn(key, F.col(key) + F.lit(int(highest)))


def with_surrogate_key(df: DataFrame, names: Sequence[str], key: str) -> DataFrame:
    return df.withColumn(key, surrogate_key(df, names))


def build_dim(seed: DataFrame, natural: Sequence[str], attributes: Sequence[str], key: str) -> DataFrame:
    """Dimension with a hash key over its natural key."""
    return seed.select(surrogate_key(seed, natural).alias(key), *natural, *attributes)


def build_dim_date(days: DataFrame, day: str = "day") -> DataFrame:
    """Calendar attributes for a frame of days."""
    d = F.col(day)
    return days.select(
        date_key(d).alias("date_sk"),
        d.alias("full_date"),
        short_day_name(d).alias("day_of_week"),
        weekday_number(d).alias("day_num"),
        iso_week(d).alias("week_of_year"),
        F.month(d).alias("month_num"),
        short_month_name(d).alias("month_name"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
        is_weekend(d).alias("is_weekend"),
    )


def build_junk_dim(df: DataFrame, flags: dict[str, Column], key: str) -> DataFrame:
    """Distinct combinations of low-cardinality flags, each with a hash key."""
    combinations = df.select(*[c.alias(n) for n, c in flags.items()]).distinct()
    return combinations.select(surrogate_key(combinations, list(flags)).alias(key), *flags)


def build_fact(raw: DataFrame, dim: DataFrame, codes: DataFrame, *, natural: dict[str, str], dim_key: str,
               code: dict[str, str], code_key: str, default_code: int, ts: str, required: str,
               measures: Sequence[str]) -> DataFrame:
    """Raw readings with their dimension keys; unknown codes get the default."""
    readings = raw.where(F.col(required).isNotNull())
    keyed = join_current(readings, dim, natural)
    coded = lookup_key(keyed, codes, code, code_key, default_code, name=f"{code_key}_found")
    return coded.select(
        dim_key, date_key(ts).alias("date_sk"), F.col(f"{code_key}_found").alias(code_key), ts, *measures
    )


def insert_missing(target: DataFrame, source: DataFrame, on: Sequence[str], null_aware: bool = False) -> DataFrame:
    """The target with the source rows whose key it lacks."""
    fresh = rows_absent(source, target, {k: k for k in on}, null_aware)
    return target.unionByName(fresh, allowMissingColumns=True)


def serving_mart(fact: DataFrame, second: DataFrame, dim: DataFrame | None, *, key: str, name: str, ts: str,
                 reading_key: str, means: dict[str, str], peak: str, second_means: dict[str, str],
                 graded: str, count_name: str, label_name: str, scale: int | None = None) -> DataFrame:
    """One wide row per member and day from two hourly facts.

    Driven from the first fact: a member that only the second one has does not
    appear, and a day without second readings falls into the default label.
    ``scale`` is the number of decimals of the averaged measures, if it is known.
    Facts of ``stored_by_slot`` join without a shuffle; without ``dim`` the
    first one has the member's ``name`` itself.
    """
    readings = fact if dim is None else join_dim(fact, dim.select(key, name), {key: key})
    slots = [c for c in SLOT if c in second.columns]
    right = second.select(key, F.col(ts).alias("__ts2"), *slots, *second_means.values())
    matched = join_on_time_bucket(readings, right, [key], ts, "__ts2", how="left")
    daily = matched.groupBy(name, day_of(ts).alias("reading_date")).agg(
        *[rounded_mean(c, scale=scale).alias(n) for n, c in means.items()],
        F.max(peak).alias(f"max_{peak}"),
        F.min(peak).alias(f"min_{peak}"),
        *[rounded_mean(c, scale=scale).alias(n) for n, c in second_means.items()],
        F.countDistinct(reading_key).alias(count_name),
    )
    return daily.withColumn(label_name, bucket(graded, AIR_QUALITY_CUTS, AIR_QUALITY_DEFAULT))


_UNIT_SECONDS = {"week": 604_800, "day": 86_400, "hour": 3_600, "minute": 60, "second": 1}


def step_seconds(step: str) -> int:
    """Seconds of a step such as ``'2 hours'``: a whole number of weeks, days, hours, minutes or seconds."""
    count, unit = step.split()
    seconds = int(count) * _UNIT_SECONDS.get(unit.lower().rstrip("s"), 0)
    if seconds <= 0:
        raise ValueError(f"a step is a positive number of weeks, days, hours, minutes or seconds, not {step!r}")
    return seconds


def gap_report(df: DataFrame, key: str, ts: str, start: str, end: str, step: str = "1 day",
               slot_name: str = "slot", status_name: str = "status") -> DataFrame:
    """Every expected slot of every key, marked OK or MISSING.

    Slots begin at ``start`` and every ``step`` after it, up to ``end``; a
    reading belongs to the last slot at or before its time. Steps are whole
    numbers of weeks, days, hours, minutes or seconds; with steps in days slots
    are dates. The slots of a key are generated from its own row and matched by
    equality, so the calendar is never crossed with a table.
    """
    seconds = step_seconds(step)
    slot_type = "date" if step.split()[1].lower().startswith("day") else "timestamp_ntz"
    at = F.col(ts).cast("timestamp_ntz")
    first, last = F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
    behind = (at - first).cast("interval second").cast("bigint")
    number = F.floor(behind / F.lit(seconds))
    slot = (first + F.make_dt_interval(secs=(number * seconds).cast("decimal(18,6)"))).cast(slot_type)
    within = (at >= first) & (at < last + F.make_dt_interval(secs=F.lit(seconds).cast("decimal(18,6)")))
    present = df.where(within).select(F.col(key).alias("__key"), slot.alias("__slot")).distinct()
    slots = F.expr(f"sequence(cast('{start}' as {slot_type}), cast('{end}' as {slot_type}), interval {step})")
    expected = df.select(key).distinct().select(key, F.explode(slots).alias(slot_name))
    match = expected[key].eqNullSafe(present["__key"]) & (expected[slot_name] == present["__slot"])
    return expected.join(present, match, "left").select(
        slot_name, key, F.when(F.col("__slot").isNull(), "MISSING").otherwise("OK").alias(status_name)
    )
