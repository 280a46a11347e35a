"""Grouped summaries. Everything combines map-side before its shuffle.

Means average doubles as they are. Callers whose measure is stored with a known
number of decimals pass it as ``scale``; the sum is then exact, whatever the
order of the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import day_of, fixed_sum, rounded_mean, rounded_ratio


def daily_summary(df: DataFrame, keys: Sequence[str], ts: str, means: dict[str, str],
                  maxima: dict[str, str] | None = None, minima: dict[str, str] | None = None,
                  day_name: str = "day", count_name: str = "row_count", scale: int | None = None) -> DataFrame:
    """Means, extremes and a row count per key and day."""
    aggs = [rounded_mean(c, scale=scale).alias(n) for n, c in means.items()]
    aggs += [F.max(c).alias(n) for n, c in (maxima or {}).items()]
    aggs += [F.min(c).alias(n) for n, c in (minima or {}).items()]
    return df.groupBy(*keys, day_of(ts).alias(day_name)).agg(*aggs, F.count(F.lit(1)).alias(count_name))


def group_corr(daily: DataFrame, keys: Sequence[str], a: str, b: str, name: str = "correlation",
               count_name: str = "days", digits: int = 3) -> DataFrame:
    """Pearson correlation of two per-day measures in each group."""
    return daily.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(count_name), F.round(F.corr(a, b), digits).alias(name)
    )


def exceedance_days(df: DataFrame, keys: Sequence[str], ts: str, value: str, limit: float,
                    day_name: str = "day", peak_name: str = "peak", count_name: str = "hours_above") -> DataFrame:
    """Days on which a limit was exceeded, with the peak and the number of readings above it."""
    return (
        df.where(F.col(value) > limit)
        .groupBy(*keys, day_of(ts).alias(day_name))
        .agg(F.round(F.max(value), 2).alias(peak_name), F.count(F.lit(1)).alias(count_name))
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of each table, one row per table."""
    report = None
    for name, df in tables.items():
        row = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        report = row if report is None else report.unionByName(row)
    return report


QUARTILES = (25, 50, 75)


def profile(df: DataFrame, numeric: Sequence[str], scale: int | None = None, quartiles: bool = False) -> DataFrame:
    """One row per column: type, NULLs and, for numeric columns, spread; a single pass.

    ``quartiles`` adds ``q25_value``, ``q50_value`` and ``q75_value``: values of
    the column whose rank is right to one part in 10,000.
    """
    spread = ["min", "max", "mean", "std"] + [f"q{q}" for q in QUARTILES if quartiles]
    types = dict(df.dtypes)
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for c in df.columns:
        aggs.append(F.count(c).alias(f"n_{c}"))
    for c in numeric:
        aggs += [F.min(c).cast("double").alias(f"min_{c}"), F.max(c).cast("double").alias(f"max_{c}"),
                 rounded_mean(c, scale=scale).alias(f"mean_{c}"), F.round(F.stddev_samp(c), 4).alias(f"std_{c}")]
        aggs += [F.percentile_approx(c, q / 100).cast("double").alias(f"q{q}_{c}") for q in QUARTILES if quartiles]
    row = df.agg(*aggs)
    missing = F.lit(None).cast("double")
    entries = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(types[c]).alias("data_type"),
            F.col("__rows").alias("row_count"),
            (F.col("__rows") - F.col(f"n_{c}")).alias("null_count"),
            *[(F.col(f"{s}_{c}") if c in numeric else missing).alias(f"{s}_value")
              for s in spread],
        )
        for c in df.columns
    ]
    return row.select(F.inline(F.array(*entries)))


# --- subtotals -------------------------------------------------------------------


def _finest(df: DataFrame, keys: Sequence[str], value: str, scale: int | None) -> DataFrame:
    """Sums and counts at the finest grain.

    The grouping sets then expand these few rows instead of every input row.
    """
    return df.groupBy(*keys).agg(
        fixed_sum(value, scale).alias("__sum"), F.count(value).alias("__cnt"), F.count(F.lit(1)).alias("__rows")
    )


def _totals(mean_name: str, count_name: str) -> list[Column]:
    return [
        rounded_ratio(F.sum("__sum"), F.sum("__cnt")).alias(mean_name),
        F.sum("__rows").alias(count_name),
    ]


def rollup_summary(df: DataFrame, keys: Sequence[str], value: str, mean_name: str = "mean",
                   count_name: str = "row_count", labels: dict[str, str] | None = None,
                   scale: int | None = None) -> DataFrame:
    finest = _finest(df, keys, value, scale)
    return _labelled(finest.rollup(*keys), keys, mean_name, count_name, labels)


def cube_summary(df: DataFrame, keys: Sequence[str], value: str, mean_name: str = "mean",
                 count_name: str = "row_count", labels: dict[str, str] | None = None,
                   scale: int | None = None) -> DataFrame:
    finest = _finest(df, keys, value, scale)
    return _labelled(finest.cube(*keys), keys, mean_name, count_name, labels)


def grouping_sets_summary(df: DataFrame, sets: Sequence[Sequence[str]], value: str, mean_name: str = "mean",
                          count_name: str = "row_count", labels: dict[str, str] | None = None,
                          scale: int | None = None) -> DataFrame:
    keys = list(dict.fromkeys(k for s in sets for k in s))
    finest = _finest(df, keys, value, scale)
    grouped = finest.groupingSets([[F.col(k) for k in s] for s in sets], *[F.col(k) for k in keys])
    return _labelled(grouped, keys, mean_name, count_name, labels)


def _labelled(grouped, keys: Sequence[str], mean_name: str, count_name: str,
              labels: dict[str, str] | None) -> DataFrame:
    """Aggregates of a grouping; ``labels`` names the subtotal rows of a key.

    A real NULL key keeps its NULL: only the grouping flag marks a subtotal.
    """
    labels = labels or {}
    flags = [F.grouping(k).alias(f"__g_{k}") for k in labels]
    summary = grouped.agg(*_totals(mean_name, count_name), *flags)
    columns = [
        F.when(F.col(f"__g_{k}") == 1, labels[k]).otherwise(F.col(k).cast("string")).alias(k)
        if k in labels else F.col(k)
        for k in keys
    ]
    return summary.select(*columns, mean_name, count_name)


# --- distinct counts that can be united -------------------------------------------


def daily_sketches(df: DataFrame, keys: Sequence[str], ts: str, value: str, precision: int = 14) -> DataFrame:
    """One sketch of the distinct values per key and day: ``keys, day, sketch``.

    Sketches have a fixed size and can be united over any days later, where
    distinct counts cannot be added up. ``precision`` is the logarithm of the
    number of registers: 14 has a standard error below 1 %.
    """
    return df.where(F.col(value).isNotNull()).groupBy(*keys, day_of(ts).alias("day")).agg(
        F.hll_sketch_agg(value, precision).alias("sketch"))


def united_distinct(sketches: DataFrame, keys: Sequence[str], name: str = "approx_distinct") -> DataFrame:
    """The number of distinct values over all days of the sketches, per key."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name))
