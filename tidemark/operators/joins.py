"""Joins between facts, dimensions and lookups.

No join here carries a broadcast hint: Spark broadcasts a side when its known
or measured size is below ``spark.sql.autoBroadcastJoinThreshold`` and
sort-merges with skew splitting otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import as_column, round_half_up
from tidemark.operators.windows import latest_per_key


def _on(left: DataFrame, right: DataFrame, on: dict[str, str]) -> Column:
    condition = None
    for l, r in on.items():
        match = left[l] == right[r]
        condition = match if condition is None else condition & match
    return condition


def join_dim(fact: DataFrame, dim: DataFrame, on: dict[str, str], how: str = "inner") -> DataFrame:
    """Fact rows with their dimension row; ``on`` maps fact to dimension columns.

    The dimension's key columns are left out when the fact has columns of the
    same name.
    """
    joined = fact.join(dim, _on(fact, dim, on), how)
    for r in set(on.values()) & set(fact.columns):
        joined = joined.drop(dim[r])
    return joined


def join_current(fact: DataFrame, dim: DataFrame, on: dict[str, str], flag: str = "is_current") -> DataFrame:
    """Join to the current version of a dimension that keeps history."""
    return join_dim(fact, dim.where(F.col(flag)).drop(flag), on)


def lookup_key(df: DataFrame, dim: DataFrame, on: dict[str, str], key: str, default: int,
               name: str | None = None) -> DataFrame:
    """Surrogate key from a lookup, or the default when the code is unknown."""
    columns = [F.col(r).alias(f"__l_{r}") for r in on.values()]
    found = dim.select(*columns, F.col(key).alias("__key"))
    joined = df.join(found, _on(df, found, {l: f"__l_{r}" for l, r in on.items()}), "left")
    return joined.withColumn(name or key, F.coalesce("__key", F.lit(default))).drop(
        "__key", *[f"__l_{r}" for r in on.values()]
    )


def coverage_count(dim: DataFrame, fact: DataFrame, on: dict[str, str], name: str = "times_seen") -> DataFrame:
    """Every dimension row with the number of facts that refer to it, zeros kept.

    Facts are counted before the join, so a hot code is one row when it moves.
    """
    counts = fact.groupBy(*on.values()).agg(F.count(F.lit(1)).alias(name))
    counts = counts.withColumnsRenamed({r: f"__f_{r}" for r in on.values()})
    joined = dim.join(counts, _on(dim, counts, {l: f"__f_{r}" for l, r in on.items()}), "left")
    return joined.withColumn(name, F.coalesce(name, F.lit(0).cast("long"))).drop(
        *[f"__f_{r}" for r in on.values()]
    )


# the day and hour of a row's time, where a table is stored by them
SLOT = ("slot_day", "slot_hour")


def with_slot(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumns({SLOT[0]: F.to_date(ts), SLOT[1]: F.hour(ts)})


def stored_by_slot(df: DataFrame, table: str, keys: Sequence[str], ts: str, buckets: int, path: str | None = None) -> DataFrame:
    """``df`` stored as a table bucketed by keys, day and hour of ``ts``, one file per bucket.

    Tables of equal buckets join on keys and time bucket without a shuffle. The
    table lies at ``path``, or in the warehouse.
    """
    by = [*keys, *SLOT]
    laid = with_slot(df, ts).repartition(buckets, *by)
    writer = laid.write.mode("overwrite").bucketBy(buckets, *by).sortBy(*by)
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return df.sparkSession.table(table)


def join_on_time_bucket(left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str,
                        how: str = "inner") -> DataFrame:
    """Join on keys and on the day and hour of two timestamps, an equi-join.

    Sides that both have the columns of ``stored_by_slot`` are joined on those;
    the left one's stay.
    """
    slots = [c for c in SLOT if c in left.columns and c in right.columns]
    if len(slots) < len(SLOT):
        slots = []
    right_renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in [*keys, *slots]})
    if slots:
        conditions = [left[c] == right_renamed[f"__r_{c}"] for c in slots]
    else:
        conditions = [of(left[left_ts]) == of(right_renamed[right_ts]) for of in (F.to_date, F.hour)]
    conditions += [left[k] == right_renamed[f"__r_{k}"] for k in keys]
    return left.join(right_renamed, conditions, how).drop(*[f"__r_{k}" for k in [*keys, *slots]])


def drill_across(first: DataFrame, second: DataFrame, keys: Sequence[str], ts: tuple[str, str],
                 group: Sequence[str | Column], aggs: Sequence[Column]) -> DataFrame:
    """Two facts of one grain joined through their shared keys, then aggregated."""
    return join_on_time_bucket(first, second, keys, *ts).groupBy(*group).agg(*aggs)


def star_join(fact: DataFrame, dims: Sequence[tuple[DataFrame, dict[str, str]]]) -> DataFrame:
    for dim, on in dims:
        fact = join_dim(fact, dim, on)
    return fact


def compare_to_baseline(df: DataFrame, key: str, base: str, ts: str, value: str, order: Sequence[str | Column],
                        base_name: str = "base_value", delta_name: str = "difference") -> DataFrame:
    """Rows of other keys next to the baseline key's value at the same instant.

    The baseline keeps one row per instant, its first by ``order``, so the join
    never multiplies rows.
    """
    baseline = latest_per_key(df.where(F.col(key) == base), [ts], order).select(
        F.col(ts).alias("__ts"), F.col(value).alias(base_name)
    )
    others = df.where(F.col(key) != base)
    joined = others.join(baseline, others[ts] == baseline["__ts"]).drop("__ts")
    return joined.withColumn(delta_name, round_half_up(F.col(value) - F.col(base_name)))


def missing_members(df: DataFrame, column: str, expected: DataFrame) -> DataFrame:
    """Expected values (first column of ``expected``) that never occur."""
    name = expected.columns[0]
    present = df.select(F.col(column).alias("__present")).distinct()
    return expected.join(present, expected[name] == present["__present"], "left_anti")


def rows_absent(source: DataFrame, target: DataFrame, on: dict[str, str], null_aware: bool = False) -> DataFrame:
    """Source rows whose key the target lacks.

    ``null_aware`` follows SQL's NOT IN on one column: a NULL among the target
    keys leaves no rows, and a NULL source key matches nothing unless the target
    is empty. That is decided from one aggregate over the target, so the large
    sides still meet in an ordinary anti-join.
    """
    found = target.select(*[F.col(r).alias(f"__t_{r}") for r in on.values()]).distinct()
    condition = _on(source, found, {l: f"__t_{r}" for l, r in on.items()})
    absent = source.join(found, condition, "left_anti")
    if not null_aware:
        return absent
    if len(on) != 1:
        raise ValueError("null_aware takes one key column")
    (left, right), = on.items()
    seen = target.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(right).isNull()).alias("nulls"),
    ).first()
    if seen["nulls"]:
        return absent.where(F.lit(False))
    return absent.where(F.col(left).isNotNull()) if seen["n"] else absent


def enrich(df: DataFrame, small: DataFrame, on: str) -> DataFrame:
    return df.join(small, on, "left")


def null_safe_changed(pairs: Sequence[tuple[str | Column, str | Column]]) -> Column:
    """True when any pair differs, a NULL counting as a value."""
    changed = F.lit(False)
    for a, b in pairs:
        changed = changed | ~as_column(a).eqNullSafe(as_column(b))
    return changed
