"""Data-quality checks.

A check finds failing rows; none means it passes. Checks on single rows, the
row count or the newest time of a table share one aggregate pass. Checks on
groups share one grouping where the keys of one lie within those of another.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.functions.columns import blank_to_null


@dataclass(frozen=True)
class Check:
    """A named check, of one kind.

    A row condition; bounds of the row count; a test of the newest value of a
    column; failures counted from the table's groups by ``keys`` or finer ones,
    each with its ``n_rows``; or a frame of failing rows.
    """

    name: str
    severity: str = "error"
    row_fails: Column | None = None
    count_fails: tuple[int | None, int | None] | None = None
    newest_fails: tuple[str, Callable[[Column], Column]] | None = None
    keys: tuple[str, ...] = ()
    group_failures: Callable[[DataFrame], DataFrame] | None = None
    failing: DataFrame | None = None

    def warn_only(self) -> "Check":
        return replace(self, severity="warn")


# --- failing rows --------------------------------------------------------------------


def duplicates(df: DataFrame, columns: Sequence[str], count_name: str = "n_rows") -> DataFrame:
    """Values that occur more than once, those with a NULL left out for one column."""
    source = df.where(F.col(columns[0]).isNotNull()) if len(columns) == 1 else df
    return source.groupBy(*columns).agg(F.count(F.lit(1)).alias(count_name)).where(F.col(count_name) > 1)


def orphans(df: DataFrame, column: str, to: DataFrame, field: str) -> DataFrame:
    """Rows whose non-NULL reference has no match."""
    known = to.select(F.col(field).alias("__known")).distinct()
    return df.where(F.col(column).isNotNull()).join(known, F.col(column) == F.col("__known"), "left_anti")


def stale_members(df: DataFrame, key: str, ts: str, as_of: str, days: int, name: str = "latest") -> DataFrame:
    """Members whose newest date is more than ``days`` before ``as_of``."""
    limit = F.date_sub(F.lit(as_of).cast("date"), days)
    return df.groupBy(key).agg(F.max(F.to_date(ts)).alias(name)).where(F.col(name) < limit)


def age_hours(at: Column, as_of: str) -> Column:
    return (F.unix_micros(F.lit(as_of).cast("timestamp")) - F.unix_micros(at.cast("timestamp"))) / F.lit(3600e6)


def age_status(at: Column, as_of: str, warn_hours: int, error_hours: int) -> Column:
    """Whether a newest time passes, warns or fails; none at all fails."""
    age = age_hours(at, as_of)
    return F.when(at.isNull() | (age > error_hours), "error").when(age > warn_hours, "warn").otherwise("pass")


def freshness(df: DataFrame, column: str, as_of: str, warn_hours: int, error_hours: int) -> DataFrame:
    """Age of the newest row and whether it passes, warns or fails; no rows fail."""
    latest = df.agg(F.max(column).alias("latest"))
    return latest.withColumns({
        "age_hours": F.round(age_hours(F.col("latest"), as_of), 2),
        "status": age_status(F.col("latest"), as_of, warn_hours, error_hours),
    })


def out_of_range(column: str, low: float, high: float, row_condition: Column | None = None) -> Column:
    """True outside the inclusive range; a NULL value fails unless the condition excludes it."""
    outside = ~F.coalesce(F.col(column).between(low, high), F.lit(False))
    return outside if row_condition is None else F.coalesce(row_condition, F.lit(False)) & outside


# --- check specifications ----------------------------------------------------------------


def not_null(column: str) -> Check:
    return Check(f"not_null_{column}", row_fails=F.col(column).isNull())


def accepted_values(column: str, values: Sequence) -> Check:
    return Check(f"accepted_values_{column}", row_fails=~F.col(column).isin(*values))


def between(column: str, low: float, high: float, row_condition: Column | None = None,
            name: str | None = None) -> Check:
    """Values within the bounds; name checks with the same bounds and other row conditions apart."""
    return Check(name or f"between_{column}_{low}_{high}", row_fails=out_of_range(column, low, high, row_condition))


def row_count_between(low: int | None, high: int | None) -> Check:
    return Check(f"row_count_between_{low}_{high}", count_fails=(low, high))


def no_row(name: str, condition: Column) -> Check:
    """No row meets the condition."""
    return Check(name, row_fails=condition)


def singular(name: str, failing: DataFrame) -> Check:
    return Check(name, failing=failing)


def unique(column: str) -> Check:
    return _distinct(f"unique_{column}", [column])


def unique_combination(columns: Sequence[str]) -> Check:
    return _distinct(f"unique_combination_{'_'.join(columns)}", columns)


def _distinct(name: str, columns: Sequence[str]) -> Check:
    """Fails per repeated value, a NULL left out for one column."""
    counts = F.col("n_rows") > 1
    if len(columns) == 1:
        counts = counts & F.col(columns[0]).isNotNull()

    def failures(groups: DataFrame) -> DataFrame:
        if set(groups.columns) != {*columns, "n_rows"}:
            groups = groups.groupBy(*columns).agg(F.sum("n_rows").alias("n_rows"))
        return groups.agg(F.count_if(counts).alias("failures"))

    return Check(name, keys=tuple(columns), group_failures=failures)


def relationships(column: str, to: DataFrame, field: str) -> Check:
    """Fails per row whose non-NULL reference has no match."""
    known = to.select(F.col(field).alias("__known")).distinct().withColumn("__found", F.lit(True))

    def failures(groups: DataFrame) -> DataFrame:
        # an outer join, and NULLs left out last: an anti join or a filter would reach below the groups, so that
        # every row were joined and other checks could not share them
        matched = groups.join(known, F.col(column) == F.col("__known"), "left")
        lost = F.col(column).isNotNull() & F.col("__found").isNull()
        return matched.agg(F.coalesce(F.sum(F.when(lost, F.col("n_rows"))), F.lit(0)).cast("long").alias("failures"))

    return Check(f"relationships_{column}", keys=(column,), group_failures=failures)


def missing_members(column: str, expected: DataFrame) -> Check:
    """Fails per distinct member of ``expected`` (its first column) without a row."""
    wanted = expected.select(F.col(expected.columns[0]).alias("__expected")).distinct().where(
        F.col("__expected").isNotNull())

    def failures(groups: DataFrame) -> DataFrame:
        # both conditions keep the groups as the other checks read them
        seen = groups.where(F.col("n_rows") > 0)
        absent = wanted.join(seen, F.col("__expected").eqNullSafe(F.col(column)), "left_anti")
        return absent.agg(F.count(F.lit(1)).alias("failures"))

    return Check(f"missing_members_{column}", keys=(column,), group_failures=failures)


def is_fresh(column: str, as_of: str, warn_hours: int, error_hours: int, severity: str = "error") -> Check:
    """Fails as an error past ``error_hours``, or as a warning past ``warn_hours``."""
    level = ["error"] if severity == "error" else ["warn", "error"]
    return Check(f"freshness_{column}_{severity}", severity=severity, newest_fails=(
        column, lambda at: age_status(at, as_of, warn_hours, error_hours).isin(level)))


# --- running -------------------------------------------------------------------------------


def _measure(check: Check) -> Column | None:
    """The aggregate of the whole table that a check needs, None for one on groups or other rows."""
    if check.row_fails is not None:
        return F.count_if(F.coalesce(check.row_fails, F.lit(False)))
    if check.count_fails is not None:
        return F.count(F.lit(1))
    if check.newest_fails is not None:
        return F.max(check.newest_fails[0])
    return None


def _failures(check: Check, measured: Column) -> Column:
    if check.row_fails is not None:
        return measured
    if check.newest_fails is not None:
        fails = check.newest_fails[1](measured)
    else:
        low, high = check.count_fails
        fails = F.lit(False) if low is None else measured < low
        fails = fails if high is None else fails | (measured > high)
    return F.when(fails, 1).otherwise(0).cast("long")


def write_measured(df: DataFrame, path: str, checks: Sequence[Check]) -> dict[str, object]:
    """Write ``df`` as Parquet; what its row, count and age checks measured meanwhile, by name.

    The rows are observed in the stage that writes them, so each is counted
    once, whichever tasks are run again. Where Spark leaves the observation out,
    as it may for a frame known to be empty, nothing is measured.
    """
    measures = {c.name: m for c in checks if (m := _measure(c)) is not None}
    if not measures:
        df.write.parquet(path)
        return {}
    seen = Observation()
    names = [f"m{i}" for i in range(len(measures))]
    df.observe(seen, *[m.alias(n) for n, m in zip(names, measures.values())]).write.parquet(path)
    found = seen.get
    return {name: found[n] for n, name in zip(names, measures) if n in found}


def run_checks(df: DataFrame, checks: Sequence[Check], measured: dict[str, object] | None = None) -> DataFrame:
    """One row per check: ``check, severity, failures, status``.

    Reads the table once for all row, count and age checks and once per set of
    keys that lies within no other; checks on the same groups use one shuffle.
    ``measured`` has what ``write_measured`` saw of this very table; if it holds
    all those checks, they need no read. Two checks of one name are refused; no
    checks give no rows.
    """
    names = [c.name for c in checks]
    repeated = sorted({n for n in names if names.count(n) > 1})
    if repeated:
        raise ValueError(f"several checks are named {repeated}")
    parts = []
    measures = {f"__m{i}": m for i, c in enumerate(checks) if (m := _measure(c)) is not None}
    if measures:
        entries = [
            F.struct(F.lit(c.name).alias("check"), F.lit(c.severity).alias("severity"),
                     _failures(c, F.col(f"__m{i}")).alias("failures"))
            for i, c in enumerate(checks) if f"__m{i}" in measures
        ]
        totals = df.agg(*[m.alias(n) for n, m in measures.items()])
        wanted = [checks[int(n[3:])].name for n in measures]
        if measured and measured.keys() >= set(wanted):
            totals = df.sparkSession.createDataFrame([tuple(measured[n] for n in wanted)], totals.schema)
        parts.append(totals.select(F.inline(F.array(*entries))))
    for c in checks:
        if c.group_failures is not None:
            # the most keys that hold this check's own; the shuffle of equal groups is planned once
            keys = max((o.keys for o in checks if set(c.keys) <= set(o.keys)), key=lambda k: (len(k), k))
            counted = c.group_failures(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")))
        elif c.failing is not None:
            counted = c.failing.agg(F.count(F.lit(1)).alias("failures"))
        else:
            continue
        parts.append(counted.select(F.lit(c.name).alias("check"), F.lit(c.severity).alias("severity"), "failures"))
    if not parts:
        return df.sparkSession.createDataFrame([], "check string, severity string, failures bigint, status string")
    results = reduce(DataFrame.unionByName, parts)
    return results.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise(
        F.when(F.col("severity") == "warn", "warn").otherwise("fail")
    ))


class ChecksFailed(Exception):
    """Raised with one line per failed check."""


def gate(results: DataFrame) -> None:
    """Raise when a check of error severity failed; one result row per check is read."""
    failed = results.where(F.col("status") == "fail").orderBy("check").collect()
    if failed:
        raise ChecksFailed("\n".join(f"[FAIL] {r['check']}: {r['failures']} failing rows" for r in failed))


def summarise_failures(results: DataFrame, text_limit: int = 200) -> DataFrame:
    """Failed entries of run-result documents (``results: array<struct<unique_id, status, message>>``)."""
    entry = F.col("entry")
    message = F.substring(F.coalesce(blank_to_null(entry["message"], [""]), F.lit("")), 1, text_limit)
    header = F.concat(F.lit("["), F.upper(entry["status"]), F.lit("] "),
                      F.coalesce(entry["unique_id"], F.lit("unknown")))
    return (
        results.select(F.explode("results").alias("entry"))
        .where(entry["status"].isin("error", "fail"))
        .select(
            F.coalesce(entry["unique_id"], F.lit("unknown")).alias("unique_id"),
            entry["status"].alias("status"),
            message.alias("message"),
            F.when(message == "", header).otherwise(F.concat(header, F.lit(": "), message)).alias("line"),
        )
    )
