"""Changes to stored tables: upserts, soft deletes, history, incremental merges.

The functions named for a change return the resulting table as a frame. The
ones that take a path keep a committed table there (see ``committed``): they
rewrite only the partitions a batch touches, all of them or none.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import as_of_or_now, day_of
from tidemark.operators.committed import CommittedTable, few_files, read_committed
from tidemark.operators.groups import written
from tidemark.operators.joins import rows_absent
from tidemark.operators.windows import latest_per_key


def one_per_key(source: DataFrame, key: Sequence[str], null_safe: bool = False) -> DataFrame:
    """``source``, where running it is an error if a key occurs more than once; NULL keys count with ``null_safe`` only.

    The rows of a key are counted in the plan itself, by the shuffle on the key
    that the join after it needs anyway.
    """
    known = F.lit(True)
    for k in key if not null_safe else ():
        known = known & F.col(k).isNotNull()
    message = F.lit(f"several source rows share a key of {list(key)}; pass an order to choose one")
    counted = source.withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy(*key)))
    once = F.when((F.col("__n") > 1) & known, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return counted.where(once).drop("__n")


def upsert(target: DataFrame, source: DataFrame, on: Sequence[str], changed: Sequence[str],
           set_cols: Sequence[str], only: Column | None = None, insert: bool = True,
           insert_defaults: dict[str, Column] | None = None, null_safe: bool = False,
           order: Sequence[str | Column] | None = None) -> DataFrame:
    """Update matched rows when a ``changed`` column differs, insert unmatched ones.

    ``source`` holds one row per key, or several of which the first by
    ``order`` counts; without ``order`` a repeated key is an error when the
    result is computed, as in MERGE. ``only`` limits which target rows can
    match. A plain comparison with a NULL is not a change; ``null_safe`` makes
    it one. Both sides meet once, in one outer join.
    """
    source = latest_per_key(source, on, order) if order is not None else one_per_key(source, on)
    left = target.withColumn("__in_target", F.lit(True))
    right = source.withColumnsRenamed({c: f"__s_{c}" for c in source.columns}).withColumn("__in_source", F.lit(True))
    condition = F.lit(True) if only is None else only
    for k in on:
        condition = condition & (F.col(k) == F.col(f"__s_{k}"))
    joined = left.join(right, condition, "full" if insert else "left")
    differs = F.lit(False)
    for c in changed:
        s = F.col(f"__s_{c}")
        differs = differs | (~F.col(c).eqNullSafe(s) if null_safe else F.coalesce(F.col(c) != s, F.lit(False)))
    held, found = F.col("__in_target").isNotNull(), F.col("__in_source").isNotNull()
    defaults = insert_defaults or {}

    def value(c: str) -> Column:
        kept = F.when(found & differs, F.col(f"__s_{c}")).otherwise(F.col(c)) if c in set_cols else F.col(c)
        if not insert:
            return kept
        new = defaults[c] if c in defaults else F.col(f"__s_{c}") if c in source.columns else F.lit(None)
        return F.when(held, kept).otherwise(new.cast(target.schema[c].dataType))

    return joined.select(*[value(c).alias(c) for c in target.columns])


def soft_delete(target: DataFrame, keep: DataFrame, key: str, as_of: str | None = None,
                flag: str = "is_current", end: str = "valid_to") -> DataFrame:
    """Close current rows whose key is not in ``keep`` (its first column).

    As with SQL's NOT IN, a row with a NULL key is left alone, and a NULL in the
    keep list closes nothing.
    """
    if not keep.where(F.col(keep.columns[0]).isNull()).isEmpty():
        return target
    kept = keep.select(F.col(keep.columns[0]).alias("__keep")).distinct().withColumn("__kept", F.lit(True))
    joined = target.join(kept, F.col(key) == F.col("__keep"), "left")
    gone = F.col(flag) & F.col(key).isNotNull() & F.col("__kept").isNull()
    return joined.withColumns({
        end: F.when(gone, as_of_or_now(as_of)).otherwise(F.col(end)),
        flag: F.when(gone, F.lit(False)).otherwise(F.col(flag)),
    }).select(*target.columns)


def scd2_snapshot(history: DataFrame, source: DataFrame, key: Sequence[str], check_cols: Sequence[str],
                  as_of: str, close_missing: bool = False,
                  order: Sequence[str | Column] | None = None) -> DataFrame:
    """History after one snapshot of ``source`` at ``as_of``.

    ``source`` holds one row per key, or several of which the first by
    ``order`` is the snapshot; without ``order`` a repeated key, NULL included, is
    an error when the result is computed.
    ``history`` has the source's columns plus ``valid_from``, ``valid_to`` and
    ``is_current``; columns that are not checked are carried along, and a NULL
    ``is_current`` is a closed version. NULL keys match each other. Running the
    same source again changes nothing.
    """
    source = latest_per_key(source, key, order) if order is not None else one_per_key(source, key, null_safe=True)
    instant = F.lit(as_of).cast("timestamp_ntz")
    is_open = F.coalesce(F.col("is_current"), F.lit(False))
    closed = history.where(~is_open)
    current = history.where(is_open).withColumn("__in_history", F.lit(True))
    incoming = source.withColumnsRenamed({c: f"__s_{c}" for c in source.columns}).withColumn("__in_source", F.lit(True))
    condition = F.lit(True)
    for k in key:
        condition = condition & F.col(k).eqNullSafe(F.col(f"__s_{k}"))
    joined = current.join(incoming, condition, "full")
    held, found = F.col("__in_history").isNotNull(), F.col("__in_source").isNotNull()
    differs = F.lit(False)
    for c in check_cols:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"__s_{c}"))
    ends = (found & differs) | (~found & F.lit(close_missing))
    marks = {"valid_from": (F.col("valid_from"), instant),
             "valid_to": (F.when(ends, instant).otherwise(F.col("valid_to")), F.lit(None).cast("timestamp_ntz")),
             "is_current": (~ends, F.lit(True))}

    def version(opened: bool) -> Column:
        return F.struct(*[
            (marks[c][opened] if c in marks
             else F.col(f"__s_{c}") if opened and c in source.columns
             else F.lit(None) if opened
             else F.col(c)).cast(history.schema[c].dataType).alias(c)
            for c in history.columns
        ])

    # the version held, ended or not, and the version a new or changed key opens
    versions = F.array(F.when(held, version(False)), F.when(found & (~held | differs), version(True)))
    return closed.unionByName(joined.select(F.explode(F.array_compact(versions)).alias("v")).select("v.*"))


# --- incremental loads -------------------------------------------------------------


def rows_above_watermark(target: DataFrame, source: DataFrame, ts: str, lookback: str | None = None,
                         day: str | None = None) -> DataFrame:
    """Source rows later than the target's highest timestamp, and those without a time.

    ``lookback`` (an interval such as ``'2 hours'``) lowers the watermark so that
    late rows still enter. An empty target lets everything in. When the target
    is partitioned by ``day``, only its last day is searched.
    """
    if day is not None:
        last_day = last_partition(target, day) or target.agg(F.max(day).cast("string")).first()[0]
        target = target.where(F.col(day) == F.lit(last_day).cast(target.schema[day].dataType))
    highest = target.agg(F.max(ts).cast("string")).first()[0]
    if highest is None:
        return source
    mark = F.lit(highest).cast(target.schema[ts].dataType)
    return source.where(F.col(ts).isNull() | (F.col(ts) > _lowered(mark, lookback)))


def _lowered(mark: Column, lookback: str | None) -> Column:
    return mark - F.expr(f"interval {lookback}") if lookback else mark


MARKS = "marks"


def newest_times(rows: DataFrame, entity: Sequence[str], ts: str, former: DataFrame | None = None) -> DataFrame:
    """The newest time of each entity, from its ``rows`` and from the times stored before."""
    marks = rows.select(*entity, F.col(ts).alias("newest"))
    return (marks if former is None else marks.unionByName(former)).groupBy(*entity).agg(F.max("newest").alias("newest"))


def rows_above_own_watermark(marks: DataFrame, source: DataFrame, entity: Sequence[str], ts: str,
                             lookback: str | None = None) -> DataFrame:
    """Source rows later than the newest time of their own entity, those of new entities and those without a time."""
    named = marks.select(*[F.col(c).alias(f"__e_{c}") for c in entity], F.col("newest").alias("__newest"))
    condition = F.lit(True)
    for c in entity:
        condition = condition & F.col(c).eqNullSafe(F.col(f"__e_{c}"))
    beside = source.join(named, condition, "left")
    above = F.col(ts).isNull() | F.col("__newest").isNull() | (F.col(ts) > _lowered(F.col("__newest"), lookback))
    return beside.where(above).select(*source.columns)


def last_partition(table: DataFrame, day: str) -> str | None:
    """The last date a stored table has a partition for, from its folder names; no file is opened."""
    folder = re.compile(rf"/{re.escape(day)}=(\d{{4}}-\d\d-\d\d)/")
    return max((found[1] for file in table.inputFiles() if (found := folder.search(file))), default=None)


def merged(target: DataFrame, batch: DataFrame, key: Sequence[str]) -> DataFrame:
    """The target with the batch's rows replacing rows of the same key; NULL keys are the same key."""
    arriving = batch.select(*[F.col(k).alias(f"__b_{k}") for k in key])
    condition = F.lit(True)
    for k in key:
        condition = condition & F.col(k).eqNullSafe(F.col(f"__b_{k}"))
    return target.join(arriving, condition, "left_anti").unionByName(batch.select(*target.columns))


def incremental_merge(spark: SparkSession, path: str, source: DataFrame, key: Sequence[str], ts: str,
                      order: Sequence[str | Column], lookback: str | None = None,
                      full_refresh: bool = False, day: str = "load_day",
                      entity: Sequence[str] | None = None, keys_move: bool = True) -> DataFrame:
    """Bring a committed table partitioned by day up to date and return it.

    Each run takes the source rows above the watermark (all of them on a full
    refresh) and those without a time, keeps the first by ``order`` per key,
    merges them with the days they fall on and commits just those days, all at
    once. With ``entity`` every entity has a watermark of its own, kept beside
    the table, so that one which lags behind the others is not skipped. A key
    whose new row falls on another day leaves its former day: an index of key
    hashes and days, stored with the table, says which days to rewrite too.
    ``keys_move=False`` saves the index where the key determines the day.
    """
    table = CommittedTable(spark, path, [day])
    staged = source.withColumn(day, day_of(ts))
    commit = table.commit()
    if full_refresh or not commit.number:
        sides = {MARKS: lambda rows: newest_times(rows, entity, ts)} if entity else None
        table.replace(latest_per_key(staged, key, order), full=True, keys=key if keys_move else (), sides=sides)
        return table.read()
    marks = table.side(MARKS) if entity else None
    if marks is not None:
        news = rows_above_own_watermark(marks, staged, entity, ts, lookback)
    else:
        days = [s for s in commit.live if not s.endswith("__HIVE_DEFAULT_PARTITION__")]
        news = rows_above_watermark(table.read([max(days, default="")]), staged, ts, lookback)
    batch = written(latest_per_key(news, key, order), "merge-batch")
    touched = table.slots(batch)
    if not touched:
        return table.read()
    if commit.keys:
        touched |= table.former_slots(batch)
    sides = {MARKS: lambda rows: newest_times(batch if marks is not None else rows, entity, ts, marks)} if entity else None
    table.replace(merged(table.read(touched), batch, key), clear=touched, sides=sides)
    return table.read()


def replace_partitions(df: DataFrame, path: str, partitions: Sequence[str]) -> None:
    """Replace only the partitions the frame has rows for, all of them or none.

    The table is a committed one; the frame may read what it replaces.
    """
    CommittedTable(df.sparkSession, path, partitions).replace(df)


def refresh_summary(path: str, summary: DataFrame, refreshed_at: str | None = None, mode: str = "append",
                    marker: DataFrame | None = None, day: str = "summary_date") -> None:
    """Store a summary stamped with its refresh time.

    ``append`` keeps every refresh, ``replace`` only the latest one of each day.
    A ``marker`` row is written first, with its missing columns NULL.
    """
    if mode not in ("append", "replace"):
        raise ValueError(f"unknown mode {mode!r}")
    table = CommittedTable(summary.sparkSession, path, [day])
    stamp = as_of_or_now(refreshed_at)
    stamped = summary.withColumn("refreshed_at", stamp)
    if marker is not None:
        marked = marker.withColumn("refreshed_at", stamp)
        columns = [
            F.col(f.name) if f.name in marked.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in stamped.schema.fields
        ]
        table.replace(marked.select(*columns), append=True)
    table.replace(stamped, append=mode == "append")


def newest_refresh(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The latest stored refresh of each summary row."""
    return latest_per_key(table, keys, [F.col("refreshed_at").desc()])
