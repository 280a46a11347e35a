"""Streaming forms of the loads: each run takes what is new, then stops.

The checkpoint holds the offset of the change feed, so a run without new files
starts no batch and adds no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.columns import date_key, fixed_sum, rounded_ratio
from tidemark.operators.committed import CommittedTable, read_committed
from tidemark.operators.groups import written
from tidemark.operators.modeling import step_seconds
from tidemark.operators.mutations import merged
from tidemark.operators.windows import latest_per_key


def landing_stream(spark: SparkSession, path: str, schema: T.StructType,
                   max_files: int | None = None) -> DataFrame:
    """New files of a parquet folder as they land."""
    reader = spark.readStream.schema(schema).option("latestFirst", "false")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def run_available(query) -> StreamingQuery:
    """Start a stream writer, work off what is there and wait for the end."""
    started = query.trigger(availableNow=True).start()
    started.awaitTermination()
    return started


def stream_fact_load(changes: DataFrame, dim: DataFrame, natural: dict[str, str], dim_key: str, ts: str,
                     measures: Sequence[str], out: str, checkpoint: str) -> StreamingQuery:
    """Append new readings with their dimension keys to a fact table, each exactly once."""
    (left, right), = natural.items()
    current = dim.where("is_current").select(F.col(right).alias("__nk"), dim_key)
    fact = changes.join(current, changes[left] == F.col("__nk")).select(
        dim_key, date_key(ts).alias("date_sk"), ts, *measures
    )
    writer = fact.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    return run_available(writer.outputMode("append"))


def event_time(ts: str) -> Column:
    """The instant whose UTC clock shows the zone-less timestamp.

    A watermark needs an instant, and windows align to UTC days and hours: this
    way they align to the timestamp's own, whatever the session zone.
    """
    return F.from_utc_timestamp(F.col(ts).cast("timestamp"), F.current_timezone())


def clock_time(at: Column) -> Column:
    """Back from such an instant to the zone-less timestamp."""
    return F.to_utc_timestamp(at, F.current_timezone()).cast("timestamp_ntz")


def stream_daily_summary(changes: DataFrame, keys: Sequence[str], ts: str, value: str, delay: str,
                         out: str, checkpoint: str, scale: int | None = None) -> StreamingQuery:
    """Daily mean and count per key, refreshed as readings arrive.

    ``scale`` is the number of decimals of the measure, if it is known; its sum
    is then exact. The summary is a committed table by day: a batch replaces
    its rows in the days it changed, all at once, so a batch that runs again
    after a failure changes nothing and no former versions pile up.
    """
    daily = (
        changes.withColumn("__at", event_time(ts))
        .withWatermark("__at", delay)
        .groupBy(*keys, F.window("__at", "1 day").alias("__w"))
        .agg(
            fixed_sum(value, scale).alias("__sum"), F.count(value).alias("__cnt"), F.count(F.lit(1)).alias("row_count")
        )
        .select(
            *keys,
            F.to_date(clock_time(F.col("__w")["start"])).alias("summary_date"),
            rounded_ratio(F.col("__sum"), F.col("__cnt")).alias("daily_mean"),
            "row_count",
        )
    )

    def store(batch: DataFrame, batch_id: int) -> None:
        table = CommittedTable(batch.sparkSession, out, ["summary_date"])
        if table.exists():
            batch = written(batch, "summary-batch")
            touched = table.slots(batch)
            if not touched:  # the watermark moved, no day did
                return
            batch = merged(table.read(touched), batch, [*keys, "summary_date"])
        table.replace(batch)

    writer = daily.writeStream.outputMode("update").foreachBatch(store).option("checkpointLocation", checkpoint)
    return run_available(writer)


def stored_summary(spark: SparkSession, out: str) -> DataFrame:
    """The stored summary as of the newest batch."""
    return read_committed(spark, out)


def stream_set_aside_late(changes: DataFrame, ts: str, delay: str, out: str, checkpoint: str,
                          slot: str = "1 hour") -> StreamingQuery:
    """Every arriving row, marked whether it came too late, in one committed table by ``late`` and ``load_day``.

    A row is late if its time slot had closed before its batch began: the slot
    ends at or before the newest time of all earlier batches, less ``delay``.
    ``lag_seconds`` says by how much; it is NULL for rows on time, to which rows
    without a time belong. A batch is committed with its number, so a batch that
    runs again is not stored twice; on time and late together are all rows.
    """
    micros = 1_000_000
    width, allowed = step_seconds(slot) * micros, step_seconds(delay) * micros

    def store(batch: DataFrame, batch_id: int) -> None:
        table = CommittedTable(batch.sparkSession, out, ["late", "load_day"])
        notes = table.commit().notes
        if notes.get("batches", {}).get(checkpoint, -1) >= batch_id:
            return
        at = F.unix_micros(event_time(ts))
        newest, seen = notes.get("newest"), batch.agg(F.max(at)).first()[0]
        behind = F.lit(None).cast("bigint") if newest is None else F.lit(newest - allowed) - at
        closes = (F.floor(at / width) + 1) * width
        late = F.lit(False) if newest is None else F.coalesce(closes <= newest - allowed, F.lit(False))
        marked = batch.withColumns({"late": late, "load_day": F.to_date(ts)})
        lag = F.when(F.col("late"), F.floor(behind / micros).cast("bigint"))
        known = [n for n in (newest, seen) if n is not None]
        table.replace(marked.withColumn("lag_seconds", lag), append=True, notes={
            "newest": max(known, default=None), "batches": {**notes.get("batches", {}), checkpoint: batch_id}})

    writer = changes.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return run_available(writer)


def stream_keep_first(changes: DataFrame, keys: Sequence[str], ts: str, order: Sequence[str],
                      payload: Sequence[str], delay: str, out: str, checkpoint: str,
                      slot: str = "1 hour") -> StreamingQuery:
    """The first reading per key and time slot, stored once the slot has closed.

    Written as a minimum per group rather than as row-wise deduplication: copies
    are combined before the shuffle, and which row is kept does not depend on
    arrival. Rows behind the watermark are dropped.
    """
    at = changes.withColumn("__at", event_time(ts)).withWatermark("__at", delay)
    first = at.groupBy(*keys, F.window("__at", slot).alias("__w")).agg(
        F.min_by(F.struct(*payload), F.struct(*order)).alias("__row")
    )
    rows = first.select(*keys, clock_time(F.col("__w")["start"]).alias("slot"), "__row.*")
    writer = rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    return run_available(writer.outputMode("append"))


def stream_drop_copies(changes: DataFrame, keys: Sequence[str], ts: str, delay: str, out: str,
                       checkpoint: str) -> StreamingQuery:
    """Rows without later copies of the same keys, passed on as they arrive.

    A key is remembered until the watermark has passed it by ``delay``.
    """
    rows = (
        changes.withColumn("__at", event_time(ts))
        .withWatermark("__at", delay)
        .dropDuplicatesWithinWatermark(list(keys))
        .drop("__at")
    )
    writer = rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    return run_available(writer.outputMode("append"))


def stream_keep_latest(changes: DataFrame, keys: Sequence[str], order: Sequence[Column], day: Column,
                       out: str, checkpoint: str) -> StreamingQuery:
    """A committed table by day holding the latest row per key, updated batch by batch.

    Within a batch copies are reduced first; then only the days the batch falls
    on are rewritten, all of them or none. The newer of stored and arriving row wins, so running a
    batch again changes nothing.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        table = CommittedTable(batch.sparkSession, out, ["load_day"])
        fresh = latest_per_key(batch.withColumn("load_day", day), keys, order)
        if table.exists():
            fresh = written(fresh, "keep-latest")
            touched = table.slots(fresh)
            fresh = latest_per_key(table.read(touched).unionByName(fresh), keys, order)
        table.replace(fresh)

    writer = changes.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return run_available(writer)
