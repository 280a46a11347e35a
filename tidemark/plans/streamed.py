"""Streaming loads run over the whole event table, each compared with its batch answer."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.columns import day_of
from tidemark.operators.committed import read_committed
from tidemark.plans.bindings import SITE_HISTORY, mean_sql, site_history, table
from tidemark.plans.registry import Family
from tidemark.session import scratch_path
from tidemark.streaming import loads as L

FAMILY = Family()
query = FAMILY.query


def _changes(spark, sf_dir):
    """The event table as a feed of new files.

    The path is a pattern because a feed must be a folder or a pattern, while
    the table is one file or a folder of them.
    """
    feed = L.landing_stream(spark, f"{sf_dir}/events.parque[t]", table(spark, sf_dir, "events").schema)
    return feed.withColumn("site_nk", (F.col("user_id") % 25).cast("int"))


# The feed of a month: its two halves, then a tenth of the first half arriving last.
_MIDDLE = "2024-01-16"
_LATE = f"(ts < TIMESTAMP '{_MIDDLE}' AND event_id % 10 = 0)"


def _arrivals(spark, sf_dir):
    """The events as a landing folder that fills in three steps; yields the feed after each."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "ts")
    first_half, tenth = F.col("ts") < F.lit(_MIDDLE).cast("timestamp_ntz"), F.col("event_id") % 10 == 0
    landing = scratch_path(spark, "landing")
    for step in (first_half & ~tenth, ~first_half, first_half & tenth):
        events.where(step).write.mode("append").parquet(landing)
        yield L.landing_stream(spark, landing, events.schema)


@query("stream_fact_load", f"""WITH {SITE_HISTORY}
SELECT site_sk, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_sk, ts, event_id, value
FROM events JOIN site_history ON user_id % 25 = site_nk WHERE is_current""")
def stream_fact_load(spark, sf_dir):
    """Run twice: the second run finds nothing new and adds no rows."""
    out, checkpoint = scratch_path(spark, "fact"), scratch_path(spark, "offsets")
    for _ in range(2):
        L.stream_fact_load(_changes(spark, sf_dir), site_history(spark, sf_dir), {"site_nk": "site_nk"}, "site_sk", "ts",
                           ["event_id", "value"], out, checkpoint)
    return spark.read.parquet(out)


@query("stream_daily_summary", f"""SELECT event_type, CAST(ts AS DATE) AS summary_date, {mean_sql('value')} AS daily_mean,
  count(*) AS row_count FROM events GROUP BY ALL""")
def stream_daily_summary(spark, sf_dir):
    out = scratch_path(spark, "summary")
    L.stream_daily_summary(_changes(spark, sf_dir), ["event_type"], "ts", "value", "1 hour", out,
                           scratch_path(spark, "offsets"), scale=2)
    return L.stored_summary(spark, out)


@query("stream_keep_first", """SELECT event_type, slot, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type, slot ORDER BY ts, event_id) AS rn
  FROM (SELECT *, date_trunc('hour', ts) AS slot FROM events))
WHERE rn = 1 AND slot + INTERVAL 1 HOUR <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 2 HOUR FROM events)""")
def stream_keep_first(spark, sf_dir):
    """The slots the watermark has closed."""
    out = scratch_path(spark, "first")
    L.stream_keep_first(_changes(spark, sf_dir), ["event_type"], "ts", ["ts", "event_id"], ["event_id", "value"],
                        "2 hours", out, scratch_path(spark, "offsets"))
    return spark.read.parquet(out)


@query("stream_drop_copies", """SELECT event_id, user_id, event_type, value, ts FROM events""")
def stream_drop_copies(spark, sf_dir):
    """The feed joined with a copy of itself comes out once."""
    feed = _changes(spark, sf_dir).select("event_id", "user_id", "event_type", "value", "ts")
    out = scratch_path(spark, "once")
    L.stream_drop_copies(feed.unionByName(feed), ["event_id"], "ts", "1 hour", out, scratch_path(spark, "offsets"))
    return spark.read.parquet(out)


@query("stream_keep_latest", """SELECT user_id, event_type, load_day, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type, load_day ORDER BY ts DESC, event_id DESC) AS rn
  FROM (SELECT *, CAST(ts AS DATE) AS load_day FROM events)) WHERE rn = 1""")
def stream_keep_latest(spark, sf_dir):
    """The latest event per user, type and day; a second feed of the same rows changes nothing."""
    out = scratch_path(spark, "latest")
    for _ in range(2):
        L.stream_keep_latest(
            _changes(spark, sf_dir).select("user_id", "event_type", "event_id", "value", "ts"),
            ["user_id", "event_type", "load_day"], [F.col("ts").desc(), F.col("event_id").desc()], day_of("ts"), out,
            scratch_path(spark, "offsets"))
    return read_committed(spark, out).select("user_id", "event_type", "load_day", "event_id", "value")


@query("stream_first_with_late_rows", f"""WITH seen AS (SELECT *, date_trunc('hour', ts) AS slot FROM events WHERE NOT {_LATE})
SELECT event_type, slot, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type, slot ORDER BY ts, event_id) AS rn FROM seen)
WHERE rn = 1 AND slot + INTERVAL 1 HOUR <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 2 HOUR FROM seen)""")
def stream_first_with_late_rows(spark, sf_dir):
    """Rows behind the watermark come too late: their slots are closed and stored."""
    out, checkpoint = scratch_path(spark, "first"), scratch_path(spark, "offsets")
    for feed in _arrivals(spark, sf_dir):
        L.stream_keep_first(feed, ["event_type"], "ts", ["ts", "event_id"], ["event_id", "value"], "2 hours", out,
                            checkpoint)
    return spark.read.parquet(out)


@query("stream_summary_with_late_rows", f"""SELECT event_type, CAST(ts AS DATE) AS summary_date,
  {mean_sql('value')} AS daily_mean, count(*) AS row_count FROM events WHERE NOT {_LATE} GROUP BY ALL""")
def stream_summary_with_late_rows(spark, sf_dir):
    """A summary kept up over three runs, without the rows that come too late."""
    out, checkpoint = scratch_path(spark, "summary"), scratch_path(spark, "offsets")
    for feed in _arrivals(spark, sf_dir):
        L.stream_daily_summary(feed, ["event_type"], "ts", "value", "1 hour", out, checkpoint, scale=2)
    return L.stored_summary(spark, out)


@query("stream_latest_with_late_rows", """SELECT user_id, event_type, load_day, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type, load_day ORDER BY ts DESC, event_id DESC) AS rn
  FROM (SELECT *, CAST(ts AS DATE) AS load_day FROM events)) WHERE rn = 1""")
def stream_latest_with_late_rows(spark, sf_dir):
    """Keep-latest has no watermark: late rows still enter their days, by the same rule as all rows at once."""
    out, checkpoint = scratch_path(spark, "latest"), scratch_path(spark, "offsets")
    for feed in _arrivals(spark, sf_dir):
        L.stream_keep_latest(feed, ["user_id", "event_type", "load_day"],
                             [F.col("ts").desc(), F.col("event_id").desc()], day_of("ts"), out, checkpoint)
    return read_committed(spark, out).select("user_id", "event_type", "load_day", "event_id", "value")


@query("stream_late_rows", f"""WITH arrivals AS (SELECT *, CASE WHEN {_LATE} THEN 3 WHEN ts < TIMESTAMP '{_MIDDLE}' THEN 1 ELSE 2 END AS step FROM events),
marked AS (SELECT *, (SELECT max(ts) FROM arrivals e WHERE e.step < a.step) - INTERVAL 2 HOUR AS mark FROM arrivals a),
judged AS (SELECT *, coalesce(date_trunc('hour', ts) + INTERVAL 1 HOUR <= mark, FALSE) AS late FROM marked)
SELECT event_id, user_id, event_type, value, ts, late, CAST(ts AS DATE) AS load_day,
  CASE WHEN late THEN CAST(floor((epoch_us(mark) - epoch_us(ts)) / 1000000) AS BIGINT) END AS lag_seconds FROM judged""")
def stream_late_rows(spark, sf_dir):
    """Rows on time and rows too late, all stored: what a watermark would drop is set aside with its lag."""
    out, checkpoint = scratch_path(spark, "arrived"), scratch_path(spark, "offsets")
    for feed in _arrivals(spark, sf_dir):
        L.stream_set_aside_late(feed, "ts", "2 hours", out, checkpoint)
    return read_committed(spark, out)
