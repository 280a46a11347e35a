"""Queries on ordered readings: deduplication, numbering, ranks, neighbours, running values."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.columns import day_of, exact_mean, round_half_up, rounded_mean
from tidemark.operators import windows as W
from tidemark.operators.joins import join_current, join_dim
from tidemark.operators.modeling import build_dim_date
from tidemark.operators.sorting import sort_sql, top_k, top_k_by, union_all
from tidemark.operators.aggregates import table_counts
from tidemark.plans.bindings import (
    HOURLY, LOCATED, READINGS, SITE_HISTORY, TABLES, exact_sql, hourly, located, mean_sql, newest_first,
    readings, site_history, table,
)
from tidemark.plans.registry import Family
from tidemark.sources.files import days_covered

FAMILY = Family()
query = FAMILY.query

BY_TIME = ["ts", "event_id"]


@query("latest_per_key", f"""WITH {READINGS}
SELECT sensor, slot, event_id, ts, value, code FROM (
  SELECT *, row_number() OVER (PARTITION BY sensor, slot ORDER BY ts DESC, event_id DESC) AS rn
  FROM readings WHERE code >= 10) WHERE rn = 1""")
def latest_per_key(spark, sf_dir):
    """Rows failing the condition do not compete, as with a NULL measure filtered before ranking."""
    raw = readings(spark, sf_dir)
    kept = W.latest_per_key(raw, ["sensor", "slot"], newest_first(), F.col("code") >= 10)
    return kept.select("sensor", "slot", "event_id", "ts", "value", "code")


@query("latest_per_user_hour", f"""WITH {READINGS}
SELECT user_id, slot, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, slot ORDER BY ts DESC, event_id DESC) AS rn
  FROM readings) WHERE rn = 1""")
def latest_per_user_hour(spark, sf_dir):
    kept = W.latest_per_key(readings(spark, sf_dir), ["user_id", "slot"], newest_first())
    return kept.select("user_id", "slot", "event_id", "value")


@query("number_rows", f"""WITH {READINGS}
SELECT sensor, event_id, ts, value, row_number() OVER (PARTITION BY sensor ORDER BY ts, event_id) AS reading_number
FROM readings""")
def number_rows(spark, sf_dir):
    raw = readings(spark, sf_dir).select("sensor", "event_id", "ts", "value")
    return W.number_rows(raw, ["sensor"], BY_TIME, "reading_number")


@query("top_hour_per_day", f"""WITH {HOURLY}
SELECT sensor, CAST(slot AS DATE) AS day, hour(slot)::INTEGER AS hour_of_day, value AS peak_value FROM (
  SELECT *, row_number() OVER (PARTITION BY sensor, CAST(slot AS DATE) ORDER BY value DESC, slot) AS rk FROM hourly)
WHERE rk = 1""")
def top_hour_per_day(spark, sf_dir):
    rows = hourly(spark, sf_dir).withColumn("day", day_of("slot"))
    top = W.top_k_per_group(rows, ["sensor", "day"], [F.col("value").desc_nulls_last(), "slot"])
    return top.select("sensor", "day", F.hour("slot").alias("hour_of_day"), F.col("value").alias("peak_value"))


@query("rank_within_hour", f"""WITH {HOURLY}
SELECT sensor, slot, value, rank() OVER (PARTITION BY slot ORDER BY value DESC) AS value_rank,
  dense_rank() OVER (PARTITION BY slot ORDER BY value DESC) AS value_dense_rank
FROM hourly""")
def rank_within_hour(spark, sf_dir):
    """An hour has one row per sensor here."""
    rows = hourly(spark, sf_dir).select("sensor", "slot", "value")
    return W.rank_within(rows, ["slot"], "value", rank_name="value_rank", dense_name="value_dense_rank")


@query("rank_codes_with_ties", f"""WITH {READINGS}
SELECT event_id, sensor, code, rank() OVER (PARTITION BY sensor, CAST(ts AS DATE) ORDER BY code DESC) AS code_rank,
  dense_rank() OVER (PARTITION BY sensor, CAST(ts AS DATE) ORDER BY code DESC) AS code_dense_rank
FROM readings""")
def rank_codes_with_ties(spark, sf_dir):
    rows = readings(spark, sf_dir).select("event_id", "sensor", "code", day_of("ts").alias("day"))
    ranked = W.rank_within(rows, ["sensor", "day"], "code", rank_name="code_rank", dense_name="code_dense_rank")
    return ranked.drop("day")


_DAILY = f"""daily AS (
  SELECT sensor, CAST(ts AS DATE) AS day, {mean_sql('value')} AS daily_mean, max(value) AS max_value,
         min(value) AS min_value, {exact_sql('value')} AS exact_mean
  FROM readings WHERE value IS NOT NULL GROUP BY ALL)"""


def _daily(spark, sf_dir):
    return readings(spark, sf_dir).where("value is not null").groupBy("sensor", day_of("ts").alias("day")).agg(
        rounded_mean("value", scale=2).alias("daily_mean"), F.max("value").alias("max_value"),
        F.min("value").alias("min_value"), exact_mean("value", scale=2).alias("exact_mean"),
    )


@query("top_days_per_sensor", f"""WITH {READINGS}, {_DAILY}
SELECT sensor, day, daily_mean, max_value, min_value, day_rank FROM (
  SELECT *, rank() OVER (PARTITION BY sensor ORDER BY daily_mean DESC) AS day_rank FROM daily)
WHERE day_rank <= 3""")
def top_days_per_sensor(spark, sf_dir):
    """A chain of steps: enrich, summarise per day, rank, keep the first three with ties."""
    top = W.top_k_per_group(_daily(spark, sf_dir), ["sensor"], [F.col("daily_mean").desc_nulls_last()], 3, "rank",
                            "day_rank")
    return top.select("sensor", "day", "daily_mean", "max_value", "min_value",
                      F.col("day_rank").cast("long").alias("day_rank"))


@query("rank_sites_overall", f"""WITH {LOCATED}, {SITE_HISTORY}
SELECT site_name, country, round(m + 1e-9, 2) AS mean_value, dense_rank() OVER (ORDER BY m DESC) AS site_rank FROM (
  SELECT site_name, country, {exact_sql('value')} AS m
  FROM located JOIN site_history USING (site_nk) WHERE is_current GROUP BY ALL)""")
def rank_sites_overall(spark, sf_dir):
    joined = join_current(located(spark, sf_dir), site_history(spark, sf_dir), {"site_nk": "site_nk"})
    ranked = W.rank_groups(joined, ["site_name", "country"], exact_mean("value", scale=2), "m", "site_rank")
    return ranked.select("site_name", "country", round_half_up("m").alias("mean_value"), "site_rank")


@query("delta_to_previous", f"""WITH {HOURLY}
SELECT sensor, slot, value, lag(value) OVER w AS previous_value, round(value - lag(value) OVER w + 1e-9, 2) AS change
FROM hourly WINDOW w AS (PARTITION BY sensor ORDER BY slot)""")
def delta_to_previous(spark, sf_dir):
    rows = hourly(spark, sf_dir).select("sensor", "slot", "value")
    with_delta = W.delta_prev(rows, ["sensor"], ["slot"], "value", "previous_value", "change")
    return with_delta.withColumn("change", round_half_up("change"))


@query("day_over_day", f"""WITH {READINGS}, {_DAILY}
SELECT sensor, day, daily_mean, round(exact_mean - lag(exact_mean) OVER (PARTITION BY sensor ORDER BY day) + 1e-9, 2) AS change
FROM daily""")
def day_over_day(spark, sf_dir):
    rows = W.period_over_period(_daily(spark, sf_dir), ["sensor"], "day", "exact_mean")
    return rows.select("sensor", "day", "daily_mean", "change")


_EARLIER = "(PARTITION BY sensor ORDER BY ts, event_id ROWS BETWEEN {} PRECEDING AND CURRENT ROW)"


@query("running_mean", f"""WITH {READINGS}
SELECT event_id, sensor, value,
  {mean_sql('value', ' OVER ' + _EARLIER.format('UNBOUNDED'))} AS running_mean FROM readings""")
def running_mean(spark, sf_dir):
    rows = readings(spark, sf_dir).select("event_id", "sensor", "ts", "value")
    return W.running_mean(rows, ["sensor"], BY_TIME, "value", "running_mean", scale=2).drop("ts")


@query("moving_mean", f"""WITH {READINGS}
SELECT event_id, sensor, value, {mean_sql('value', ' OVER ' + _EARLIER.format('2'))} AS moving_mean
FROM readings""")
def moving_mean(spark, sf_dir):
    rows = readings(spark, sf_dir).select("event_id", "sensor", "ts", "value")
    return W.moving_mean(rows, ["sensor"], BY_TIME, "value", 3, "moving_mean", scale=2).drop("ts")


@query("moving_mean_of_sevenths", f"""WITH {READINGS}
SELECT event_id, round(avg(value / 7) OVER {_EARLIER.format('2')}, 6) AS moving_mean FROM readings""")
def moving_mean_of_sevenths(spark, sf_dir):
    """A measure without a fixed number of decimals."""
    rows = readings(spark, sf_dir).select("event_id", "sensor", "ts", (F.col("value") / 7).alias("seventh"))
    return W.moving_mean(rows, ["sensor"], BY_TIME, "seventh", 3, "moving_mean", 6).select("event_id", "moving_mean")


@query("running_max", f"""WITH {READINGS}
SELECT event_id, sensor, max(value) OVER w AS highest_so_far, min(value) OVER w AS lowest_so_far,
  count(value) OVER w AS readings_so_far
FROM readings WINDOW w AS {_EARLIER.format('UNBOUNDED')}""")
def running_max(spark, sf_dir):
    rows = readings(spark, sf_dir).select("event_id", "sensor", "ts", "value")
    return W.running(rows, ["sensor"], BY_TIME, {
        "highest_so_far": ("max", "value"), "lowest_so_far": ("min", "value"), "readings_so_far": ("count", "value"),
    }).select("event_id", "sensor", "highest_so_far", "lowest_so_far", "readings_so_far")


_WEEK = "round(CAST(sum(CAST(exact_mean AS DECIMAL(18,6))) OVER w AS DOUBLE) / count(exact_mean) OVER w + 1e-9, 2)"


@query("rolling_seven_rows", f"""WITH {READINGS}, {_DAILY}
SELECT sensor, day, daily_mean, {_WEEK} AS rolling_mean
FROM daily WINDOW w AS (PARTITION BY sensor ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
def rolling_seven_rows(spark, sf_dir):
    rows = W.rolling_periods(_daily(spark, sf_dir), ["sensor"], "day", "exact_mean", 7, "rolling_mean", scale=6)
    return rows.select("sensor", "day", "daily_mean", "rolling_mean")


@query("rolling_seven_days", f"""WITH {READINGS}, daily AS (
  SELECT user_id, CAST(ts AS DATE) AS day, {exact_sql('value')} AS exact_mean FROM readings GROUP BY ALL)
SELECT user_id, day, {_WEEK} AS rolling_mean
FROM daily WINDOW w AS (PARTITION BY user_id ORDER BY day
  RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW)""")
def rolling_seven_days(spark, sf_dir):
    """Calendar days instead of rows: users have days without readings."""
    days = readings(spark, sf_dir).groupBy("user_id", day_of("ts").alias("day")).agg(
        exact_mean("value", scale=2).alias("exact_mean"))
    rows = W.rolling_periods(days, ["user_id"], "day", "exact_mean", 7, "rolling_mean", mode="days", scale=6)
    return rows.select("user_id", "day", "rolling_mean")


@query("running_max_of_days", f"""WITH {READINGS}, {_DAILY}
SELECT sensor, day, max(daily_mean) OVER (PARTITION BY sensor ORDER BY day
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_max
FROM daily""")
def running_max_of_days(spark, sf_dir):
    rows = W.running(_daily(spark, sf_dir), ["sensor"], ["day"], {"running_max": ("max", "daily_mean")})
    return rows.select("sensor", "day", "running_max")


@query("first_and_peak_of_day", f"""WITH {READINGS}
SELECT event_id, sensor, value,
  first_value(value) OVER (PARTITION BY sensor, CAST(ts AS DATE) ORDER BY ts, event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS first_of_day,
  max(value) OVER (PARTITION BY sensor, CAST(ts AS DATE)) AS peak_of_day
FROM readings""")
def first_and_peak_of_day(spark, sf_dir):
    """Both group values from one aggregate."""
    rows = readings(spark, sf_dir).select("event_id", "sensor", "ts", "value", day_of("ts").alias("day"))
    return W.group_stat(rows, ["sensor", "day"], {
        "first_of_day": F.min_by("value", F.struct(*BY_TIME)), "peak_of_day": F.max("value"),
    }).drop("ts", "day")


@query("first_in_group", f"""WITH {READINGS}
SELECT event_id, user_id, first_value(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS first_value
FROM readings""")
def first_in_group(spark, sf_dir):
    rows = readings(spark, sf_dir).select("event_id", "user_id", "ts", "value")
    return W.first_in_group(rows, ["user_id"], BY_TIME, "value", "first_value").select(
        "event_id", "user_id", "first_value")


@query("group_peak", f"""WITH {READINGS}
SELECT event_id, sensor, max(value) OVER (PARTITION BY sensor, slot) AS hour_peak,
  count(*) OVER (PARTITION BY sensor, slot) AS hour_rows FROM readings""")
def group_peak(spark, sf_dir):
    rows = readings(spark, sf_dir).select("event_id", "sensor", "slot", "value")
    return W.group_stat(rows, ["sensor", "slot"], {
        "hour_peak": F.max("value"), "hour_rows": F.count(F.lit(1)),
    }).drop("slot", "value")


_SITE_DAYS = f"""site_days AS (
  SELECT site_nk, CAST(ts AS DATE) AS full_date, sensor, {mean_sql('value')} AS mean_value, max(value) AS max_value,
         count(*) AS n_readings
  FROM located GROUP BY ALL)"""


@query("daily_rank_of_sites", f"""WITH {LOCATED}, {SITE_HISTORY}, {_SITE_DAYS}
SELECT full_date, strftime(full_date, '%a') AS day_of_week, site_name, sensor, mean_value, max_value, n_readings,
  rank() OVER (PARTITION BY full_date ORDER BY mean_value DESC) AS daily_rank
FROM site_days JOIN site_history USING (site_nk) WHERE is_current""")
def daily_rank_of_sites(spark, sf_dir):
    """Summary first, then the dimensions, then the rank within the day.

    A day holds one row per site and sensor by then.
    """
    rows = located(spark, sf_dir)
    daily = rows.groupBy("site_nk", day_of("ts").alias("day"), "sensor").agg(
        rounded_mean("value", scale=2).alias("mean_value"), F.max("value").alias("max_value"),
        F.count(F.lit(1)).alias("n_readings"),
    )
    calendar = build_dim_date(days_covered(rows, "ts")).select("full_date", "day_of_week")
    star = join_dim(join_current(daily, site_history(spark, sf_dir), {"site_nk": "site_nk"}), calendar,
                    {"day": "full_date"})
    ranked = W.rank_within(star, ["day"], "mean_value", rank_name="daily_rank")
    return ranked.select(F.col("day").alias("full_date"), "day_of_week", "site_name", "sensor", "mean_value",
                         "max_value", "n_readings", "daily_rank")


@query("trend_report", f"""WITH {READINGS}, {_DAILY}
SELECT sensor, day, daily_mean, rank() OVER (PARTITION BY sensor ORDER BY exact_mean DESC) AS day_rank,
  round(max(exact_mean) OVER (PARTITION BY sensor ORDER BY day ROWS UNBOUNDED PRECEDING) + 1e-9, 2) AS running_max,
  round(exact_mean - lag(exact_mean) OVER (PARTITION BY sensor ORDER BY day) + 1e-9, 2) AS change
FROM daily""")
def trend_report(spark, sf_dir):
    rows = W.trend_report(_daily(spark, sf_dir), ["sensor"], "day", "exact_mean", "day_rank", "running_max", "change")
    return rows.select("sensor", "day", "daily_mean", "day_rank",
                       round_half_up("running_max").alias("running_max"), "change")


@query("deviation_top", f"""WITH {READINGS}, {_DAILY}
SELECT r.event_id, r.sensor, r.ts, r.value, round(d.exact_mean + 1e-9, 2) AS daily_avg,
  round(r.value - d.exact_mean + 1e-9, 2) AS deviation
FROM readings r JOIN daily d ON r.sensor = d.sensor AND CAST(r.ts AS DATE) = d.day
WHERE abs(r.value - d.exact_mean) > 2 ORDER BY abs(r.value - d.exact_mean) DESC, r.event_id LIMIT 20""")
def deviation_top(spark, sf_dir):
    """The twenty readings furthest from their sensor's daily mean."""
    rows = readings(spark, sf_dir).select("event_id", "sensor", "ts", "value", day_of("ts").alias("day"))
    far = W.deviation_from_group(rows, ["sensor", "day"], "value", scale=2).where(F.abs("deviation") > 2)
    top = top_k_by(far, 20, F.abs("deviation"), "event_id")
    return top.select("event_id", "sensor", "ts", "value", round_half_up("group_mean").alias("daily_avg"),
                      round_half_up("deviation").alias("deviation"))


@query("deviation_all", f"""WITH {READINGS}
SELECT r.event_id, round(d.m + 1e-9, 2) AS hour_mean, round(d.s, 6) AS hour_stddev, round(r.value - d.m + 1e-9, 2) AS deviation
FROM readings r JOIN (SELECT sensor, slot, {exact_sql('value')} AS m, stddev_samp(value) AS s
  FROM readings GROUP BY ALL) d USING (sensor, slot) WHERE abs(r.value - d.m) > 2""")
def deviation_all(spark, sf_dir):
    rows = readings(spark, sf_dir).select("event_id", "sensor", "slot", "value")
    far = W.deviation_from_group(rows, ["sensor", "slot"], "value", stddev_name="s", scale=2).where(F.abs("deviation") > 2)
    return far.select("event_id", round_half_up("group_mean").alias("hour_mean"),
                      F.round("s", 6).alias("hour_stddev"), round_half_up("deviation").alias("deviation"))


# --- sorts, limits, unions ------------------------------------------------------------


@query("sorted_daily_means", f"""WITH {READINGS}, {_DAILY}
SELECT day, sensor, daily_mean FROM daily ORDER BY day, daily_mean DESC""")
def sorted_daily_means(spark, sf_dir):
    return sort_sql(_daily(spark, sf_dir).select("day", "sensor", "daily_mean"), "day", "-daily_mean")


@query("top_orders", """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
ORDER BY o_totalprice DESC, o_orderkey LIMIT 25""")
def top_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return top_k(orders, 25, "-o_totalprice", "o_orderkey")


@query("first_readings_with_context", f"""WITH {LOCATED}, {SITE_HISTORY}
SELECT ts, event_id, site_name, country, strftime(ts, '%a') AS day_of_week, value, code
FROM located JOIN site_history USING (site_nk) WHERE is_current ORDER BY ts, event_id LIMIT 20""")
def first_readings_with_context(spark, sf_dir):
    """A sorted limit on a star join."""
    rows = located(spark, sf_dir)
    calendar = build_dim_date(days_covered(rows, "ts")).select("full_date", "day_of_week")
    star = join_dim(
        join_current(rows.withColumn("day", day_of("ts")), site_history(spark, sf_dir), {"site_nk": "site_nk"}),
        calendar, {"day": "full_date"})
    return top_k(star.select("ts", "event_id", "site_name", "country", "day_of_week", "value", "code"), 20,
                 "ts", "event_id")


@query("row_limit", """SELECT count(*) AS n_rows, count(DISTINCT event_id) AS n_ids FROM
(SELECT event_id FROM events LIMIT 1000)""")
def row_limit(spark, sf_dir):
    """Any thousand rows; only their number is determined."""
    rows = table(spark, sf_dir, "events").select("event_id").limit(1000)
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("event_id").alias("n_ids"))


@query("union_of_spenders", """SELECT CAST(c_custkey AS BIGINT) AS party, 'customer' AS kind, c_acctbal AS balance FROM customer
UNION ALL SELECT s_suppkey, 'supplier', s_acctbal FROM supplier""")
def union_of_spenders(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("party"), F.lit("customer").alias("kind"), F.col("c_acctbal").alias("balance"))
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("party"), F.lit("supplier").alias("kind"), F.col("s_acctbal").alias("balance"))
    return union_all(customers, suppliers)


@query("table_row_counts", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES))
def table_row_counts(spark, sf_dir):
    return table_counts({t: table(spark, sf_dir, t) for t in TABLES})
