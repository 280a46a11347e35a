"""Grouped summaries: means, subtotals, correlation, distinct counts, profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.columns import bucket, day_of, rounded_mean, short_day_name
from tidemark.operators import aggregates as A
from tidemark.operators.committed import CommittedTable
from tidemark.operators.joins import drill_across, join_current
from tidemark.operators.modeling import AIR_QUALITY_CUTS, AIR_QUALITY_DEFAULT
from tidemark.plans.bindings import (
    HOURLY, LOCATED, READINGS, SITE_FACTS, SITE_HISTORY, hourly, located, mean_sql, readings, site_history,
    site_readings, sites, stored_facts, table,
)
from tidemark.plans.registry import Family
from tidemark.session import scratch_path

FAMILY = Family()
query = FAMILY.query


@query("sensor_means", f"""WITH {READINGS}
SELECT sensor, {mean_sql('value')} AS mean_value, {mean_sql('code')} AS mean_code, max(value) AS max_value,
  min(value) AS min_value, count(*) AS n_readings FROM readings GROUP BY sensor""")
def sensor_means(spark, sf_dir):
    return readings(spark, sf_dir).groupBy("sensor").agg(
        rounded_mean("value", scale=2).alias("mean_value"), rounded_mean("code", scale=2).alias("mean_code"),
        F.max("value").alias("max_value"), F.min("value").alias("min_value"), F.count(F.lit(1)).alias("n_readings"))


@query("daily_summary", f"""WITH {HOURLY}
SELECT sensor, CAST(slot AS DATE) AS reading_date, {mean_sql('value')} AS mean_value, {mean_sql('code')} AS mean_code,
  max(value) AS max_value, min(value) AS min_value, count(*) AS reading_cnt FROM hourly GROUP BY ALL""")
def daily_summary(spark, sf_dir):
    return A.daily_summary(
        hourly(spark, sf_dir), ["sensor"], "slot", {"mean_value": "value", "mean_code": "code"},
        {"max_value": "value"}, {"min_value": "value"}, "reading_date", "reading_cnt", scale=2)


@query("mean_of_any_scale", """SELECT l_returnflag, l_linestatus, round(avg(l_quantity), 4) AS mean_quantity,
  count(*) AS n_lines FROM lineitem GROUP BY ALL""")
def mean_of_any_scale(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        rounded_mean("l_quantity", 4, scale=None).alias("mean_quantity"), F.count(F.lit(1)).alias("n_lines"))


@query("group_by_expression", f"""SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year,
  CAST(quarter(o_orderdate) AS INTEGER) AS order_quarter, {mean_sql('o_totalprice')} AS mean_price, count(*) AS n_orders
FROM orders GROUP BY ALL""")
def group_by_expression(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy(
        F.year("o_orderdate").alias("order_year"), F.quarter("o_orderdate").alias("order_quarter")
    ).agg(rounded_mean("o_totalprice", scale=2).alias("mean_price"), F.count(F.lit(1)).alias("n_orders"))


@query("distinct_beside_aggregates", f"""WITH {READINGS}
SELECT sensor, CAST(ts AS DATE) AS day, count(DISTINCT user_id) AS users, count(DISTINCT slot) AS slots,
  {mean_sql('value')} AS mean_value, count(*) AS n_rows FROM readings GROUP BY ALL""")
def distinct_beside_aggregates(spark, sf_dir):
    return readings(spark, sf_dir).groupBy("sensor", day_of("ts").alias("day")).agg(
        F.countDistinct("user_id").alias("users"), F.countDistinct("slot").alias("slots"),
        rounded_mean("value", scale=2).alias("mean_value"), F.count(F.lit(1)).alias("n_rows"))


@query("global_totals", """SELECT count(*) AS n_rows, max(ts) AS last_ts, min(ts) AS first_ts FROM events""")
def global_totals(spark, sf_dir):
    return table(spark, sf_dir, "events").agg(
        F.count(F.lit(1)).alias("n_rows"), F.max("ts").alias("last_ts"), F.min("ts").alias("first_ts"))


@query("having_count", f"""WITH {READINGS}
SELECT user_id, count(*) AS n_readings, max(CAST(ts AS DATE)) AS last_day FROM readings
GROUP BY user_id HAVING count(*) > 70""")
def having_count(spark, sf_dir):
    counts = readings(spark, sf_dir).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_readings"), F.max(day_of("ts")).alias("last_day"))
    return counts.where("n_readings > 70")


@query("sample_stddev", f"""WITH {READINGS}
SELECT sensor, slot, round(stddev_samp(value), 6) AS sd, count(*) AS n FROM readings GROUP BY ALL""")
def sample_stddev(spark, sf_dir):
    """Groups of one row have no deviation."""
    return readings(spark, sf_dir).groupBy("sensor", "slot").agg(
        F.round(F.stddev_samp("value"), 6).alias("sd"), F.count(F.lit(1)).alias("n"))


@query("site_correlation", f"""WITH {SITE_FACTS}, daily AS (
  SELECT r_name AS site_name, CAST(w.recorded_at AS DATE) AS day, {mean_sql('w.value')} AS mean_first,
         {mean_sql('a.value')} AS mean_second
  FROM first_fact w JOIN second_fact a ON w.site = a.site AND CAST(w.recorded_at AS DATE) = CAST(a.recorded_at AS DATE)
    AND hour(w.recorded_at) = hour(a.recorded_at)
  JOIN region ON w.site = r_regionkey GROUP BY ALL)
SELECT site_name, count(*) AS days, round(corr(mean_first, mean_second), 3) AS correlation
FROM daily GROUP BY site_name HAVING count(*) > 1""")
def site_correlation(spark, sf_dir):
    """Correlation of two facts' daily means: an aggregate of aggregates."""
    first = site_readings(spark, sf_dir, "view").join(sites(spark, sf_dir), "site")
    second = site_readings(spark, sf_dir, "purchase").select(
        "site", F.col("recorded_at").alias("second_at"), F.col("value").alias("second_value"))
    daily = drill_across(
        first, second, ["site"], ("recorded_at", "second_at"), ["site_name", day_of("recorded_at").alias("day")],
        [rounded_mean("value", scale=2).alias("mean_first"), rounded_mean("second_value", scale=2).alias("mean_second")])
    return A.group_corr(daily, ["site_name"], "mean_first", "mean_second").where("days > 1")


_BASE = f"""{LOCATED}, {SITE_HISTORY}, base AS (
  SELECT country, site_name, CAST(ts AS DATE) AS reading_date, value
  FROM located JOIN site_history USING (site_nk) WHERE is_current)"""


def _base(spark, sf_dir):
    joined = join_current(located(spark, sf_dir), site_history(spark, sf_dir), {"site_nk": "site_nk"})
    return joined.select("country", "site_name", day_of("ts").alias("reading_date"), "value")


LABELS = {"site_name": "ALL SITES", "reading_date": "ALL DATES"}
_LABELLED = """CASE WHEN GROUPING(site_name) = 1 THEN 'ALL SITES' ELSE site_name END AS site_name,
  CASE WHEN GROUPING(reading_date) = 1 THEN 'ALL DATES' ELSE CAST(reading_date AS VARCHAR) END AS reading_date"""


@query("rollup_sites", f"""WITH {_BASE}
SELECT country, site_name, reading_date, {mean_sql('value')} AS mean_value, count(*) AS n_readings
FROM base GROUP BY ROLLUP (country, site_name, reading_date)""")
def rollup_sites(spark, sf_dir):
    return A.rollup_summary(_base(spark, sf_dir), ["country", "site_name", "reading_date"], "value", "mean_value",
                            "n_readings", scale=2)


@query("rollup_of_sevenths", f"""WITH {_BASE}
SELECT country, site_name, round(avg(value / 7), 2) AS mean_value, count(*) AS n_readings
FROM base GROUP BY ROLLUP (country, site_name)""")
def rollup_of_sevenths(spark, sf_dir):
    """Means of a measure with no fixed number of decimals."""
    base = _base(spark, sf_dir).withColumn("seventh", F.col("value") / 7)
    return A.rollup_summary(base, ["country", "site_name"], "seventh", "mean_value", "n_readings")


@query("daily_summary_of_sevenths", f"""WITH {HOURLY}
SELECT sensor, CAST(slot AS DATE) AS reading_date, round(avg(value / 7), 2) AS mean_value, count(*) AS reading_cnt
FROM hourly GROUP BY ALL""")
def daily_summary_of_sevenths(spark, sf_dir):
    rows = hourly(spark, sf_dir).withColumn("seventh", F.col("value") / 7)
    return A.daily_summary(rows, ["sensor"], "slot", {"mean_value": "seventh"}, day_name="reading_date", count_name="reading_cnt")


@query("rollup_labelled", f"""WITH {_BASE}
SELECT country, {_LABELLED}, {mean_sql('value')} AS mean_value, count(*) AS n_readings
FROM base GROUP BY ROLLUP (country, base.site_name, base.reading_date)""")
def rollup_labelled(spark, sf_dir):
    return A.rollup_summary(_base(spark, sf_dir), ["country", "site_name", "reading_date"], "value", "mean_value",
                            "n_readings", LABELS, scale=2)


@query("rollup_with_null_key", f"""WITH {READINGS}, base AS (
  SELECT CASE WHEN code % 7 = 0 THEN NULL ELSE sensor END AS sensor, value FROM readings)
SELECT CASE WHEN GROUPING(sensor) = 1 THEN 'ALL' ELSE sensor END AS sensor, {mean_sql('value')} AS mean_value,
  count(*) AS n_readings FROM base GROUP BY ROLLUP (base.sensor)""")
def rollup_with_null_key(spark, sf_dir):
    """A real NULL in the key stays apart from the subtotal."""
    base = readings(spark, sf_dir).select(F.when(F.col("code") % 7 != 0, F.col("sensor")).alias("sensor"), "value")
    return A.rollup_summary(base, ["sensor"], "value", "mean_value", "n_readings", {"sensor": "ALL"}, scale=2)


@query("cube_sites", f"""WITH {_BASE}
SELECT {_LABELLED}, {mean_sql('value')} AS mean_value, count(*) AS n_readings
FROM base GROUP BY CUBE (base.site_name, base.reading_date)""")
def cube_sites(spark, sf_dir):
    return A.cube_summary(_base(spark, sf_dir), ["site_name", "reading_date"], "value", "mean_value", "n_readings",
                          LABELS, scale=2)


@query("grouping_sets_sites", f"""WITH {_BASE}
SELECT {_LABELLED}, {mean_sql('value')} AS mean_value, count(*) AS n_readings
FROM base GROUP BY GROUPING SETS ((base.site_name), (base.reading_date), ())""")
def grouping_sets_sites(spark, sf_dir):
    return A.grouping_sets_summary(_base(spark, sf_dir), [["site_name"], ["reading_date"], []], "value",
                                   "mean_value", "n_readings", LABELS, scale=2)


@query("distinct_members", f"""WITH {LOCATED}
SELECT DISTINCT sensor, site_nk, code FROM located""")
def distinct_members(spark, sf_dir):
    return located(spark, sf_dir).select("sensor", "site_nk", "code").distinct()


@query("exceedance_days", f"""WITH {LOCATED}, {SITE_HISTORY}
SELECT site_name, CAST(ts AS DATE) AS reading_date, round(max(value), 2) AS peak, count(*) AS hours_above
FROM located JOIN site_history USING (site_nk) WHERE is_current AND value > 150 GROUP BY ALL""")
def exceedance_days(spark, sf_dir):
    joined = join_current(located(spark, sf_dir), site_history(spark, sf_dir), {"site_nk": "site_nk"})
    return A.exceedance_days(joined, ["site_name"], "ts", "value", 150, "reading_date")


@query("count_rows_and_values", f"""WITH {READINGS}
SELECT sensor, count(*) AS n_rows, count(CASE WHEN code >= 50 THEN value END) AS n_values,
  {mean_sql('CASE WHEN code >= 50 THEN value END')} AS mean_value FROM readings GROUP BY sensor""")
def count_rows_and_values(spark, sf_dir):
    rows = readings(spark, sf_dir).withColumn("value", F.when(F.col("code") >= 50, F.col("value")))
    return rows.groupBy("sensor").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("value").alias("n_values"),
        rounded_mean("value", scale=2).alias("mean_value"))


@query("mean_of_daily_means", f"""WITH {READINGS}, daily AS (
  SELECT sensor, CAST(ts AS DATE) AS day, {mean_sql('value')} AS m FROM readings GROUP BY ALL)
SELECT sensor, count(*) AS days, {mean_sql('m')} AS mean_of_days, max(m) AS best_day FROM daily GROUP BY sensor""")
def mean_of_daily_means(spark, sf_dir):
    daily = readings(spark, sf_dir).groupBy("sensor", day_of("ts").alias("day")).agg(rounded_mean("value", scale=2).alias("m"))
    return daily.groupBy("sensor").agg(
        F.count(F.lit(1)).alias("days"), rounded_mean("m", scale=2).alias("mean_of_days"), F.max("m").alias("best_day"))


def _profile_sql(columns: dict[str, str], numeric: set[str]) -> str:
    parts = []
    for c, kind in columns.items():
        spread = (f"CAST(min({c}) AS DOUBLE), CAST(max({c}) AS DOUBLE), {mean_sql(c)}, round(stddev_samp({c}), 4)"
                  if c in numeric else "NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE")
        parts.append(f"SELECT '{c}', '{kind}', count(*), count(*) - count({c}), {spread} FROM orders")
    first = " UNION ALL ".join(parts)
    return (f"SELECT * FROM ({first}) AS t(column_name, data_type, row_count, null_count, min_value, max_value, "
            "mean_value, std_value)")


@query("profile_orders", _profile_sql(
    {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double",
     "o_orderdate": "timestamp_ntz", "o_orderpriority": "string"}, {"o_custkey", "o_totalprice"}))
def profile_orders(spark, sf_dir):
    return A.profile(table(spark, sf_dir, "orders"), ["o_custkey", "o_totalprice"], scale=2)


DRILL_ACROSS = f"""WITH {SITE_FACTS}, daily AS (
  SELECT r_name AS site_name, CAST(w.recorded_at AS DATE) AS full_date, {mean_sql('w.value')} AS mean_first,
    {mean_sql('w.code')} AS mean_code, {mean_sql('a.value')} AS mean_second, {mean_sql('a.code')} AS mean_second_code
  FROM first_fact w JOIN second_fact a ON w.site = a.site AND w.recorded_at = a.recorded_at
  JOIN region ON w.site = r_regionkey GROUP BY ALL)
SELECT *, strftime(full_date, '%a') AS day_of_week,
  CASE WHEN mean_second > 75 THEN 'Unhealthy' WHEN mean_second > 35 THEN 'Moderate' ELSE 'Good' END AS category
FROM daily"""


@query("drill_across_daily", DRILL_ACROSS)
def drill_across_daily(spark, sf_dir):
    first = site_readings(spark, sf_dir, "view").join(sites(spark, sf_dir), "site")
    second = site_readings(spark, sf_dir, "purchase").select("site", "recorded_at", "value", "code")
    return _drilled(first, second)


@query("drill_across_stored", DRILL_ACROSS)
def drill_across_stored(spark, sf_dir):
    """The same over facts stored by site and hour, so that they join where they lie."""
    return _drilled(*stored_facts(spark, sf_dir))


def _drilled(first, second):
    second = second.withColumnsRenamed({"recorded_at": "at", "value": "v2", "code": "c2"})
    daily = drill_across(
        first, second, ["site"], ("recorded_at", "at"), ["site_name", day_of("recorded_at").alias("full_date")],
        [rounded_mean("value", scale=2).alias("mean_first"), rounded_mean("code", scale=2).alias("mean_code"),
         rounded_mean("v2", scale=2).alias("mean_second"), rounded_mean("c2", scale=2).alias("mean_second_code")])
    return daily.withColumns({
        "day_of_week": short_day_name("full_date"),
        "category": bucket("mean_second", AIR_QUALITY_CUTS, AIR_QUALITY_DEFAULT),
    })


@query("approx_distinct_readings", """SELECT event_type, count(DISTINCT user_id) AS exact, TRUE AS within_five_percent
FROM events WHERE ts >= TIMESTAMP '2024-01-05' GROUP BY event_type""")
def approx_distinct_readings(spark, sf_dir):
    """Sketches stored by day in two loads, those of some days united, beside the exact count of the same days."""
    events = table(spark, sf_dir, "events")
    stored = CommittedTable(spark, scratch_path(spark, "sketches"), ["day"])
    for arrived in (events.where("ts < timestamp_ntz'2024-01-16'"), events.where("ts >= timestamp_ntz'2024-01-16'")):
        stored.replace(A.daily_sketches(arrived, ["event_type"], "ts", "user_id"))
    wanted = A.united_distinct(stored.read().where("day >= date'2024-01-05'"), ["event_type"])
    exact = events.where("ts >= timestamp_ntz'2024-01-05'").groupBy("event_type").agg(F.countDistinct("user_id").alias("exact"))
    near = F.abs(F.col("approx_distinct") - F.col("exact")) <= 0.05 * F.col("exact")
    return exact.join(wanted, "event_type").select("event_type", "exact", near.alias("within_five_percent"))
