"""Projections, filters and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.operators.modeling import AIR_QUALITY_CUTS, AIR_QUALITY_DEFAULT
from tidemark.plans.bindings import READINGS, mean_sql, readings, table
from tidemark.plans.registry import Family
from tidemark.sources.files import run_sql

FAMILY = Family()
query = FAMILY.query


@query("projection_with_rename", "SELECT event_id AS id, event_type AS sensor, ts AS recorded_at, value AS reading FROM events")
def projection_with_rename(spark, sf_dir):
    names = {"event_id": "id", "event_type": "sensor", "ts": "recorded_at", "value": "reading"}
    return table(spark, sf_dir, "events").select(*names).withColumnsRenamed(names)


@query("star_with_derived", """SELECT *, CASE WHEN o_totalprice > 300000 THEN 'large' ELSE 'other' END AS size_class
FROM orders""")
def star_with_derived(spark, sf_dir):
    return table(spark, sf_dir, "orders").withColumn("size_class", C.bucket("o_totalprice", [(300000, "large")], "other"))


@query("null_filters", f"""WITH {READINGS}, n AS (
  SELECT event_id, CASE WHEN code % 10 <> 0 THEN value END AS value, CASE WHEN code % 4 <> 0 THEN code END AS code FROM readings)
SELECT count(*) AS n_rows, count(value) AS with_value, count(CASE WHEN value IS NOT NULL AND code IS NOT NULL THEN 1 END) AS complete
FROM n""")
def null_filters(spark, sf_dir):
    """Rows before and after dropping NULLs in one column and in any, counted in one scan."""
    holes = readings(spark, sf_dir).select("event_id", "value", "code")
    holes = C.null_where(holes, F.col("code") % 10 == 0, ["value"])
    holes = C.null_where(holes, F.col("code") % 4 == 0, ["code"])

    complete = F.col("event_id").isNotNull() & F.col("value").isNotNull() & F.col("code").isNotNull()
    return holes.agg(F.count(F.lit(1)).alias("n_rows"), F.count("value").alias("with_value"), F.count_if(complete).alias("complete"))


@query("null_out_cells", f"""WITH {READINGS}
SELECT event_id, CASE WHEN code = 13 THEN NULL ELSE value END AS value, sensor FROM readings""")
def null_out_cells(spark, sf_dir):
    return C.null_where(readings(spark, sf_dir).select("event_id", "value", "sensor", "code"), F.col("code") == 13,
                        ["value"]).drop("code")


@query("filter_on_column", """SELECT event_id, user_id, value FROM events WHERE value > 100 AND ts >= TIMESTAMP '2024-01-10'""")
def filter_on_column(spark, sf_dir):
    events = table(spark, sf_dir, "events").where("value > 100 and ts >= timestamp_ntz'2024-01-10'")
    return events.select("event_id", "user_id", "value")


_HOT_DAYS = f"""SELECT event_type, CAST(ts AS DATE) AS reading_date, {mean_sql('value')} AS mean_value FROM events
  WHERE value IS NOT NULL GROUP BY ALL"""


@query("filter_on_aggregate", f"SELECT * FROM ({_HOT_DAYS}) WHERE mean_value > 52")
def filter_on_aggregate(spark, sf_dir):
    daily = table(spark, sf_dir, "events").where("value is not null").groupBy(
        "event_type", C.day_of("ts").alias("reading_date")).agg(C.rounded_mean("value", scale=2).alias("mean_value"))
    return daily.where("mean_value > 52")


@query("filter_on_aggregate_sql", f"WITH d AS ({_HOT_DAYS}) SELECT * FROM d WHERE mean_value > 52")
def filter_on_aggregate_sql(spark, sf_dir):
    """The same question as query text over a frame."""
    return run_sql(spark, """
        WITH daily AS (
          SELECT event_type, to_date(ts) AS reading_date,
                 round(cast(sum(cast(value AS decimal(18, 2))) AS double) / count(value) + 1e-9D, 2) AS mean_value
          FROM {events} WHERE value IS NOT NULL GROUP BY event_type, to_date(ts))
        SELECT * FROM daily WHERE mean_value > 52""", events=table(spark, sf_dir, "events"))


@query("scalar_subquery_filter", """SELECT event_id, ts FROM events
WHERE ts > (SELECT max(ts) FROM events WHERE event_type = 'error' AND value > 120)""")
def scalar_subquery_filter(spark, sf_dir):
    return run_sql(spark, """
        SELECT event_id, ts FROM {events}
        WHERE ts > (SELECT max(ts) FROM {events} WHERE event_type = 'error' AND value > 120)""",
                   events=table(spark, sf_dir, "events"))


@query("list_membership", """SELECT c_custkey, c_mktsegment FROM customer
WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY') AND c_nationkey IN (1, 7, 13)""")
def list_membership(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    kept = customers.where(~F.col("c_mktsegment").isin("BUILDING", "MACHINERY") & F.col("c_nationkey").isin(1, 7, 13))
    return kept.select("c_custkey", "c_mktsegment")


@query("threshold_bucket", f"""WITH {READINGS}, n AS (SELECT event_id, CASE WHEN code % 5 <> 0 THEN value END AS v FROM readings)
SELECT event_id, CASE WHEN v > 75 THEN 'Unhealthy' WHEN v > 35 THEN 'Moderate' ELSE 'Good' END AS category,
  CASE WHEN v IS NULL THEN 'Unknown' WHEN v > 75 THEN 'Unhealthy' WHEN v > 35 THEN 'Moderate' ELSE 'Good' END AS known_category
FROM n""")
def threshold_bucket(spark, sf_dir):
    rows = C.null_where(readings(spark, sf_dir), F.col("code") % 5 == 0, ["value"])
    return rows.select(
        "event_id", C.bucket("value", AIR_QUALITY_CUTS, AIR_QUALITY_DEFAULT).alias("category"),
        C.bucket("value", AIR_QUALITY_CUTS, AIR_QUALITY_DEFAULT, "Unknown").alias("known_category"))


@query("date_functions", """SELECT event_id, CAST(ts AS DATE) AS day, CAST(hour(ts) AS INTEGER) AS hour,
  CAST(month(ts) AS INTEGER) AS month, CAST(quarter(ts) AS INTEGER) AS quarter, CAST(year(ts) AS INTEGER) AS year,
  CAST(week(ts) AS INTEGER) AS iso_week, CAST(dayofweek(ts) + 1 AS INTEGER) AS weekday, dayofweek(ts) IN (0, 6) AS is_weekend,
  strftime(ts, '%a') AS day_name, strftime(ts, '%b') AS month_name, dayname(ts) AS full_day_name,
  date_trunc('hour', ts) AS hour_start, CAST(CAST(ts AS DATE) - 3 AS DATE) AS three_days_before,
  CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_key, strftime(ts, '%Y-%m-%d %H:%M:%S') AS formatted,
  'run_' || strftime(ts, '%Y%m%d_%H%M%S') AS run_id FROM events""")
def date_functions(spark, sf_dir):
    parts = C.date_parts("ts")
    return table(spark, sf_dir, "events").select(
        "event_id", C.day_of("ts").alias("day"), *[c.alias(n) for n, c in parts.items()],
        C.iso_week("ts").alias("iso_week"), C.weekday_number("ts").alias("weekday"),
        C.is_weekend("ts").alias("is_weekend"), C.short_day_name("ts").alias("day_name"),
        C.short_month_name("ts").alias("month_name"), C.full_day_name("ts").alias("full_day_name"),
        C.hour_floor("ts").alias("hour_start"), C.add_days(C.day_of("ts"), -3).alias("three_days_before"),
        C.date_key("ts").alias("date_key"), C.format_ts("ts").alias("formatted"),
        C.run_id(F.col("ts"), "run_").alias("run_id"))


@query("casts_and_parsing", """SELECT event_id, CAST(user_id AS VARCHAR) AS user_text,
  CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(floor(value) AS INTEGER) END AS parsed_int,
  CASE WHEN event_id % 5 = 0 THEN NULL ELSE date_trunc('minute', ts) END AS parsed_ts FROM events""")
def casts_and_parsing(spark, sf_dir):
    """Dirty text becomes NULL instead of failing the task."""
    e = table(spark, sf_dir, "events")
    number = F.when(F.col("event_id") % 3 == 0, "n/a").otherwise(F.floor("value").cast("string"))
    stamp = F.when(F.col("event_id") % 5 == 0, "soon").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm"))
    return e.select("event_id", F.col("user_id").cast("string").alias("user_text"),
                    C.safe_cast(number, "int").alias("parsed_int"),
                    C.parse_ts(stamp, "yyyy-MM-dd'T'HH:mm").alias("parsed_ts"))


@query("unit_conversion", """SELECT event_id, round(value * 9.0::DOUBLE / 5.0::DOUBLE + 32, 2) AS fahrenheit,
  round(abs(value - 50) + 1e-9, 1) AS distance  FROM events""")
def unit_conversion(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", C.c_to_f("value").alias("fahrenheit"), C.round_half_up(F.abs(F.col("value") - 50), 1).alias("distance"))


@query("text_functions", r"""SELECT c_custkey, md5(upper(trim(c_name))) AS name_hash,
  upper(trim('  ' || c_mktsegment || ' ')) AS segment, c_name || '|' || c_mktsegment AS joined,
  coalesce(CASE WHEN c_nationkey > 10 THEN c_mktsegment END, 'none') AS late_segment,
  'Customer ' || c_custkey || ' in ' || c_mktsegment AS sentence, regexp_replace(c_name, '[^0-9]', '', 'g') AS digits,
  CAST(floor(length(c_name) / 4) AS BIGINT) AS est_tokens, substring(c_name, 1, 8) AS prefix FROM customer""")
def text_functions(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey", C.hash_of(C.normalised("c_name")).alias("name_hash"),
        C.normalised(F.concat(F.lit("  "), "c_mktsegment", F.lit(" "))).alias("segment"),
        F.concat_ws("|", "c_name", "c_mktsegment").alias("joined"),
        F.coalesce(F.when(F.col("c_nationkey") > 10, F.col("c_mktsegment")), F.lit("none")).alias("late_segment"),
        F.format_string("Customer %d in %s", "c_custkey", "c_mktsegment").alias("sentence"),
        F.regexp_replace("c_name", "[^0-9]", "").alias("digits"), C.token_estimate("c_name").alias("est_tokens"),
        F.substring("c_name", 1, 8).alias("prefix"))


@query("document_token_estimates", """SELECT lang, count(*) AS n_docs,
  CAST(sum(CAST(floor(length(text) / 4) AS BIGINT)) AS BIGINT) AS est_tokens FROM documents GROUP BY lang""")
def document_token_estimates(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy("lang").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(C.token_estimate("text")).alias("est_tokens"))


@query("surrogate_keys", """SELECT event_id, md5(event_type || '-' || strftime(ts, '%Y-%m-%d %H:%M:%S.%g')) AS reading_sk,
  md5(coalesce(CASE WHEN user_id % 3 <> 0 THEN CAST(user_id AS VARCHAR) END, '_dbt_utils_surrogate_key_null_') || '-' || event_type)
  AS member_sk FROM events""")
def surrogate_keys(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("member", F.when(F.col("user_id") % 3 != 0, F.col("user_id")))
    return e.select("event_id", C.surrogate_key(e, ["event_type", "ts"]).alias("reading_sk"),
                    C.surrogate_key(e, ["member", "event_type"]).alias("member_sk"))
