"""Report text from the mart, and parsed, validated and rendered responses."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import report as R
from tidemark.operators.marts import newest_rows
from tidemark.plans.bindings import READINGS, readings, table
from tidemark.plans.modelled import FAMILY as MODELLED
from tidemark.plans.modelled import serving_mart, stored_mart
from tidemark.plans.registry import Family

FAMILY = Family()
query = FAMILY.query

_MART = MODELLED.oracles["serving_mart"]


def _latest(spark, sf_dir):
    """The report's read: the stored mart, of which only the days some member was last seen on are opened."""
    return newest_rows(stored_mart(spark, sf_dir), ["site_name"])


_LATEST = f"""latest AS (SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY site_name ORDER BY reading_date DESC) AS rn FROM ({_MART})) WHERE rn = 1)"""


@query("latest_mart_rows", f"WITH {_LATEST} SELECT * FROM latest")
def latest_mart_rows(spark, sf_dir):
    return _latest(spark, sf_dir)


_LINE = """'- ' || site_name || ' (' || reading_date || '): Avg ' || coalesce(CAST(avg_value AS VARCHAR), 'nan') || 'C (max '
  || coalesce(CAST(max_value AS VARCHAR), 'nan') || ', min ' || coalesce(CAST(min_value AS VARCHAR), 'nan') || ') | Humidity '
  || coalesce(CAST(avg_code AS VARCHAR), 'nan') || '% | PM2.5 ' || coalesce(CAST(avg_second AS VARCHAR), 'nan') || ' (' || category
  || ') | UV ' || coalesce(CAST(avg_second_code AS VARCHAR), 'nan')"""


LINE = ("- {name} ({date}): Avg {mean}C (max {max}, min {min}) | Humidity {humidity}% | PM2.5 {pm25} ({category})"
        " | UV {uv}")


def _lines(mart):
    return mart.select("site_name", "reading_date", R.render_line(LINE, {
        "name": "site_name", "date": "reading_date", "mean": "avg_value", "max": "max_value", "min": "min_value",
        "humidity": "avg_code", "pm25": "avg_second", "category": "category", "uv": "avg_second_code"}).alias("line"))


HEADER = "Daily summary - generated 2024-02-01 06:00 UTC\n"


@query("render_lines", f"SELECT site_name, reading_date, {_LINE} AS line FROM ({_MART})")
def render_lines(spark, sf_dir):
    return _lines(serving_mart(spark, sf_dir))


@query("render_block", f"""WITH {_LATEST}, lines AS (SELECT site_name, {_LINE} AS line FROM latest)
SELECT substring('{HEADER[:-1]}' || chr(10) || chr(10) || string_agg(line, chr(10) ORDER BY site_name), 1, 8000) AS block FROM lines""")
def render_block(spark, sf_dir):
    return R.render_block(_lines(_latest(spark, sf_dir)), [], ["site_name"], "line", HEADER)


@query("render_blocks_capped", f"""WITH lines AS (SELECT site_name, reading_date, {_LINE} AS line FROM ({_MART}))
SELECT site_name, substring('{HEADER[:-1]}' || chr(10) || chr(10) || string_agg(line, chr(10) ORDER BY reading_date), 1, 400) AS block
FROM lines GROUP BY site_name""")
def render_blocks_capped(spark, sf_dir):
    """A block per member, cut at a hundred tokens; a member has a line per day."""
    return R.render_block(_lines(serving_mart(spark, sf_dir)), ["site_name"], ["reading_date"], "line", HEADER, 100)


@query("cap_tokens", """SELECT doc_id, CAST(floor(length(text) / 4) AS BIGINT) AS est_tokens, md5(CASE WHEN floor(length(text) / 4) > 500
  THEN substring(text, 1, 2000) ELSE text END) AS text_hash FROM documents""")
def cap_tokens(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return R.cap_tokens(documents, "text", 500).select("doc_id", "est_tokens", F.md5("text").alias("text_hash"))


def _responses(spark, sf_dir):
    """Responses as a model might return them, in eight forms."""
    rows = readings(spark, sf_dir).select("event_id", "sensor", "value", "code")
    number = F.col("value").cast("decimal(18,2)").cast("string")
    member = F.concat(
        F.lit('{"city": "'), "sensor", F.lit('", "avg_temp": '), number, F.lit(', "air_quality": "Good", "avg_pm25": '),
        F.when(F.col("code") % 2 == 0, F.lit("null")).otherwise(F.col("code").cast("string")),
        F.lit(', "comment": "Steady."}'))
    alerts = F.when(F.col("code") > 50, F.concat(F.lit('["'), "sensor", F.lit(' is high", "check"]'))).otherwise("[]")
    plain = F.concat(F.lit('{"overview": "All steady.", "cities": ['), member, F.lit('], "alerts": '), alerts, F.lit("}"))
    form = F.col("event_id") % 8
    return rows.withColumn("response", (
        F.when(form == 0, plain)
        .when(form == 1, F.concat(F.lit("```json\n"), plain, F.lit("\n```")))
        .when(form == 2, F.concat(F.lit("Here is the report:\n"), plain, F.lit("\nThank you.")))
        .when(form == 3, F.expr("substring('{\"overview\": \"cut off', 1, 20)"))
        .when(form == 4, F.lit("[1, 2]"))
        .when(form == 5, F.concat(F.lit('{"overview": "No lists.", "cities": "'), "sensor", F.lit('"}')))
        .when(form == 6, F.concat(F.lit('{"overview": "Gaps.", "cities": [{"city": "'), "sensor",
                                  F.lit('", "avg_temp": 1}, 7], "alerts": []}')))
        .otherwise(F.lit("   "))))


_FORMS = f"""{READINGS}, forms AS (SELECT event_id, sensor, code, event_id % 8 AS form,
  CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS num, CAST(value AS DECIMAL(18,2)) AS dec FROM readings)"""


@query("parse_reports", f"""WITH {_FORMS}
SELECT event_id, form IN (3, 4, 7) AS parse_failed,
  CASE form WHEN 3 THEN 'Report unavailable - the AI response could not be parsed.' WHEN 4 THEN 'Report unavailable - unexpected response shape.'
    WHEN 7 THEN 'Report unavailable - the AI response could not be parsed.' WHEN 5 THEN 'No lists.' WHEN 6 THEN 'Gaps.' ELSE 'All steady.' END AS overview,
  CASE form WHEN 5 THEN 'Missing top-level keys: [''alerts'']; ''cities'' is not a list; ''alerts'' is not a list'
    WHEN 6 THEN 'cities[0] missing ''air_quality''; cities[0] missing ''avg_pm25''; cities[0] missing ''comment''; cities[1] is not an object'
    ELSE '' END AS problems, form NOT IN (5, 6) AS is_valid FROM forms""")
def parse_reports(spark, sf_dir):
    parsed = R.parse_reports(_responses(spark, sf_dir), "response")
    return parsed.select("event_id", "parse_failed", "overview", F.array_join("problems", "; ").alias("problems"), "is_valid")


@query("render_reports", f"""WITH {_FORMS}, t AS (SELECT *, chr(10) AS n, CAST(CAST(num AS DOUBLE) AS VARCHAR) AS temp FROM forms)
SELECT event_id, '=== DAILY REPORT ===' || n || n ||
  CASE WHEN form IN (0, 1, 2) THEN 'All steady.' || n || n || sensor || ': Avg ' || temp || 'C | PM2.5 ' ||
      CASE WHEN code % 2 = 0 THEN 'Not available' ELSE CAST(code AS VARCHAR) END || ' | Air quality: Good' || n || '  Steady.' || n ||
      CASE WHEN code > 50 THEN n || 'ALERTS:' || n || '  ! ' || sensor || ' is high' || n || '  ! check' ELSE '' END
    WHEN form = 4 THEN 'Report unavailable - unexpected response shape.' || n
    WHEN form = 5 THEN 'No lists.' || n
    WHEN form = 6 THEN 'Gaps.' || n || n || sensor || ': Avg 1C | PM2.5 Not available | Air quality: Not available' || n || '  ' || n
      || n || 'Unknown: Avg Not available | PM2.5 Not available | Air quality: Not available' || n || '  ' || n
    ELSE 'Report unavailable - the AI response could not be parsed.' || n END AS report FROM t""")
def render_reports(spark, sf_dir):
    parsed = R.parse_reports(_responses(spark, sf_dir), "response")
    return R.render_reports(parsed).select("event_id", "report")


@query("call_metrics", """SELECT role AS label, count(*) AS calls, count(CASE WHEN conv_id % 10 = 0 THEN 1 END) AS failed_calls,
  count(CASE WHEN conv_id % 10 = 1 THEN 1 END) AS empty_outputs,
  CAST(sum(CAST(floor(length(text) / 4) AS BIGINT)) AS BIGINT) AS est_input_tokens,
  CAST(sum(CASE WHEN conv_id % 10 > 1 THEN length(text) WHEN conv_id % 10 = 1 THEN 2 ELSE 0 END) AS BIGINT) AS output_chars,
  CAST(sum(turn * 100 + 5) AS BIGINT) AS elapsed_ms FROM conversations GROUP BY role""")
def call_metrics(spark, sf_dir):
    """Turns as recorded calls: a tenth failed, a tenth came back blank."""
    kind = F.col("conv_id") % 10
    calls = table(spark, sf_dir, "conversations").select(
        F.col("role").alias("label"), F.col("text").alias("input_text"),
        F.when(kind == 1, "  ").when(kind > 1, F.col("text")).alias("output_text"),
        (F.col("turn") * 100 + 5).alias("elapsed_ms"), F.when(kind == 0, "Timeout").alias("error"))
    return R.call_metrics(calls)
