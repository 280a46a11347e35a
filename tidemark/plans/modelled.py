"""Dimensions, facts, the serving mart, history tables and mutations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.columns import day_of
from tidemark.operators import modeling as M
from tidemark.operators import mutations as U
from tidemark.operators import vault as V
from tidemark.operators.aggregates import daily_summary
from tidemark.operators.committed import CommittedTable
from tidemark.operators.groups import written
from tidemark.operators.marts import keep_mart
from tidemark.plans.bindings import (
    LOCATED, READINGS, SITE_FACTS, SITE_HISTORY, located, mean_sql, newest_first, readings, site_history,
    site_readings, sites, stored_facts, table, table_state,
)
from tidemark.plans.matched import CODES, codes
from tidemark.plans.registry import Family
from tidemark.session import scratch_path, shared_dir
from tidemark.sources.files import date_spine, days_covered, inline, load_seed

FAMILY = Family()
query = FAMILY.query


# --- serving mart -------------------------------------------------------------------


SERVING_MART = f"""WITH {SITE_FACTS}, daily AS (
  SELECT r_name AS site_name, CAST(w.recorded_at AS DATE) AS reading_date,
    {mean_sql('w.value')} AS avg_value, {mean_sql('w.code')} AS avg_code, max(w.value) AS max_value,
    min(w.value) AS min_value, {mean_sql('a.value')} AS avg_second, {mean_sql('a.code')} AS avg_second_code,
    count(DISTINCT w.reading_sk) AS reading_cnt
  FROM first_fact w JOIN region ON w.site = r_regionkey
  LEFT JOIN second_fact a ON w.site = a.site AND CAST(w.recorded_at AS DATE) = CAST(a.recorded_at AS DATE)
    AND hour(w.recorded_at) = hour(a.recorded_at)
  GROUP BY ALL)
SELECT *, CASE WHEN avg_second > 75 THEN 'Unhealthy' WHEN avg_second > 35 THEN 'Moderate' ELSE 'Good' END AS category
FROM daily"""


@query("serving_mart", SERVING_MART)
def serving_mart(spark, sf_dir):
    return _mart(spark, sf_dir, site_readings(spark, sf_dir, "view"), site_readings(spark, sf_dir, "purchase"))


@query("serving_mart_stored", SERVING_MART)
def serving_mart_stored(spark, sf_dir):
    """The mart over facts stored by site and hour, the first with the sites' names."""
    return _mart_of(*stored_facts(spark, sf_dir), None)


def _mart(spark, sf_dir, first, second):
    return _mart_of(first, second, sites(spark, sf_dir))


def _mart_of(first, second, members):
    second = second.withColumnsRenamed({"value": "second_value", "code": "second_code"})
    return M.serving_mart(
        first, second, members, key="site", name="site_name", ts="recorded_at",
        reading_key="reading_sk", means={"avg_value": "value", "avg_code": "code"}, peak="value",
        second_means={"avg_second": "second_value", "avg_second_code": "second_code"}, graded="avg_second",
        count_name="reading_cnt", label_name="category", scale=2)


def store_mart(spark, sf_dir, path, upto):
    """Both facts loaded up to a time, and the mart brought up to date with them; returns the mart's table."""
    facts = {name: CommittedTable(spark, f"{path}/{name}", ["load_day"]) for name in ("view", "purchase")}
    for sensor, fact in facts.items():
        arrived = site_readings(spark, sf_dir, sensor).where(F.col("recorded_at") < F.lit(upto).cast("timestamp_ntz"))
        # the key is a hash of the site and the hour, so it never moves
        U.incremental_merge(spark, fact.path, arrived, ["reading_sk"], "recorded_at", ["recorded_at"], keys_move=False)
    mart = CommittedTable(spark, f"{path}/mart", ["reading_date"])
    keep_mart(mart, facts, lambda days: _mart(spark, sf_dir, days["view"], days["purchase"]), ["site_name"])
    return mart


BATCHES = ("2024-01-11", "2024-01-21", "9999-01-01")


@query("mart_kept_up", SERVING_MART)
def mart_kept_up(spark, sf_dir):
    """A mart stored by three incremental runs holds what one rebuild gives."""
    path = scratch_path(spark, "marts")
    for upto in BATCHES:
        mart = store_mart(spark, sf_dir, path, upto)
    return mart.read()


def stored_mart(spark, sf_dir):
    """The mart of these tables as stored by three incremental runs, which only the first call of an application makes.

    It is known by the size and time of the tables it is built from, so new
    files are a new mart.
    """
    state = "_".join(table_state(spark, sf_dir, name) for name in ("events", "region"))
    path = f"{shared_dir(spark).rstrip('/')}/marts_{spark.sparkContext.applicationId}_{state}"
    mart = CommittedTable(spark, f"{path}/mart", ["reading_date"])
    if mart.commit().number < len(BATCHES):
        for upto in BATCHES:
            mart = store_mart(spark, sf_dir, path, upto)
    return mart


# --- dimensions and facts ---------------------------------------------------------------


@query("build_dim", """SELECT md5(n_name) AS site_sk, n_name, n_regionkey FROM nation""")
def build_dim(spark, sf_dir):
    return M.build_dim(table(spark, sf_dir, "nation"), ["n_name"], ["n_regionkey"], "site_sk")


@query("build_dim_date", """SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_sk, d AS full_date,
  strftime(d, '%a') AS day_of_week, CAST(dayofweek(d) + 1 AS INTEGER) AS day_num, CAST(week(d) AS INTEGER) AS week_of_year,
  CAST(month(d) AS INTEGER) AS month_num, strftime(d, '%b') AS month_name, CAST(quarter(d) AS INTEGER) AS quarter,
  CAST(year(d) AS INTEGER) AS year, dayofweek(d) IN (0, 6) AS is_weekend
FROM (SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS d FROM orders)""")
def build_dim_date(spark, sf_dir):
    """The calendar of all days the orders span."""
    return M.build_dim_date(days_covered(table(spark, sf_dir, "orders"), "o_orderdate"))


@query("calendar_coverage", """SELECT d AS day, count(o_orderkey) AS n_orders
FROM (SELECT DATE '1995-01-01' + CAST(i AS INTEGER) AS d FROM range(90) t(i))
LEFT JOIN orders ON CAST(o_orderdate AS DATE) = d GROUP BY d""")
def calendar_coverage(spark, sf_dir):
    """Ninety generated days with the orders on each."""
    orders = table(spark, sf_dir, "orders").groupBy(day_of("o_orderdate").alias("day")).agg(
        F.count(F.lit(1)).alias("n_orders"))
    spine = date_spine(spark, "1995-01-01", 90)
    return spine.join(orders, "day", "left").withColumn("n_orders", F.coalesce("n_orders", F.lit(0).cast("long")))


@query("build_fact", f"""WITH {LOCATED}, {SITE_HISTORY}, {CODES}
SELECT site_sk, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_sk, coalesce(code_sk, 1) AS code_sk, ts, event_id, value
FROM located JOIN site_history USING (site_nk) LEFT JOIN codes ON code = code_value WHERE is_current AND value IS NOT NULL""")
def build_fact(spark, sf_dir):
    return M.build_fact(
        located(spark, sf_dir), site_history(spark, sf_dir), codes(spark), natural={"site_nk": "site_nk"},
        dim_key="site_sk", code={"code": "code_value"}, code_key="code_sk", default_code=1, ts="ts",
        required="value", measures=["event_id", "value"])


@query("junk_dimension", f"""WITH {READINGS}
SELECT md5(CAST(is_high AS VARCHAR) || '-' || CAST(is_night AS VARCHAR) || '-' || sensor) AS flag_sk, * FROM (
  SELECT DISTINCT value > 100 AS is_high, hour(ts) < 6 AS is_night, sensor FROM readings)""")
def junk_dimension(spark, sf_dir):
    return M.build_junk_dim(readings(spark, sf_dir), {
        "is_high": F.col("value") > 100, "is_night": F.hour("ts") < 6, "sensor": F.col("sensor")}, "flag_sk")


@query("assign_keys", """SELECT row_number() OVER (ORDER BY c_name) + (SELECT max(c_custkey) + 1 FROM customer WHERE c_mktsegment = 'BUILDING') AS customer_sk,
  c_name FROM customer WHERE c_mktsegment <> 'BUILDING'""")
def assign_keys(spark, sf_dir):
    """New customers numbered on from the highest key in use."""
    customers = table(spark, sf_dir, "customer")
    existing = customers.where("c_mktsegment = 'BUILDING'").select((F.col("c_custkey") + 1).alias("customer_sk"), "c_name")
    new = customers.where("c_mktsegment != 'BUILDING'").select("c_name")
    return M.assign_keys(new, existing, ["c_name"], "customer_sk")


@query("insert_missing", f"""WITH {READINGS}, {CODES}, seen AS (SELECT DISTINCT code AS code_value FROM readings)
SELECT code_value, description FROM codes UNION ALL
SELECT code_value, NULL FROM seen WHERE code_value NOT IN (SELECT code_value FROM codes)""")
def insert_missing(spark, sf_dir):
    """The seeded codes and, once each, the observed codes the seed lacks."""
    dim = load_seed(spark, "weather_codes").select("code_value", "description")
    seen = readings(spark, sf_dir).select(F.col("code").alias("code_value")).distinct()
    once = M.insert_missing(dim, seen, ["code_value"])
    return M.insert_missing(once, seen, ["code_value"])


_SLOTS = """SELECT {slot} AS slot, sensor, CASE WHEN p.s IS NULL THEN 'MISSING' ELSE 'OK' END AS status
FROM (SELECT DISTINCT event_type AS sensor FROM events) CROSS JOIN ({spine}) AS g(d)
LEFT JOIN (SELECT DISTINCT event_type AS k, {floor} AS s FROM events {where}) p ON p.k = sensor AND p.s = d"""


@query("gap_report_hours", _SLOTS.format(
    slot="d", floor="date_trunc('hour', ts)", where="",
    spine="SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30 23:00:00', INTERVAL 1 HOUR))"))
def gap_report_hours(spark, sf_dir):
    return M.gap_report(readings(spark, sf_dir), "sensor", "ts", "2024-01-01 00:00:00", "2024-01-30 23:00:00", "1 hour")


@query("gap_report_days", """WITH held AS (SELECT user_id, CAST(ts AS DATE) AS d FROM events WHERE value > 60)
SELECT g.d AS slot, u.user_id, CASE WHEN p.d IS NULL THEN 'MISSING' ELSE 'OK' END AS status
FROM (SELECT DISTINCT user_id FROM held) u CROSS JOIN (SELECT DATE '2024-01-01' + CAST(i AS INTEGER) AS d FROM range(35) t(i)) g
LEFT JOIN (SELECT DISTINCT * FROM held) p ON p.user_id = u.user_id AND p.d = g.d""")
def gap_report_days(spark, sf_dir):
    held = readings(spark, sf_dir).where("value > 60")
    return M.gap_report(held, "user_id", "ts", "2024-01-01", "2024-02-04")


def _step_sql(start: str, end: str, step: str, seconds: int) -> str:
    return _SLOTS.format(
        slot="d", where=f"WHERE ts >= TIMESTAMP '{start}'",
        floor=f"TIMESTAMP '{start}' + INTERVAL {seconds} SECOND * (date_diff('microsecond', TIMESTAMP '{start}', ts) // {seconds * 1_000_000})",
        spine=f"SELECT unnest(generate_series(TIMESTAMP '{start}', TIMESTAMP '{end}', INTERVAL {step}))")


@query("gap_report_two_hours", _step_sql("2024-01-01 00:30:00", "2024-01-30 22:30:00", "2 HOUR", 7200))
def gap_report_two_hours(spark, sf_dir):
    return M.gap_report(readings(spark, sf_dir), "sensor", "ts", "2024-01-01 00:30:00", "2024-01-30 22:30:00", "2 hours")


@query("gap_report_quarter_hours", _step_sql("2024-01-01 00:00:00", "2024-01-30 23:45:00", "15 MINUTE", 900))
def gap_report_quarter_hours(spark, sf_dir):
    return M.gap_report(readings(spark, sf_dir), "sensor", "ts", "2024-01-01 00:00:00", "2024-01-30 23:45:00", "15 minutes")


@query("gap_report_two_days", f"""SELECT CAST(slot AS DATE) AS slot, sensor, status
FROM ({_step_sql("2024-01-02 00:00:00", "2024-02-05 00:00:00", "2 DAY", 172_800)})""")
def gap_report_two_days(spark, sf_dir):
    return M.gap_report(readings(spark, sf_dir), "sensor", "ts", "2024-01-02", "2024-02-05", "2 days")


# --- changes to stored tables -----------------------------------------------------------


def _dim_customers(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_mktsegment", "c_acctbal", (F.col("c_nationkey") != 9).alias("is_current"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"))


def _changes(spark, sf_dir):
    """Customers of one nation in a new segment, of two others unchanged, and new keys."""
    customers = table(spark, sf_dir, "customer")
    moved = customers.where("c_nationkey in (0, 1, 9)").select(
        "c_custkey", "c_name",
        F.when(F.col("c_nationkey") == 0, F.lit("MOVED")).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"))
    new = customers.where("c_nationkey = 5").select(
        (F.col("c_custkey") + 10_000_000).alias("c_custkey"), F.concat(F.lit("New "), "c_name").alias("c_name"),
        "c_mktsegment")
    return moved.unionByName(new)


_DIM_CHANGES = """dim AS (SELECT c_custkey, c_name, c_mktsegment, c_acctbal, c_nationkey <> 9 AS is_current,
    CAST(NULL AS TIMESTAMP) AS valid_to FROM customer),
changes AS (
  SELECT c_custkey, c_name, CASE WHEN c_nationkey = 0 THEN 'MOVED' ELSE c_mktsegment END AS c_mktsegment
  FROM customer WHERE c_nationkey IN (0, 1, 9)
  UNION ALL SELECT c_custkey + 10000000, 'New ' || c_name, c_mktsegment FROM customer WHERE c_nationkey = 5)"""
_UPDATED = """SELECT d.c_custkey, d.c_name, CASE WHEN d.c_mktsegment <> s.c_mktsegment THEN s.c_mktsegment
    ELSE d.c_mktsegment END AS c_mktsegment, d.c_acctbal, d.is_current, d.valid_to
  FROM dim d LEFT JOIN changes s ON d.c_custkey = s.c_custkey AND d.is_current"""


@query("upsert", f"""WITH {_DIM_CHANGES} {_UPDATED} UNION ALL
SELECT s.c_custkey, s.c_name, s.c_mktsegment, NULL, TRUE, NULL FROM changes s
WHERE NOT EXISTS (SELECT 1 FROM dim d WHERE d.c_custkey = s.c_custkey AND d.is_current)""")
def upsert(spark, sf_dir):
    return U.upsert(_dim_customers(spark, sf_dir), _changes(spark, sf_dir), ["c_custkey"], ["c_mktsegment", "c_name"],
                    ["c_mktsegment", "c_name"], only=F.col("is_current"),
                    insert_defaults={"is_current": F.lit(True)})


@query("update_only", f"WITH {_DIM_CHANGES} {_UPDATED}")
def update_only(spark, sf_dir):
    return U.upsert(_dim_customers(spark, sf_dir), _changes(spark, sf_dir), ["c_custkey"], ["c_mktsegment"],
                    ["c_mktsegment"], only=F.col("is_current"), insert=False)


_GONE = "is_current AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 200000)"


@query("soft_delete", f"""WITH {_DIM_CHANGES}
SELECT c_custkey, c_name, c_mktsegment, c_acctbal, is_current AND NOT ({_GONE}) AS is_current,
  CASE WHEN {_GONE} THEN TIMESTAMP '2024-02-01' ELSE valid_to END AS valid_to FROM dim""")
def soft_delete(spark, sf_dir):
    keep = table(spark, sf_dir, "orders").where("o_orderstatus = 'F' and o_totalprice > 200000").select("o_custkey")
    return U.soft_delete(_dim_customers(spark, sf_dir), keep, "c_custkey", "2024-02-01 00:00:00")


@query("scd2_snapshot", """WITH first_state AS (SELECT c_custkey, c_mktsegment, c_nationkey FROM customer WHERE c_nationkey <> 8),
second_state AS (SELECT c_custkey, CASE WHEN c_nationkey = 2 THEN 'MOVED' WHEN c_nationkey = 3 THEN NULL
    ELSE c_mktsegment END AS c_mktsegment, c_nationkey FROM customer WHERE c_acctbal > 0)
SELECT f.*, TIMESTAMP '2024-01-01' AS valid_from,
  CASE WHEN s.c_custkey IS NULL OR s.c_mktsegment IS DISTINCT FROM f.c_mktsegment THEN TIMESTAMP '2024-01-02' END AS valid_to,
  s.c_custkey IS NOT NULL AND s.c_mktsegment IS NOT DISTINCT FROM f.c_mktsegment AS is_current
FROM first_state f LEFT JOIN second_state s USING (c_custkey)
UNION ALL SELECT s.*, TIMESTAMP '2024-01-02', NULL, TRUE FROM second_state s LEFT JOIN first_state f USING (c_custkey)
WHERE f.c_custkey IS NULL OR s.c_mktsegment IS DISTINCT FROM f.c_mktsegment""")
def scd2_snapshot(spark, sf_dir):
    """Three snapshots: a first load, a change with new and missing keys, and the change again."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey", "c_acctbal")
    first = customers.where("c_nationkey != 8").drop("c_acctbal")
    nation = F.col("c_nationkey")
    second = customers.where("c_acctbal > 0").drop("c_acctbal").withColumn(
        "c_mktsegment", F.when(nation == 2, "MOVED").when(nation != 3, F.col("c_mktsegment")))
    history = inline(spark, [], "c_custkey bigint, c_mktsegment string, c_nationkey int, valid_from timestamp_ntz, "
                                "valid_to timestamp_ntz, is_current boolean")
    for source, at in ((first, "2024-01-01"), (second, "2024-01-02"), (second, "2024-01-03")):
        history = written(U.scd2_snapshot(history, source, ["c_custkey"], ["c_mktsegment", "c_nationkey"], at,
                                          close_missing=True), "history")
    return history


_FACT = """SELECT md5(event_type || '-' || strftime(slot, '%Y-%m-%d %H:%M:%S.%g')) AS reading_sk, event_type AS sensor,
  slot AS recorded_at, event_id, value FROM (
    SELECT *, row_number() OVER (PARTITION BY event_type, slot ORDER BY ts DESC, event_id DESC) AS rn
    FROM (SELECT *, date_trunc('hour', ts) AS slot FROM events WHERE {where})) WHERE rn = 1"""


def _keyed(df):
    rows = df.withColumn("recorded_at", F.col("slot"))
    return M.with_surrogate_key(rows, ["sensor", "recorded_at"], "reading_sk").select(
        "reading_sk", "sensor", "recorded_at", "event_id", "ts", "value")


@query("incremental_merge", _FACT.format(where="TRUE"))
def incremental_merge(spark, sf_dir):
    """A first load up to mid-month, then two runs over everything, the last without news."""
    source = _keyed(readings(spark, sf_dir))
    path = scratch_path(spark, "fact")
    first_half = source.where("recorded_at < timestamp_ntz'2024-01-16'")
    for batch in (first_half, source, source):
        result = U.incremental_merge(spark, path, batch, ["reading_sk"], "recorded_at", newest_first())
    return result.select("reading_sk", "sensor", "recorded_at", "event_id", "value")


@query("incremental_lookback", f"""WITH early AS ({_FACT.format(where="ts < TIMESTAMP '2024-01-16' AND minute(ts) < 30")}),
late AS ({_FACT.format(where="date_trunc('hour', ts) > (SELECT max(recorded_at) FROM early) - INTERVAL 4 HOUR")})
SELECT * FROM late UNION ALL SELECT * FROM early WHERE reading_sk NOT IN (SELECT reading_sk FROM late)""")
def incremental_lookback(spark, sf_dir):
    """Late rows within four hours of the watermark enter, older ones do not."""
    source = _keyed(readings(spark, sf_dir))
    path = scratch_path(spark, "fact")
    on_time = source.where("recorded_at < timestamp_ntz'2024-01-16' and minute(ts) < 30")
    U.incremental_merge(spark, path, on_time, ["reading_sk"], "recorded_at", newest_first())
    result = U.incremental_merge(spark, path, source, ["reading_sk"], "recorded_at", newest_first(), "4 hours")
    return result.select("reading_sk", "sensor", "recorded_at", "event_id", "value")


@query("full_refresh", _FACT.format(where="TRUE"))
def full_refresh(spark, sf_dir):
    """Rows behind the watermark are skipped by an incremental run and found by a full refresh."""
    source = _keyed(readings(spark, sf_dir))
    path = scratch_path(spark, "fact")
    U.incremental_merge(spark, path, source.where("sensor != 'view'"), ["reading_sk"], "recorded_at", newest_first())
    U.incremental_merge(spark, path, source, ["reading_sk"], "recorded_at", newest_first())
    result = U.incremental_merge(spark, path, source, ["reading_sk"], "recorded_at", newest_first(), full_refresh=True)
    return result.select("reading_sk", "sensor", "recorded_at", "event_id", "value")


@query("incremental_moved_keys", """SELECT event_id, CASE WHEN event_id % 7 = 0 THEN ts + INTERVAL 15 DAY ELSE ts END AS ts,
  CASE WHEN event_id % 7 = 0 THEN value + 1 ELSE value END AS value FROM events WHERE ts < TIMESTAMP '2024-01-16'""")
def incremental_moved_keys(spark, sf_dir):
    """A seventh of the keys comes again fifteen days later: each leaves its former day, as in a full refresh."""
    first = table(spark, sf_dir, "events").where("ts < timestamp_ntz'2024-01-16'").select("event_id", "ts", "value")
    again = first.where("event_id % 7 = 0").select(
        "event_id", (F.col("ts") + F.expr("interval 15 days")).alias("ts"), (F.col("value") + 1).alias("value"))
    path = scratch_path(spark, "fact")
    for source in (first, first.unionByName(again)):
        result = U.incremental_merge(spark, path, source, ["event_id"], "ts", [F.col("ts").desc()])
    return result.drop("load_day")


@query("incremental_own_watermark", """WITH early AS (SELECT * FROM events WHERE CASE WHEN event_type = 'view'
  THEN ts < TIMESTAMP '2024-01-09' ELSE ts < TIMESTAMP '2024-01-16' AND event_id % 10 <> 0 END),
marks AS (SELECT event_type, max(ts) AS newest FROM early GROUP BY event_type)
SELECT event_id, event_type, ts, value FROM early UNION ALL
SELECT event_id, event_type, ts, value FROM events LEFT JOIN marks USING (event_type) WHERE newest IS NULL OR ts > newest""")
def incremental_own_watermark(spark, sf_dir):
    """One type is a week behind the others: its rows still enter, while late rows of the others do not."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "ts", "value")
    early = events.where("CASE WHEN event_type = 'view' THEN ts < timestamp_ntz'2024-01-09' "
                         "ELSE ts < timestamp_ntz'2024-01-16' AND event_id % 10 <> 0 END")
    path = scratch_path(spark, "fact")
    for source in (early, events, events):
        result = U.incremental_merge(spark, path, source, ["event_id"], "ts", ["value"], entity=["event_type"])
    return result.drop("load_day")


@query("incremental_without_times", """SELECT event_id, CASE WHEN event_id % 50 <> 0 THEN ts END AS ts, value,
  CASE WHEN event_id % 50 <> 0 THEN CAST(ts AS DATE) END AS load_day FROM events""")
def incremental_without_times(spark, sf_dir):
    """Rows without a time enter with every run, and once, as in a full refresh."""
    rows = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 50 != 0, F.col("ts")).alias("ts"), "value")
    path = scratch_path(spark, "fact")
    for source in (rows.where("ts < timestamp_ntz'2024-01-16' OR event_id % 100 = 0"), rows):
        result = U.incremental_merge(spark, path, source, ["event_id"], "ts", ["value"])
    return result


@query("replace_partitions", """SELECT event_id, CAST(ts AS DATE) AS day, CASE WHEN ts >= TIMESTAMP '2024-01-20' THEN value + 1
  ELSE value END AS value FROM events WHERE ts < TIMESTAMP '2024-01-20' OR value > 50""")
def replace_partitions(spark, sf_dir):
    """Reloading some days replaces just those."""
    rows = table(spark, sf_dir, "events").select("event_id", "value", day_of("ts").alias("day"))
    path = scratch_path(spark, "readings")
    U.replace_partitions(rows, path, ["day"])
    again = U.read_committed(spark, path).where("day >= date'2024-01-20' and value > 50")
    U.replace_partitions(again.withColumn("value", F.col("value") + 1), path, ["day"])
    return U.read_committed(spark, path)


def _summary(spark, sf_dir):
    rows = readings(spark, sf_dir)
    return daily_summary(rows, ["sensor"], "ts", {"mean_value": "value"}, day_name="summary_date",
                         count_name="reading_count", scale=2)


_SUMMARY = f"""SELECT sensor, CAST(ts AS DATE) AS summary_date, {mean_sql('value')} AS mean_value,
  count(*) AS reading_count, TIMESTAMP '{{at}}' AS refreshed_at FROM readings GROUP BY ALL"""


@query("refresh_summary_append", f"""WITH {READINGS} {_SUMMARY.format(at='2024-02-01')} UNION ALL
{_SUMMARY.format(at='2024-02-02')} UNION ALL SELECT 'START_MARKER', DATE '2024-02-01', NULL, NULL, TIMESTAMP '2024-02-01'""")
def refresh_summary_append(spark, sf_dir):
    """A marker row and a refresh, then a second refresh: all are kept."""
    path = scratch_path(spark, "summary")
    marker = inline(spark, [("START_MARKER", "2024-02-01")], "sensor string, summary_date string").withColumn(
        "summary_date", F.col("summary_date").cast("date"))
    U.refresh_summary(path, _summary(spark, sf_dir), "2024-02-01", marker=marker)
    U.refresh_summary(path, _summary(spark, sf_dir), "2024-02-02")
    return U.read_committed(spark, path)


@query("refresh_summary_newest", f"WITH {READINGS} {_SUMMARY.format(at='2024-02-02')}")
def refresh_summary_newest(spark, sf_dir):
    path = scratch_path(spark, "summary")
    U.refresh_summary(path, _summary(spark, sf_dir), "2024-02-01")
    U.refresh_summary(path, _summary(spark, sf_dir), "2024-02-02")
    return U.newest_refresh(U.read_committed(spark, path), ["sensor", "summary_date"])


@query("refresh_summary_replace", f"WITH {READINGS} {_SUMMARY.format(at='2024-02-02')}")
def refresh_summary_replace(spark, sf_dir):
    path = scratch_path(spark, "summary")
    for at in ("2024-02-01", "2024-02-02"):
        U.refresh_summary(path, _summary(spark, sf_dir), at, mode="replace")
    return U.read_committed(spark, path)


# --- insert-only history -------------------------------------------------------------------


_HASHES = """md5(upper(trim(sensor)) || '|' || strftime(slot, '%Y-%m-%d %H:%M:%S')) AS reading_hk,
  md5(upper(trim(sensor))) AS sensor_hk, md5(strftime(slot, '%Y-%m-%d')) AS date_hk"""
_SPELT = f"""{READINGS}, spelt AS (
  SELECT * REPLACE (CASE WHEN code % 3 = 0 THEN ' ' || upper(sensor) ELSE sensor END AS sensor) FROM readings)"""
SOURCE = "sensor-feed"
FIRST_LOAD, SECOND_LOAD = "2024-02-01 00:00:00", "2024-02-02 00:00:00"


def _spelt(spark, sf_dir):
    """Readings whose sensor names vary in case and blanks."""
    return readings(spark, sf_dir).withColumn(
        "sensor", F.when(F.col("code") % 3 == 0, F.concat(F.lit(" "), F.upper("sensor"))).otherwise(F.col("sensor")))


def _empty(spark, schema):
    return inline(spark, [], schema)


_STAMPS = "load_date timestamp_ntz, record_source string"


def _sensor_hub(spark, rows, hub=None, load_date=FIRST_LOAD):
    hub = hub if hub is not None else _empty(spark, f"sensor_hk string, sensor_nk string, {_STAMPS}")
    return V.load_hub(hub, rows, V.name_hash("sensor"), F.col("sensor"), key="sensor_hk", name="sensor_nk",
                      load_date=load_date, record_source=SOURCE)


def _date_hub(spark, rows, hub=None, load_date=FIRST_LOAD):
    hub = hub if hub is not None else _empty(spark, f"date_hk string, full_date date, {_STAMPS}")
    return V.load_hub(hub, rows, V.day_hash("slot"), F.to_date("slot"), key="date_hk", name="full_date",
                      load_date=load_date, record_source=SOURCE)


def _link(spark, rows, link=None, load_date=FIRST_LOAD):
    link = link if link is not None else _empty(
        spark, f"reading_hk string, sensor_hk string, date_hk string, slot timestamp_ntz, {_STAMPS}")
    hashes = {"reading_hk": V.reading_hash("sensor", "slot"), "sensor_hk": V.name_hash("sensor"),
              "date_hk": V.day_hash("slot")}
    return V.load_link(link, rows, hashes, ["slot"], load_date=load_date, record_source=SOURCE)


def _satellite(spark, rows, satellite=None, load_date=FIRST_LOAD, mode="changed"):
    satellite = satellite if satellite is not None else _empty(
        spark, f"reading_hk string, value double, code int, {_STAMPS}, load_end_date timestamp_ntz")
    return V.load_satellite(
        satellite, rows, V.reading_hash("sensor", "slot"), key="reading_hk", attributes=["value", "code"],
        order=newest_first(), required="value", load_date=load_date, record_source=SOURCE, mode=mode)


_STAMPED = f"TIMESTAMP '{FIRST_LOAD}' AS load_date, '{SOURCE}' AS record_source"


@query("vault_hub_names", f"""WITH {_SPELT}
SELECT md5(upper(trim(sensor))) AS sensor_hk, min(sensor) AS sensor_nk, {_STAMPED} FROM spelt GROUP BY 1""")
def vault_hub_names(spark, sf_dir):
    """Loaded twice; spellings that hash alike are one key."""
    rows = _spelt(spark, sf_dir)
    return _sensor_hub(spark, rows, written(_sensor_hub(spark, rows), "hub"), SECOND_LOAD)


@query("vault_hub_dates", f"""WITH {_SPELT}, days AS (SELECT DISTINCT CAST(slot AS DATE) AS full_date FROM spelt)
SELECT md5(strftime(full_date, '%Y-%m-%d')) AS date_hk, full_date,
  CASE WHEN full_date < DATE '2024-01-11' THEN TIMESTAMP '{FIRST_LOAD}' ELSE TIMESTAMP '{SECOND_LOAD}' END AS load_date,
  '{SOURCE}' AS record_source FROM days""")
def vault_hub_dates(spark, sf_dir):
    """A first load of ten days and a second of all: known days keep their load date."""
    rows = _spelt(spark, sf_dir)
    first = written(_date_hub(spark, rows.where("slot < timestamp_ntz'2024-01-11'")), "hub")
    return _date_hub(spark, rows, first, SECOND_LOAD)


@query("vault_link", f"""WITH {_SPELT}
SELECT DISTINCT {_HASHES}, slot, {_STAMPED} FROM spelt""")
def vault_link(spark, sf_dir):
    rows = _spelt(spark, sf_dir)
    return _link(spark, rows, written(_link(spark, rows), "link"), SECOND_LOAD)


_LATEST = """SELECT reading_hk, value, code FROM (SELECT *, row_number() OVER (
  PARTITION BY reading_hk ORDER BY ts DESC, event_id DESC) AS rn FROM {source}) WHERE rn = 1"""


@query("vault_satellite_changes", f"""WITH {_SPELT}, hashed AS (SELECT *, {_HASHES} FROM spelt),
old AS ({_LATEST.format(source="(SELECT * FROM hashed WHERE minute(ts) < 40)")}),
new AS ({_LATEST.format(source="hashed")})
SELECT o.*, TIMESTAMP '{FIRST_LOAD}' AS load_date, '{SOURCE}' AS record_source,
  CASE WHEN n.value <> o.value OR n.code <> o.code THEN TIMESTAMP '{SECOND_LOAD}' END AS load_end_date
FROM old o JOIN new n USING (reading_hk)
UNION ALL SELECT n.*, TIMESTAMP '{SECOND_LOAD}', '{SOURCE}', NULL FROM new n LEFT JOIN old o USING (reading_hk)
WHERE o.reading_hk IS NULL OR n.value <> o.value OR n.code <> o.code""")
def vault_satellite_changes(spark, sf_dir):
    """A first load of the readings up to minute forty, then all, then all again.

    Changed attributes end the old version; the third load adds nothing.
    """
    rows = _spelt(spark, sf_dir)
    satellite = written(_satellite(spark, rows.where("minute(ts) < 40")), "satellite")
    satellite = written(_satellite(spark, rows, satellite, SECOND_LOAD), "satellite")
    return _satellite(spark, rows, satellite, "2024-02-03 00:00:00")


@query("vault_satellite_append", f"""WITH {_SPELT}, loads AS (SELECT unnest([TIMESTAMP '{FIRST_LOAD}', TIMESTAMP '{SECOND_LOAD}']) AS load_date)
SELECT md5(upper(trim(sensor)) || '|' || strftime(slot, '%Y-%m-%d %H:%M:%S')) AS reading_hk, value, code, load_date,
  '{SOURCE}' AS record_source, CAST(NULL AS TIMESTAMP) AS load_end_date FROM spelt CROSS JOIN loads""")
def vault_satellite_append(spark, sf_dir):
    """Plain appends: every load adds every row."""
    rows = _spelt(spark, sf_dir)
    return _satellite(spark, rows, _satellite(spark, rows, mode="append"), SECOND_LOAD, "append")


@query("vault_member_details", """SELECT md5(upper(trim(n_name))) AS site_hk, r_name AS country,
  TIMESTAMP '2024-02-01' AS load_date, 'sensor-feed' AS record_source, CAST(NULL AS TIMESTAMP) AS load_end_date
FROM nation JOIN region ON n_regionkey = r_regionkey""")
def vault_member_details(spark, sf_dir):
    """A satellite of a hub rather than of a link."""
    members = site_history(spark, sf_dir).where("is_current")
    satellite = _empty(spark, f"site_hk string, country string, {_STAMPS}, load_end_date timestamp_ntz")
    for at in (FIRST_LOAD, SECOND_LOAD):
        satellite = V.load_satellite(
            satellite, members, V.name_hash("site_name"), key="site_hk", attributes=["country"], order=["site_sk"],
            required=None, load_date=at, record_source=SOURCE)
    return satellite


@query("vault_view", f"""WITH {_SPELT}, hashed AS (SELECT *, {_HASHES} FROM spelt), latest AS ({_LATEST.format(source='hashed')})
SELECT h.sensor_nk, CAST(l.slot AS DATE) AS full_date, l.slot, s.value, s.code
FROM (SELECT DISTINCT reading_hk, sensor_hk, slot FROM hashed) l JOIN latest s USING (reading_hk)
JOIN (SELECT sensor_hk, min(sensor) AS sensor_nk FROM hashed GROUP BY 1) h USING (sensor_hk)""")
def vault_view(spark, sf_dir):
    rows = _spelt(spark, sf_dir)
    view = V.vault_view(
        _link(spark, rows), [(_sensor_hub(spark, rows), "sensor_hk"), (_date_hub(spark, rows), "date_hk")],
        _satellite(spark, rows), "reading_hk")
    return view.select("sensor_nk", "full_date", "slot", "value", "code")


@query("vault_current_view", f"""WITH {_SPELT}, hashed AS (SELECT *, {_HASHES} FROM spelt), latest AS ({_LATEST.format(source='hashed')})
SELECT h.sensor_nk, CAST(l.slot AS DATE) AS full_date, l.slot, s.value, s.code
FROM (SELECT DISTINCT reading_hk, sensor_hk, slot FROM hashed) l JOIN latest s USING (reading_hk)
JOIN (SELECT sensor_hk, min(sensor) AS sensor_nk FROM hashed GROUP BY 1) h USING (sensor_hk)""")
def vault_current_view(spark, sf_dir):
    """The same view from a satellite stored in two loads, read from its current rows."""
    rows = _spelt(spark, sf_dir)
    table = CommittedTable(spark, scratch_path(spark, "satellite"), ["load_date"])
    for source, at in ((rows.where("minute(ts) < 40"), FIRST_LOAD), (rows, SECOND_LOAD), (rows, SECOND_LOAD)):
        current = V.store_satellite(
            table, source, V.reading_hash("sensor", "slot"), key="reading_hk", attributes=["value", "code"],
            order=newest_first(), required="value", load_date=at, record_source=SOURCE)
    view = V.current_view(
        _link(spark, rows), [(_sensor_hub(spark, rows), "sensor_hk"), (_date_hub(spark, rows), "date_hk")], current, "reading_hk")
    return view.select("sensor_nk", "full_date", "slot", "value", "code")
