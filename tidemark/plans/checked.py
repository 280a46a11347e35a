"""Data-quality checks over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.columns import null_where
from tidemark.operators import quality as Q
from tidemark.operators.joins import missing_members
from tidemark.plans.bindings import READINGS, readings, sites, table
from tidemark.plans.modelled import serving_mart
from tidemark.plans.registry import Family
from tidemark.session import scratch_path, shared_dir, unique_name
from tidemark.sources.files import inline
from tidemark.sources.sinks import publish, publish_fresh

FAMILY = Family()
query = FAMILY.query

AS_OF = "2024-01-31 12:00:00"


@query("check_unique", """SELECT user_id, count(*) AS n_rows FROM events WHERE user_id IS NOT NULL
GROUP BY user_id HAVING count(*) > 1""")
def check_unique(spark, sf_dir):
    return Q.duplicates(table(spark, sf_dir, "events"), ["user_id"])


@query("check_unique_combination", """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY ALL HAVING count(*) > 1""")
def check_unique_combination(spark, sf_dir):
    return Q.duplicates(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("check_not_null", f"""WITH {READINGS} SELECT event_id, sensor FROM readings WHERE code % 25 = 0""")
def check_not_null(spark, sf_dir):
    """Rows whose measure is missing."""
    rows = null_where(readings(spark, sf_dir), F.col("code") % 25 == 0, ["value"])
    return rows.where(F.col("value").isNull()).select("event_id", "sensor")


@query("check_accepted_values", """SELECT event_id, event_type FROM events
WHERE event_type NOT IN ('click', 'view', 'signup', 'purchase')""")
def check_accepted_values(spark, sf_dir):
    check = Q.accepted_values("event_type", ["click", "view", "signup", "purchase"])
    return table(spark, sf_dir, "events").where(check.row_fails).select("event_id", "event_type")


@query("check_relationships", """SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""")
def check_relationships(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return Q.orphans(orders, "o_custkey", table(spark, sf_dir, "customer").where("c_acctbal > 0"), "c_custkey")


@query("check_between", f"""WITH {READINGS} SELECT event_id, value FROM readings
WHERE code >= 50 AND NOT (value BETWEEN 0 AND 100)""")
def check_between(spark, sf_dir):
    outside = Q.out_of_range("value", 0, 100, F.col("code") >= 50)
    return readings(spark, sf_dir).where(outside).select("event_id", "value")


@query("check_singular", """SELECT event_id, ts, value FROM events WHERE value > 250 OR value < 0.05""")
def check_singular(spark, sf_dir):
    return table(spark, sf_dir, "events").where("value > 250 or value < 0.05").select("event_id", "ts", "value")


@query("check_missing_members", f"""WITH {READINGS} SELECT DISTINCT user_id FROM readings
WHERE user_id NOT IN (SELECT user_id FROM readings WHERE value > 200)""")
def check_missing_members(spark, sf_dir):
    """Every user was expected to have a high reading."""
    rows = readings(spark, sf_dir)
    return missing_members(rows.where("value > 200"), "user_id", rows.select("user_id").distinct())


@query("check_stale_members", """SELECT user_id, max(CAST(ts AS DATE)) AS latest FROM events
GROUP BY user_id HAVING max(CAST(ts AS DATE)) < DATE '2024-01-31' - 1""")
def check_stale_members(spark, sf_dir):
    return Q.stale_members(table(spark, sf_dir, "events"), "user_id", "ts", "2024-01-31", 1)


@query("check_freshness", f"""SELECT max(ts) AS latest, round((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(max(ts))) / 3600e6, 2) AS age_hours,
  CASE WHEN TIMESTAMP '{AS_OF}' - max(ts) > INTERVAL 48 HOUR THEN 'error'
       WHEN TIMESTAMP '{AS_OF}' - max(ts) > INTERVAL 24 HOUR THEN 'warn' ELSE 'pass' END AS status
FROM events""")
def check_freshness(spark, sf_dir):
    return Q.freshness(table(spark, sf_dir, "events"), "ts", AS_OF, 24, 48)


def _event_checks(spark, sf_dir):
    kinds = inline(spark, [("click",), ("view",), ("signup",), ("purchase",), ("refund",)], "kind string")
    return [
        Q.not_null("event_id"),
        Q.not_null("value"),
        Q.accepted_values("event_type", ["click", "view", "signup", "purchase"]),
        Q.between("value", 0, 400).warn_only(),
        Q.between("value", 0, 100, F.col("event_type") == "view"),
        Q.row_count_between(1, 1_000_000_000_000),
        Q.unique("event_id"),
        Q.unique_combination(["user_id", "event_type"]).warn_only(),
        Q.relationships("user_id", table(spark, sf_dir, "customer"), "c_custkey"),
        Q.no_row("no_extreme_value", F.col("value") > 250),
        Q.missing_members("event_type", kinds),
        Q.is_fresh("ts", AS_OF, 6, 48, "warn"),
        Q.is_fresh("ts", AS_OF, 6, 48),
    ]


_RESULTS = [
    ("not_null_event_id", "error", "(SELECT count(*) FROM events WHERE event_id IS NULL)"),
    ("not_null_value", "error", "(SELECT count(*) FROM events WHERE value IS NULL)"),
    ("accepted_values_event_type", "error",
     "(SELECT count(*) FROM events WHERE event_type NOT IN ('click', 'view', 'signup', 'purchase'))"),
    ("between_value_0_400", "warn", "(SELECT count(*) FROM events WHERE NOT (value BETWEEN 0 AND 400))"),
    ("between_value_0_100", "error",
     "(SELECT count(*) FROM events WHERE event_type = 'view' AND NOT (value BETWEEN 0 AND 100))"),
    ("row_count_between_1_1000000000000", "error",
     "(SELECT CASE WHEN count(*) BETWEEN 1 AND 1000000000000 THEN 0 ELSE 1 END FROM events)"),
    ("unique_event_id", "error", "(SELECT count(*) FROM (SELECT 1 FROM events GROUP BY event_id HAVING count(*) > 1))"),
    ("unique_combination_user_id_event_type", "warn",
     "(SELECT count(*) FROM (SELECT 1 FROM events GROUP BY user_id, event_type HAVING count(*) > 1))"),
    ("relationships_user_id", "error",
     "(SELECT count(*) FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer))"),
    ("no_extreme_value", "error", "(SELECT count(*) FROM events WHERE value > 250)"),
    ("missing_members_event_type", "error",
     "(SELECT count(*) FROM (VALUES ('click'), ('view'), ('signup'), ('purchase'), ('refund')) k(kind)"
     " WHERE kind NOT IN (SELECT event_type FROM events WHERE event_type IS NOT NULL))"),
    ("freshness_ts_warn", "warn",
     f"(SELECT CASE WHEN TIMESTAMP '{AS_OF}' - max(ts) > INTERVAL 6 HOUR THEN 1 ELSE 0 END FROM events)"),
    ("freshness_ts_error", "error",
     f"(SELECT CASE WHEN TIMESTAMP '{AS_OF}' - max(ts) > INTERVAL 48 HOUR THEN 1 ELSE 0 END FROM events)"),
]
_RESULT_ROWS = " UNION ALL ".join(
    f"SELECT '{name}' AS \"check\", '{severity}' AS severity, CAST({failures} AS BIGINT) AS failures"
    for name, severity, failures in _RESULTS)
_STATUS = "CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status"


@query("run_checks", f"SELECT *, {_STATUS} FROM ({_RESULT_ROWS})")
def run_checks(spark, sf_dir):
    return Q.run_checks(table(spark, sf_dir, "events"), _event_checks(spark, sf_dir))


@query("publish_checked_mart", f"""WITH {READINGS}, s AS (SELECT DISTINCT CAST(user_id % 5 AS INTEGER) AS site, slot FROM readings
  WHERE sensor = 'view')
SELECT r_name AS site_name, CAST(slot AS DATE) AS reading_date, count(*) AS reading_cnt
FROM s JOIN region ON site = r_regionkey GROUP BY ALL""")
def publish_checked_mart(spark, sf_dir):
    """A mart that passes is published; a second version that fails leaves readers on the first."""
    name = unique_name("mart")
    mart = serving_mart(spark, sf_dir)
    members = sites(spark, sf_dir).select("site_name")

    def checks(_candidate):
        return [
            Q.not_null("site_name"), Q.not_null("reading_date"),
            Q.accepted_values("category", ["Good", "Moderate", "Unhealthy"]),
            Q.unique_combination(["site_name", "reading_date"]),
            Q.missing_members("site_name", members),
            Q.row_count_between(4, None),
        ]

    publish(mart, checks, name, shared_dir(spark))
    try:
        publish(mart.where("site_name != 'ASIA'"), checks, name, shared_dir(spark))
    except Q.ChecksFailed:
        pass
    published = spark.table(name).select("site_name", "reading_date", "reading_cnt")
    spark.sql(f"DROP TABLE {name}")  # the name only; the files stay
    return published


@query("publish_fresh_days", """SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS row_count, max(value) AS max_value
FROM events GROUP BY ALL""")
def publish_fresh_days(spark, sf_dir):
    """Freshness, build, test, publish; a week later the feed is too old and readers keep what was published."""
    name = unique_name("days")

    def build(events):
        return events.groupBy("event_type", F.to_date("ts").alias("day")).agg(
            F.count(F.lit(1)).alias("row_count"), F.max("value").alias("max_value"))

    def checks(_candidate):
        return [Q.not_null("event_type"), Q.unique_combination(["event_type", "day"]), Q.row_count_between(1, None)]

    events = table(spark, sf_dir, "events")
    publish_fresh(events, [Q.is_fresh("ts", AS_OF, 6, 48)], build, checks, name, shared_dir(spark))
    try:
        publish_fresh(events.where("event_type = 'view'"), [Q.is_fresh("ts", "2024-02-07 12:00:00", 6, 48)], build,
                      checks, name, shared_dir(spark))
    except Q.ChecksFailed:
        pass
    published = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the name only; the files stay
    return published


@query("summarise_failures", """WITH e AS (SELECT event_id, event_type, value, event_id % 4 AS s FROM events),
r AS (SELECT 'model.' || event_type || '.' || event_id AS unique_id, CASE s WHEN 0 THEN 'error' WHEN 1 THEN 'fail' END AS status,
  CASE WHEN s = 0 THEN substring('Value ' || CAST(event_id AS VARCHAR) || repeat(' is out of range', 20), 1, 200) ELSE '' END AS message
  FROM e WHERE s < 2)
SELECT *, '[' || upper(status) || '] ' || unique_id || CASE WHEN message <> '' THEN ': ' || message ELSE '' END AS line FROM r""")
def summarise_failures(spark, sf_dir):
    """Run-result documents with a failed or passed entry per reading."""
    kind = F.col("event_id") % 4
    status = F.when(kind == 0, "error").when(kind == 1, "fail").when(kind == 2, "warn").otherwise("success")
    message = F.when(kind == 0, F.concat(F.lit("Value "), F.col("event_id").cast("string"),
                                         F.expr("repeat(' is out of range', 20)"), F.lit("  "))).when(kind == 1, "  ")
    entry = F.struct(F.concat_ws(".", F.lit("model"), "event_type", "event_id").alias("unique_id"),
                     status.alias("status"), message.alias("message"))
    path = scratch_path(spark, "run-results")
    documents = table(spark, sf_dir, "events").select(F.array(entry).alias("results"))
    documents.write.json(path)
    schema = "results array<struct<unique_id: string, status: string, message: string>>"
    return Q.summarise_failures(spark.read.schema(schema).json(path))
