"""Sources and sinks: files written from the test tables and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.plans.bindings import READINGS, readings, table
from tidemark.plans.registry import Family
from tidemark.session import scratch_path, unique_name
from tidemark.sources import files, payloads, sinks

FAMILY = Family()
query = FAMILY.query


def _csv_of_orders(spark, sf_dir):
    """Orders as padded CSV text with the NULL tokens mixed in."""
    k = F.col("o_orderkey") % 5
    dirty = F.when(k == 0, "NULL").when(k == 1, "null").when(k == 2, "").otherwise(
        F.concat(F.lit("  "), F.col("o_orderpriority"), F.lit(" ")))
    price = F.when(k == 3, "n/a").otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string"))
    path = scratch_path(spark, "csv")
    table(spark, sf_dir, "orders").select(
        "o_orderkey", dirty.alias("priority"), price.alias("price"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("ordered_at"),
    ).write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False).csv(path)
    return path


@query("read_csv_declared", """SELECT o_orderkey, CASE WHEN o_orderkey % 5 > 2 THEN o_orderpriority END AS priority,
  CASE WHEN o_orderkey % 5 <> 3 THEN o_totalprice END AS price, o_orderdate AS ordered_at FROM orders""")
def read_csv_declared(spark, sf_dir):
    return files.read_csv(spark, _csv_of_orders(spark, sf_dir),
                          "o_orderkey bigint, priority string, price double, ordered_at timestamp_ntz")


@query("read_csv_inferred", """SELECT l_returnflag, CAST(l_linenumber AS INTEGER) AS l_linenumber, count(*) AS n_lines,
  round(sum(l_quantity), 2) AS quantity FROM lineitem GROUP BY ALL""")
def read_csv_inferred(spark, sf_dir):
    path = scratch_path(spark, "csv")
    table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linenumber", "l_quantity").write.option(
        "header", True).csv(path)
    lines = files.read_csv(spark, path)
    return lines.groupBy("l_returnflag", "l_linenumber").agg(
        F.count(F.lit(1)).alias("n_lines"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


@query("seed_lookup", f"""WITH {READINGS}, cities AS (SELECT * FROM (VALUES
  (0, 'Mumbai', 19.0760), (1, 'Bangalore', 12.9716), (2, 'Delhi', 28.7041), (3, 'Chennai', 13.0827)) AS v(i, city_name, latitude))
SELECT city_name, CAST(latitude AS DOUBLE) AS latitude, count(*) AS n_readings FROM readings JOIN cities ON user_id % 4 = i GROUP BY ALL""")
def seed_lookup(spark, sf_dir):
    """Readings spread over the seeded members."""
    seed = files.load_seed(spark, "cities").select("city_name", "latitude")
    names = ["Mumbai", "Bangalore", "Delhi", "Chennai"]
    member = F.element_at(F.array(*[F.lit(n) for n in names]), (F.col("user_id") % 4 + 1).cast("int"))
    rows = readings(spark, sf_dir).select(member.alias("city_name"))
    return rows.join(seed, "city_name").groupBy("city_name", "latitude").agg(F.count(F.lit(1)).alias("n_readings"))


@query("literal_relation", """SELECT o_orderpriority, v.weight, count(*) AS n_orders FROM orders JOIN (VALUES
  ('1-URGENT', 5), ('2-HIGH', 4), ('3-MEDIUM', 3)) AS v(o_orderpriority, weight) USING (o_orderpriority) GROUP BY ALL""")
def literal_relation(spark, sf_dir):
    weights = files.inline(spark, [("1-URGENT", 5), ("2-HIGH", 4), ("3-MEDIUM", 3)], "o_orderpriority string, weight int")
    return table(spark, sf_dir, "orders").join(weights, "o_orderpriority").groupBy("o_orderpriority", "weight").agg(
        F.count(F.lit(1)).alias("n_orders"))


FIELDS = {"temperature_2m": ("value", "double"), "weather_code": ("code", "int")}


def _payloads(spark, sf_dir):
    """One JSON payload of three hourly readings per order, some of them unusable."""
    times = F.transform(F.sequence(F.lit(0), F.lit(2)), lambda h: F.date_format(
        F.expr("o_orderdate") + F.make_dt_interval(hours=h), "yyyy-MM-dd'T'HH:mm"))
    values = F.array("o_totalprice", F.lit(None).cast("double"), F.col("o_totalprice") * 2)
    codes = F.array(*[(F.col("o_custkey") + i).cast("int") for i in range(3)])
    kind = F.col("o_orderkey") % 10
    given = F.when(kind == 2, F.slice(values, 1, 1)).otherwise(values)
    hourly = F.struct(times.alias("time"), given.alias("temperature_2m"), codes.alias("weather_code"))
    body = F.when(kind == 0, '{"hourly": {}}').when(kind == 1, '{"hourly": {"time"').otherwise(
        F.to_json(F.struct(hourly.alias("hourly")), {"ignoreNullFields": "false"}))
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", body.alias("payload"))


@query("flatten_payloads", """SELECT o_orderkey, o_orderpriority, o_orderdate + h * INTERVAL 1 HOUR AS recorded_at,
  CASE h WHEN 0 THEN o_totalprice WHEN 2 THEN o_totalprice * 2 END AS value, CAST(o_custkey + h AS INTEGER) AS code
FROM orders CROSS JOIN (VALUES (0), (1), (2)) AS v(h) WHERE o_orderkey % 10 > 2""")
def flatten_payloads(spark, sf_dir):
    ok, _ = payloads.ingest_payloads(_payloads(spark, sf_dir), "payload", FIELDS)
    return ok


@query("rejected_payloads", """SELECT o_orderkey, o_orderpriority,
  CASE WHEN o_orderkey % 10 = 2 THEN 'array lengths differ' ELSE 'no hourly data' END AS reason
FROM orders WHERE o_orderkey % 10 < 3""")
def rejected_payloads(spark, sf_dir):
    _, rejects = payloads.ingest_payloads(_payloads(spark, sf_dir), "payload", FIELDS)
    return rejects.drop("payload")


@query("rejected_times", """SELECT o_orderkey, 'bad time' AS reason FROM orders WHERE o_orderkey % 7 = 0""")
def rejected_times(spark, sf_dir):
    """Payloads of which one time is no time are set aside whole."""
    shown = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm")
    second = F.when(F.col("o_orderkey") % 7 == 0, "late").otherwise(shown)
    value = F.col("o_totalprice")
    hourly = F.struct(F.array(shown, second).alias("time"), F.array(value, value).alias("temperature_2m"),
                      F.array("o_custkey", "o_custkey").alias("weather_code"))
    bodies = table(spark, sf_dir, "orders").select("o_orderkey", F.to_json(F.struct(hourly.alias("hourly"))).alias("payload"))
    _, rejects = payloads.ingest_payloads(bodies, "payload", FIELDS)
    return rejects.drop("payload")


@query("query_text_scan", """SELECT n_name, count(*) AS n_customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL""")
def query_text_scan(spark, sf_dir):
    return files.run_sql(
        spark, "SELECT n_name, count(*) AS n_customers FROM {c} JOIN {n} ON c_nationkey = n_nationkey GROUP BY n_name",
        c=table(spark, sf_dir, "customer"), n=table(spark, sf_dir, "nation"))


_STAMPED = """SELECT event_id AS "EVENT_ID", sensor AS "SENSOR", value AS "VALUE", TIMESTAMP '2024-02-01 06:00:00' AS "LOADED_AT",
  '20240201_060000' AS "PIPELINE_RUN_ID" FROM readings WHERE code >= 5"""


def _prepared(spark, sf_dir):
    rows = readings(spark, sf_dir).select("event_id", "sensor", F.when(F.col("code") >= 5, F.col("value")).alias("value"))
    return sinks.stamp_load(rows, "20240201_060000", "2024-02-01 06:00:00", "value")


@query("stamp_load", f"WITH {READINGS} {_STAMPED}")
def stamp_load(spark, sf_dir):
    return _prepared(spark, sf_dir)


@query("append_checked", f"WITH {READINGS} {_STAMPED} UNION ALL {_STAMPED}")
def append_checked(spark, sf_dir):
    """Two appends to a declared schema; a frame that differs is refused in between."""
    schema = "EVENT_ID bigint, SENSOR string, VALUE double, LOADED_AT timestamp_ntz, PIPELINE_RUN_ID string"
    path, rows = scratch_path(spark, "raw"), _prepared(spark, sf_dir)
    sinks.append_checked(rows, path, schema)
    try:
        sinks.append_checked(rows.withColumn("EXTRA", F.lit(1)), path, schema)
    except ValueError:
        pass
    sinks.append_checked(rows, path, schema)
    return spark.read.parquet(path)


@query("materialised_view", """SELECT event_type, count(*) AS n FROM events GROUP BY ALL""")
def materialised_view(spark, sf_dir):
    name = unique_name("event_counts")
    counts = table(spark, sf_dir, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return sinks.materialize(counts, "view", name)


@query("materialised_table", """SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY ALL""")
def materialised_table(spark, sf_dir):
    name = unique_name("daily_counts")
    counts = table(spark, sf_dir, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("n"))
    stored = sinks.materialize(counts, "table", name, scratch_path(spark, name))
    spark.sql(f"DROP TABLE {name}")  # the name only; the files stay
    return stored


@query("target_routing", """SELECT 'dev' AS target, count(*) AS n_rows, min(ts) AS first_ts FROM events WHERE ts >= TIMESTAMP '2024-01-16'
UNION ALL SELECT 'prod', count(*), min(ts) FROM events""")
def target_routing(spark, sf_dir):
    """The development target reads the last thirty days only."""
    events = table(spark, sf_dir, "events")
    reports = []
    for target in ("dev", "prod"):
        env = sinks.Env(target, scratch_path(spark, "env"))
        rows = env.source(events, "ts", "2024-02-15 08:00:00")
        rows.agg(F.count(F.lit(1)).alias("n_rows"), F.min("ts").alias("first_ts")).write.parquet(env.path("report"))
        reports.append(spark.read.parquet(env.path("report")).select(F.lit(target).alias("target"), "n_rows", "first_ts"))
    return reports[0].unionByName(reports[1])


@query("backfill", """SELECT event_id, ts, value, 'backfill_20240301_000000' AS pipeline_run_id FROM events
WHERE event_type = 'view' AND ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-13'""")
def backfill(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "ts", "value", "event_type")
    return sinks.backfill(rows, "event_type", "view", "ts", "2024-01-05", "2024-01-12", "20240301_000000").drop("event_type")


@query("report_files", """SELECT c_custkey, c_name, 'Balance of ' || c_name AS line FROM customer""")
def report_files(spark, sf_dir):
    """Rows written as JSON and a column as text, both read back."""
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", F.concat(F.lit("Balance of "), "c_name").alias("line"))
    as_json, as_text = scratch_path(spark, "report"), scratch_path(spark, "report")
    sinks.write_report(rows, as_json)
    sinks.write_report(rows, as_text, "text", "line")
    parsed = spark.read.schema("c_custkey bigint, c_name string").json(as_json)
    lines = spark.read.text(as_text).select(F.col("value").alias("line"))
    return parsed.join(lines, F.concat(F.lit("Balance of "), parsed["c_name"]) == lines["line"])
