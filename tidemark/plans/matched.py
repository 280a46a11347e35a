"""Queries that match tables: dimension joins, lookups, self and anti joins."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions.columns import rounded_mean
from tidemark.operators import joins as J
from tidemark.plans.bindings import (
    HOURLY, LOCATED, READINGS, SITE_FACTS, SITE_HISTORY, hourly, located, mean_sql, newest_first, readings,
    site_history, site_readings, table,
)
from tidemark.plans.registry import Family
from tidemark.sources.files import inline, load_seed

FAMILY = Family()
query = FAMILY.query

# The code dimension's seed with its numbered keys, as the second engine's literal.
CODES = """codes AS (SELECT * FROM (VALUES
  (1, 0, 'Clear sky', 'Clear', 'Low'), (2, 1, 'Mainly clear', 'Clear', 'Low'), (3, 2, 'Partly cloudy', 'Cloudy', 'Low'),
  (4, 3, 'Overcast', 'Cloudy', 'Low'), (5, 45, 'Foggy', 'Fog', 'Medium'), (6, 51, 'Light drizzle', 'Rain', 'Low'),
  (7, 61, 'Slight rain', 'Rain', 'Medium'), (8, 80, 'Slight rain showers', 'Rain', 'Medium'),
  (9, 95, 'Thunderstorm', 'Thunderstorm', 'High')) AS v(code_sk, code_value, description, category, severity))"""


def codes(spark):
    """The seeded codes, keyed by their rank: a handful of fixed rows."""
    seed = load_seed(spark, "weather_codes")
    return seed.withColumn("code_sk", F.row_number().over(Window.orderBy("code_value")))


@query("join_fact_to_dimension", """SELECT o_orderkey, c_name, c_mktsegment, n_name, o_totalprice
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""")
def join_fact_to_dimension(spark, sf_dir):
    star = J.star_join(table(spark, sf_dir, "orders"), [
        (table(spark, sf_dir, "customer"), {"o_custkey": "c_custkey"}),
        (table(spark, sf_dir, "nation"), {"c_nationkey": "n_nationkey"}),
    ])
    return star.select("o_orderkey", "c_name", "c_mktsegment", "n_name", "o_totalprice")


@query("join_current_version", f"""WITH {LOCATED}, {SITE_HISTORY}
SELECT event_id, site_sk, site_name, country, value FROM located JOIN site_history USING (site_nk) WHERE is_current""")
def join_current_version(spark, sf_dir):
    joined = J.join_current(located(spark, sf_dir), site_history(spark, sf_dir), {"site_nk": "site_nk"})
    return joined.select("event_id", "site_sk", "site_name", "country", "value")


@query("lookup_with_default", f"""WITH {READINGS}, {CODES}
SELECT event_id, code, coalesce(code_sk, 1) AS code_sk FROM readings LEFT JOIN codes ON code = code_value""")
def lookup_with_default(spark, sf_dir):
    rows = readings(spark, sf_dir).select("event_id", "code")
    return J.lookup_key(rows, codes(spark), {"code": "code_value"}, "code_sk", 1)


@query("coverage_count", f"""WITH {READINGS}, {CODES}
SELECT code_value, description, category, count(event_id) AS times_observed
FROM codes LEFT JOIN readings ON code = code_value AND sensor = 'error' AND value > 100
GROUP BY code_value, description, category""")
def coverage_count(spark, sf_dir):
    """Codes never observed keep a zero."""
    rows = readings(spark, sf_dir).where("sensor = 'error' and value > 100")
    dim = load_seed(spark, "weather_codes").select("code_value", "description", "category")
    return J.coverage_count(dim, rows, {"code_value": "code"}, "times_observed")


@query("customer_order_counts", """SELECT c_custkey, c_mktsegment, count(o_orderkey) AS n_orders
FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'P' GROUP BY ALL""")
def customer_order_counts(spark, sf_dir):
    dim = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    orders = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'")
    return J.coverage_count(dim, orders, {"c_custkey": "o_custkey"}, "n_orders")


@query("join_on_time_bucket", f"""WITH {SITE_FACTS}
SELECT w.site, w.recorded_at, w.value, a.value AS second_value
FROM first_fact w LEFT JOIN second_fact a ON w.site = a.site AND w.recorded_at = a.recorded_at""")
def join_on_time_bucket(spark, sf_dir):
    first = site_readings(spark, sf_dir, "view").select("site", "recorded_at", "value")
    second = site_readings(spark, sf_dir, "purchase").select(
        "site", F.col("recorded_at").alias("at"), F.col("value").alias("second_value"))
    return J.join_on_time_bucket(first, second, ["site"], "recorded_at", "at", "left").drop("at")


@query("star_revenue", f"""SELECT n_name, r_name, p_brand, CAST(year(o_orderdate) AS INTEGER) AS order_year,
  {mean_sql('l_extendedprice')} AS mean_price, count(*) AS n_lines
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""")
def star_revenue(spark, sf_dir):
    star = J.star_join(table(spark, sf_dir, "lineitem"), [
        (table(spark, sf_dir, "orders"), {"l_orderkey": "o_orderkey"}),
        (table(spark, sf_dir, "part"), {"l_partkey": "p_partkey"}),
        (table(spark, sf_dir, "supplier"), {"l_suppkey": "s_suppkey"}),
        (table(spark, sf_dir, "nation"), {"s_nationkey": "n_nationkey"}),
        (table(spark, sf_dir, "region"), {"n_regionkey": "r_regionkey"}),
    ])
    return star.groupBy("n_name", "r_name", "p_brand", F.year("o_orderdate").alias("order_year")).agg(
        rounded_mean("l_extendedprice", scale=2).alias("mean_price"), F.count(F.lit(1)).alias("n_lines"))


@query("compare_to_baseline", f"""WITH {HOURLY}
SELECT a.slot, a.sensor, a.value, b.value AS click_value, round(a.value - b.value + 1e-9, 2) AS difference
FROM hourly a JOIN hourly b ON a.slot = b.slot AND b.sensor = 'click' WHERE a.sensor <> 'click'""")
def compare_to_baseline(spark, sf_dir):
    rows = hourly(spark, sf_dir).select("slot", "sensor", "value", "ts", "event_id")
    compared = J.compare_to_baseline(rows, "sensor", "click", "slot", "value", newest_first(), "click_value")
    return compared.select("slot", "sensor", "value", "click_value", "difference")


@query("missing_members", f"""WITH {READINGS}
SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM readings WHERE value > 200)""")
def missing_members(spark, sf_dir):
    expected = table(spark, sf_dir, "customer").select("c_custkey")
    return J.missing_members(readings(spark, sf_dir).where("value > 200"), "user_id", expected)


@query("not_exists", """SELECT o_orderkey, o_custkey FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')""")
def not_exists(spark, sf_dir):
    returned = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return J.rows_absent(orders, returned, {"o_orderkey": "l_orderkey"})


@query("not_in_null_aware", f"""WITH {READINGS}
SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM readings WHERE code < 20)""")
def not_in_null_aware(spark, sf_dir):
    seen = readings(spark, sf_dir).where("code < 20")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return J.rows_absent(customers, seen, {"c_custkey": "user_id"}, null_aware=True)


@query("not_in_with_null", f"""WITH {READINGS}, seen AS (SELECT CASE WHEN code = 0 THEN NULL ELSE user_id END AS u FROM readings)
SELECT count(*) AS n_customers FROM customer WHERE c_custkey NOT IN (SELECT u FROM seen)""")
def not_in_with_null(spark, sf_dir):
    """One NULL among the excluded keys leaves nothing."""
    seen = readings(spark, sf_dir).select(F.when(F.col("code") != 0, F.col("user_id")).alias("u"))
    customers = table(spark, sf_dir, "customer").select("c_custkey")
    absent = J.rows_absent(customers, seen, {"c_custkey": "u"}, null_aware=True)
    return absent.agg(F.count(F.lit(1)).alias("n_customers"))


@query("enrich_from_literal", """SELECT o_orderkey, o_orderstatus, v.status_name
FROM orders LEFT JOIN (VALUES ('F', 'finished'), ('O', 'open')) AS v(o_orderstatus, status_name) USING (o_orderstatus)""")
def enrich_from_literal(spark, sf_dir):
    """One status has no entry and stays NULL."""
    names = inline(spark, [("F", "finished"), ("O", "open")], "o_orderstatus string, status_name string")
    return J.enrich(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), names, "o_orderstatus")


@query("unseen_then_seen", f"""WITH {LOCATED}
SELECT CAST(n_nationkey AS INTEGER) AS n_nationkey, n_name, count(event_id) AS n_peaks
FROM nation LEFT JOIN located ON site_nk = n_nationkey AND value > 300 GROUP BY ALL""")
def unseen_then_seen(spark, sf_dir):
    dim = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return J.coverage_count(dim, located(spark, sf_dir).where("value > 300"), {"n_nationkey": "site_nk"}, "n_peaks")
