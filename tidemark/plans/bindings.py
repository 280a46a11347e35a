"""The modelling roles, bound to the test tables.

``events`` are the readings: ``event_type`` is the sensor, ``props.k`` the code
and second measure. ``user_id`` modulo 5 or 25 is the site, whose dimensions
are ``region`` and ``nation``.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import hour_floor, surrogate_key
from tidemark.operators.joins import stored_by_slot
from tidemark.operators.windows import latest_per_key
from tidemark.session import scratch_path, unique_name

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_state(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Length, number of files and time of a stored table: another value after any change of its files."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    whole = files.getContentSummary(path)
    return f"{whole.getLength()}-{whole.getFileCount()}-{files.getFileStatus(path).getModificationTime()}-{zlib.crc32(path.toString().encode())}"


def newest_first() -> list[Column]:
    return [F.col("ts").desc_nulls_last(), F.col("event_id").desc_nulls_last()]


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw readings: several per sensor and hour."""
    e = table(spark, sf_dir, "events")
    return e.select(
        "event_id", "ts", "user_id", F.col("event_type").alias("sensor"), "value",
        F.get_json_object("props", "$.k").cast("int").alias("code"),
        hour_floor("ts").alias("slot"),
    )


READINGS = """readings AS (
  SELECT event_id, ts, user_id, event_type AS sensor, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS code,
         date_trunc('hour', ts) AS slot
  FROM events)"""


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reading per sensor and hour, the latest."""
    return latest_per_key(readings(spark, sf_dir), ["sensor", "slot"], newest_first())


HOURLY = READINGS + """,
hourly AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY sensor, slot ORDER BY ts DESC, event_id DESC) AS rn
    FROM readings) WHERE rn = 1)"""


def site_readings(spark: SparkSession, sf_dir: str, sensor: str) -> DataFrame:
    """One sensor's latest reading per site and hour, with its hash key."""
    raw = readings(spark, sf_dir).where(F.col("sensor") == sensor)
    sited = raw.withColumn("site", (F.col("user_id") % 5).cast("int"))
    kept = latest_per_key(sited, ["site", "slot"], newest_first(), F.col("value").isNotNull())
    return kept.select(
        surrogate_key(kept, ["site", "slot"]).alias("reading_sk"), "site", F.col("slot").alias("recorded_at"),
        "value", F.col("code").cast("double").alias("code"),
    )


def stored_facts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Both site facts stored by site and hour, the first with its sites' names."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    named = site_readings(spark, sf_dir, "view").join(sites(spark, sf_dir), "site")
    second = site_readings(spark, sf_dir, "purchase").select("site", "recorded_at", "value", "code")
    laid = []
    for fact in (named, second):
        name = unique_name("fact")
        laid.append(stored_by_slot(fact, name, ["site"], "recorded_at", buckets, scratch_path(spark, name)))
        spark.sql(f"DROP TABLE {name}")  # the name only; the files stay
    return laid[0], laid[1]


def _site_sql(alias: str, sensor: str) -> str:
    return f"""{alias} AS (
  SELECT md5(CAST(site AS VARCHAR) || '-' || strftime(slot, '%Y-%m-%d %H:%M:%S.%g')) AS reading_sk,
         site, slot AS recorded_at, value, CAST(code AS DOUBLE) AS code
  FROM (SELECT *, row_number() OVER (PARTITION BY site, slot ORDER BY ts DESC, event_id DESC) AS rn
        FROM (SELECT *, CAST(user_id % 5 AS INTEGER) AS site FROM readings WHERE sensor = '{sensor}'
              AND value IS NOT NULL))
  WHERE rn = 1)"""


SITE_FACTS = READINGS + ",\n" + _site_sql("first_fact", "view") + ",\n" + _site_sql("second_fact", "purchase")


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("site"), F.col("r_name").alias("site_name")
    )


def site_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as a dimension with history: a closed version and the current one of each."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    now = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        (F.col("n_nationkey") + 1).alias("site_sk"), F.col("n_nationkey").alias("site_nk"),
        F.col("n_name").alias("site_name"), F.col("r_name").alias("country"), F.lit(True).alias("is_current"),
    )
    old = now.select(
        (F.col("site_sk") + 100).alias("site_sk"), "site_nk",
        F.concat("site_name", F.lit(" (old)")).alias("site_name"), "country", F.lit(False).alias("is_current"),
    )
    return now.unionByName(old)


SITE_HISTORY = """site_history AS (
  SELECT n_nationkey + 1 AS site_sk, n_nationkey AS site_nk, n_name AS site_name, r_name AS country,
         TRUE AS is_current
  FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL
  SELECT n_nationkey + 101, n_nationkey, n_name || ' (old)', r_name, FALSE
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""


def located(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw readings with the natural key of their site, one of 25."""
    return readings(spark, sf_dir).withColumn("site_nk", (F.col("user_id") % 25).cast("int"))


LOCATED = READINGS + """,
located AS (SELECT *, CAST(user_id % 25 AS INTEGER) AS site_nk FROM readings)"""


def mean_sql(c: str, over: str = "", digits: int = 2) -> str:
    """Rounded mean of a two-decimal measure, exact before rounding."""
    return (f"round(CAST(sum(CAST({c} AS DECIMAL(18,2))){over} AS DOUBLE) / count({c}){over} + 1e-9, {digits})")


def exact_sql(c: str) -> str:
    return f"(CAST(sum(CAST({c} AS DECIMAL(18,2))) AS DOUBLE) / count({c}))"
