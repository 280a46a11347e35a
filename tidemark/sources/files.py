"""Reading files, seeds, literal relations and generated days."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from importlib import resources

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import blank_to_null

NULL_TOKENS = ("NULL", "null", "")

# Schemas of the bundled seeds (fixed reference data, a few rows each).
SEED_SCHEMAS = {
    "cities": "city_name string, country string, latitude double, longitude double",
    "weather_codes": "code_value int, description string, category string, severity string",
}


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType | None = None, sep: str = ",",
             null_tokens: Sequence[str] = NULL_TOKENS, header: bool = True) -> DataFrame:
    """CSV with a declared schema: fields trimmed, NULL tokens blanked, then cast.

    A field that does not fit its type becomes NULL. Without a schema the types
    are inferred, which reads the file twice.
    """
    reader = spark.read.option("sep", sep).option("header", header)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    raw = reader.option("enforceSchema", True).schema(text).csv(path)
    return raw.select(*[
        blank_to_null(f.name, null_tokens).try_cast(f.dataType).alias(f.name) for f in schema.fields
    ])


def inline(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A literal relation.

    Built from literal columns, so that Spark knows how small it is and
    broadcasts it without shuffling the other side of a join.
    """
    fields = T.StructType.fromDDL(schema).fields
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for f, v in zip(fields, row, strict=True)])
        for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))


def load_seed(spark: SparkSession, name: str) -> DataFrame:
    """A bundled seed as a literal relation, so that executors need no file."""
    names = T.StructType.fromDDL(SEED_SCHEMAS[name]).fieldNames()
    with resources.files("tidemark.sources").joinpath("seeds", f"{name}.csv").open() as f:
        lines = csv.DictReader(line for line in f if not line.startswith("#"))
        rows = [tuple(line[c] for c in names) for line in lines]
    return inline(spark, rows, SEED_SCHEMAS[name])


def date_spine(spark: SparkSession, start: str, n: int, name: str = "day") -> DataFrame:
    """n consecutive days."""
    return spark.range(n).select(F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias(name))


def days_covered(df: DataFrame, ts: str, name: str = "day") -> DataFrame:
    """Every day from the first to the last timestamp of a table."""
    bounds = df.agg(F.min(F.to_date(ts)).alias("lo"), F.max(F.to_date(ts)).alias("hi"))
    return bounds.select(F.explode(F.sequence("lo", "hi")).alias(name))


def run_sql(spark: SparkSession, query: str, **tables: DataFrame) -> DataFrame:
    """A query over catalog tables and the given frames, named as ``{name}``."""
    return spark.sql(query, **tables)
