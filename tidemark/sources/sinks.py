"""Writing: checked appends, load stamps, materialisation, backfill, routing, publishing."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import as_of_or_now
from tidemark.operators.quality import Check, gate, run_checks, write_measured
from tidemark.session import unique_name


def stamp_load(df: DataFrame, run: str, loaded_at: str | None, required: str, upper: bool = True) -> DataFrame:
    """Rows ready to land: incomplete ones dropped, load time and run id added."""
    stamped = df.dropna(subset=[required]).withColumns({
        "loaded_at": as_of_or_now(loaded_at),
        "pipeline_run_id": F.lit(run),
    })
    return stamped.toDF(*[c.upper() for c in stamped.columns]) if upper else stamped


def append_checked(df: DataFrame, path: str, schema: str | T.StructType) -> None:
    """Append to a table of a declared schema; a frame with other columns is refused."""
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    wanted = {f.name: f.dataType for f in declared.fields}
    given = {f.name: f.dataType for f in df.schema.fields}
    if wanted != given:
        odd = sorted(set(wanted.items()) ^ set(given.items()), key=str)
        raise ValueError(f"schema differs from the declared one in {odd}")
    df.select(*declared.fieldNames()).write.mode("append").parquet(path)


def materialize(df: DataFrame, kind: str, name: str, path: str | None = None) -> DataFrame:
    """A named view, computed on use, or a stored table, computed now.

    A table lies at ``path``, or in the warehouse: it outlives the scratch folder.
    """
    spark = df.sparkSession
    if kind == "view":
        df.createOrReplaceTempView(name)
    elif kind == "table":
        writer = df.write.mode("overwrite")
        (writer.option("path", path) if path else writer).saveAsTable(name)
    else:
        raise ValueError(f"unknown kind {kind!r}; incremental tables use incremental_merge")
    return spark.table(name)


@dataclass(frozen=True)
class Env:
    """Where a target's tables live and how much of the sources it reads."""

    target: str
    root: str
    dev_days: int = 30

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{self.target}/{table}"

    def source(self, df: DataFrame, ts: str, as_of: str | None = None) -> DataFrame:
        """The source, of which ``dev`` keeps the last ``dev_days`` days only."""
        if self.target != "dev":
            return df
        today = F.to_date(as_of_or_now(as_of))
        start = F.date_sub(today, self.dev_days).cast(df.schema[ts].dataType)
        return df.where(F.col(ts) >= start)


def backfill(source: DataFrame, key: str, member, ts: str, start: str, end: str, run: str) -> DataFrame:
    """One member's rows from ``start`` through the day ``end``, stamped as a backfill."""
    kind = source.schema[ts].dataType
    first = F.lit(start).cast("date").cast(kind)
    after = F.date_add(F.lit(end).cast("date"), 1).cast(kind)
    rows = source.where((F.col(key) == member) & (F.col(ts) >= first) & (F.col(ts) < after))
    return rows.withColumn("pipeline_run_id", F.lit(f"backfill_{run}"))


def write_report(df: DataFrame, path: str, kind: str = "json", column: str | None = None) -> None:
    """Report rows as JSON lines, or one text column as text."""
    if kind == "json":
        df.write.mode("overwrite").json(path)
    elif kind == "text":
        df.select(column or df.columns[0]).write.mode("overwrite").text(path)
    else:
        raise ValueError(f"unknown kind {kind!r}")


def publish(df: DataFrame, checks: Callable[[DataFrame], Sequence[Check]], table: str, root: str) -> DataFrame:
    """Write, audit, then publish: the table moves to the new files only if no check fails.

    ``checks`` gets the frame and returns its checks: once before the write,
    for those on rows, counts and ages, which are observed while writing, and
    once with the written frame for the others. Readers of ``table`` keep the
    former files until the move, and after a failure.
    """
    spark: SparkSession = df.sparkSession
    path = f"{root.rstrip('/')}/{unique_name(table)}"
    measured = write_measured(df, path, checks(df))
    candidate = spark.read.schema(df.schema).parquet(path)
    results = run_checks(candidate, checks(candidate), measured)
    gate(results)
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
        spark.catalog.refreshTable(table)
    else:
        spark.catalog.createTable(table, path=path, source="parquet", schema=candidate.schema)
    return results


def publish_fresh(source: DataFrame, freshness: Sequence[Check], build: Callable[[DataFrame], DataFrame],
                  checks: Callable[[DataFrame], Sequence[Check]], table: str, root: str) -> DataFrame:
    """Gate the source, build, then write, audit and publish; the results of both gates.

    Nothing is built from a source that fails a ``freshness`` check.
    """
    aged = run_checks(source, freshness)
    gate(aged)
    return aged.unionByName(publish(build(source), checks, table, root))
