"""Shared pieces for work on groups that may be very large.

A window function sends a whole group to one task. That is fine while the
largest group fits a task, which is checked here; beyond that the rows are
range-partitioned on group and order, so one group spans many partitions, and
the partitions of a group are stitched together through a small summary.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import max_group_rows, scratch_path

PART = "__part"


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read back.

    Cuts the lineage and fixes row placement, so that every later read sees the
    same partition numbers even after an executor is lost.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def group_sizes(df: DataFrame, keys: Sequence[str]) -> tuple[int, int]:
    """Rows of the largest group and rows in all, counted map-side first."""
    row = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.max("n").alias("largest"), F.sum("n").alias("total"))
        .first()
    )
    return row["largest"] or 0, row["total"] or 0


def split_by_range(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                   fits: bool = False) -> DataFrame | None:
    """None while every group fits a task, else the rows cut into ordered parts.

    The result carries the part number in ``__part``; within a group the parts
    follow ``order``. Rows that tie on group and order are told apart by a hash
    of the row, so one order value cannot fill a part; only equal rows stay
    together. With ``fits`` the caller vouches for the group size, say one row per key and day,
    and the pass that measures it is saved.
    """
    if fits:
        return None
    limit = max_group_rows(df.sparkSession)
    largest, total = group_sizes(df, keys)
    if largest <= limit:
        return None
    parts = 2 * total // limit + 1
    tie = F.xxhash64(*[F.col(f"`{c}`") for c, kind in df.dtypes if "map<" not in kind])
    cut = df.repartitionByRange(parts, *keys, *order, tie).withColumn(PART, F.spark_partition_id())
    return written(cut, "parts")


def before_part(keys: Sequence[str]):
    """Window over part summaries: all earlier parts of the same group."""
    return Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)


def join_back(df: DataFrame, summary: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Rows with the columns of their group's summary row; NULL keys match.

    The choice between a broadcast and a sort-merge join is left to the sizes
    Spark sees at run time, and a hot key is split by its skew handling.
    """
    right = summary.withColumnsRenamed({k: f"__g_{k}" for k in keys})
    condition = None
    for k in keys:
        match = df[k].eqNullSafe(right[f"__g_{k}"])
        condition = match if condition is None else condition & match
    return df.join(right, condition, how).drop(*[f"__g_{k}" for k in keys])
