"""Sorts, limits and unions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import as_column


def sort_key(spec: str | Column) -> Column:
    """``'name'`` ascending or ``'-name'`` descending, NULLs counting as the highest value."""
    if not isinstance(spec, str):
        return spec
    return F.col(spec[1:]).desc_nulls_first() if spec.startswith("-") else F.col(spec).asc_nulls_last()


def sort_sql(df: DataFrame, *keys: str | Column) -> DataFrame:
    return df.orderBy(*[sort_key(k) for k in keys])


def top_k(df: DataFrame, k: int, *keys: str | Column) -> DataFrame:
    """The first k rows; end the keys with a unique column."""
    return sort_sql(df, *keys).limit(k)


def top_k_by(df: DataFrame, k: int, score: str | Column, tie_break: str) -> DataFrame:
    """The k rows with the highest score, NULL scores last."""
    return df.orderBy(as_column(score).desc_nulls_last(), F.col(tie_break)).limit(k)


def union_all(*frames: DataFrame) -> DataFrame:
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result
