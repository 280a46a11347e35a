"""The corpus pipeline: documents filtered, deduplicated, decontaminated and encoded, stage by stage.

Every stage works on all rows its predecessor kept and is written as Parquet
below the shared checkpoint folder before the next reads it. Classifiers learn
from the labelled rows of the ``documents`` table, never from the folds their
operators leave out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, quality, simhash, toxicity
from tidemark.llm.common import stored
from tidemark.llm.queries import segmentation_digests, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.drop_poor(docs, table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents"))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not judged toxic."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component, the one of the smallest id."""
    return simhash.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not contaminated by the benchmark."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of every document, checked to decode to its text."""
    return segmentation_digests(docs)


STAGES = [
    ("quality", quality_stage),
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("segmentation", encoding_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs


# trained models and 64-bit hashes are beyond SQL; tests hold each stage against a brute-force version
ORACLE_SQL = None
