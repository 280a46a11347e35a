"""Quartile bucket digests: similar texts have similar fingerprints of fixed length.

Byte triplets are hashed to buckets and counted; each bucket is written as the
quartile its count falls in, beside the length and the relations of the
quartile limits. Two digests are compared with a bounded difference score.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import bound_batches, stored

BUCKETS = 256
# steps of the length code: one step is a factor of 1.1
LENGTH_BASE = 1.1
# difference of two quartile codes that are 0, 1, 2 or 3 apart
CODE_COST = np.array([0, 1, 3, 6])
MAX_LENGTH_COST = 32
MAX_RATIO_COST = 16
MAX_DIFFERENCE = BUCKETS * int(CODE_COST[-1]) + MAX_LENGTH_COST + 2 * MAX_RATIO_COST
_BLOCK = 1 << 20


def bucket_counts(raw: bytes) -> np.ndarray:
    """How many of the byte triplets of ``raw`` fall in each bucket."""
    codes, counts = np.frombuffer(raw, np.uint8), np.zeros(BUCKETS, np.int64)
    for k in range(0, max(0, len(codes) - 2), _BLOCK):
        b = codes[k:k + _BLOCK + 2].astype(np.uint32)
        triple = b[:-2] << np.uint32(16) | b[1:-1] << np.uint32(8) | b[2:]
        counts += np.bincount(triple * np.uint32(2654435761) >> np.uint32(24), minlength=BUCKETS)
    return counts


def digest(text: str) -> str:
    """Hex digits: length code, two quartile ratios, then two bits per bucket.

    Equal texts have equal digests. A text of fewer than three bytes has no
    triplets: all its buckets are in the first quartile.
    """
    raw = text.encode()
    counts = bucket_counts(raw)
    q1, q2, q3 = (int(np.sort(counts)[BUCKETS * k // 4 - 1]) for k in (1, 2, 3))
    length = min(255, round(math.log(1 + len(raw), LENGTH_BASE)))
    ratios = [15 * q // q3 if q3 else 0 for q in (q1, q2)]
    codes = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    packed = codes.reshape(-1, 4) @ np.array([64, 16, 4, 1], np.uint8)
    return f"{length:02x}{ratios[0]:x}{ratios[1]:x}{packed.astype(np.uint8).tobytes().hex()}"


def difference(a: str, b: str) -> int:
    """0 for equal digests, at most ``MAX_DIFFERENCE``."""
    length = min(abs(int(a[:2], 16) - int(b[:2], 16)), MAX_LENGTH_COST)
    ratios = sum(abs(int(a[k], 16) - int(b[k], 16)) for k in (2, 3))
    apart = np.abs(_codes(a) - _codes(b))
    return int(length + ratios + CODE_COST[apart].sum())


def _codes(value: str) -> np.ndarray:
    packed = np.frombuffer(bytes.fromhex(value[4:]), np.uint8).astype(np.int64)
    return np.stack([packed >> 6, packed >> 4 & 3, packed >> 2 & 3, packed & 3], axis=1).ravel()


def likeness(a: str, b: str) -> float:
    """1 for equal digests, falling with the difference to 0 at its bound."""
    return 1.0 - difference(a, b) / MAX_DIFFERENCE


def edited(text: str, following: str) -> str:
    """``text`` with its last half (rounded down) replaced by the first as many characters of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


RESULT = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")
ROW = f"part int, {RESULT}, head string, tail string"
_NAMES = [field.split()[0] for field in RESULT.split(", ")]
_KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
RUN = 4096  # parts whose successors are found together


def _compared(ident: int | None, text: str, print_: str, following: str, print_next: str) -> tuple:
    other = edited(text, following)
    print_other = digest(other)
    return (ident, len(text), hashlib.sha256(other.encode()).hexdigest(), print_, print_other,
            likeness(print_, print_other), likeness(print_, print_next))


def _within_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of a part's rows in order, each beside the one that follows; last a row with the part's first and last text.

    Rows stream: two texts and the part's first are held.
    """
    part = TaskContext.get().partitionId()
    held = head = None
    for batch in batches:
        made = []
        for ident, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            print_ = digest(text)
            if held is None:
                head = text
            else:
                made.append(_compared(*held, text, print_))
            held = (ident, text, print_)
        if made:
            columns = [pa.array([None] * len(made), pa.int32()), *(pa.array(c, k) for c, k in zip(zip(*made), _KINDS))]
            yield pa.RecordBatch.from_arrays([*columns, *[pa.nulls(len(made), pa.string())] * 2], names=["part", *_NAMES, "head", "tail"])
    if held is not None:
        columns = [pa.array([part], pa.int32()), pa.array([held[0]], pa.int64()), *(pa.nulls(1, k) for k in _KINDS[1:])]
        yield pa.RecordBatch.from_arrays([*columns, pa.array([head], pa.string()), pa.array([held[1]], pa.string())],
                                         names=["part", *_NAMES, "head", "tail"])


def _between_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of the last rows of parts, each beside the first text of the part that follows."""
    for batch in batches:
        made = [_compared(ident, tail, digest(tail), head, digest(head))
                for ident, tail, head in zip(*(batch.column(k).to_pylist() for k in range(3)))]
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*made), _KINDS)], names=_NAMES)


def successors(parts: DataFrame, run: int = RUN) -> DataFrame:
    """Per number in ``part`` the next larger one as ``following``; the smallest for the largest.

    Numbers are looked at in runs of ``run``; a run's last one is followed by
    the first of the next run that has any, so a window holds ``run`` numbers or
    one number of each run.
    """
    placed = parts.select("part", F.floor(F.col("part") / run).alias("run"))
    over_runs = Window.orderBy("run")
    firsts = placed.groupBy("run").agg(F.min("part").alias("first")).select(
        "run", F.lead("first").over(over_runs).alias("next_run"),
        F.min("first").over(Window.partitionBy()).alias("smallest"))
    inner = F.lead("part").over(Window.partitionBy("run").orderBy("part"))
    return placed.select("run", "part", inner.alias("inner")).join(firsts, "run").select(
        "part", F.coalesce("inner", "next_run", "smallest").alias("following"))


def in_order(docs: DataFrame, part_bytes: int) -> DataFrame:
    """``doc_id, text`` in partitions of about ``part_bytes``: ordered in each and from one to the next."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(math.ceil(size / part_bytes), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    text = F.coalesce("text", F.lit(""))
    # among equal rows the order does not matter, so the split they came from may spread them
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"),
                       F.md5(text.cast("binary")).alias("mark"), F.spark_partition_id().alias("split"))
    order = [F.col("doc_id").asc_nulls_first(), "mark", "split"]
    return rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "text")


def compare_with_edited(docs: DataFrame, part_bytes: int = 16 << 20) -> DataFrame:
    """Each document's digest beside those of its edited text and of the next document.

    The next document is the one of the following ``doc_id``; the first
    follows the last, and a single document follows itself. The edited text
    replaces the last half of the characters by the first as many (or all) of
    the next document. Null texts count as empty. Null ids come first and
    repeated ids stand in the order of their texts' MD5, so equal rows
    follow each other. No rows give no rows; further columns are ignored.

    Rows are shuffled once, by Spark's ranges over id, text hash and input
    split, so that neither a repeated id nor a repeated row binds its rows to
    one task. Parts stream. Their first and last rows, one pair per part of
    about ``part_bytes`` of text, meet in a join on the part's number. Results
    are a written table below the checkpoint folder.
    """
    bound_batches(docs.sparkSession)
    found = stored(in_order(docs, part_bytes).mapInArrow(_within_part, ROW), "digests")
    edges = found.where("part IS NOT NULL")
    heads = edges.select(F.col("part").alias("following"), "head")
    last = edges.select("part", "doc_id", "tail").join(successors(edges.select("part")), "part").join(heads, "following")
    return found.where("part IS NULL").select(*_NAMES).unionByName(
        last.select("doc_id", "tail", "head").mapInArrow(_between_parts, RESULT))
