"""Quality classifier: Naive Bayes support vectors over n-gram indicators.

Each text becomes a set of n-grams that occur in it: byte trigrams, and runs
of word shapes (how a word's length and its repetition of earlier words look),
all hashed to a fixed number of slots. Indicators are scaled by the log ratio
of their smoothed counts in the two classes, and a linear hinge-loss model is
fitted to them by dual coordinate descent. Margins become probabilities by a
logistic fit on labelled rows kept out of the descent.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bound_batches, fit_platt, fold, lists, sigmoid, strings, training_sample

TRIGRAM_SLOTS = 1 << 16
SHAPES = 9
SHAPE_RUN = 4
LEVELS = 32
SLOTS = TRIGRAM_SLOTS + SHAPES**SHAPE_RUN + LEVELS

LEFT_OUT = (4, 2)  # rows whose CRC32 fold modulo 4 is 2 are never learnt from
TRAINING_ROWS = 8_000
TRAINING_BYTES = 64 << 20
THRESHOLD = 0.7


def indicators(text: str) -> np.ndarray:
    """Sorted slots of the n-grams that occur in the whole text; none for an empty text."""
    raw = text.encode()
    seen = np.zeros(SLOTS, bool)
    codes = np.frombuffer(raw, np.uint8)
    for k in range(0, max(0, len(codes) - 2), 1 << 20):  # blocks bound the memory of very long texts
        b = codes[k:k + (1 << 20) + 2].astype(np.uint32)
        triple = b[:-2] << np.uint32(16) | b[1:-1] << np.uint32(8) | b[2:]
        seen[(triple * np.uint32(2654435761)) >> np.uint32(16)] = True
    words = raw.split()
    if words:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        marks = np.fromiter(map(zlib.crc32, words), np.int64, len(words))
        echo = np.zeros(len(words), np.int64)
        for back in (4, 3, 2):
            echo[back:][marks[back:] == marks[:-back]] = 1
        echo[1:][marks[1:] == marks[:-1]] = 2
        shape = 3 * echo + (lengths > 3) + (lengths > 8)
        padded = np.concatenate([np.zeros(SHAPE_RUN - 1, np.int64), shape])
        run = np.zeros(len(words), np.int64)
        for k in range(SHAPE_RUN):
            run = run * SHAPES + padded[k:k + len(words)]
        seen[TRIGRAM_SLOTS + run] = True
        fresh = len(np.unique(marks)) / len(words)
        level = int((LEVELS // 2 - 1) * fresh)
        echoed = int((LEVELS // 2 - 1) * (echo == 2).mean())
        seen[SLOTS - LEVELS:SLOTS - LEVELS + level + 1] = True
        seen[SLOTS - LEVELS // 2:SLOTS - LEVELS // 2 + echoed + 1] = True
    return np.flatnonzero(seen)


def indicator_column(text: Column) -> Column:
    @F.arrow_udf("array<int>")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([indicators(t).astype(np.int32) for t in strings(batch)], pa.list_(pa.int32()))

    return of(text)


@dataclass
class QualityModel:
    """Weights of the slots (a fixed number), bias, and the logistic map to probabilities."""

    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def probability(self, text: str) -> float:
        margin = float(self.weights[indicators(text)].sum()) + self.bias
        return float(sigmoid(np.array(self.slope * margin + self.offset)))


def log_count_ratio(rows: list[np.ndarray], positive: np.ndarray, smoothing: float = 1.0) -> np.ndarray:
    """Per slot the log ratio of its smoothed, normalised counts in positive and negative rows."""
    counts = np.full((2, SLOTS), smoothing)
    for slots, label in zip(rows, positive):
        counts[int(label), slots] += 1
    return np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())


def dual_coordinate_descent(
    rows: list[np.ndarray], ratio: np.ndarray, positive: np.ndarray, cost: float, epochs: int, seed: int = 7
) -> tuple[np.ndarray, float]:
    """Hinge-loss weights over indicators scaled by ``ratio``, and the bias; the scaling is folded into the weights."""
    scaled = [ratio[slots] for slots in rows]
    norms = np.array([s @ s + 1.0 for s in scaled])
    sign = np.where(positive, 1.0, -1.0)
    # each class gets the same total cost
    upper = np.where(positive, cost / max(positive.mean(), 1e-9), cost / max((~positive).mean(), 1e-9)) / 2
    alpha, weights, bias = np.zeros(len(rows)), np.zeros(SLOTS), 0.0
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in order.permutation(len(rows)):
            slots = rows[i]
            gradient = sign[i] * (weights[slots] @ scaled[i] + bias) - 1.0
            value = min(max(alpha[i] - gradient / norms[i], 0.0), upper[i])
            step = (value - alpha[i]) * sign[i]
            if step:
                weights[slots] += step * scaled[i]
                bias += step
                alpha[i] = value
                moved = max(moved, abs(step) * norms[i])
        if moved < 1e-3:
            break
    return weights * ratio, bias


def fit_quality(
    docs: DataFrame, labels: DataFrame, max_rows: int = TRAINING_ROWS, max_bytes: int = TRAINING_BYTES,
    cost: float = 0.1, epochs: int = 15,
) -> QualityModel:
    """Learn from labelled rows whose fold is not left out, at most ``max_rows`` and ``max_bytes`` of text.

    A fifth of the rows fits the logistic map. With rows of one class only, or
    none, every text gets that class's share of the labels (one half without any).
    """
    bound_batches(docs.sparkSession)
    sample = training_sample(docs, labels, "quality", *LEFT_OUT, max_rows, max_bytes)
    taken = sample.select("id", "label", indicator_column(F.col("text")).alias("slots")).toArrow()
    names = [str(i).encode() for i in taken["id"].to_pylist()]
    order = sorted(range(taken.num_rows), key=lambda n: (zlib.crc32(names[n]), names[n]))
    slots = lists(taken["slots"])
    rows = [slots[n] for n in order]
    positive = taken["label"].to_numpy()[order] == 1
    held = np.arange(len(rows)) % 5 == 4
    if len(set(positive[~held].tolist())) < 2:
        share = (positive.sum() + 1) / (len(positive) + 2)
        return QualityModel(np.zeros(SLOTS), 0.0, 1.0, float(np.log(share / (1 - share))))
    fitted = [rows[i] for i in np.flatnonzero(~held)]
    ratio = log_count_ratio(fitted, positive[~held])
    weights, bias = dual_coordinate_descent(fitted, ratio, positive[~held], cost, epochs)
    judged = np.flatnonzero(held) if len(set(positive[held].tolist())) == 2 else np.arange(len(rows))
    margins = np.array([weights[rows[i]].sum() + bias for i in judged])
    slope, offset = fit_platt(margins, positive[judged])
    return QualityModel(weights.astype(np.float32), float(bias), slope, offset)


def quality_score(text: str | Column, model: QualityModel) -> Column:
    """Probability that a text is labelled 1, from its whole text alone; null counts as empty."""

    @F.arrow_udf("double")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([model.probability(t) for t in strings(batch)], pa.float64())

    return of(text)


def score_quality(docs: DataFrame, labels: DataFrame, **fit) -> DataFrame:
    """Per row of ``docs``: ``doc_id, held_out, score, predicted``.

    Null texts score as empty ones; repeated and null ids keep their rows;
    further columns are ignored; no rows give no rows.
    """
    bound_batches(docs.sparkSession)
    model = fit_quality(docs, labels, **fit)
    scored = docs.select("doc_id", quality_score(F.col("text"), model).alias("score"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def held_out(doc_id: Column) -> Column:
    return fold(doc_id, LEFT_OUT[0]) == LEFT_OUT[1]


def drop_poor(docs: DataFrame, labels: DataFrame, learn_from: DataFrame | None = None, threshold: float = THRESHOLD,
              **fit) -> DataFrame:
    """``docs`` without the rows that score below ``threshold``, with all their columns."""
    bound_batches(docs.sparkSession)
    model = fit_quality(docs if learn_from is None else learn_from, labels, **fit)
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return packed.where(quality_score(F.col("row.text"), model) >= threshold).select("row.*")
