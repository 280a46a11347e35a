"""Toxicity by multiple-instance learning: sentence scores combined by noisy-or, learnt from document labels.

A sentence's score is a logistic function of its hashed words and word
beginnings. A document is toxic unless every sentence is not, so its
probability is one minus the product of the sentences' complements. Only
documents carry labels; the gradient of the document loss reaches each sentence
through that product.
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

SLOTS = 1 << 20
LEFT_OUT = (5, 0)  # rows whose CRC32 fold modulo 5 is 0 are never learnt from
TRAINING_ROWS = 6_000
TRAINING_BYTES = 32 << 20
MIN_EVIDENCE = 16.0  # a slot keeps weight 0 unless its likelihood ratio statistic over documents reaches this
THRESHOLD = 0.5
ENDS = b".!?\n\r"
RESULT = "score double, sentences array<struct<start: int, end: int, score: double>>"


def sentence_table() -> bytes:
    """Byte map: A-Z lowered, letters, digits and non-ASCII bytes kept, sentence ends to newlines, the rest blank."""
    table = bytearray(b" " * 256)
    for code in range(256):
        character = chr(code)
        if code >= 0x80 or "0" <= character <= "9" or "a" <= character <= "z":
            table[code] = code
        elif "A" <= character <= "Z":
            table[code] = code + 32
        elif code in ENDS:
            table[code] = 10
    return bytes(table)


TABLE = sentence_table()
PREFIXES = (4, 5)  # bytes of word beginnings
MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
MIX = np.uint64(0x9E3779B97F4A7C15)


def instances(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the words and word beginnings in each sentence of the text, each once, and their sentences' numbers."""
    raw = text.encode().translate(TABLE)
    padded = np.frombuffer(b" " + raw + b" " * 9, np.uint8)
    codes = padded[:len(raw) + 2]
    inside = (codes != 32) & (codes != 10)
    starts, ends = np.flatnonzero(~inside[:-1] & inside[1:]) + 1, np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # eight bytes from every position on
    eight = np.ndarray((len(raw) + 3,), "<u8", padded, strides=(1,))
    length = ends - starts
    head = eight[starts]
    word = (head & MASKS[np.minimum(length, 8)]) ^ (eight[np.maximum(ends - 8, starts)] & MASKS[np.minimum(length, 8)]) * MIX
    keys = [word + length.astype(np.uint64) * np.uint64(11400714819323198485)]
    sentence = np.cumsum(codes == 10)[starts]
    sentences = [sentence]
    for size in PREFIXES:
        long = length > size
        keys.append((head[long] & MASKS[size]) * np.uint64(2 * size + 1) + np.uint64(size))
        sentences.append(sentence[long])
    slots = (np.concatenate(keys) * MIX >> np.uint64(44)).astype(np.int64)
    both = np.unique(np.concatenate(sentences) * SLOTS + slots)
    return both % SLOTS, both // SLOTS


@dataclass
class ToxicityModel:
    """Weights of the slots (a fixed number), the sentence bias and the map of document log-odds to probabilities."""

    weights: np.ndarray
    bias: float
    slope: float = 1.0
    offset: float = 0.0

    def sentence_logits(self, slots: np.ndarray, sentence: np.ndarray, n: int) -> np.ndarray:
        return self.bias + np.bincount(sentence, self.weights[slots], minlength=n)[:n]

    def log_odds(self, text: str) -> float:
        slots, sentence = instances(text)
        if not len(slots):
            return noisy_or_logit(np.array([self.bias]))
        present = np.unique(sentence)
        return noisy_or_logit(self.sentence_logits(slots, sentence, int(present[-1]) + 1)[present])

    def probability(self, text: str) -> float:
        return float(sigmoid(np.array(self.slope * self.log_odds(text) + self.offset)))

    def offending(self, text: str, threshold: float = 0.5) -> list[dict]:
        """Character ranges and scores of the sentences that alone reach ``threshold``."""
        slots, sentence = instances(text)
        if not len(slots):
            return []
        scores = sigmoid(self.slope * self.sentence_logits(slots, sentence, int(sentence.max()) + 1) + self.offset)
        scores[np.setdiff1d(np.arange(len(scores)), sentence)] = 0.0
        if not (scores >= threshold).any():
            return []
        raw = text.encode()
        mapped = raw.translate(TABLE)
        character = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
        found, at = [], 0
        for score, piece in zip(scores, mapped.split(b"\n")):
            if score >= threshold:
                start, end = at + len(piece) - len(piece.lstrip(b" ")), at + len(piece.rstrip(b" "))
                found.append({"start": int(character[start]), "end": int(character[end]), "score": float(score)})
            at += len(piece) + 1
        return found


def noisy_or_logit(logits: np.ndarray) -> float:
    """Log-odds of one minus the product of the complements, without loss for long texts."""
    calm = -np.logaddexp(0.0, logits).sum()  # log of the product
    return float(np.log(-np.expm1(min(calm, -1e-300))) - calm) if calm < 0 else -700.0


def telling_slots(bags: list[tuple[np.ndarray, np.ndarray]], toxic: np.ndarray) -> np.ndarray:
    """Slots whose presence depends on the document's label, by the likelihood ratio statistic of the two-way table."""
    held = np.zeros((2, SLOTS))
    for (slots, _), label in zip(bags, toxic):
        held[int(label), np.unique(slots)] += 1
    total = np.array([[(~toxic).sum()], [toxic.sum()]], float)
    statistic = np.zeros(SLOTS)
    for observed in (held, total - held):
        expected = observed.sum(axis=0) * total / total.sum()
        ratio = np.divide(observed, expected, out=np.ones_like(observed), where=observed > 0)
        statistic += 2 * (observed * np.log(ratio)).sum(axis=0)
    return statistic >= MIN_EVIDENCE


def logit_slopes(score: np.ndarray, document: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Derivatives of the documents' log losses by their sentences' logits.

    For a document with probability p, the loss falls with a sentence's logit
    by its score times (1 - p) / p if the label is 1, and rises by its score
    if it is 0.
    """
    calm = np.bincount(document, np.log1p(-np.minimum(score, 1 - 1e-12)), minlength=len(toxic))
    p = np.maximum(-np.expm1(calm), 1e-9)
    return score * np.where(toxic, -(1 - p) / p, 1.0)[document]


def train_bags(
    bags: list[tuple[np.ndarray, np.ndarray]], toxic: np.ndarray, epochs: int = 10, rate: float = 0.25,
    decay: float = 1e-3, batch: int = 64, seed: int = 11,
) -> tuple[np.ndarray, float]:
    """Weights and bias by adaptive gradient descent on the document log loss of the noisy-or."""
    weights, bias, used = np.zeros(SLOTS), -4.0, telling_slots(bags, toxic)
    # a sentence without telling words still counts as an instance
    counts_of = [len(np.unique(sentence)) for _, sentence in bags]
    dense = [np.unique(sentence, return_inverse=True)[1] for _, sentence in bags]
    bags = [(slots[used[slots]], number[used[slots]]) for (slots, _), number in zip(bags, dense)]
    square, bias_square = np.full(SLOTS, 0.1), 0.1
    balance = np.where(toxic, 0.5 / max(toxic.mean(), 1e-6), 0.5 / max((~toxic).mean(), 1e-6))
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        shuffled = order.permutation(len(bags))
        for k in range(0, len(shuffled), batch):
            part = shuffled[k:k + batch]
            slots = np.concatenate([bags[i][0] for i in part])
            counts = [counts_of[i] for i in part]
            first = np.concatenate([[0], np.cumsum(counts)])
            of = np.concatenate([bags[i][1] + first[n] for n, i in enumerate(part)])
            total = int(first[-1])
            if not total:
                continue
            document = np.repeat(np.arange(len(part)), counts)
            score = sigmoid(bias + np.bincount(of, weights[slots], minlength=total))
            slope = logit_slopes(score, document, toxic[part]) * balance[part][document]
            gradient = np.bincount(slots, slope[of], minlength=SLOTS)
            touched = np.flatnonzero(gradient)
            step = gradient[touched] + decay * weights[touched]
            square[touched] += step * step
            weights[touched] -= rate * step / np.sqrt(square[touched])
            bias_step = float(slope.sum())
            bias_square += bias_step * bias_step
            bias -= rate * bias_step / np.sqrt(bias_square)
    return weights, bias


def bag_column(text: Column) -> Column:
    @F.arrow_udf("struct<slots: array<int>, sentence: array<int>>")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            bags = [instances(t) for t in strings(batch)]
            yield pa.StructArray.from_arrays(
                [pa.array([b[k].astype(np.int32) for b in bags], pa.list_(pa.int32())) for k in (0, 1)],
                names=["slots", "sentence"])

    return of(text)


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, max_rows: int = TRAINING_ROWS, max_bytes: int = TRAINING_BYTES, epochs: int = 10
) -> ToxicityModel:
    """Learn from labelled rows whose fold is not left out, at most ``max_rows`` and ``max_bytes`` of text.

    A fifth of the rows fits the logistic map of log-odds. With rows of one
    class only, or none, every text gets that class's share of the labels.
    """
    bound_batches(docs.sparkSession)
    sample = training_sample(docs, labels, "toxic", *LEFT_OUT, max_rows, max_bytes)
    taken = sample.select("id", "label", bag_column(F.col("text")).alias("bag")).select("id", "label", "bag.*").toArrow()
    names = [str(i).encode() for i in taken["id"].to_pylist()]
    order = sorted(range(taken.num_rows), key=lambda n: (zlib.crc32(names[n]), names[n]))
    slots, sentences = lists(taken["slots"]), lists(taken["sentence"])
    bags = [(slots[n], sentences[n]) for n in order]
    toxic = taken["label"].to_numpy()[order] == 1
    held = np.arange(len(bags)) % 5 == 4
    if len(set(toxic[~held].tolist())) < 2:
        share = (toxic.sum() + 1) / (len(toxic) + 2)
        return ToxicityModel(np.zeros(SLOTS, np.float32), 0.0, 0.0, float(np.log(share / (1 - share))))
    weights, bias = train_bags([bags[i] for i in np.flatnonzero(~held)], toxic[~held], epochs)
    model = ToxicityModel(weights.astype(np.float32), float(bias))
    judged = np.flatnonzero(held) if len(set(toxic[held].tolist())) == 2 else np.arange(len(bags))
    odds = []
    for i in judged:
        slots, sentence = bags[i]
        if len(slots):
            present = np.unique(sentence)
            odds.append(noisy_or_logit(model.sentence_logits(slots, sentence, int(present[-1]) + 1)[present]))
        else:
            odds.append(noisy_or_logit(np.array([model.bias])))
    model.slope, model.offset = fit_platt(np.array(odds), toxic[judged])
    return model


def toxicity(text: str | Column, model: ToxicityModel) -> Column:
    """Struct column: the document's probability, and the offending sentences as character ranges with scores.

    Null counts as empty; a text without words scores as one sentence without
    words, which has none that offend.
    """

    @F.arrow_udf(RESULT)
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        place = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])
        for batch in batches:
            texts = strings(batch)
            scores = [model.probability(t) for t in texts]
            found = [model.offending(t) if s >= 0.05 else [] for t, s in zip(texts, scores)]
            yield pa.StructArray.from_arrays(
                [pa.array(scores, pa.float64()), pa.array(found, pa.list_(place))], names=["score", "sentences"])

    return of(text)


def score_toxicity(docs: DataFrame, labels: DataFrame, **fit) -> DataFrame:
    """Per row of ``docs``: ``doc_id, held_out, score, predicted, sentences``.

    Null texts score as empty ones; repeated and null ids keep their rows;
    further columns are ignored; no rows give no rows.
    """
    bound_batches(docs.sparkSession)
    model = fit_toxicity(docs, labels, **fit)
    scored = docs.select("doc_id", toxicity(F.col("text"), model).alias("found"))
    return scored.select("doc_id", (fold("doc_id", LEFT_OUT[0]) == LEFT_OUT[1]).alias("held_out"), "found.score",
                         (F.col("found.score") >= THRESHOLD).cast("int").alias("predicted"), "found.sentences")


def drop_toxic(docs: DataFrame, labels: DataFrame, learn_from: DataFrame | None = None, threshold: float = THRESHOLD,
               **fit) -> DataFrame:
    """``docs`` without the rows that score at least ``threshold``, with all their columns."""
    bound_batches(docs.sparkSession)
    model = fit_toxicity(docs if learn_from is None else learn_from, labels, **fit)
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    found = packed.select("row", toxicity(F.col("row.text"), model)["score"].alias("score"))
    return found.where(F.col("score") < threshold).select("row.*")
