"""URL filters: host and path rules, and a character language-model ratio for the rest.

Rules decide the URLs they fit. The URLs they accept and reject train two
variable-order Markov models over bytes, smoothed by interpolating every order
with the next shorter context (Witten-Bell). What no rule fits is judged by
the difference of its two log-likelihoods per byte, against a threshold
calibrated on rule-decided URLs left out of the models.

A cell is a symbol after its exact context, written as one integer. Cells are
counted, smoothed and looked up by Spark in tables that grow with the input.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bound_batches, stored, strings

# (host, path, verdict)
RULES = (
    ("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
)
ORDERS = 6  # contexts of 0 to 5 bytes
SYMBOLS = 97  # printable ASCII, one for all other bytes, one for the end
BASE = SYMBOLS + 1  # a cell's digits are its symbols, counted from 1, so that its length is known too
CALIBRATION = 5  # one host in so many calibrates
BINS = 400
SPAN = 4.0  # differences are counted in bins from -SPAN to SPAN


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lowered) and path of a URL; both empty for null or without ``://``."""
    pattern = r"^(?s).*?://([^/?#]*)([^?#]*)"
    whole = F.coalesce(url, F.lit(""))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(F.regexp_extract(whole, pattern, 1), upper, lower), F.regexp_extract(whole, pattern, 2)


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits (host and path written together) and its verdict; null where none does.

    A rule fits its host and all subdomains where the path starts with the
    rule's. Of equally long rules the first in the order of their texts counts.
    """
    name = verdict = F.lit(None).cast("string")
    for rule_host, rule_path, says in sorted(rules, key=lambda r: (len(r[0] + r[1]), r[0] + r[1])):
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(rule_path))
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return name, verdict


def cells(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """For all symbols of all texts (each with an end symbol): the cells of each order, and the text's number."""
    raw = [t.encode() for t in texts]
    lengths = np.fromiter(map(len, raw), np.int64, len(raw))
    codes = np.frombuffer(b"".join(r + b"\0" for r in raw), np.uint8).astype(np.int64)
    symbols = np.where((codes >= 32) & (codes < 127), codes - 32, 95)
    ends = np.cumsum(lengths + 1) - 1
    symbols[ends] = 96
    text = np.repeat(np.arange(len(raw)), lengths + 1)
    position = np.arange(len(codes)) - np.repeat(ends - lengths, lengths + 1)
    found = np.zeros((ORDERS, len(codes)), np.int64)
    found[0] = symbols + 1
    for order in range(1, ORDERS):
        before = np.concatenate([np.zeros(order, np.int64), symbols[:-order]])[:len(codes)]
        # before the first byte stands the end symbol
        before = np.where(position >= order, before, 96)
        found[order] = found[order - 1] + (before + 1) * BASE ** order
    return found, text


def _count_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a batch's cells as ``grp, cell, n``."""
    for batch in batches:
        texts, group = strings(batch.column(0)), np.array(batch.column(1).to_pylist(), np.int64)
        if not texts:
            continue
        cell, text = cells(texts)
        for g in np.unique(group).tolist():
            used, n = np.unique(cell[:, group[text] == g], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(used), g)), pa.array(used), pa.array(n)], names=["grp", "cell", "n"])


def _longest_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row ``key, cell, size`` for each symbol of each text: its cell of the highest order, and the text's length."""
    for batch in batches:
        keys, texts = batch.column(0).to_numpy(), strings(batch.column(1))
        if not texts:
            continue
        cell, text = cells(texts)
        size = np.bincount(text, minlength=len(texts))
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys[text]), pa.array(cell[-1]), pa.array(size[text])], names=["key", "cell", "size"])


# how the counts of (held back, accepted), as numbers 0 to 3, make up the models
MODELS = {"accepted": (1, 3), "rejected": (0, 2), "accepted_part": (1,), "rejected_part": (0,)}


def cell_probabilities(texts: DataFrame) -> DataFrame:
    """Per longest cell of any text its probability in each of ``MODELS``, from ``text, grp``; other groups are not counted.

    Every order is smoothed by the next shorter one: a join of the cells of
    one order with those of the order before, whose contexts lack the oldest
    symbol.
    """
    partial = texts.mapInArrow(_count_cells, "grp bigint, cell bigint, n bigint")
    counts = [F.sum(F.when(F.col("grp").isin(*groups), F.col("n")).otherwise(0)).alias(name) for name, groups in MODELS.items()]
    counted = stored(partial.groupBy("cell").agg(*counts), "url_cells")
    context = F.expr(f"cell div {BASE}")
    sums = counted.groupBy(context.alias("context")).agg(
        *[F.sum(m).alias(f"{m}_total") for m in MODELS], *[F.count(F.when(F.col(m) > 0, 1)).alias(f"{m}_kinds") for m in MODELS])
    placed = stored(counted.withColumn("context", context).join(sums, "context"), "url_contexts")
    shorter = None
    for order in range(ORDERS):
        level = placed.where((F.col("cell") >= BASE ** order) & (F.col("cell") < BASE ** (order + 1)))
        if shorter is None:
            before = {m: F.lit(1.0 / SYMBOLS) for m in MODELS}
        else:
            level = level.withColumn("tail", F.col("cell") % BASE ** order).join(shorter, "tail")
            before = {m: F.col(f"{m}_p") for m in MODELS}
        made = []
        for m in MODELS:
            weight = F.col(f"{m}_total") + F.col(f"{m}_kinds")
            p = (F.col(m) + F.col(f"{m}_kinds") * before[m]) / weight
            made.append(F.when(weight > 0, p).otherwise(before[m]).alias(f"{m}_p"))
        shorter = stored(level.select(F.col("cell").alias("tail"), *made), f"url_order_{order}")
    return shorter.withColumnRenamed("tail", "cell")


def text_ratios(texts: DataFrame) -> DataFrame:
    """Per distinct ``key`` (a hash of ``text``) the log-likelihood difference per symbol: ``ratio``, and ``ratio_part`` by the parts.

    Positive speaks for acceptance. ``grp`` is as in ``MODELS``, or -1.
    """
    apart = [(F.log(F.col(f"accepted{x}_p")) - F.log(F.col(f"rejected{x}_p"))).alias(f"apart{x}") for x in ("", "_part")]
    by_cell = cell_probabilities(texts.select("text", "grp")).select("cell", *apart)
    once = texts.groupBy("key").agg(F.min("text").alias("text")).mapInArrow(_longest_cells, "key bigint, cell bigint, size bigint")
    # a frequent cell is met by many texts: the join splits it
    return once.join(by_cell.hint("merge"), "cell").groupBy("key").agg(
        *[(F.sum(f"apart{x}") / F.first("size")).alias(f"ratio{x}") for x in ("", "_part")])


def best_threshold(bins: list[tuple[bool, int, int]]) -> float:
    """The bin edge with the best balanced accuracy; 0 unless both classes have rows."""
    tally = np.zeros((2, BINS))
    for accepted, at, n in bins:
        tally[int(accepted), at] += n
    if not tally.sum(axis=1).all():
        return 0.0
    share = tally / tally.sum(axis=1, keepdims=True)
    below = np.concatenate([np.zeros((2, 1)), np.cumsum(share, axis=1)], axis=1)
    quality = below[0] + 1 - below[1]
    edges = np.linspace(-SPAN, SPAN, BINS + 1)
    best = np.flatnonzero(quality >= quality.max() - 1e-12)
    return float(edges[best[np.argmin(np.abs(edges[best]))]])


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """Per row of ``pages``: ``page_id, host, path, rule, ratio, verdict``.

    The verdict is the rule's, else allow where the ratio reaches the
    threshold, else block. Null and unreadable URLs have empty parts and are
    judged by the method like any other. Repeated and null ids keep their
    rows; further columns are ignored; no rows give no rows.
    """
    bound_batches(pages.sparkSession)
    host, path = parts(F.col("url"))
    split = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, says = matching_rule(F.col("host"), F.col("path"), rules)
    ruled = split.select("page_id", "host", "path", rule.alias("rule"), says.alias("says"))
    held = (F.crc32(F.col("host").cast("binary")) % CALIBRATION == 0).cast("bigint")
    text = F.concat("host", "path")
    grouped = ruled.select(
        "*", F.xxhash64(text).alias("key"), text.alias("text"),
        F.when(F.col("says").isNull(), -1).otherwise(2 * held + (F.col("says") == "allow").cast("bigint")).cast("bigint").alias("grp"))
    sides = grouped.where("grp >= 0").select((F.col("grp") % 2).alias("side")).distinct().count()
    if sides < 2:
        judged, threshold = grouped.withColumn("ratio", F.lit(0.0)), 0.0
    else:
        judged = stored(grouped.join(text_ratios(grouped.select("key", "text", "grp")).hint("merge"), "key").drop("text"), "url_ratios")
        # the threshold is tried on the hosts held back, by the models without them
        place = F.floor((F.col("ratio_part") + SPAN) * (BINS / (2 * SPAN)))
        bins = judged.where("grp >= 2").groupBy("grp", F.least(F.greatest(place, F.lit(0)), F.lit(BINS - 1)).alias("bin")).count().collect()
        threshold = best_threshold([(r["grp"] == 3, int(r["bin"]), r["count"]) for r in bins])
    own = F.when(F.col("ratio") >= threshold, "allow").otherwise("block")
    return judged.select("page_id", "host", "path", "rule", "ratio", F.coalesce("says", own).alias("verdict"))
