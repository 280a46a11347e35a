"""Periodic runs: stretches of words that repeat with a period, found by a Kruskal pass over the suffixes of a text.

The suffixes of a text are united in the order of their common prefixes,
longest first, with union-find over ordered sets of positions. When two
positions i < j become neighbours in a set at common prefix L, the words from
i to j + L repeat with period j - i. If that period is at most L, it is the
smallest one of the stretch: a smaller one would have put another position
between the two before. A stretch that also cannot be continued to the left is
a run, and every run is found exactly once, from its start.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bound_batches, strings

MIN_WORDS = 24
MIN_REPEATS = 3
RUN = "struct<start: bigint, length: bigint, period: bigint>"
_BLOCK = 512


class Positions:
    """An ordered set of positions, in blocks so that an insertion moves few of them."""

    __slots__ = ("blocks", "heads", "size")

    def __init__(self, first: int):
        self.blocks, self.heads, self.size = [[first]], [first], 1

    def __iter__(self) -> Iterator[int]:
        for block in self.blocks:
            yield from block

    def insert(self, at: int) -> tuple[int, int]:
        """Add ``at``; its neighbours below and above, -1 for none."""
        b = max(bisect_right(self.heads, at) - 1, 0)
        block = self.blocks[b]
        k = bisect_left(block, at)
        below = block[k - 1] if k else -1
        if k < len(block):
            above = block[k]
        else:
            above = self.heads[b + 1] if b + 1 < len(self.heads) else -1
        block.insert(k, at)
        self.size += 1
        if not k:
            self.heads[b] = at
        if len(block) > _BLOCK:
            half = len(block) // 2
            self.blocks.insert(b + 1, block[half:])
            self.heads.insert(b + 1, block[half])
            del block[half:]
        return below, above


def repeats_window(codes: np.ndarray, width: int) -> bool:
    """Whether two windows of ``width`` codes may be equal; False is certain, True is to be verified."""
    if len(codes) <= width:
        return False
    codes, span, mix = codes.astype(np.uint64), 1, 0x9E3779B97F4A7C15
    while span < width:
        step = min(span, width - span)  # the last two windows may overlap
        codes = codes[:-step] * np.uint64(mix) + codes[step:]
        codes ^= codes >> np.uint64(29)
        span, mix = span + step, mix + 2 * span
    codes.sort()
    return bool((codes[1:] == codes[:-1]).any())


def sorted_suffixes(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all suffixes in order, and the common prefix of each with the one after it."""
    n = len(ids)
    rank = np.unique(ids, return_inverse=True)[1].astype(np.int64) + 1
    levels = [rank]  # ranks of the windows of 1, 2, 4, ... words; 0 stands behind the end
    while n and int(rank.max()) < n:
        span = 1 << len(levels) - 1
        ahead = np.zeros(n, np.int64)
        ahead[:max(0, n - span)] = rank[span:]
        rank = np.unique(rank * (n + 1) + ahead, return_inverse=True)[1] + 1
        levels.append(rank)
    order = np.empty(n, np.int64)
    order[rank - 1] = np.arange(n)
    i, j, shared = order[:-1].copy(), order[1:].copy(), np.zeros(max(0, n - 1), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        # equal windows of two suffixes never reach behind the end
        padded = np.append(levels[level], 0)
        step = (padded[i] == padded[j]) * (1 << level)
        i, j, shared = i + step, j + step, shared + step
    return order, shared


def runs_of(ids: np.ndarray, min_words: int = MIN_WORDS, min_repeats: int = MIN_REPEATS) -> np.ndarray:
    """The runs of a sequence of integers as rows ``start, length, period``, in that order of start and period.

    A run is a stretch with smallest period q and a length of at least
    ``min_words`` and ``min_repeats`` times q (2 at least) that no neighbour
    extends with period q.
    """
    if min_repeats < 2:
        raise ValueError("a run repeats at least twice")
    order, shared = sorted_suffixes(ids)
    near = np.flatnonzero(shared >= _least_prefix(min_words, min_repeats))
    near = near[np.argsort(-shared[near], kind="stable")]
    # only suffixes with such a neighbour take part
    ends = np.unique(np.concatenate([near, near + 1]))
    index = np.searchsorted(ends, near).tolist()
    start, word = order[ends].tolist(), ids.tolist()
    parent, sets = list(range(len(ends))), {}
    found = []

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def seed(i: int, j: int, prefix: int) -> None:
        period = j - i
        if (period * (min_repeats - 1) <= prefix and period + prefix >= min_words
                and (not i or word[i - 1] != word[j - 1])):
            found.append((i, period + prefix, period))

    for at, prefix in zip(index, shared[near].tolist()):
        a, b = root(at), root(at + 1)
        large, small = sets.pop(a, None) or Positions(start[a]), sets.pop(b, None) or Positions(start[b])
        if large.size < small.size:
            large, small, a, b = small, large, b, a
        parent[b] = a
        sets[a] = large
        before, added = -1, list(small)
        for k, position in enumerate(added):
            below, above = large.insert(position)
            if below >= 0 and below != before:
                seed(below, position, prefix)
            if above >= 0 and (k + 1 == len(added) or added[k + 1] > above):
                seed(position, above, prefix)
            before = position
    return np.array(sorted(found, key=lambda r: (r[0], r[2])), np.int64).reshape(-1, 3)


def _least_prefix(min_words: int, min_repeats: int) -> int:
    """No run has a common prefix below this with itself one period on, whatever its period."""
    return max(1, -(-min_words * (min_repeats - 1) // min_repeats))


def text_runs(words: list[bytes], min_words: int = MIN_WORDS, min_repeats: int = MIN_REPEATS) -> np.ndarray:
    """The runs of a list of words, as in ``runs_of``."""
    if len(words) < max(min_words, min_repeats) or not repeats_window(
            np.fromiter(map(hash, words), np.int64, len(words)), _least_prefix(min_words, min_repeats)):
        return np.zeros((0, 3), np.int64)
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    return runs_of(ids, min_words, min_repeats)


def repeated(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of ``n`` words some run contains after its first period."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edges)[:-1] > 0


def periodic_runs(text: str | Column, min_words: int = MIN_WORDS, min_repeats: int = MIN_REPEATS) -> Column:
    """Struct column ``n_words, runs, collapsed`` of a text column.

    Words are maximal stretches without ASCII white space. ``runs`` are ordered
    by start and period and count words from 0; ``collapsed`` is the text with
    every run cut to its first period, its words joined by one space. A null or
    empty text has no words, no runs and an empty collapsed text.
    """

    @F.arrow_udf(f"n_words bigint, runs array<{RUN}>, collapsed string")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            counts, sizes, rows, left = [], [], [], []
            for text in strings(batch):
                words = text.encode().split()
                runs = text_runs(words, min_words, min_repeats)
                counts.append(len(words))
                sizes.append(len(runs))
                if len(runs):
                    rows.append(runs)
                    words = [w for w, gone in zip(words, repeated(len(words), runs).tolist()) if not gone]
                left.append(b" ".join(words))
            flat = np.concatenate(rows) if rows else np.zeros((0, 3), np.int64)
            parts = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], ["start", "length", "period"])
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            yield pa.StructArray.from_arrays(
                [pa.array(counts, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), parts),
                 pa.array(left, pa.binary()).cast(pa.string())], ["n_words", "runs", "collapsed"])

    return of(text)


def find_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS,
              min_repeats: int = MIN_REPEATS) -> DataFrame:
    """Per document ``doc_id, n_words, runs, collapsed``, as in ``periodic_runs``.

    One row per row of ``docs``; null and repeated ids are kept, further
    columns are ignored, an empty table gives no rows. A text is searched
    whole: a task holds one batch of texts and, for one text at a time, its
    words and a rank per word for every doubling of the longest repeat.
    """
    bound_batches(docs.sparkSession)
    found = docs.select(F.col(doc_id).alias("doc_id"), periodic_runs(F.col(text), min_words, min_repeats).alias("found"))
    return found.select("doc_id", "found.*")


def longest_power(runs: str | Column) -> Column:
    """Of an array of runs the one with the greatest exact length over period; ties by order in the array; null if empty."""
    runs = F.col(runs) if isinstance(runs, str) else runs

    def better(best: Column, run: Column) -> Column:
        more = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(best.isNull() | more, run).otherwise(best)

    return F.aggregate(runs, F.lit(None).cast(RUN), better)


def with_planted_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` with repeats planted in a tenth of the documents, chosen by the CRC32 of their id.

    The words of such a document from a place on are replaced by repetitions
    of the first few of them; the place and their number follow from the id.
    Other texts, and those of rows without id, stay as they are.
    """

    @F.arrow_udf("string")
    def planted(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for ids, texts in batches:
            made = []
            for ident, text in zip(ids.to_pylist(), texts.to_pylist()):
                key = None if ident is None else zlib.crc32(ident.encode())
                if key is None or key % 10 or not text or not (words := text.encode().split()):
                    made.append(text)
                    continue
                n, g = len(words), key // 10
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                tail = words[a:a + p]
                words[a:] = (tail * -(-(n - a) // p))[:n - a]
                made.append(b" ".join(words).decode())
            yield pa.array(made, pa.string())

    bound_batches(docs.sparkSession)
    return docs.select("doc_id", planted(F.col("doc_id").cast("string"), F.col("text")).alias("text"))
