"""Benchmark decontamination: one Aho-Corasick automaton over the word windows of all items.

Texts are normalised byte by byte (A-Z lowered, ASCII separators blanked), so
a word keeps its byte offset and hits map back to the original text. Words
become numbers of the benchmark's vocabulary, and one automaton over number
sequences finds every window of every item in a single pass over a text.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bound_batches, stored

WINDOW_WORDS = 13
# Text of items that one automaton holds, as every task does; a larger benchmark is scanned in parts.
MAX_BENCHMARK_BYTES = 64 << 20
HITS = "items array<string>, words array<struct<first: int, last: int>>"
RESULT = "n_words bigint, n_hit bigint, items array<string>, spans array<struct<start: int, end: int>>"


def normalise_table() -> bytes:
    """Byte map: digits, letters and every byte of a non-ASCII character stay, A-Z lowered, the rest is blank."""
    table = bytearray(b" " * 256)
    for code in range(256):
        character = chr(code)
        if code >= 0x80 or "0" <= character <= "9" or "a" <= character <= "z":
            table[code] = code
        elif "A" <= character <= "Z":
            table[code] = code + 32
    return bytes(table)


Items = list[tuple[str | None, str]]


def benchmark_parts(benchmark: DataFrame, max_bytes: int = MAX_BENCHMARK_BYTES) -> Iterator[Items]:
    """The items as (id, text), in parts of at most ``max_bytes`` of text or one item; one part at least.

    Rows without text are left out. Parts are dealt by a hash of the item, in
    so many that the largest fits, and come to the driver one at a time.
    """
    usable = benchmark.select(F.col("item_id").cast("string").alias("id"), "text").where("text IS NOT NULL").distinct()
    usable = usable.withColumn("size", F.octet_length("text"))
    count, total = usable.agg(F.count(F.lit(1)), F.sum("size")).first()
    parts = 1
    while total and parts < 4 * count:
        dealt = usable.groupBy(F.pmod(F.xxhash64("text", "id"), F.lit(parts)).alias("part"))
        summed = dealt.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"))
        if summed.where((F.col("size") > max_bytes) & (F.col("n") > 1)).isEmpty():
            break
        parts = max(2 * parts, -(-2 * total // max_bytes)) if max_bytes > 0 else 2 * parts
    for part in range(parts):
        rows = usable.where(F.pmod(F.xxhash64("text", "id"), F.lit(parts)) == part).collect()
        if rows or parts == 1:
            yield sorted(((r["id"], r["text"]) for r in rows), key=lambda item: (item[0] is not None, item[0] or "", item[1]))


class Scanner:
    """The automaton of some items, and the search of one text."""

    def __init__(self, items: Items, width: int = WINDOW_WORDS):
        self.table = normalise_table()
        self.vocabulary: dict[bytes, int] = {}
        windows: dict[tuple[int, ...], set[str]] = {}
        for ident, text in items:
            words = text.encode().translate(self.table).split()
            numbers = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
            for k in range(max(1, len(numbers) - width + 1) if numbers else 0):
                named = windows.setdefault(tuple(numbers[k:k + width]), set())
                if ident is not None:
                    named.add(ident)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for window, idents in windows.items():
            self.automaton.add_word(window, (len(window), sorted(idents)))
        self.empty = not windows
        self.shortest = min(map(len, windows), default=0)
        if windows:
            self.automaton.make_automaton()

    def scan(self, text: str) -> tuple[int, int, list[str], list[dict]]:
        """Number of words, number of hit words, items found (sorted as strings), spans of hit characters."""
        raw = text.encode()
        words = raw.translate(self.table).split()
        hit, items = self.hits(words)
        if hit is None:
            return len(words), 0, [], []
        return len(words), int(hit.sum()), sorted(items), self.spans(raw, hit)

    def hits(self, words: list[bytes]) -> tuple[np.ndarray | None, set[str]]:
        """Which words are hit, None for none, and the items found."""
        items: set[str] = set()
        if self.empty or len(words) < self.shortest:
            return None, items
        known = self.vocabulary.get
        numbers = tuple([known(w, 0) for w in words])
        edges = None
        for end, (length, idents) in self.automaton.iter(numbers):
            if edges is None:
                edges = np.zeros(len(words) + 1, np.int64)
            edges[end + 1 - length] += 1
            edges[end + 1] -= 1
            items.update(idents)
        return (None if edges is None else np.cumsum(edges)[:-1] > 0), items

    def spans(self, raw: bytes, hit: np.ndarray) -> list[dict]:
        """Character ranges of the original text that runs of hit words cover."""
        codes = np.frombuffer(raw.translate(self.table), np.uint8)
        inside = np.concatenate([[False], codes != 32, [False]])
        starts = np.flatnonzero(~inside[:-1] & inside[1:])
        ends = np.flatnonzero(inside[:-1] & ~inside[1:])
        character = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
        return [{"start": int(character[starts[a]]), "end": int(character[ends[b]])} for a, b in zip(*word_runs(hit))]


def word_runs(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last word of every stretch of hit words."""
    run = np.concatenate([[False], hit, [False]])
    return np.flatnonzero(~run[:-1] & run[1:]), np.flatnonzero(run[:-1] & ~run[1:]) - 1


_FOUND = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())),
                    ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])


def _found(rows: list[tuple]) -> pa.Array:
    return pa.array([dict(zip(("n_words", "n_hit", "items", "spans"), r)) for r in rows], _FOUND)


def contamination(text: str | Column, items: Items, width: int = WINDOW_WORDS) -> Column:
    """Struct column ``n_words, n_hit, items, spans`` of a text column, for items that one automaton holds.

    A word is hit when it lies in an occurrence of a window, ``width``
    consecutive words of an item (a shorter item is one window; an item
    without words has none). ``items`` are the ids with an occurring window,
    sorted as strings, where an item without id hits words but is not named;
    ``spans`` are character ranges of the original text. A null or empty text
    has no words. Without items nothing is hit.
    """

    @F.arrow_udf(RESULT)
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scanner = Scanner(items, width)
        for batch in batches:
            yield _found([scanner.scan(t or "") for t in batch.to_pylist()])

    return of(text)


def _part_hits(text: Column, items: Items, width: int) -> Column:
    """``items, words`` that one part of a benchmark hits in a text; null where it hits nothing."""

    @F.arrow_udf(HITS)
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scanner = Scanner(items, width)
        kind = pa.struct([("items", pa.list_(pa.string())), ("words", pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())])))])
        for batch in batches:
            made = []
            for t in batch.to_pylist():
                hit, named = scanner.hits((t or "").encode().translate(scanner.table).split())
                runs = [] if hit is None else [{"first": int(a), "last": int(b)} for a, b in zip(*word_runs(hit))]
                made.append({"items": sorted(named), "words": runs} if runs else None)
            yield pa.array(made, kind)

    return of(text)


def _united(text: Column, items: Column, words: Column) -> Column:
    """``RESULT`` of a text from the hits of all parts."""

    @F.arrow_udf(RESULT)
    def of(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        scanner = Scanner([])
        for texts, named, runs in batches:
            made = []
            for t, idents, stretches in zip(texts.to_pylist(), named.to_pylist(), runs.to_pylist()):
                raw = (t or "").encode()
                hit = np.zeros(len(raw.translate(scanner.table).split()), bool)
                for stretch in stretches or ():
                    hit[stretch["first"]:stretch["last"] + 1] = True
                made.append((len(hit), int(hit.sum()), sorted(idents or ()), scanner.spans(raw, hit)))
            yield _found(made)

    return of(text, items, words)


def with_contamination(rows: DataFrame, text: Column, benchmark: DataFrame, width: int = WINDOW_WORDS,
                       max_bytes: int = MAX_BENCHMARK_BYTES) -> DataFrame:
    """``rows`` with ``found``, as in ``contamination``, for a benchmark of any size.

    Up to ``max_bytes`` of items are one automaton and one pass. A larger
    benchmark is scanned part by part over the written rows; only rows that a
    part hits travel, and their word ranges and items are united per row.
    """
    parts = benchmark_parts(benchmark, max_bytes)
    first, second = next(parts), next(parts, None)
    if second is None:
        return rows.withColumn("found", contamination(text, first, width))
    numbered = stored(rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"), text.alias("text"),
                                  F.monotonically_increasing_id().alias("number")), "scanned")
    hits = None
    for items in chain([first, second], parts):
        hit = numbered.select("number", _part_hits(F.col("text"), items, width).alias("hit")).where("hit IS NOT NULL")
        hit = stored(hit.select("number", "hit.items", "hit.words"), "part_hits")
        hits = hit if hits is None else hits.unionByName(hit)
    united = hits.groupBy("number").agg(F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
                                        F.flatten(F.collect_list("words")).alias("words"))
    beside = numbered.join(united, "number", "left")
    return beside.select("row.*", _united(F.col("text"), F.col("items"), F.col("words")).alias("found"))


def is_contaminated(found: Column, per_word: int = 20) -> Column:
    """Whether at least one word in ``per_word`` is hit."""
    return (found["n_hit"] > 0) & (per_word * found["n_hit"] >= found["n_words"])


def contaminated_documents(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW_WORDS,
                           max_bytes: int = MAX_BENCHMARK_BYTES) -> DataFrame:
    """Every document's id with what of it occurs in the benchmark: ``doc_id, n_words, n_hit, items, spans, contaminated``.

    One row per row of ``docs``, repeated and null ids included; further columns are ignored.
    """
    bound_batches(docs.sparkSession)
    found = with_contamination(docs.select("doc_id", "text"), F.col("text"), benchmark, width, max_bytes)
    return found.select("doc_id", "found.*", is_contaminated(F.col("found")).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW_WORDS,
                      max_bytes: int = MAX_BENCHMARK_BYTES) -> DataFrame:
    """``docs`` without the contaminated rows, with all their columns."""
    bound_batches(docs.sparkSession)
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    found = with_contamination(packed, F.col("row.text"), benchmark, width, max_bytes)
    return found.where(~is_contaminated(F.col("found"))).select("row.*")
