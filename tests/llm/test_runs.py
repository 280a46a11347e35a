"""Periodic runs against a search of every period, on random words, the test table and edge rows."""

import hashlib
import os
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import queries, runs

SF = "/root/testdata/sf0.001"


def brute_runs(words, min_words=24, min_repeats=3):
    """Every maximal stretch of every period, without those that a smaller period explains."""
    found, n = [], len(words)
    for period in range(1, n // min_repeats + 1):
        i = 0
        while i + period < n:
            start = i
            while i + period < n and words[i] == words[i + period]:
                i += 1
            length = i - start + period
            if i > start and length >= max(min_words, min_repeats * period):
                stretch = words[start:start + length]
                if not any(period % p == 0 and stretch[p:] == stretch[:-p] for p in range(1, period)):
                    found.append((start, length, period))
            i += 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_row(ident, text):
    words = (text or "").encode().split()
    n, h = len(words), None if ident is None else zlib.crc32(str(ident).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = brute_runs(words)
    gone = {k for s, length, q in found for k in range(s + q, s + length)}
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    rest = b" ".join(w for k, w in enumerate(words) if k not in gone)
    return (ident, len(found), *best, 1000 * best[1] // best[2] if found else None,
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(rest).hexdigest())


@pytest.mark.parametrize("block", [1, 3, 512])
def test_runs_against_every_period(monkeypatch, block):
    monkeypatch.setattr(runs, "_BLOCK", block)
    draw = random.Random(block)
    for _ in range(500):
        n, letters = draw.randrange(70), draw.choice([1, 2, 3, 5])
        words = [draw.randrange(letters) for _ in range(n)]
        if n and draw.random() < 0.6:
            a, p = draw.randrange(n), draw.randrange(1, 12)
            words = words[:a] + (words[a:a + p] * n)[:n - a]
        for limits in ((1, 2), (4, 2), (6, 3), (24, 3), (5, 4)):
            wanted = brute_runs(words, *limits)
            assert list(map(tuple, runs.runs_of(np.array(words, np.int64), *limits).tolist())) == wanted
            assert list(map(tuple, runs.text_runs([b"%d" % w for w in words], *limits).tolist())) == wanted
    with pytest.raises(ValueError):
        runs.runs_of(np.zeros(9, np.int64), 1, 1)


def test_long_texts():
    assert runs.text_runs([b"a"] * 100_000).tolist() == [[0, 100_000, 1]]
    assert runs.text_runs([b"%d" % (k % 777) for k in range(100_000)]).tolist() == [[0, 100_000, 777]]
    assert len(runs.text_runs([b"%d" % (k * k % 50_021) for k in range(50_000)])) == 0


def test_defined_rows(frame):
    line = "one two three "
    texts = [(1, line * 8), (1, line * 8), (2, None), (3, ""), (4, " \n\t "), (None, line * 30 + "end"), (5, "x" * 100_000),
             (6, line * 7 + "one two"), (7, "a b " * 20 + "c d " * 20), (8, "q q " * 30 + "é " * 24)]
    docs = frame([(i, t, 1, "z", 2) for i, t in texts], "doc_id bigint, text string, start int, runs string, period int")
    found = runs.find_runs(docs).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, tuple(map(tuple, r["runs"]))) for r in found) == sorted(
        (i is None, i or 0, tuple(brute_runs((t or "").encode().split()))) for i, t in texts)
    by = {r["doc_id"]: r for r in found}
    assert by[1]["collapsed"] == "one two three" and by[None]["collapsed"] == "one two three end" and by[3]["collapsed"] == by[2]["collapsed"] == ""
    assert by[6]["runs"] == [] and by[6]["n_words"] == 23 and by[7]["collapsed"] == "a b c d" and by[8]["collapsed"] == "q q é"
    assert runs.find_runs(docs.limit(0)).count() == 0
    best = frame([([(0, 24, 8), (9, 30, 10), (40, 25, 8), (70, 50, 16)],), ([],), (None,)], f"runs array<{runs.RUN}>")
    assert [r[0] and tuple(r[0]) for r in best.select(runs.longest_power("runs")).collect()] == [(40, 25, 8), None, None]


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables absent")
def test_query_against_every_period(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    docs = docs.union(docs.where("doc_id < 40").select(F.col("doc_id") + 5_000_000, "text"))
    docs = docs.union(docs.where("doc_id < 3").select(F.lit(None).cast("bigint"), "text"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, queries.op12_periodic_runs(spark, str(tmp_path)).collect()), key=repr)
    assert got == sorted((brute_row(r["doc_id"], r["text"]) for r in docs.collect()), key=repr)
    assert sum(r[1] > 0 for r in got) > 10
