"""Whitening against exact integers and a dense eigensolver, and the eigensolver on spectra of every kind."""

import os
from fractions import Fraction
from math import floor, inf, nan, sqrt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import queries, whitening

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("dims, count, kind", [
    (64, 32, "flat"), (300, 5, "falling"), (200, 12, "flat"), (50, 32, "of rank 7"), (40, 32, "repeated"), (3, 32, "flat"), (1, 1, "flat"),
    (20, 8, "zero")])
def test_eigenpairs(dims, count, kind):
    draw = np.random.default_rng(dims)
    x = draw.standard_normal((900, dims))
    if kind == "falling":
        x *= 0.97 ** np.arange(dims)
    elif kind == "of rank 7":
        x = x[:, :7] @ draw.standard_normal((7, dims))
    elif kind == "repeated":
        x = np.linalg.qr(x)[0] * np.repeat(np.arange(1, dims // 4 + 1), 4)
    elif kind == "zero":
        x *= 0
    v = x.T @ x
    columns = []

    def product(b):
        columns.append(b.shape[1])
        return v @ b

    values, vectors = whitening.leading_eigenpairs(product, dims, count)
    wanted = np.linalg.eigvalsh(v)[::-1][:count]
    top = max(wanted[0], 1e-300)
    assert np.abs(values - wanted).max() <= 1e-13 * top
    assert np.linalg.norm(v @ vectors - vectors * values, axis=0).max() <= 1e-12 * top
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() <= 1e-13
    assert max(columns) <= count + whitening.GUARD


def test_minres():
    draw = np.random.default_rng(3)
    a = draw.standard_normal((30, 30))
    a = a + a.T  # indefinite
    b = np.hstack([draw.standard_normal((30, 3)), np.zeros((30, 1))])
    x = whitening.minres(lambda c: a @ c, b, 60, reduce=1e-12)
    assert np.abs(a @ x - b).max() < 1e-8 and not x[:, 3].any()


def brute_whitened(rows, components=32):
    """Exact integers and fractions, then a dense eigensolver."""
    kept = [(i, [floor(64 * Fraction(c)) + 1_000_000 for c in v]) for i, v in rows
            if v is not None and all(c is not None and abs(c) < inf for c in v)]
    n, dims = len(kept), len(kept[0][1])
    sums = [sum(x[k] for _, x in kept) for k in range(dims)]
    y = [[n * x[k] - sums[k] for k in range(dims)] for _, x in kept]
    z = np.array([[float(Fraction(v, n)) for v in row] for row in y])
    e, u = np.linalg.eigh(z.T @ z / n)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    e, u = e[e > 1e-9 * e[0]], u[:, e > 1e-9 * e[0]]
    return n, [i for i, _ in kept], [sum(v * v for v in row) for row in y], z @ u / np.sqrt(e), e / (z * z).sum() * n


def check(found, rows):
    n, ids, deviations, w, explained = brute_whitened(rows)
    k = len(explained)
    got = found.collect()
    assert len(got) == n * k and {r["n"] for r in got} == {n}
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] <= 1e-9
    by = {}
    for r in got:
        by.setdefault(r["vec_id"], {}).setdefault(r["component"], []).append((r["whitened"], r["deviation"], r["explained"]))
    for c in range(1, k + 1):
        values = np.array([sorted(by[i][c])[0][0] for i in ids])
        sign = np.sign(values @ w[:, c - 1])
        assert np.abs(sign * values - w[:, c - 1]).max() < 1e-7
        assert all(by[i][c][0][1] == d for i, d in zip(ids, deviations))
        assert abs(by[ids[0]][c][0][2] - explained[c - 1]) < 1e-12
    return got


def test_defined_rows(frame):
    draw = np.random.default_rng(5)
    good = [(k, [float(c) for c in draw.standard_normal(6) * (k % 3 + 1)]) for k in range(40)]
    rows = [*good, (0, good[0][1]), (None, good[1][1]), (41, None), (42, [1.0, None] + [0.0] * 4), (43, [nan] + [0.0] * 5),
            (44, [inf] + [0.0] * 5)]
    made = frame(rows, "vec_id bigint, embedding array<double>").withColumn("component", F.lit("x")).withColumn("n", F.lit(2))
    check(whitening.whiten(made), rows)
    # a huge entry and another length leave the row out
    odd = frame([*rows, (45, [1e30] + [0.0] * 5), (46, [1.0]), (47, [])], "vec_id bigint, embedding array<double>")
    check(whitening.whiten(odd), rows)
    assert whitening.whiten(odd.limit(0)).count() == whitening.whiten(frame([(1, None), (2, [])], "vec_id bigint, embedding array<float>")).count() == 0
    still = frame([(k, [0.5, 2.0]) for k in range(5)], "vec_id bigint, embedding array<float>")
    assert whitening.whiten(still).count() == 0
    line = whitening.whiten(frame([(f"v{k}", [float(k), 2.0 * k, 7.0]) for k in range(5)], "name string, e array<float>"), "name", "e").collect()
    assert {r["component"] for r in line} == {1} and {r["vec_id"] for r in line} == {f"v{k}" for k in range(5)}
    assert sorted(abs(r["whitened"]) for r in line) == pytest.approx([0, sqrt(.5), sqrt(.5), sqrt(2), sqrt(2)]) and line[0]["explained"] == pytest.approx(1)


def test_large_integers_stay_exact():
    x = np.array([[1 << 60, 5], [-(1 << 60), 7], [3, 9]], np.int64)
    sums = tuple(int(v) for v in x.astype(object).sum(axis=0))
    y = whitening.centred(x, 3, sums)
    assert y.tolist() == [[3 * int(a) - s for a, s in zip(row, sums)] for row in x]
    assert whitening.deviations(y) == [None, None, sum(v * v for v in y[2].tolist())]
    small = whitening.centred(np.array([[1_000_001], [1_000_004]]), 2, (2_000_005,))
    assert small.dtype == np.int64 and whitening.deviations(small) == [9, 9]


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables absent")
def test_query_on_the_test_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = check(queries.op13_whitening(spark, SF), rows)
    assert {r["component"] for r in got} == set(range(1, 33))
