"""Embedding whitening: leading eigenpairs of the covariance by a blocked Jacobi-Davidson method on Spark products.

The covariance is never formed. Its product with a few columns is one job over
the written vectors: every task centres its rows, multiplies them twice and
returns sums of fixed size, which Spark adds up. The driver holds the search
basis only, some dozens of columns of the vectors' dimension. Correction
equations of all pairs still open are solved in lockstep by MINRES, one product
a step; Rayleigh-Ritz over the grown basis follows, and pairs are locked once
their residual reaches double precision.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bound_batches, stored

COMPONENTS = 32
SCALE = 64
SHIFT = 1_000_000
# basis columns beyond the wanted pairs, MINRES steps of a correction, rounds before giving up
GUARD = 8
INNER_STEPS = 6
MAX_ROUNDS = 200
EPS = float(np.finfo(float).eps)
Product = Callable[[np.ndarray], np.ndarray]


# --- the eigensolver, on any symmetric positive semidefinite product -------------------


def _orthonormal(columns: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of the part of ``columns`` that is orthogonal to ``against``; dependent ones are dropped."""
    norms = np.linalg.norm(columns, axis=0)
    columns = columns[:, norms > 0] / norms[norms > 0]
    for _ in range(2):
        for held in against:
            columns = columns - held @ (held.T @ columns)
        if not columns.shape[1]:
            return columns
        left, sizes, _ = np.linalg.svd(columns, full_matrices=False)
        columns = left[:, sizes > 1e-10]
    return columns


def minres(apply: Product, rhs: np.ndarray, steps: int, reduce: float = 0.05) -> np.ndarray:
    """Approximate solutions of one symmetric system per column of ``rhs``, all by one ``apply`` a step."""
    tiny = np.finfo(float).tiny
    x, w, w_old = np.zeros_like(rhs), np.zeros_like(rhs), np.zeros_like(rhs)
    before, now, ahead = rhs, rhs, rhs
    beta = first = np.linalg.norm(rhs, axis=0)
    old_beta, residual = np.ones_like(beta), beta.copy()
    cosine, sine = -np.ones_like(beta), np.zeros_like(beta)
    bar, epsilon = np.zeros_like(beta), np.zeros_like(beta)
    for step in range(steps):
        live = beta > EPS * first
        if not (live & (residual > reduce * first)).any():
            break
        v = np.where(live, ahead / np.maximum(beta, tiny), 0.0)
        ahead = apply(v)
        if step:
            ahead = ahead - np.where(live, beta / old_beta, 0.0) * before
        alpha = (v * ahead).sum(axis=0)
        ahead = ahead - np.where(live, alpha / np.maximum(beta, tiny), 0.0) * now
        before, now, old_beta = now, ahead, np.maximum(beta, tiny)
        beta = np.where(live, np.linalg.norm(ahead, axis=0), 0.0)
        older, delta = epsilon, cosine * bar + sine * alpha
        slope = sine * bar - cosine * alpha
        epsilon, bar = sine * beta, -cosine * beta
        gamma = np.maximum(np.hypot(slope, beta), tiny)
        cosine, sine = slope / gamma, beta / gamma
        w, w_old = np.where(live, (v - older * w_old - delta * w) / gamma, 0.0), w
        x = x + np.where(live, cosine * residual, 0.0) * w
        residual = np.where(live, sine * residual, residual)
    return x


def leading_eigenpairs(product: Product, dims: int, count: int, seed: int = 13,
                       inner_steps: int = INNER_STEPS) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues, falling, and their unit vectors as columns.

    A pair is locked when the norm of its residual is at most ``max(64, dims)``
    roundings of the largest eigenvalue, which is what products in double
    precision can reach. Equal eigenvalues get any basis of their space.
    """
    count = min(count, dims)
    locked, values = np.zeros((dims, 0)), np.zeros(0)
    basis = _orthonormal(np.random.default_rng(seed).standard_normal((dims, min(dims, count + GUARD))))
    images, widest = product(basis), 3 * count + GUARD
    for _ in range(MAX_ROUNDS):
        inner = basis.T @ images
        theta, turn = np.linalg.eigh((inner + inner.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        basis, images = basis @ turn, images @ turn
        wanted = count - len(values)
        residuals = images[:, :wanted] - basis[:, :wanted] * theta[:wanted]
        residuals -= locked @ (locked.T @ residuals)
        top = max([*values[:1], theta[0], 0.0])
        good = np.linalg.norm(residuals, axis=0) <= max(64, dims) * EPS * top
        done = wanted if good.all() else int(np.argmin(good))
        locked, values = np.hstack([locked, basis[:, :done]]), np.append(values, theta[:done])
        if len(values) == count:
            order = np.argsort(-values, kind="stable")
            return values[order], locked[:, order]
        basis, images, theta = basis[:, done:], images[:, done:], theta[done:]
        open_ = np.flatnonzero(~good[done:])
        if basis.shape[1] + len(open_) > widest:
            basis, images = basis[:, :wanted - done + GUARD], images[:, :wanted - done + GUARD]
        room = dims - basis.shape[1] - len(values)
        if not room:  # the basis spans all there is: only its images can still be improved
            basis = _orthonormal(basis, locked)
            images = product(basis)
            continue
        ritz, shifts = basis[:, open_], theta[open_]

        def projected(columns: np.ndarray) -> np.ndarray:
            columns = columns - locked @ (locked.T @ columns)
            return columns - ritz * (ritz * columns).sum(axis=0)

        def corrected(columns: np.ndarray) -> np.ndarray:
            inside = projected(columns)
            return projected(product(inside) - inside * shifts)

        corrections = minres(corrected, projected(-residuals[:, done + open_]), inner_steps)
        added = _orthonormal(corrections, locked, basis)[:, :room]
        if not added.shape[1]:  # nothing new in the corrections: go on from another direction
            added = _orthonormal(np.random.default_rng(len(values)).standard_normal((dims, 1)), locked, basis)
        basis, images = np.hstack([basis, added]), np.hstack([images, product(added)])
    raise RuntimeError(f"{count - len(values)} of {count} eigenpairs did not reach double precision")


# --- vectors as written integers ------------------------------------------------------


def _flat(column: pa.Array, dims: int) -> np.ndarray:
    """The integer vectors of a binary column as rows, without a copy."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    if not dims or not len(column):
        return np.zeros((len(column), dims), np.int64)
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]].view("<i8").reshape(-1, dims)


def integer_vectors(table: DataFrame, vec_id: str, vector: str, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """Written rows ``id, x``: the entries as 64-bit integers ``floor(scale * c) + shift``.

    Left out are rows whose vector is null, holds a null, NaN, infinity or an
    entry too large for 61 bits, or has another length than most of the rest.
    """
    chosen = table.select(F.col(vec_id).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    kind = chosen.schema["id"].dataType.simpleString()

    def integers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(1)
            usable = np.flatnonzero(vectors.is_valid().to_numpy(zero_copy_only=False))
            ids, vectors = batch.column(0).take(pa.array(usable)), vectors.take(pa.array(usable))
            entries = np.floor(vectors.flatten().to_numpy(zero_copy_only=False).astype(float) * scale)
            offsets = vectors.offsets.to_numpy()
            offsets = offsets - offsets[0]
            held = np.abs(entries) < 2.0 ** 61
            bad = np.append(0, np.cumsum(~held))
            fine = np.flatnonzero(bad[offsets[1:]] == bad[offsets[:-1]])
            x = np.where(held, entries, 0).astype("<i8") + shift
            rows = [x[offsets[k]:offsets[k + 1]].tobytes() for k in fine]
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(fine)), pa.array(rows, pa.binary())], names=["id", "x"])

    made = stored(chosen.mapInArrow(integers, f"id {kind}, x binary"), "vectors")
    lengths = made.groupBy(F.length("x").alias("bytes")).count().orderBy(F.desc("count"), F.desc("bytes")).first()
    return made.where(F.length("x") == (lengths["bytes"] if lengths else 0))


@dataclass(frozen=True)
class Whitening:
    """What the rows of the fit list determine: exact sums, and the components as columns."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``n * x - sums``, exactly; Python integers where 64 bits do not suffice."""
        return centred(x, self.n, self.sums)


def centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    middle = [s // n for s in sums]
    rest = [s - n * m for s, m in zip(sums, middle)]
    near = x - np.array(middle, np.int64)
    if len(near) and int(np.abs(near.astype(float)).max()) >= (1 << 61) // n:
        return n * x.astype(object) - np.array(sums, object)
    return n * near - np.array(rest, np.int64)


def deviations(y: np.ndarray) -> list[int | None]:
    """Exact sums of squares of the rows; None where one does not fit 64 bits."""
    rough = (y.astype(float) ** 2).sum(axis=1)
    if y.dtype != object and (rough < 2.0 ** 62).all():
        return (y * y).sum(axis=1).tolist()
    exact = [sum(v * v for v in row) for row in y.astype(object).tolist()]
    return [v if v < 1 << 63 else None for v in exact]


def _summed(vectors: DataFrame, kind: str, of_batch: Callable[[pa.RecordBatch], np.ndarray], cells: int) -> np.ndarray:
    """Cells of fixed number, added over all batches of a task, then over tasks by Spark."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                made = of_batch(batch)
                total = made if total is None else total + made
        if total is not None:
            values = [int(v) for v in total] if kind != "double" else total
            wide = pa.decimal128(38, 0) if kind != "double" else pa.float64()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(cells, dtype=np.int32)), pa.array(values, wide)],
                                             names=["cell", "value"])

    rows = vectors.mapInArrow(partial, f"cell int, value {kind}").groupBy("cell").agg(F.sum("value").alias("value")).collect()
    made = np.zeros(cells, object if kind != "double" else float)
    for row in rows:  # one per cell
        made[row["cell"]] = row["value"]
    return made


def fit_whitening(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The components of all ``vectors`` (see ``integer_vectors``); None without rows or without variance.

    Of ``components`` those are kept whose variance exceeds the rounding of the largest one.
    """
    first = vectors.select("x").first()
    if first is None:
        return None
    dims = len(first["x"]) // 8

    def totals(batch: pa.RecordBatch) -> np.ndarray:
        x = _flat(batch.column("x"), dims)
        low, high = x & 0xFFFFFFFF, x >> 32
        return np.append(low.sum(axis=0).astype(object) + (high.sum(axis=0).astype(object) << 32), len(x))

    *sums, n = [int(v) for v in _summed(vectors, "decimal(38,0)", totals, dims + 1)]
    sums = tuple(sums)

    def product(columns: np.ndarray) -> np.ndarray:
        def of_batch(batch: pa.RecordBatch) -> np.ndarray:
            z = centred(_flat(batch.column("x"), dims), n, sums).astype(float) / n
            return (z.T @ (z @ columns)).ravel()

        return _summed(vectors, "double", of_batch, dims * columns.shape[1]).reshape(dims, -1) / n

    if not dims:
        return None
    values, basis = leading_eigenpairs(product, dims, components)
    kept = values > max(64, dims) * 64 * EPS * max(values[0], 0.0)
    values, basis = values[kept], basis[:, kept]
    k = len(values)

    def moments(batch: pa.RecordBatch) -> np.ndarray:
        z = centred(_flat(batch.column("x"), dims), n, sums).astype(float) / n
        w = z @ basis / np.sqrt(values)
        return np.concatenate([(w.T @ w).ravel(), w.sum(axis=0), [(z * z).sum()]])

    if not k:
        return None
    found = _summed(vectors, "double", moments, k * k + k + 1) / n
    mean = found[k * k:-1]
    error = np.abs(found[:k * k].reshape(k, k) - np.outer(mean, mean) - np.eye(k)).max()
    return Whitening(n, sums, values, basis, float(found[-1]), float(error))


def whiten(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Per usable vector and component ``vec_id, component, n, deviation, whitened, explained, identity_error``.

    Vectors become integers first (see ``integer_vectors``, which also names the
    rows left out). ``deviation`` is the exact sum of ``(n * x - S) ** 2`` over
    the dimensions, null where 64 bits do not hold it. Components are numbered
    from 1 by falling variance; there are fewer than asked for where the
    vectors span fewer dimensions, and no rows where they do not vary at all.
    Null and repeated ids keep their rows; further columns are ignored.
    """
    spark = table.sparkSession
    bound_batches(spark)
    vectors = integer_vectors(table, vec_id, vector)
    model = fit_whitening(vectors, components)
    kind = vectors.schema["id"].dataType.simpleString()
    schema = (f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, "
              "identity_error double")
    if model is None:
        return spark.createDataFrame([], schema)
    k, dims = len(model.values), len(model.sums)
    explained = model.values / model.trace

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = model.centred(_flat(batch.column("x"), dims))
            w = (y.astype(float) / model.n) @ model.vectors / np.sqrt(model.values)
            each = pa.array(np.repeat(np.arange(len(y)), k))
            yield pa.RecordBatch.from_arrays([
                batch.column("id").take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(y))),
                pa.array(np.full(len(y) * k, model.n, np.int64)), pa.array(deviations(y), pa.int64()).take(each),
                pa.array(w.ravel()), pa.array(np.tile(explained, len(y))), pa.array(np.full(len(y) * k, model.identity_error)),
            ], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return vectors.mapInArrow(rows, schema)
