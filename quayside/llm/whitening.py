"""Embedding whitening through QDWH spectral divide and conquer.

Entries are put on a grid of whole numbers first, so all sums over the table are exact: each task adds up
whole numbers, split into limbs of 40 bits, and Spark adds the limbs. Sums, covariance, components and deviations
therefore do not depend on how rows are dealt; projected values do so only in their last bits.

The covariance (dimension squared, whatever the number of rows) is taken apart on the driver. The polar
factor of the covariance shifted by a mean eigenvalue, from dynamically weighted Halley steps by QR
(QDWH), is +1 on the eigenvectors above the shift and -1 on those below; half of it plus half the identity
is a spectral projector, whose range and complement are invariant subspaces. Each is split again until it
holds one component. The components are broadcast, and rows are projected where they are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 32
LIMB, LIMBS = 40, 4
#: Rows that are multiplied at once; products of whole numbers up to EXACT stay exact in doubles.
ROWS, EXACT = 4096, 1 << 20
EPS = np.finfo(np.float64).eps
LONG = 1 << 62


# Exact sums

def limbs(values: np.ndarray) -> np.ndarray:
    """Whole numbers (long or Python's own) as longs of 40 bits each, the last one with the sign."""
    out = []
    for _ in range(LIMBS - 1):
        out.append((values & ((1 << LIMB) - 1)).astype(np.int64))
        values = values >> LIMB
    return np.stack([*out, values.astype(np.int64)])


def _whole(row, names=tuple(f"l{i}" for i in range(LIMBS))) -> int:
    return sum(row[name] << (LIMB * i) for i, name in enumerate(names))


def _total(values: np.ndarray) -> np.ndarray:
    """Sums down the columns, exact."""
    small = not values.size or np.abs(values).max() < 1 << 40
    return values.sum(0) if small else values.astype(object).sum(0)


def _gram(values: np.ndarray) -> np.ndarray:
    """Products of all columns, exact, of at most `ROWS` rows of whole numbers."""
    if not values.size or np.abs(values).max() <= EXACT:
        d = values.astype(np.float64)
        return (d.T @ d).astype(np.int64)
    v = values.astype(object)
    return v.T @ v


def grid(column: pa.Array, size: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions and whole numbers of the usable vectors, by length (only `size`, if given).

    A vector is usable if it is there and all its entries are finite. Entries beyond a long's range, of
    which no sum could be told, take the range's end.
    """
    lengths = column.value_lengths().fill_null(-1).to_numpy()
    values = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64)
    starts = np.cumsum(np.maximum(lengths, 0)) - np.maximum(lengths, 0)
    for n in np.unique(lengths) if size is None else [size]:
        if n < 0:
            continue
        at = np.flatnonzero(lengths == n)
        own = values[starts[at][:, None] + np.arange(n)]
        fine = np.isfinite(own).all(1)
        x = np.clip(np.floor(own[fine] * SCALE), -LONG, LONG).astype(np.int64) + OFFSET
        yield at[fine], x


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per length of vector: rows and the sum of every place (place -1 has the rows)."""
    held: dict[int, list] = {}
    for batch in batches:
        for at, x in grid(batch.column("_vector")):
            own = held.setdefault(x.shape[1], [0, np.zeros((LIMBS, x.shape[1]), np.int64)])
            own[0] += len(at)
            own[1] += limbs(_total(x))
    for size, (n, sums) in held.items():
        places = np.concatenate([np.concatenate([[n], np.zeros(LIMBS - 1, np.int64)])[:, None], sums], axis=1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(size + 1, size)), pa.array(np.arange(-1, size)), *map(pa.array, places)],
            names=["size", "place", *(f"l{i}" for i in range(LIMBS))])


def _products(size: int, centre: np.ndarray):
    """Task function: products of all places after taking `centre`, whole numbers near the means, away."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((LIMBS, size, size), np.int64)
        for batch in batches:
            for _, x in grid(batch.column("_vector"), size):
                for start in range(0, len(x), ROWS):
                    held += limbs(_gram(x[start:start + ROWS] - centre))
        i, j = np.triu_indices(size)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i), pa.array(j), *(pa.array(x[i, j]) for x in held)], names=["i", "j", *(f"l{k}" for k in range(LIMBS))])

    return run


# Spectral divide and conquer

def polar(a: np.ndarray, most: int = 60) -> np.ndarray:
    """The orthogonal polar factor of a square matrix, by QDWH steps."""
    n = len(a)
    x = a / max(np.sqrt(np.linalg.norm(a, 1) * np.linalg.norm(a, np.inf)), np.finfo(np.float64).tiny)
    low, eye = EPS, np.eye(n)
    for _ in range(most):
        d = np.cbrt(4 * (1 - low**2) / low**4)
        a_ = math.sqrt(1 + d) + math.sqrt(8 - 4 * d + 8 * (2 - low**2) / (low**2 * math.sqrt(1 + d))) / 2
        b = (a_ - 1) ** 2 / 4
        c = a_ + b - 1
        q, _ = np.linalg.qr(np.concatenate([math.sqrt(c) * x, eye]))
        step = (b / c) * x + (a_ - b / c) / math.sqrt(c) * (q[:n] @ q[n:].T)
        moved = np.linalg.norm(step - x)
        x, low = step, min(1.0, low * (a_ + b * low**2) / (1 + c * low**2))
        if moved <= np.cbrt(EPS) and abs(1 - low) <= 10 * EPS:
            break
    return x


def split(a: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the invariant subspaces above and below a shift; None if all eigenvalues
    of `a` agree within rounding of `scale`."""
    n = len(a)
    mean = np.trace(a) / n
    spread = np.linalg.norm(a - mean * np.eye(n)) / math.sqrt(n)
    if spread <= 4 * EPS * scale:
        return None
    best, rng = None, np.random.default_rng(n)
    # The mean lies between the least and the greatest eigenvalue. A shift that happens to fall on an
    # eigenvalue splits badly, which the coupling left between the two subspaces shows.
    for k in range(24):
        shift = mean + (rng.uniform(-1, 1) * spread if k else 0.0)
        projector = (polar(a - shift * np.eye(n)) + np.eye(n)) / 2
        rank = round(float(np.trace(projector)))
        if not 0 < rank < n:
            continue
        q, _ = np.linalg.qr(projector @ rng.standard_normal((n, rank)))
        q, _ = np.linalg.qr(projector @ q, mode="complete")
        coupling = np.linalg.norm(q[:, :rank].T @ a @ q[:, rank:])
        if best is None or coupling < best[0]:
            best = coupling, q[:, :rank], q[:, rank:]
        if coupling <= 2 * EPS * scale * math.sqrt(n):
            break
    return best and best[1:]


def components(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a symmetric matrix, falling, and unit eigenvectors as columns."""
    scale = np.linalg.norm(a)
    waiting, found = [np.eye(len(a))] if len(a) else [], []
    while waiting:
        basis = waiting.pop()
        inner = basis.T @ a @ basis
        halves = split((inner + inner.T) / 2, scale) if basis.shape[1] > 1 else None
        if halves is None:
            found += list(basis.T)
        else:
            waiting += [basis @ h for h in halves]
    vectors = np.linalg.qr(np.array(found).T)[0] if found else np.zeros((0, 0))
    values = np.einsum("ji,jk,ki->i", vectors, a, vectors)
    order = np.argsort(-values, kind="stable")
    values, vectors = values[order], _polished(a, vectors[:, order], scale)
    vectors = vectors * np.where(np.take_along_axis(vectors, np.abs(vectors).argmax(0)[None], 0) < 0, -1, 1)
    return np.einsum("ji,jk,ki->i", vectors, a, vectors), vectors


def _polished(a: np.ndarray, x: np.ndarray, scale: float) -> np.ndarray:
    """One Newton step on all eigenvectors at once, where eigenvalues are apart."""
    inner, off = x.T @ a @ x, np.eye(len(a)) - x.T @ x
    values = np.diag(inner) / (1 - np.diag(off))
    gap = values[None, :] - values[:, None]
    apart = np.abs(gap) > 1e-6 * scale
    step = np.where(apart, (inner + values[None, :] * off) / np.where(apart, gap, 1), off / 2)
    np.fill_diagonal(step, np.diag(off) / 2)
    return x + x @ step


# Operator

@dataclass(frozen=True)
class Whitening:
    """What is broadcast: `n` fitted vectors of `size` entries, their `sums`, `values` and `vectors` (columns)
    of the components kept, `explained` share of each."""

    size: int
    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray


def fit(vectors: DataFrame, column: str = "embedding", most: int = COMPONENTS) -> Whitening:
    """Components of the grid covariance over all usable vectors of the commonest length (of equals, the
    longest). Components without variance beyond rounding are left out: nothing can be divided by it."""
    rows = vectors.select(F.col(column).cast("array<double>").alias("_vector"))
    names = [f"l{i}" for i in range(LIMBS)]
    added = [F.sum(c).alias(c) for c in names]
    sums = rows.mapInArrow(_sums, "size long, place long, " + ", ".join(f"{c} long" for c in names)).groupBy("size", "place").agg(*added)
    by_size: dict[int, dict[int, int]] = {}
    for row in sums.collect():  # one row per length and place
        by_size.setdefault(row["size"], {})[row["place"]] = _whole(row)
    if not by_size:
        return Whitening(0, 0, [], np.zeros(0), np.zeros((0, 0)), np.zeros(0))
    size = max(by_size, key=lambda s: (by_size[s][-1], s))
    n, total = by_size[size][-1], [by_size[size][i] for i in range(size)]
    centre = [(2 * s + n) // (2 * n) for s in total]
    products = rows.mapInArrow(
        _products(size, np.asarray(centre, np.int64)), "i long, j long, " + ", ".join(f"{c} long" for c in names)
    ).groupBy("i", "j").agg(*added)
    left = [s - n * c for s, c in zip(total, centre)]
    covariance = np.zeros((size, size))
    for row in products.collect():  # the dimension squared, halved
        i, j = row["i"], row["j"]
        covariance[i, j] = covariance[j, i] = (n * _whole(row) - left[i] * left[j]) / (n * n)
    values, axes = components(covariance)
    kept = np.flatnonzero(values > size * EPS * max(values, default=0.0))[:most]
    return Whitening(size, n, total, values[kept], axes[:, kept], values[kept] / np.trace(covariance) if len(kept) else values[kept])


def _placed(fitted: Whitening):
    """Function of grid vectors: deviations (Python's whole numbers or longs) and whitened places."""
    n = fitted.n
    centre = np.asarray([(2 * s + n) // (2 * n) for s in fitted.sums], np.int64)
    left = [s - n * int(c) for s, c in zip(fitted.sums, centre)]
    onto = fitted.vectors / np.sqrt(fitted.values)
    mean = np.asarray([s / n for s in left])
    far = max(map(abs, left), default=0)

    def place(x: np.ndarray) -> tuple[list[int | None], np.ndarray]:
        y = x - centre
        most = n * int(np.abs(y).max(initial=0)) + far
        if most * most * max(1, x.shape[1]) < 1 << 63:
            away = ((n * y - np.asarray(left, np.int64)) ** 2).sum(1).tolist()
        else:
            wide = y.astype(object) * n - np.asarray(left, object)
            away = [a if a < 1 << 63 else None for a in (wide * wide).sum(1)]
        return away, (y - mean) @ onto

    return place


def whiten(
    vectors: DataFrame, column: str = "embedding", id_column: str = "vec_id", most: int = COMPONENTS,
) -> DataFrame:
    """Every usable vector on every component kept, whitened.

    Returns the id, component (from 1, by falling eigenvalue), n (vectors fitted), deviation (sum over
    dimensions of (n*x-S)^2; null beyond a long), whitened, explained and identity_error (largest entry of
    the whitened covariance minus the identity, measured over all rows).

    Rows whose vector is null or holds null or non-finite entries are dropped, and so are rows of another
    length than the commonest. Ids may be null or repeated; repeated rows count as often as they occur.
    Without rows, or without variance, there are no rows; other columns are not looked at.
    """
    fitted = fit(vectors, column, most)
    k = len(fitted.values)
    rows = vectors.select(F.col(id_column).alias("_id"), F.col(column).cast("array<double>").alias("_vector"))

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held = _placed(fitted), np.zeros((k, k))
        for batch in batches:
            for _, x in grid(batch.column("_vector"), fitted.size):
                z = place(x)[1]
                held += z.T @ z
        i, j = np.indices((k, k)).reshape(2, -1)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(held.ravel())], names=["i", "j", "v"])

    error = 0.0
    if k:
        seen = rows.mapInArrow(measured, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
        error = max(abs(r["v"] / fitted.n - (r["i"] == r["j"])) for r in seen.collect())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = _placed(fitted)
        for batch in batches:
            for at, x in grid(batch.column("_vector"), fitted.size):
                for start in range(0, len(at), ROWS):
                    own = at[start:start + ROWS]
                    away, z = place(x[start:start + ROWS])
                    repeat = pa.array(np.repeat(np.arange(len(own)), k))
                    many = len(own) * k
                    yield pa.RecordBatch.from_arrays([
                        batch.column("_id").take(pa.array(own)).take(repeat), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(own))),
                        pa.array(np.full(many, fitted.n)), pa.array(away, pa.int64()).take(repeat), pa.array(z.ravel()),
                        pa.array(np.tile(fitted.explained, len(own))), pa.array(np.full(many, error)),
                    ], names=["_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    kind = vectors.schema[id_column].dataType.simpleString()
    schema = f"_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    placed = rows.mapInArrow(run, schema) if k else rows.sparkSession.createDataFrame([], schema)
    return placed.withColumnRenamed("_id", id_column)
