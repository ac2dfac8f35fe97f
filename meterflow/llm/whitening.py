"""Embedding whitening: principal components by contour integration.

The entries of a vector are taken as integers, ``floor(scale * c) + offset``.
Sums and centred products are made on the cluster, in exact integers within a
task. The components of the covariance (a matrix of the embedding's dimension,
whatever the number of rows) follow on the driver:

* Brackets: the pivots of a shifted covariance (brought to tridiagonal form once)
  count the eigenvalues above any shift, so bisection brackets the wanted ones.
  Eigenvalues closer than ``CLUSTER`` of the largest form one cluster.
* Contour: around each cluster a circle crosses the axis in the middle of the
  gaps beside it. Quadrature of complex solves with the covariance shifted to
  points of the circle projects a block of vectors onto the cluster's space.
* Rayleigh-Ritz within that space gives the components; the projection is repeated
  until their residuals are at rounding level.
* The number found inside a circle has to be the difference of the counts at its
  ends, else the block grows and the contour is done again; a cluster that still
  lacks one raises an error, so none is ever missed silently.

Rows whose vector is null, empty, or holds null or non-finite entries (or entries
beyond 2**52 after scaling) are dropped, as are vectors of another length than the most
frequent one (of equally frequent ones the longest). Repeated rows count and are
returned as often as they occur; null ids are kept. Equal eigenvalues are
numbered in the order Rayleigh-Ritz gives, and any basis of their space is right.
Where an eigenvalue is zero to rounding there is nothing to divide by: whitened values of
that component are null and it takes no part in the identity error (null if none
does); without any variance the explained share is null too. ``deviation`` is null
beyond the range of a long. Empty tables give no rows. Vectors of any dimension are
held as single rows; only the id and the vector are read, so further columns may have any name.
"""

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ..shipping import mapped

COMPONENTS = 8
SCALE = 1024
OFFSET = 100_000
LARGEST = 1 << 52
NODES = 8
CLUSTER = 1e-6
SPARE = 3  # vectors of a block beyond the cluster's size
REPEATS = 20
_LONG = (1 << 63) - 1
_LIMB = 20
_BLOCK = 1 << 12


def vectors(column, scale=SCALE, offset=OFFSET):
    """{dimension: (row numbers, integer matrix)} of a batch's usable vectors."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    firsts = np.concatenate([[0], np.cumsum(sizes)])
    found = {}
    for size in np.unique(sizes[sizes > 0]):
        rows = np.flatnonzero(sizes == size)
        entries = np.floor(values[firsts[rows, None] + np.arange(size)] * scale)
        good = (np.abs(entries) < LARGEST).all(1)  # false of nan too
        found[int(size)] = rows[good], entries[good].astype(np.int64) + offset
    return found


def exact_sum(x):
    """Column sums of an integer matrix as Python integers."""
    if not len(x):
        return [0] * x.shape[1]
    if int(np.abs(x).max()) * len(x) < _LONG:
        return x.sum(0).tolist()
    return x.astype(object).sum(0).tolist()


def exact_products(y):
    """``y.T @ y`` of an integer matrix in Python integers: products of 20-bit limbs are exact in floats."""
    d = y.shape[1]
    total = np.zeros((d, d), object)
    for first in range(0, len(y), _BLOCK):
        rest, limbs = y[first : first + _BLOCK], []
        while rest.any():
            low = ((rest + (1 << (_LIMB - 1))) & ((1 << _LIMB) - 1)) - (1 << (_LIMB - 1))
            limbs.append(low.astype(float))
            rest = (rest - low) >> _LIMB
        for i, a in enumerate(limbs):
            for j, b in enumerate(limbs):
                total += (a.T @ b).astype(np.int64).astype(object) << (_LIMB * (i + j))
    return total


class Fit:
    """n, the sums and the covariance of the fit list."""

    def __init__(self, n, sums):
        self.n, self.sums = n, sums
        # Rows are centred in integers: x minus the nearest integer of the mean, then the rest of it.
        self.shift = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
        self.rest = [s - n * int(m) for s, m in zip(sums, self.shift, strict=True)]
        self.mean = np.array([r / n for r in self.rest])
        self.covariance = None

    def centred(self, x):
        """x - S / n in doubles."""
        return (x - self.shift) - self.mean

    def deviations(self, x):
        """Sum of (n x - S)^2 per row, exact; None beyond a long."""
        y = x - self.shift
        most = self.n * int(np.abs(y).max(initial=0)) + max(map(abs, self.rest), default=0)
        if most * most * max(x.shape[1], 1) <= _LONG:
            gap = y * self.n - np.array(self.rest, np.int64)
            return (gap * gap).sum(1).tolist()
        gap = y.astype(object) * self.n - np.array(self.rest, object)
        return [v if v <= _LONG else None for v in (gap * gap).sum(1)]


def fit(df, vector_col="embedding", scale=SCALE, offset=OFFSET):
    """A Fit of all usable vectors (None without any): two passes, sums and then centred products."""

    def sums(batches):
        total = {}
        for batch in batches:
            for size, (rows, x) in vectors(batch.column(0), scale, offset).items():
                n, s = total.get(size, (0, [0] * size))
                total[size] = n + len(rows), [a + b for a, b in zip(s, exact_sum(x), strict=True)]
        for size, (n, s) in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([size] * (size + 1), pa.int32()), pa.array(range(-1, size), pa.int32()), pa.array([Decimal(v) for v in [n, *s]], pa.decimal128(38, 0))],
                names=["size", "at", "value"],
            )

    column = df.select(vector_col)
    totals = column.transform(mapped, sums, "size int, at int, value decimal(38,0)").groupBy("size", "at").agg(F.sum("value").alias("value"))
    totals = totals.persist()
    usual = totals.where("at = -1 AND value > 0").orderBy(F.desc("value"), F.desc("size")).first()
    if usual is None:
        totals.unpersist()
        return None
    listed = {r["at"]: int(r["value"]) for r in totals.where(F.col("size") == usual["size"]).collect()}  # one row per dimension
    totals.unpersist()
    size = usual["size"]
    made = Fit(listed[-1], [listed[k] for k in range(size)])
    upper = np.triu_indices(size)

    def products(batches):
        total = np.zeros((size, size), object)
        for batch in batches:
            _, x = vectors(batch.column(0), scale, offset).get(size, ([], np.empty((0, size), np.int64)))
            total += exact_products(x - made.shift)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(upper[0]), dtype=np.int32)), pa.array(total[upper].astype(float))], names=["at", "value"]
        )

    sums2 = column.transform(mapped, products, "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).toArrow()
    flat = np.zeros(len(upper[0]))
    flat[sums2["at"].to_numpy()] = sums2["value"].to_numpy()
    cov = np.zeros((size, size))
    cov[upper] = flat
    cov = cov + np.triu(cov, 1).T
    made.covariance = cov / made.n - np.outer(made.mean, made.mean)
    return made


def tridiagonal(a):
    """(diagonal, off-diagonal) of a symmetric matrix after Householder reflections."""
    a = np.array(a, float)
    for k in range(len(a) - 2):
        x = a[k + 1 :, k].copy()
        x[0] += np.copysign(np.linalg.norm(x), x[0])
        size = np.linalg.norm(x)
        if size == 0:
            continue
        x /= size
        a[k + 1 :, :] -= 2 * np.outer(x, x @ a[k + 1 :, :])
        a[:, k + 1 :] -= 2 * np.outer(a[:, k + 1 :] @ x, x)
    return np.diag(a).copy(), np.diag(a, 1).copy()


class Inertia:
    """Counts the eigenvalues above a shift by the signs of the shifted matrix's pivots."""

    def __init__(self, matrix):
        self.diagonal, off = tridiagonal(matrix)
        self.squares = off * off
        reach = np.concatenate([[0], np.abs(off)]) + np.concatenate([np.abs(off), [0]])
        self.low, self.high = float((self.diagonal - reach).min()), float((self.diagonal + reach).max())
        self.least = max(np.finfo(float).eps * max(abs(self.low), abs(self.high)) ** 2, np.finfo(float).tiny)

    def above(self, shift):
        count, pivot = 0, 1.0
        for k, value in enumerate((self.diagonal - shift).tolist()):
            pivot = value - (self.squares[k - 1] / pivot if k else 0.0)
            if abs(pivot) < self.least / max(abs(self.high), 1e-300):
                pivot = -self.least / max(abs(self.high), 1e-300)
            count += pivot > 0
        return count

    def bracket(self, k, width):
        """(low, high) around the k-th largest eigenvalue (from 1)."""
        low, high = self.low - width, self.high + width
        while high - low > width:
            middle = (low + high) / 2
            if middle in (low, high):
                break
            if self.above(middle) >= k:
                low = middle
            else:
                high = middle
        return low, high


def clusters(inertia, wanted, closeness=CLUSTER):
    """(low, high, count) circles over the largest eigenvalues, from the top: ``wanted`` of them or more."""
    d = len(inertia.diagonal)
    width = closeness * max(abs(inertia.low), abs(inertia.high), np.finfo(float).tiny)
    found, k, previous = [], 1, None
    while k <= d:
        at = inertia.bracket(k, width / 4)
        if previous is not None and previous[0] - at[1] > width:
            found.append(previous)
            if k > wanted:
                break
            previous = None
        previous = (at[0], previous[1] if previous else at[1], (previous[2] if previous else 0) + 1)
        k += 1
    else:
        found.append(previous)
        at = None
    circles = []
    for c, (low, high, count) in enumerate(found):
        above = found[c - 1][0] if c else None
        below = found[c + 1][1] if c + 1 < len(found) else at[1] if at else None
        reach = min([v for v in (above - high if above is not None else None, low - below if below is not None else None) if v is not None], default=max(high - low, width, abs(high)))
        circles.append((low - reach / 2, high + reach / 2, count))
    return circles


def contour_space(matrix, low, high, block, rng, nodes=NODES, repeats=REPEATS):
    """(values, vectors, residuals) of the Ritz pairs in a circle after repeated projections."""
    d = len(matrix)
    centre, radius = (low + high) / 2, (high - low) / 2
    x, weights = np.polynomial.legendre.leggauss(nodes)
    turns = np.exp(1j * np.pi / 2 * (1 - x))
    basis = rng.normal(size=(d, min(block, d)))
    size = np.abs(matrix).sum(1).max()
    best = None
    for _ in range(repeats):
        projected = np.zeros_like(basis)
        for turn, weight in zip(turns, weights, strict=True):
            solved = np.linalg.solve((centre + radius * turn) * np.eye(d) - matrix, basis.astype(complex))
            projected += weight / 2 * (radius * turn * solved).real
        q, _ = np.linalg.qr(projected)
        values, turned = np.linalg.eigh(q.T @ matrix @ q)
        basis = q @ turned
        inside = (values > low) & (values < high)
        residual = np.linalg.norm(matrix @ basis[:, inside] - basis[:, inside] * values[inside], axis=0)
        worst = residual.max(initial=0.0)
        if best is not None and len(best[0]) == inside.sum() and worst >= best[2].max(initial=0.0) * 0.5:
            break  # at rounding level, or no better
        best = values[inside], basis[:, inside], residual
        if worst <= 1e-15 * size and inside.any():
            break
    return (*best, size)


def principal(matrix, wanted, seed=0):
    """(eigenvalues, unit eigenvectors as columns) of the ``wanted`` largest, falling."""
    wanted = min(wanted, len(matrix))
    inertia, rng = Inertia(matrix), np.random.default_rng(seed)
    if inertia.high - inertia.low <= np.finfo(float).tiny:  # a multiple of the unit matrix
        return np.full(wanted, matrix[0, 0] if len(matrix) else 0.0), np.eye(len(matrix))[:, :wanted]
    values, columns = [], []
    for low, high, count in clusters(inertia, wanted):
        if inertia.above(low) - inertia.above(high) != count:
            raise ArithmeticError(f"{count} eigenvalues bracketed, another number counted in [{low}, {high}]")
        block = count + SPARE
        while True:
            found, vectors_, residual, size = contour_space(matrix, low, high, block, rng)
            if len(found) == count and residual.max(initial=0.0) <= 1e-11 * size:
                break
            if block >= len(matrix):
                raise ArithmeticError(f"{count} eigenvalues counted in [{low}, {high}], {len(found)} found")
            block = min(2 * block, len(matrix))
        values += found[::-1].tolist()
        columns += list(vectors_.T[::-1])
    return np.array(values[:wanted]), np.array(columns[:wanted]).T


def _identity_error(df, vector_col, model, directions, usable, scale, offset):
    """Largest entry of the whitened rows' covariance minus the unit matrix, from the rows themselves."""
    k, size = int(usable.sum()), len(model.sums)
    if not k:
        return None

    def moments(batches):
        total = np.zeros((k + 1, k + 1))
        for batch in batches:
            _, x = vectors(batch.column(0), scale, offset).get(size, ([], np.empty((0, size), np.int64)))
            w = np.column_stack([model.centred(x) @ directions[:, usable], np.ones(len(x))])
            total += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array(np.arange((k + 1) ** 2, dtype=np.int32)), pa.array(total.ravel())], names=["at", "value"])

    rows = df.select(vector_col).transform(mapped, moments, "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).collect()
    total = np.zeros((k + 1) ** 2)
    total[[r["at"] for r in rows]] = [r["value"] for r in rows]
    total = total.reshape(k + 1, k + 1) / model.n
    # The rows are centred already; what is left of their mean is taken off as well.
    return float(np.abs(total[:k, :k] - np.outer(total[k, :k], total[k, :k]) - np.eye(k)).max())


def op_whiten(df, id_col="vec_id", vector_col="embedding", components=COMPONENTS, scale=SCALE, offset=OFFSET):
    """One row per usable vector and component: id, component, n, deviation, whitened, explained, identity_error."""
    kind = df.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    model = fit(df, vector_col, scale, offset)
    if model is None:
        return df.sparkSession.createDataFrame([], schema)
    values, found = principal(model.covariance, components)
    size, k = len(model.sums), len(values)
    usable = values > size * np.finfo(float).eps * max(float(np.abs(values).max()), 1e-300) * 8
    directions = np.where(usable, found / np.sqrt(np.where(usable, values, 1.0)), 0.0)
    trace = float(np.trace(model.covariance))
    error = _identity_error(df, vector_col, model, directions, usable, scale, offset)
    explained = [float(v) / trace if trace > 0 else None for v in values]

    def rows(batches):
        for batch in batches:
            good, x = vectors(batch.column(1), scale, offset).get(size, (np.empty(0, np.int64), np.empty((0, size), np.int64)))
            for a in range(0, len(good), 4096):
                part, own = good[a : a + 4096], x[a : a + 4096]
                m = len(part)
                whitened = model.centred(own) @ directions
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(np.repeat(part, k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * k, model.n)), pa.array(np.repeat(np.array(model.deviations(own), object), k), pa.int64()),
                        pa.array(whitened.ravel(), mask=np.tile(~usable, m)), pa.array(explained * m, pa.float64()),
                        pa.array([error] * (m * k), pa.float64()),
                    ],
                    names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return df.select(id_col, vector_col).transform(mapped, rows, schema)
