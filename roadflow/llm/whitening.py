"""Embedding whitening: vectors projected on the leading principal components of a table, each with variance one.

Entries become whole numbers ``x = floor(64 c) + 1000000``, and the fit list is every distinct x vector once, so
copies weigh nothing. Spark adds up the fit list in two passes: sums, then products of entries centred at the
whole number next to the mean. Both are whole numbers, so the covariance is the exact one, rounded once, and
the same on every run. The driver holds nothing but that matrix (dimension x dimension): Householder
reflections make it tridiagonal, Sturm counts bisect the leading eigenvalues, and inverse iteration with
reorthogonalisation inside clusters gives their vectors. Rows are projected in place, without a shuffle.

Edge cases. Dropped: null vectors, empty ones, those with a null or non-finite entry or one of magnitude
``LIMIT`` or more, and those of another length than most of the fit list (of two equally common lengths the
longer counts). A null id is kept, repeated rows are each returned, other columns are not read, whatever their
names. Components whose eigenvalue is not above ``LEAST`` of the trace do not exist: a table of one vector or
none has no rows. Equal eigenvalues: any orthonormal vectors of their space, the same for all rows. A deviation
that no long holds is null. Very long vectors: the driver's matrix grows with the square of their length.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadflow.llm.common import stored

SCALE = 64
OFFSET = 1_000_000
#: Entries of this magnitude count as not finite: sums of products stay below 38 digits.
LIMIT = float(2**40)
COMPONENTS = 16
#: An eigenvalue this small, as a share of the trace, is rounding noise.
LEAST = 1e-12
#: Eigenvalues nearer than this share of the largest are one cluster.
CLUSTER = 1e-3
BLOCK = 4096


@dataclass(frozen=True)
class Whitening:
    """A fitted projection: ``n`` vectors with exact ``sums``; ``vectors`` (dimension x components) are unit
    eigenvectors of the covariance by falling ``values``."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    @property
    def dimension(self) -> int:
        return len(self.sums)

    def centre(self) -> np.ndarray:
        """The whole number next to each mean."""
        return np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], dtype=np.int64)

    def rest(self) -> list[int]:
        """n times the distance of each mean from its centre."""
        return [s - self.n * int(c) for s, c in zip(self.sums, self.centre(), strict=True)]


def scaled(column: Column) -> Column:
    """x of every entry."""
    return F.transform(column, lambda c: F.floor(c.cast("double") * SCALE) + OFFSET)


def usable(column: Column) -> Column:
    """Whether a vector has entries, all of them finite."""
    whole = F.forall(column, lambda c: F.coalesce(F.abs(c.cast("double")) < LIMIT, F.lit(False)))
    return F.coalesce(whole & (F.size(column) > 0), F.lit(False))


# --- sums over the fit list -------------------------------------------------------------------------------

def _matrices(batches: Iterator[pa.RecordBatch], dimension: int) -> Iterator[np.ndarray]:
    """The x vectors of Arrow batches as matrices of at most ``BLOCK`` rows."""
    for batch in batches:
        rows = batch.column(batch.schema.get_field_index("x")).flatten().to_numpy().reshape(-1, dimension)
        for at in range(0, len(rows), BLOCK):
            yield rows[at : at + BLOCK]


def exact_products(y: np.ndarray) -> np.ndarray:
    """y' y of whole numbers, exactly: in floating point where every partial sum is below 2^53."""
    largest = int(np.abs(y).max(initial=0))
    if largest * largest * len(y) < 1 << 53:
        f = y.astype(np.float64)
        return (f.T @ f).astype(np.int64).astype(object)
    f = y.astype(object)
    return f.T.dot(f)


def _added(fit: DataFrame, per_task: Callable, cells: int) -> list[int]:
    """Whole numbers per cell, summed within each task by ``per_task`` and over the tasks by Spark."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = per_task(batches)
        if values is not None:
            numbers = pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))
            yield pa.record_batch([pa.array(range(cells), pa.int64()), numbers], names=["cell", "value"])

    sums = fit.mapInArrow(partial, "cell long, value decimal(38,0)").groupBy("cell").agg(F.sum("value").alias("value"))
    got = dict.fromkeys(range(cells), 0)
    got.update((r.cell, int(r.value)) for r in sums.collect())  # as many rows as cells: set by the dimension
    return [got[c] for c in range(cells)]


def _sums(fit: DataFrame, dimension: int) -> tuple[int, list[int]]:
    def per_task(batches):
        total = None
        for x in _matrices(batches, dimension):
            part = np.append(x.sum(axis=0), len(x)).astype(object)  # below 2^62 for a block
            total = part if total is None else total + part
        return total

    *sums, n = _added(fit, per_task, dimension + 1)
    return n, sums


def covariance(fit: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """The covariance of the fit list, divisor n. Entries are centred at a whole number before they are multiplied;
    what the mean differs from it is taken off in exact arithmetic."""
    d = len(sums)
    model = Whitening(n, sums, np.zeros((d, 0)), np.zeros(0), 0.0)
    centre, rest = model.centre(), model.rest()
    upper = np.triu_indices(d)

    def per_task(batches):
        total = None
        for x in _matrices(batches, d):
            part = exact_products(x - centre)[upper]
            total = part if total is None else total + part
        return total

    cells = _added(fit, per_task, len(upper[0]))
    v = np.zeros((d, d))
    for i, j, cell in zip(*upper, cells, strict=True):
        v[i, j] = v[j, i] = (n * cell - rest[i] * rest[j]) / (n * n)  # whole numbers: rounded once
    return v


# --- eigenvectors of the covariance -----------------------------------------------------------------------

def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal and off-diagonal of H matrix H', and the unit vectors of the reflections H is made of."""
    a = matrix.copy()
    d = len(a)
    reflections = []
    for k in range(d - 2):
        v = a[k + 1 :, k].copy()
        alpha = -np.copysign(np.linalg.norm(v), v[0])
        v[0] -= alpha
        length = np.linalg.norm(v)
        if length > 0:
            v /= length
            block = a[k + 1 :, k + 1 :]
            p = block @ v
            p -= (v @ p) * v
            block -= 2 * (np.outer(v, p) + np.outer(p, v))
            a[k + 1, k] = a[k, k + 1] = alpha
        reflections.append(v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), reflections


def sturm_counts(diag: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues of a tridiagonal matrix lie below each number of ``at``."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    q, below = np.ones_like(at), np.zeros(len(at), dtype=int)
    for d, e in zip(diag, np.append(0, off), strict=True):
        q = d - at - e * e / q
        q = np.where(np.abs(q) < tiny, -tiny, q)
        below += q < 0
    return below


def leading_values(diag: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, each bisected until no double lies between its bounds."""
    reach = np.abs(np.append(off, 0)) + np.abs(np.append(0, off))
    low = np.full(k, (diag - reach).min())
    high = np.full(k, (diag + reach).max())
    pad = np.finfo(float).eps * max(abs(low[0]), abs(high[0])) + np.finfo(float).tiny
    low, high = low - pad, high + pad
    allowed = len(diag) - 1 - np.arange(k)  # eigenvalue i has at most so many below it
    while True:
        middle = low + (high - low) / 2
        if np.all((middle <= low) | (middle >= high)):
            return middle
        over = sturm_counts(diag, off, middle) > allowed
        high = np.where(over, middle, high)
        low = np.where(over, low, middle)


def _solve(diag: np.ndarray, off: np.ndarray, shift: float, b: np.ndarray) -> np.ndarray:
    """(T - shift) z = b by elimination with row exchanges; a zero pivot becomes a tiny one."""
    n = len(diag)
    small = np.finfo(float).eps * max(np.abs(diag).max(), np.abs(off).max(initial=0), np.finfo(float).tiny)
    main, up, up2, z = diag - shift, np.append(off, 0.0), np.zeros(n), b.copy()
    for i in range(n - 1):
        below, nxt, nxt_up = off[i], main[i + 1], up[i + 1]
        if abs(below) > abs(main[i]):
            factor = main[i] / below
            main[i], old_up = below, up[i]
            up[i], up2[i] = nxt, nxt_up
            main[i + 1], up[i + 1] = old_up - factor * nxt, -factor * nxt_up
            z[i], z[i + 1] = z[i + 1], z[i] - factor * z[i + 1]
        else:
            main[i] = main[i] if abs(main[i]) > small else small
            factor = below / main[i]
            main[i + 1] = nxt - factor * up[i]
            z[i + 1] -= factor * z[i]
    main[n - 1] = main[n - 1] if abs(main[n - 1]) > small else small
    for i in range(n - 1, -1, -1):
        z[i] -= (up[i] * z[i + 1] if i + 1 < n else 0) + (up2[i] * z[i + 2] if i + 2 < n else 0)
        z[i] /= main[i]
    return z


def leading_vectors(diag: np.ndarray, off: np.ndarray, values: np.ndarray, rounds: int = 4) -> np.ndarray:
    """Unit eigenvectors by inverse iteration, orthogonal to the earlier ones of their cluster after each round."""
    n, scale = len(diag), max(abs(values).max(initial=0), np.finfo(float).tiny)
    start = np.random.default_rng(1).standard_normal((len(values), n))
    found = np.zeros((n, len(values)))
    first = 0
    for i, value in enumerate(values):
        if i and values[i - 1] - value > CLUSTER * scale:
            first = i
        shift = value - (i - first) * np.finfo(float).eps * scale  # equal eigenvalues get different systems
        z = start[i] / np.linalg.norm(start[i])
        for _ in range(rounds):
            z = _solve(diag, off, shift, z)
            z /= np.abs(z).max()
            for _ in range(2):
                z = z - found[:, first:i] @ (found[:, first:i].T @ z)
            z /= np.linalg.norm(z)
        found[:, i] = z
    return found


def leading_components(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues of a symmetric matrix, falling, and their unit vectors as columns."""
    scale = np.abs(matrix).max(initial=0)
    if not k or not scale:
        return np.zeros(0), np.zeros((len(matrix), 0))
    diag, off, reflections = tridiagonal(matrix / scale)
    values = leading_values(diag, off, k)
    vectors = leading_vectors(diag, off, values)
    for i in range(len(reflections) - 1, -1, -1):
        v = reflections[i]
        vectors[i + 1 :] -= 2 * np.outer(v, v @ vectors[i + 1 :])
    return values * scale, vectors / np.linalg.norm(vectors, axis=0)


# --- the operator ------------------------------------------------------------------------------------------

def fit_list(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """Every distinct x vector once, stored. Copies are dropped within the reading tasks before the shuffle."""
    x = vectors.where(usable(F.col(column))).select(scaled(F.col(column)).alias("x")).distinct()
    fit = stored(x, "whitening-fit")
    common = fit.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return fit.where(F.size("x") == (common.d if common else 0))


def fit(fitting: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of a fit list, or None if it has no vectors."""
    first = fitting.first()
    if first is None:
        return None
    n, sums = _sums(fitting, len(first.x))
    v = covariance(fitting, n, sums)
    trace = float(np.trace(v))
    values, vectors = leading_components(v, min(components, len(v)))
    kept = int((values > LEAST * trace).sum())
    return Whitening(n, sums, vectors[:, :kept], values[:kept], trace)


def _projector(model: Whitening) -> Callable[[np.ndarray], np.ndarray]:
    centre = model.centre()
    mean = np.array([r / model.n for r in model.rest()])
    weights = model.vectors / np.sqrt(model.values)
    return lambda x: ((x - centre) - mean) @ weights


def _deviations(model: Whitening) -> Callable[[np.ndarray], list]:
    """Sum of (n x - S)^2 per row, exactly; None where a long does not hold it."""
    centre, rest, n, d = model.centre(), model.rest(), model.n, model.dimension

    def of(x: np.ndarray) -> list:
        y = x - centre
        largest = n * int(np.abs(y).max(initial=0)) + max(map(abs, rest))
        kind = np.int64 if d * largest * largest < 1 << 63 else object
        far = n * y.astype(kind) - np.array(rest, dtype=kind)
        return [int(s) if s < 1 << 63 else None for s in (far * far).sum(axis=1).tolist()]

    return of


def identity_error(fitting: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the covariance of the whitened fit list minus the identity, measured over it."""
    project, d, k = _projector(model), model.dimension, len(model.values)
    cells = k * (k + 1)

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for x in _matrices(batches, d):
            w = project(x)
            total += np.vstack([w.T @ w, w.sum(axis=0)])
        yield pa.record_batch([pa.array(range(cells), pa.int64()), pa.array(total.ravel())], names=["cell", "value"])

    sums = fitting.mapInArrow(per_task, "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value"))
    total = np.zeros(cells)
    for r in sums.collect():
        total[r.cell] = r.value
    total = total.reshape(k + 1, k) / model.n
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max(initial=0))


def whitened(vectors: DataFrame, model: Whitening, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """id, exact ``deviation`` and the ``whitened`` coordinates of every usable row, by the model every task gets."""
    project, deviations, d = _projector(model), _deviations(model), model.dimension
    rows = vectors.where(usable(F.col(column)) & (F.size(column) == d)).select(F.col(id_column).alias("id"), scaled(F.col(column)).alias("x"))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().reshape(-1, d)
            w = project(x)
            flat = pa.FixedSizeListArray.from_arrays(pa.array(w.ravel()), w.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.record_batch([batch.column(0), pa.array(deviations(x), pa.int64()), flat], names=["id", "deviation", "whitened"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(apply, f"id {kind}, deviation long, whitened array<double>").withColumnRenamed("id", id_column)


REPORT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitening_report(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """One row per usable vector and component."""
    fitting = fit_list(vectors, column)
    model = fit(fitting)
    if model is None or not len(model.values):
        kind = vectors.schema[id_column].dataType.simpleString()
        return vectors.sparkSession.createDataFrame([], f"{id_column} {kind}, {REPORT}")
    error = identity_error(fitting, model)
    shares = F.array(*[F.lit(float(e / model.trace)) for e in model.values])
    rows = whitened(vectors, model, id_column, column).select(id_column, "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return rows.select(
        id_column,
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
