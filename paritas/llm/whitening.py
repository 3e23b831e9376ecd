"""Whitening of embeddings: principal components by FEAST contour integration.

Vectors become integers, floor(256 x).  The covariance of the distinct ones is
summed on the executors, centred before multiplying: partial matrices per task,
d rows of d numbers, whatever the number of vectors.

Eigenvalue intervals come from inertia counts: the covariance is brought to
tridiagonal form, and the signs of the pivots of the form less a shift tell how
many eigenvalues lie below the shift (Sylvester).  Bisection on these counts
brackets the wanted eigenvalues; each group that a gap sets apart gets an interval
of its own.  The intervals are rows of a table and are solved side by side.  FEAST
on one: the spectral projector, an integral of the resolvent over a circle
through the interval's ends, is applied to a block of vectors by quadrature, that
is by solving complex shifted systems; Rayleigh-Ritz on the projected block gives
eigenpairs, and both repeat until the residuals are at rounding.  The count of
pairs found in the interval must equal its inertia count, and the counts of all
intervals that of everything above the lowest one, so no eigenvalue is missed.

Only d x d numbers reach the driver, d the length of the vectors; rows never do.

Defined cases: vectors that are null or hold null or non-finite entries take no
part, nor do empty ones.  Vectors of one length are whitened by themselves, so a
table with several lengths has a fit, and an ``identity_error``, for each.  A null
id is kept; rows that repeat come out each.  Directions without variance are no
components: fewer than k come out where the rank is lower, none where all
vectors are equal.  Eigenvalues that are equal to rounding span their directions
in any rotation, the same for all rows.  Numbers beyond 2^40 after scaling and
deviations beyond 63 bits end the query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paritas.llm.common import Workspace, ship

K, SCALE = 4, 256
#: Scaled entries must stay below this, so that sums over 2^22 rows of a task fit in 63 bits.
_LARGEST = 1 << 40
#: Quadrature nodes on the half circle, FEAST rounds at most, and vectors of a block beyond the expected count.
_NODES, _ROUNDS, _SPARE = 8, 40, 4
#: Eigenvalues nearer than this share of the largest count as one group; below the second share they count as zero.
_GAP, _ZERO = 1e-9, 1e-13


# Rows and sums


def _scaled(vector: Column) -> Column:
    """The integer vector; null unless the vector is whole."""
    sound = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    scaled = F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE))
    fits = F.forall(vector, lambda c: F.abs(c.cast("double") * SCALE) < _LARGEST)
    return F.when(
        vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(sound, F.lit(False)),
        F.when(fits, scaled).otherwise(F.raise_error(F.lit("scaled entries must be below 2^40"))),
    )


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _column_sums(d: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, total = 0, np.zeros(d, np.int64)
        for batch in batches:
            if batch.num_rows:
                rows += batch.num_rows
                total += _matrix(batch.column("x"), d).sum(axis=0)
                if rows >= 1 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(np.arange(d)), pa.array(total), pa.array(np.full(d, rows))], ["i", "s", "n"])
                    rows, total = 0, np.zeros(d, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d)), pa.array(total), pa.array(np.full(d, rows))], ["i", "s", "n"])

    return run


def _product_sums(mean: np.ndarray, directions: np.ndarray | None = None):
    """Partial sums of products of centred vectors, or of their projections, as rows ``(i, j, g)`` with i <= j."""
    d = len(mean)
    size = d if directions is None else directions.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            if batch.num_rows:
                y = _matrix(batch.column("x"), d) - mean
                y = y if directions is None else y @ directions
                total += y.T @ y
        for i in range(size):
            j = np.arange(i, size)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(size - i, i)), pa.array(j), pa.array(total[i, i:])], ["i", "j", "g"])

    return run


def _symmetric(fit: DataFrame, mean: np.ndarray, n: int, directions: np.ndarray | None = None) -> np.ndarray:
    """Covariance over ``fit`` (``x``), or that of its projections; d x d numbers come to the driver."""
    size = len(mean) if directions is None else directions.shape[1]
    parts = fit.select("x").mapInArrow(_product_sums(mean, directions), "i long, j long, g double")
    sums = parts.groupBy("i", "j").agg(F.sum("g").alias("g")).toArrow()
    out = np.zeros((size, size))
    i, j = sums.column("i").to_numpy(), sums.column("j").to_numpy()
    out[i, j] = out[j, i] = sums.column("g").to_numpy() / n
    return out


# Inertia counts and intervals


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a symmetric matrix after Householder reflections on both sides."""
    a = matrix.copy()
    d = len(a)
    for k in range(d - 2):
        x = a[k + 1 :, k].copy()
        x[0] += np.copysign(np.linalg.norm(x), x[0])
        norm = np.linalg.norm(x)
        if norm == 0:
            continue
        x /= norm
        a[k + 1 :, :] -= 2 * np.outer(x, x @ a[k + 1 :, :])
        a[:, k + 1 :] -= 2 * np.outer(a[:, k + 1 :] @ x, x)
    return np.diagonal(a).copy(), np.diagonal(a, 1).copy()


def inertia(diagonal: np.ndarray, beside: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """Number of eigenvalues below each shift: negative pivots of the tridiagonal form less the shift."""
    least = np.finfo(float).eps ** 2 * max(1.0, float(np.abs(diagonal).max()))
    pivot = diagonal[0] - shifts
    below = (pivot < 0).astype(int)
    for a, b in zip(diagonal[1:], beside):
        pivot = np.where(np.abs(pivot) < least, -least, pivot)
        pivot = a - shifts - b * b / pivot
        below += pivot < 0
    return below


def _bracketed(diagonal: np.ndarray, beside: np.ndarray, count: int, bound: float) -> np.ndarray:
    """The ``count`` largest eigenvalues, falling, by bisection on inertia counts to about 1e-12 of the bound."""
    want = len(diagonal) - np.arange(count)  # so many lie at or below the sought one
    low, high = np.full(count, -bound * 1e-3), np.full(count, bound * 1.001)
    for _ in range(41):
        middle = (low + high) / 2
        above = inertia(diagonal, beside, middle) < want
        low, high = np.where(above, middle, low), np.where(above, high, middle)
    return (low + high) / 2


def intervals(matrix: np.ndarray, k: int) -> list[tuple[float, float, int]]:
    """``(low, high, count)`` of disjoint intervals that hold the k largest eigenvalues, and ties of the last.

    Ends lie half way into the narrower of the gaps beside a group; counts are inertia counts.
    """
    diagonal, beside = tridiagonal(matrix)
    bound = float(np.abs(matrix).sum(axis=1).max())
    if not bound > 0:
        return []
    values = _bracketed(diagonal, beside, len(diagonal), bound) if len(diagonal) <= 2 * k else None
    reach = min(len(diagonal), 2 * k)
    while values is None:
        values = _bracketed(diagonal, beside, reach, bound)
        gaps = np.flatnonzero(-np.diff(values) > _GAP * values[0])
        if reach < len(diagonal) and not len(gaps[gaps >= k - 1]):
            reach, values = min(len(diagonal), 2 * reach), None  # ties of the last go on beyond
    values = values[values > _ZERO * len(diagonal) * values[0]]
    out: list[tuple[float, float, int]] = []
    first, seen = 0, 0
    while seen < min(k, len(values)):
        last = first
        while last + 1 < len(values) and values[last] - values[last + 1] <= _GAP * values[0]:
            last += 1
        spread = values[first] - values[last]
        over = values[first - 1] - values[first] if first else bound * 1.001 - values[first] + values[first] / 2
        under = values[last] - values[last + 1] if last + 1 < len(values) else values[last]
        margin = min(over, under) / 2
        low, high = values[last] - margin, values[first] + margin
        count = int(np.diff(inertia(diagonal, beside, np.array([low, high])))[0])
        if count != last - first + 1:
            raise RuntimeError(f"{count} eigenvalues between {low} and {high}, bisection saw {last - first + 1}")
        out.append((float(low), float(high), count))
        first, seen = last + 1, seen + count
    total = len(diagonal) - int(inertia(diagonal, beside, np.array([out[-1][0]]))[0]) if out else 0
    if total != seen:
        raise RuntimeError(f"{total} eigenvalues above the lowest interval, {seen} in the intervals")
    return out


# FEAST


def feast(matrix: np.ndarray, low: float, high: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """``(eigenvalues falling, unit eigenvectors as columns)`` of the ``count`` eigenvalues in an interval."""
    d = len(matrix)
    width = min(d, count + _SPARE)
    centre, radius = (low + high) / 2, (high - low) / 2
    angles = np.pi * (np.arange(_NODES) + 0.5) / _NODES
    nodes = centre + radius * np.exp(1j * angles)
    block = np.random.default_rng(1).standard_normal((d, width))
    block = np.linalg.qr(block)[0]
    best, tolerance = np.inf, np.finfo(float).eps * np.abs(matrix).sum(axis=1).max()
    found = None
    for _ in range(_ROUNDS):
        projected = np.zeros((d, width))
        for z, angle in zip(nodes, angles):  # the lower half circle gives the conjugate
            solved = np.linalg.solve(z * np.eye(d) - matrix, block.astype(complex))
            projected += (np.exp(1j * angle) * solved).real * (radius / _NODES)
        basis = np.linalg.qr(projected)[0]
        values, turn = np.linalg.eigh(basis.T @ matrix @ basis)
        block = basis @ turn
        inside = np.flatnonzero((values > low) & (values < high))
        if len(inside) == count:
            vectors = block[:, inside]
            residual = float(np.linalg.norm(matrix @ vectors - vectors * values[inside], axis=0).max())
            if residual < best:
                found = values[inside][::-1], vectors[:, ::-1]
            if residual <= 4 * tolerance or (residual >= best / 2 and best <= 1000 * tolerance):
                break
            best = min(best, residual)
    if found is None:
        raise RuntimeError(f"{count} eigenvalues counted between {low} and {high}, {len(inside)} found")
    return found


def _solver(matrix: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                values, vectors = feast(matrix, row["low"], row["high"], row["count"])
                yield pa.RecordBatch.from_pydict({"value": values, "vector": list(vectors.T)})

    return run


def leading_components(fit: DataFrame, matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues above zero, falling, and unit eigenvectors as columns.

    Every interval is a task of its own.  A last Rayleigh-Ritz step over all of them makes the columns orthogonal.
    """
    spark = fit.sparkSession
    rows = intervals(matrix, k)
    if not rows:
        return np.zeros(0), np.zeros((len(matrix), 0))
    table = spark.createDataFrame(rows, "low double, high double, count int").repartitionByRange(len(rows), "low")
    pairs = table.mapInArrow(_solver(matrix), "value double, vector array<double>").toArrow()
    basis = np.linalg.qr(np.array(pairs.column("vector").to_pylist()).T)[0]
    values, turn = np.linalg.eigh(basis.T @ matrix @ basis)
    values, vectors = values[::-1][:k], (basis @ turn)[:, ::-1][:, :k]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return values, vectors * signs


def _project(n: int, sums: list[int], directions: np.ndarray, explained: np.ndarray, error: float):
    mean, k = np.array([s / n for s in sums]), directions.shape[1]
    most = (1 << 63) - 1

    def deviations(x: np.ndarray) -> np.ndarray:
        rough = n * x.astype(float) - np.array(sums, float)
        if not len(x) or np.square(rough).sum(axis=1).max() < 2.0**62:
            return np.square(n * x - np.array(sums)).sum(axis=1)
        exact = [sum((n * int(c) - s) ** 2 for c, s in zip(row, sums)) for row in x]
        if max(exact) > most:
            raise OverflowError("a deviation does not fit in 63 bits")
        return np.array(exact, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column("x"), len(sums))
                rows = np.repeat(np.arange(len(x)), k)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(pa.array(rows)),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                        pa.array(np.full(len(rows), n)),
                        pa.array(deviations(x)[rows]),
                        pa.array(((x - mean) @ directions).reshape(-1)),
                        pa.array(np.tile(explained, len(x))),
                        pa.array(np.full(len(rows), error)),
                    ],
                    ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return run


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K) -> DataFrame:
    """``<id>, component, n, deviation, whitened, explained, identity_error``: a row per vector and component.

    ``n`` is the number of distinct integer vectors x the components are fitted
    on, each counted once; ``deviation`` the exact sum of (n x - S)^2, S their sums;
    ``whitened`` the centred vector on the component over the root of its
    eigenvalue; ``explained`` the eigenvalue's share of the trace;
    ``identity_error`` the largest entry of the covariance of ``whitened`` over
    the fitted vectors less the identity.
    """
    spark = vectors.sparkSession
    ship(spark)
    work = Workspace(spark, "whitening")
    vector = F.col(f"`{vector_col}`")
    scaled = vectors.select(F.col(f"`{id_col}`").alias("id"), _scaled(vector).alias("x")).where("x is not null")
    fit = work.write(scaled.select("x").distinct(), "fit")
    kind = dict(scaled.dtypes)["id"]
    layout = f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    results = [spark.createDataFrame([], layout)]
    for row in sorted(fit.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).collect()):
        d, n = row["d"], row["n"]
        part = fit.where(F.size("x") == d)
        parts = part.mapInArrow(_column_sums(d), "i long, s long, n long").groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
        sums = [int(r["s"]) for r in parts.orderBy("i").collect()]
        mean = np.array([s / n for s in sums])
        covariance = _symmetric(part, mean, n)
        values, components = leading_components(fit, covariance, k)
        if len(values):
            directions = components / np.sqrt(values)
            error = float(np.abs(_symmetric(part, mean, n, directions) - np.eye(len(values))).max())
            rows = scaled.where(F.size("x") == d)
            results.append(rows.mapInArrow(_project(n, sums, directions, values / np.trace(covariance), error), layout))
    out = results[0] if len(results) == 1 else results[1]
    for other in results[2:]:
        out = out.union(other)
    return out.withColumnRenamed("id", id_col)
