"""Whitening of embeddings with components found by spectral divide and conquer.

Spark adds up, over all rows, the exact integer sums and the centred covariance, merged in each task first. The
covariance, as large as the square of the dimension whatever the number of rows, is split on the driver: the polar factor
of the covariance less a shift, by the QR-based dynamically weighted Halley iteration (QDWH), gives the projector on the
subspace of the eigenvalues above the shift; orthonormal bases of that subspace and of its complement compress the
covariance to two smaller ones, which are split likewise until single components are left. The few leading components are
broadcast, and every row is projected on them where it lies.

Rows whose vector is null or holds null or non-finite entries take no part; of vectors of several lengths those of the
most frequent one do (of equally frequent ones the longest); a vector with an entry that 64 bits cannot hold once it is scaled
takes no part either. Repeated rows count as often as they occur. Components whose
eigenvalue is below `FLOOR` of the total, as with too few or equal rows, have no direction in double precision and are not
given; no row has any then if all vectors are equal. A deviation beyond 64 bits is null. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMPONENTS = 8
#: Fixed value: entries become floor(SCALE * entry) + OFFSET.
SCALE, OFFSET = 1024, 100_000
#: Share of the total variance under which rounding hides a component.
FLOOR = 1e-11
#: Rows a task adds up at a time.
ROWS = 4096
_EPS = np.finfo(float).eps


# --- spectral divide and conquer -------------------------------------------------


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix by the QDWH iteration.

    The singular values of a / bound lie in (0, 1]; `low`, at first far below any that matters, is what the smallest
    has come to. The weights are the best of all rational steps of their kind for it, so six steps or so are enough.
    """
    n = len(a)
    bound = np.linalg.norm(a)
    if bound == 0:
        return np.eye(n)
    x, low, unit = a / bound, _EPS / n, np.eye(n)
    for _ in range(40):
        d = np.cbrt(4 * (1 - low**2) / low**4)
        s = np.sqrt(1 + d)
        wa = s + np.sqrt(8 - 4 * d + 8 * (2 - low**2) / (low**2 * s)) / 2
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        if wc > 100:
            q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, unit]))
            new = (wb / wc) * x + (wa - wb / wc) / np.sqrt(wc) * (q[:n] @ q[n:].T)
        else:  # well conditioned by now: Cholesky factors do
            half = np.linalg.cholesky(unit + wc * (x.T @ x))
            inside = np.linalg.solve(half.T, np.linalg.solve(half, x.T)).T
            new = (wb / wc) * x + (wa - wb / wc) * inside
        low = min(1.0, low * (wa + wb * low**2) / (1 + wc * low**2))
        change = np.linalg.norm(new - x)
        x = (new + new.T) / 2
        if abs(1 - low) < 10 * _EPS and change < np.cbrt(_EPS):
            break
    return x


def _bases(a: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray, float] | None:
    """Orthonormal bases of the invariant subspaces above and below the shift, and what couples them; None where the
    shift has all eigenvalues on one side, or one of them upon it."""
    n = len(a)
    projector = (polar(a - shift * np.eye(n)) + np.eye(n)) / 2
    rank = int(round(np.trace(projector)))
    if not 0 < rank < n or abs(np.trace(projector) - rank) > 0.01:
        return None
    # the columns of the projector span the subspace; the longest of them first, as a start for two steps of iteration
    longest = np.argsort(-np.einsum("ij,ij->j", projector, projector), kind="stable")
    start = projector @ np.linalg.qr(projector[:, longest[:rank]] + 1e-8 * np.eye(n)[:, :rank])[0]
    whole = np.linalg.qr(projector @ np.linalg.qr(start)[0], mode="complete")[0]
    above, below = whole[:, :rank], whole[:, rank:]
    return above, below, float(np.abs(above.T @ a @ below).max())


def components(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues in falling order and unit eigenvectors (columns) of a symmetric positive matrix."""
    n = len(matrix)
    if n == 0:
        return np.zeros(0), np.zeros((0, 0))
    matrix = (matrix + matrix.T) / 2
    small = n * _EPS * np.linalg.norm(matrix)
    values: list[float] = []
    vectors: list[np.ndarray] = []

    def split(basis: np.ndarray) -> None:
        a = basis.T @ matrix @ basis
        a = (a + a.T) / 2
        m = len(a)
        diagonal = np.diag(a)
        if m == 1 or np.abs(a - np.diag(diagonal)).max() <= _EPS * np.abs(diagonal).min():
            values.extend(diagonal)
            vectors.extend(basis.T)
            return
        best = None
        spread = np.linalg.norm(a - diagonal.mean() * np.eye(m)) / m
        # the mean lies between the ends of the spectrum, the median splits it evenly
        for shift in (np.median(diagonal), diagonal.mean(), *(diagonal.mean() + spread * k / 7 for k in (1, -1, 3, -3))):
            found = _bases(a, float(shift))
            if found and (best is None or found[2] < best[2]):
                best = found
                if best[2] <= small:
                    break
        if best is None or best[2] > 1e3 * small:
            # nothing to tell apart at this precision: any basis serves
            values.extend(diagonal)
            vectors.extend(basis.T)
            return
        split(basis @ best[0])
        split(basis @ best[1])

    split(np.eye(n))
    order = np.argsort(-np.array(values), kind="stable")
    return np.array(values)[order], np.array(vectors)[order].T


# --- Spark ------------------------------------------------------------------------


class Whitening(NamedTuple):
    """What is fitted: rows n, sums by dimension (exact), the residue of the rounded mean, eigenvalues and unit
    eigenvectors (columns) of the components, the total variance."""

    n: int
    sums: list[int]
    residue: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    total: float


def _fits(entry: Column) -> Column:
    """Neither null nor non-finite, nor beyond 64 bits once scaled; a NaN is greater than all numbers."""
    return F.coalesce(F.abs(entry.cast("double") * SCALE) < F.lit(2.0**63 - 2.0**20), F.lit(False))


def usable(vector: Column) -> Column:
    """Vectors with entries that all take part."""
    return vector.isNotNull() & F.forall(vector, _fits)


def _integers(vector: Column) -> Column:
    # Spark may look at a vector before it drops it
    return F.transform(vector, lambda x: F.when(_fits(x), F.floor(SCALE * x.cast("double")) + OFFSET))


def _sums_by_task(rows: DataFrame, size: int, add: Callable[[np.ndarray], dict[int, np.ndarray]]) -> dict[int, np.ndarray]:
    """For each index what `add` gives for blocks of rows, added up in each task, then by Spark; one array an index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            x = _matrix(batch.column(0), size)
            for start in range(0, len(x), ROWS):
                for k, values in add(x[start : start + ROWS]).items():
                    held[k] = held[k] + values if k in held else values
        for k, values in held.items():
            columns = [pa.array([k] * len(values), pa.int32()), pa.array(range(len(values)), pa.int32())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(values, pa.float64())], names=["k", "i", "value"])

    parts = rows.select("_x").mapInArrow(run, "k int, i int, value double")
    total = parts.groupBy("k", "i").agg(F.sum("value").alias("value"))
    found: dict[int, np.ndarray] = {}
    for row in total.collect():  # as many numbers as the square of the dimension
        found.setdefault(row.k, np.zeros(size))[row.i] = row.value
    return found


def _matrix(lists: pa.Array, size: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), size)


def fit(rows: DataFrame, size: int, n_components: int = COMPONENTS) -> Whitening | None:
    """The whitening of `rows`, whose column `_x` holds `size` integers each."""
    entries = rows.select(F.posexplode("_x").alias("i", "x")).groupBy("i")
    exact = entries.agg(F.sum(F.col("x").cast("decimal(20,0)")).alias("s"), F.count("*").alias("n")).collect()
    if not exact:
        return None
    n = exact[0].n
    sums = [int(r.s) for r in sorted(exact, key=lambda r: r.i)]
    mean = np.array([s / n for s in sums])

    def moments(x: np.ndarray) -> dict[int, np.ndarray]:
        centred = x - mean
        return dict(enumerate(centred.T @ centred)) | {size: centred.sum(axis=0)}

    found = _sums_by_task(rows, size, moments)
    residue = found[size] / n  # of the mean as a double
    covariance = np.array([found[k] for k in range(size)]) / n - np.outer(residue, residue)
    values, vectors = components(covariance)
    total = float(np.trace(covariance))
    kept = int((values[:n_components] > FLOOR * total).sum())
    return Whitening(n, sums, residue, values[:kept], vectors[:, :kept], total)


def _whitened(model: Whitening) -> Callable[[np.ndarray], np.ndarray]:
    mean = np.array([s / model.n for s in model.sums])
    scaled = model.vectors / np.sqrt(model.values)
    return lambda x: (x - mean) @ scaled


def identity_error(rows: DataFrame, size: int, model: Whitening) -> float:
    """The largest absolute entry of the whitened rows' covariance less the identity, measured over all rows."""
    k = len(model.values)
    project = _whitened(model)
    mean = model.residue @ (model.vectors / np.sqrt(model.values))

    def gram(x: np.ndarray) -> dict[int, np.ndarray]:
        w = project(x) - mean
        return dict(enumerate(w.T @ w))

    found = _sums_by_task(rows, size, gram)
    return float(max(np.abs(found[i][:k] / model.n - np.eye(k)[i]).max() for i in range(k)))


def _deviations(x: np.ndarray, model: Whitening) -> list[int | None]:
    """sum((n * x - S)^2) of each row, exact; None beyond 64 bits."""
    top = 2**63 - 1
    sums = np.array(model.sums, dtype=object)
    largest = np.abs(x.astype(float)).max(initial=0.0) * model.n + float(max(map(abs, model.sums), default=0))
    if largest**2 * 4 * max(1, x.shape[1]) < float(top):
        off = model.n * x - sums.astype(np.int64)
        return (off * off).sum(axis=1).tolist()
    return [v if v <= top else None for row in x.tolist() for v in [sum((model.n * e - s) ** 2 for e, s in zip(row, model.sums))]]


_ADDED = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding", n_components: int = COMPONENTS) -> DataFrame:
    """One row for each row that takes part and each component: key, component (from 1), n, deviation (the sum over
    dimensions of (n * x - S)^2), whitened, explained (the component's share of the variance), identity_error."""
    good = embeddings.where(usable(F.col(vector)) & (F.size(vector) > 0))
    rows = good.select(F.col(key).alias("_key"), _integers(F.col(vector)).alias("_x"))
    lengths = rows.groupBy(F.size("_x").alias("size")).agg(F.count("*").alias("n"))
    usual = lengths.orderBy(F.col("n").desc(), F.col("size").desc()).first()
    schema = T.StructType([T.StructField(key, embeddings.schema[key].dataType), *T.StructType.fromDDL(_ADDED).fields])
    if usual is None:
        return embeddings.sparkSession.createDataFrame([], schema)
    size = usual["size"]
    rows = rows.where(F.size("_x") == size)
    model = fit(rows, size, n_components)
    k = len(model.values)
    if k == 0:
        return embeddings.sparkSession.createDataFrame([], schema)
    error = identity_error(rows, size, model)
    weights = embeddings.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = weights.value
        project = _whitened(fitted)
        share = fitted.values / fitted.total
        for batch in batches:
            x = _matrix(batch.column(1), size)
            m = len(x)
            each = np.repeat(np.arange(m), k)
            columns = [
                batch.column(0).take(pa.array(each)),
                pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                pa.array(np.full(m * k, fitted.n), pa.int64()),
                pa.array(_deviations(x, fitted), pa.int64()).take(pa.array(each)),
                pa.array(project(x).ravel(), pa.float64()),
                pa.array(np.tile(share, m), pa.float64()),
                pa.array(np.full(m * k, error), pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(run, schema)
