"""Whitening of vectors: pivoted Cholesky of the centred scatter, one-sided Jacobi on the triangular factor.

Entries are whole numbers of a fixed step, so sums and the scatter are exact whatever the order in which partitions
arrive. The scatter A, one number for each pair of dimensions, is factored on the driver as P L L' P'; rotations of the
columns of L make them orthogonal, which leaves singular vectors and values of P L: squared column norms are the
eigenvalues of A, normalised columns its eigenvectors. Squaring is avoided, so small eigenvalues keep their digits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table

#: Doubles are whole numbers one apart up to here; larger entries are set to it.
LARGEST = 1 << 53
#: Sums of this size are exact in doubles, and below the next in 64-bit integers.
EXACT_DOUBLE, EXACT_LONG = 1 << 53, 1 << 62


@dataclass(frozen=True)
class Whitening:
    """A fit: ``axes`` has a unit eigenvector in each column, ``values`` their eigenvalues, both by falling value."""

    n: int
    sums: list[int]
    values: np.ndarray
    axes: np.ndarray
    trace: float

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums, exact: 64-bit integers where they fit, Python's otherwise."""
        bound = int(np.abs(x).max(initial=0)) * self.n + max(map(abs, self.sums), default=0)
        kind = np.int64 if bound < EXACT_LONG else object
        return x.astype(kind) * self.n - np.array(self.sums, kind)

    def whitened(self, deviations: np.ndarray, components: int) -> np.ndarray:
        """Rows of the first components, each over the root of its eigenvalue."""
        return (deviations.astype(np.float64) / self.n) @ self.axes[:, :components] / np.sqrt(self.values[:components])


def whole(vector: Column) -> Column:
    """Not null and only finite components, none of them null."""
    fine = F.forall(vector, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))  # NaN is above infinity
    return F.coalesce(fine, F.lit(False))


def _entries(column: pa.Array, scale: int, offset: int, width: int) -> np.ndarray:
    """floor(scale * c) + offset as 64-bit integers, a row per vector."""
    flat = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
    return np.clip(flat, -LARGEST, LARGEST).astype(np.int64).reshape(-1, width) + offset


def _squares(y: np.ndarray) -> np.ndarray:
    """y' y, exact: Python integers only where neither doubles nor slices of rows are."""
    width = y.shape[1]
    out = np.zeros((width, width), object)
    largest = int(np.abs(y).max(initial=0)) ** 2
    if largest > EXACT_DOUBLE:
        z = y.astype(object)
        return z.T @ z
    rows = max(1, EXACT_DOUBLE // max(1, largest))
    z = y.astype(np.float64)
    for at in range(0, len(y), rows):
        part = z[at : at + rows]
        out += (part.T @ part).astype(np.int64).astype(object)
    return out


def _partial_sums(vectors: DataFrame, name: str, compute) -> dict[tuple[int, int], int]:
    """Totals of the exact matrices that ``compute`` gives for each batch; an entry is a row, added up by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                found = compute(batch.column(0))
                total = found if total is None else total + found
        if total is not None:
            i, j = np.indices(total.shape)
            values = pa.array([Decimal(int(v)) for v in total.ravel()], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), values], names=["i", "j", "v"])

    partial = vectors.select(name).mapInArrow(run, "i int, j int, v decimal(38,0)")
    return {(r["i"], r["j"]): int(r["v"]) for r in partial.groupBy("i", "j").agg(F.sum("v").alias("v")).collect()}


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pivots, L): a[pivots][:, pivots] = L L', L lower triangular with as many columns as ``a`` has rank."""
    a = a.astype(np.longdouble)
    n = len(a)
    order = np.arange(n)
    factor = np.zeros((n, n), np.longdouble)
    left = a.diagonal().copy()
    least = left.max(initial=0) * n * np.finfo(np.longdouble).eps * 8
    rank = 0
    while rank < n:
        best = rank + int(np.argmax(left[rank:]))
        if not left[best] > least:
            break
        for x in (order, left):
            x[[rank, best]] = x[[best, rank]]
        factor[[rank, best], :rank] = factor[[best, rank], :rank]
        pivot = np.sqrt(left[rank])
        factor[rank, rank] = pivot
        below = a[order[rank + 1 :], order[rank]] - factor[rank + 1 :, :rank] @ factor[rank, :rank]
        factor[rank + 1 :, rank] = below / pivot
        left[rank + 1 :] -= factor[rank + 1 :, rank] ** 2
        rank += 1
    return order, factor[:, :rank].astype(np.float64)


def _rounds(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Every pair of 0..n-1 once, in rounds of pairs that share no number."""
    places = list(range(n + n % 2))
    for _ in range(len(places) - 1):
        half = len(places) // 2
        pairs = [(a, b) for a, b in zip(places[:half], places[half:][::-1], strict=True) if max(a, b) < n]
        yield np.array([min(p) for p in pairs], np.int64), np.array([max(p) for p in pairs], np.int64)
        places = [places[0], places[-1], *places[1:-1]]


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """(squared norms, unit columns) of the factor's columns, rotated until they are orthogonal, by falling norm."""
    columns = np.ascontiguousarray(factor.T)
    small = np.finfo(np.float64).eps * np.sqrt(max(1, factor.shape[0]))
    for _ in range(sweeps):
        rotated = False
        for p, q in _rounds(len(columns)):
            x, y = columns[p], columns[q]
            xx, yy, xy = (x * x).sum(axis=1), (y * y).sum(axis=1), (x * y).sum(axis=1)
            turn = np.abs(xy) > small * np.sqrt(xx * yy)
            if not turn.any():
                continue
            rotated = True
            p, q, x, y, xx, yy, xy = (v[turn] for v in (p, q, x, y, xx, yy, xy))
            slope = (yy - xx) / (2 * xy)
            tangent = np.where(slope < 0, -1.0, 1.0) / (np.abs(slope) + np.sqrt(1 + slope * slope))
            cosine = (1 / np.sqrt(1 + tangent * tangent))[:, None]
            sine = cosine * tangent[:, None]
            columns[p], columns[q] = cosine * x - sine * y, sine * x + cosine * y
        if not rotated:
            break
    norms = np.sqrt((columns * columns).sum(axis=1))
    order = np.argsort(-norms, kind="stable")
    norms, columns = norms[order], columns[order]
    return norms * norms, (columns / norms[:, None]).T


def fit(vectors: DataFrame, width: int, scale: int, offset: int, name: str = "vector") -> Whitening:
    """Fit of all rows; every one is usable and has ``width`` entries.

    Entries are shifted by the nearest whole number to their mean before they are multiplied, and the rest of the
    centring is done on exact sums. The driver sees one number for each pair of dimensions.
    """

    def sums_of(column: pa.Array) -> np.ndarray:
        x = _entries(column, scale, offset, width)
        exact = int(np.abs(x).max(initial=0)) * len(x) < EXACT_LONG
        total = (x if exact else x.astype(object)).sum(axis=0)
        return np.array([len(x), *total.tolist()], object)[None, :]

    found = _partial_sums(vectors, name, sums_of)
    n = found[0, 0]
    sums = [found[0, j + 1] for j in range(width)]
    shift = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
    squares = _partial_sums(vectors, name, lambda column: _squares(_entries(column, scale, offset, width) - shift))
    rest = [s - n * int(c) for s, c in zip(sums, shift, strict=True)]
    # n times the scatter, exact
    scatter = np.array([[n * squares[i, j] - rest[i] * rest[j] for j in range(width)] for i in range(width)], object)
    order, factor = pivoted_cholesky(scatter)
    values, columns = one_sided_jacobi(factor)
    axes = np.empty_like(columns)
    axes[order] = columns
    return Whitening(n, sums, values / float(n) ** 2, axes, float(sum(scatter.diagonal())) / float(n) ** 2)


def identity_error(vectors: DataFrame, model: Whitening, width: int, components: int, scale: int, offset: int, name: str = "vector") -> float:
    """Largest entry of the whitened rows' covariance minus the identity; two passes, as means come first."""

    def sums(column: pa.Array, center: np.ndarray | None) -> np.ndarray:
        w = model.whitened(model.deviations(_entries(column, scale, offset, width)), components)
        return w.sum(axis=0)[None, :] if center is None else (w - center).T @ (w - center)

    def total(center: np.ndarray | None) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = sum((sums(b.column(0), center) for b in batches if b.num_rows), np.zeros((1, 1)))
            i, j = np.indices(out.shape)
            yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(out.ravel())], names=["i", "j", "v"])

        found = vectors.select(name).mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
        out = np.zeros((1 if center is None else components, components))
        for r in found:
            out[r["i"], r["j"]] = r["v"]
        return out / model.n

    return float(np.abs(total(total(None)[0]) - np.eye(components)).max())


def whiten(
    vectors: DataFrame, components: int = 32, scale: int = 64, offset: int = 1_000_000, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row for each usable row and component.

    Vectors that are null or hold null or non-finite entries are dropped. An entry c becomes floor(scale * c) + offset;
    beyond 2^53 it is set to that, and a deviation above 2^63 - 1 is null. Components of no variance do not exist: equal
    rows, a single row, empty vectors and an empty table give no rows, fewer dimensions fewer components. Vectors of
    different length are fitted apart. Repeated rows and ids count as often as they stand there; of equal eigenvalues
    any directions serve. Other columns are not looked at, whatever their names.
    """
    kind = vectors.schema[key].dataType.simpleString()
    rows = vectors.select(F.col(f"`{key}`").alias("vec_id"), F.col(f"`{vector}`").alias("vector")).where(whole(F.col("vector")))
    widths = sorted(r["w"] for r in rows.groupBy(F.size("vector").alias("w")).count().collect())  # lengths of vectors
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    out = None
    for width in (w for w in widths if w):
        same = rows.where(F.size("vector") == width)
        model = fit(same, width, scale, offset)
        many = min(components, len(model.values))
        if not many:
            continue
        error = identity_error(same, model, width, many, scale, offset)
        part = same.mapInArrow(_emit(model, width, many, scale, offset, error), schema)
        out = part if out is None else out.unionAll(part)
    return rows.sparkSession.createDataFrame([], schema) if out is None else out


def _emit(model: Whitening, width: int, components: int, scale: int, offset: int, error: float):
    explained = model.values[:components] / model.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = model.deviations(_entries(batch.column(1), scale, offset, width))
            fits = int(np.abs(d).max(initial=0)) ** 2 * width < 1 << 63
            exact = ((d if fits else d.astype(object)) ** 2).sum(axis=1)
            deviation = pa.array([v if v < 1 << 63 else None for v in exact.tolist()], pa.int64())
            each = pa.array(np.repeat(np.arange(batch.num_rows), components))
            rows = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(each),
                    pa.array(np.tile(np.arange(1, components + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * components, model.n, np.int64)),
                    deviation.take(each),
                    pa.array(model.whitened(d, components).ravel()),
                    pa.array(np.tile(explained, rows)),
                    pa.array(np.full(rows * components, error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return run


def query(spark, sf_dir):
    return whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
