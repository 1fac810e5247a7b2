"""Embedding whitening by polarisation.

Entries are quantised to whole numbers, ``x = floor(scale * entry)``. The fit
list holds each distinct x once: n vectors with sums S. All that is summed over
it are squares of centred whole numbers, ``(n * x_i - S_i)`` for a dimension
and the sum of two such for a pair of dimensions; each square sum is exact.
Half the difference of the pair's and the two dimensions' is the pair's
co-moment: ``2 * cov(i, j) = var(i + j) - var(i) - var(j)``. The covariance
matrix is divided once, by ``n ** 3``, and goes to ``eigh``.

Spark carries the rows: distinct vectors by a grouped shuffle (copies meet in
their own map task first), sums and square sums by one row a dimension or pair
from each task, added up as ``decimal(38, 0)``. What reaches the driver is a
number for each pair of dimensions, whatever the number of rows; what goes back
with the tasks is S and as many eigenvectors as are asked for.

Defined results: rows whose vector is null, empty, or holds null or non-finite
entries are left out, and so are vectors of another length than most
(``vectors.usable``); null ids and repeated rows are rows like others, and
copies of a vector stand once in the fit list; components without variance
(all vectors equal, one vector, fewer distinct vectors than dimensions) are not
given, so a table without any gives an empty result, as an empty one does;
columns beyond the two named are not read. Entries for which ``n * x`` leaves
62 bits raise.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import stage
from starmart.llm.vectors import matrix, usable

SCALE = 256
COMPONENTS = 4
WIDE = "decimal(38,0)"
_LIMB = 21  # bits of a limb: three hold 62 bits and a sign
_ROWS = 4096  # rows that are squared at once: limb products of so many fit 64 bits
_RESULT = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


@dataclass(frozen=True)
class Fit:
    """What was fitted: counts, sums, eigenvalues and -vectors (columns), share of the trace, and the check."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``n * x - S``, whole."""
        most = int(np.abs(x).max(initial=0))
        if most < 0 or self.n * most + max(map(abs, self.sums), default=0) >= 1 << 61:
            raise OverflowError("n * floor(scale * entry) leaves 62 bits")
        return np.int64(self.n) * x - np.array(self.sums, np.int64)

    def whiten(self, centred: np.ndarray) -> np.ndarray:
        return centred / self.n @ self.vectors / np.sqrt(self.values)


def square_sums(t: np.ndarray, axis: int) -> np.ndarray:
    """Exact sums of squares of whole numbers under ``2 ** 62``, as Python integers; at most ``_ROWS`` are added."""
    most = int(np.abs(t).max(initial=0))
    if most * most * max(t.shape[axis], 1) < 1 << 62:
        return (t * t).sum(axis=axis).astype(object)
    low = np.int64((1 << _LIMB) - 1)
    limbs = [t & low, t >> _LIMB & low, t >> 2 * _LIMB]
    total: np.ndarray | int = 0
    for i in range(3):
        for j in range(i, 3):
            part = (limbs[i] * limbs[j]).sum(axis=axis).astype(object)
            total = total + (part * ((1 if i == j else 2) << _LIMB * (i + j)))
    return total


def quantised(df: DataFrame, id_col: str, vector_col: str, scale: int) -> tuple[DataFrame, int]:
    """``(vec_id, x)`` of the rows that take part, and their dimension."""
    rows, dim = usable(df, id_col, vector_col)
    x = F.transform("vector", lambda e: F.floor(F.lit(float(scale)) * e.cast("double")))
    return rows.select("vec_id", x.alias("x")), dim


def _decimals(values) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))


def _sums(dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(dim, object)
        for batch in batches:
            x = matrix(batch.column(0), dim)
            for at in range(0, len(x), _ROWS):
                part = x[at : at + _ROWS]
                if int(np.abs(part).max(initial=0)) >= 1 << 49 or int(part.min(initial=0)) < -(1 << 49):
                    raise OverflowError("floor(scale * entry) leaves 49 bits")
                total = total + part.sum(axis=0).astype(object)
            n += len(x)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(dim, dtype=np.int32)), pa.array([n] * dim, pa.int64()), _decimals(total)],
                ["i", "n", "s"],
            )

    return run


def _pair_squares(dim: int, centre: Fit):
    upper = np.triu_indices(dim)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = [np.zeros(dim - i, object) for i in range(dim)], 0
        for batch in batches:
            x = matrix(batch.column(0), dim)
            rows += len(x)
            for at in range(0, len(x), _ROWS):
                c = np.ascontiguousarray(centre.centred(x[at : at + _ROWS]).T)  # a row for each dimension
                for i in range(dim):
                    t = c[i:] + c[i]
                    t[0] = c[i]  # the dimension alone; below it, its sum with each later one
                    total[i] = total[i] + square_sums(t, 1)
        if rows:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(upper[0].astype(np.int32)),
                    pa.array(upper[1].astype(np.int32)),
                    _decimals(np.concatenate(total)),
                ],
                ["i", "j", "q"],
            )

    return run


def _whitened_moments(dim: int, fit: Fit):
    k = len(fit.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second, rows = np.zeros(k), np.zeros((k, k)), 0
        for batch in batches:
            w = fit.whiten(fit.centred(matrix(batch.column(0), dim)))
            first, second, rows = first + w.sum(axis=0), second + w.T @ w, rows + len(w)
        if rows:
            # Row -1 has the sums, the others the products.
            both = np.vstack((first[None], second))
            i, j = np.divmod(np.arange(both.size), k)
            yield pa.RecordBatch.from_arrays(
                [pa.array((i - 1).astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(both.ravel())],
                ["i", "j", "v"],
            )

    return run


def covariance(pairs: dict[tuple[int, int], int], n: int, dim: int) -> np.ndarray:
    """The matrix from exact square sums of ``n * x - S``; every entry is rounded once."""
    v = np.empty((dim, dim))
    for (i, j), q in pairs.items():
        v[i, j] = v[j, i] = q / n**3 if i == j else (q - pairs[i, i] - pairs[j, j]) / (2 * n**3)
    return v


def fit_list(rows: DataFrame) -> DataFrame:
    """Each distinct x once, written."""
    return stage(rows.select("x").distinct())


def fit(listed: DataFrame, dim: int, components: int = COMPONENTS) -> Fit | None:
    """Fits the leading components to the rows of ``listed``; None where there are none."""
    if not dim:
        return None
    found = listed.mapInArrow(_sums(dim), f"i int, n long, s {WIDE}")
    sums = sorted(found.groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").cast(WIDE).alias("s")).collect())
    if not sums:
        return None
    n, centre = sums[0]["n"], [int(r["s"]) for r in sums]
    whole = Fit(n, centre, np.empty(0), np.empty((dim, 0)), np.empty(0))
    squares = listed.mapInArrow(_pair_squares(dim, whole), f"i int, j int, q {WIDE}")
    squares = squares.groupBy("i", "j").agg(F.sum("q").cast(WIDE).alias("q"))
    v = covariance({(r["i"], r["j"]): int(r["q"]) for r in squares.collect()}, n, dim)
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(components, int((values > values[0] * dim * np.finfo(float).eps).sum())) if values[0] > 0 else 0
    if not k:
        return None
    vectors = vectors[:, :k] * np.sign(vectors[np.abs(vectors[:, :k]).argmax(axis=0), np.arange(k)])
    found = Fit(n, centre, values[:k].copy(), vectors, values[:k] / np.trace(v))
    moments = listed.mapInArrow(_whitened_moments(dim, found), "i int, j int, v double")
    said = {(r["i"], r["j"]): r["v"] / n for r in moments.groupBy("i", "j").agg(F.sum("v").alias("v")).collect()}
    error = max(
        abs(said[i, j] - said[-1, i] * said[-1, j] - (i == j)) for i in range(k) for j in range(k)
    )
    return Fit(n, centre, found.values, vectors, found.explained, error)


def _project(dim: int, fitted: Fit):
    k = len(fitted.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = fitted.centred(matrix(batch.column(1), dim))
            rows = len(c)
            dev = [int(v) for at in range(0, rows, _ROWS) for v in square_sums(c[at : at + _ROWS], 1)]
            take = np.repeat(np.arange(rows), k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(take)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, fitted.n, np.int64)),
                    _decimals(dev).take(pa.array(take)),
                    pa.array(fitted.whiten(c).ravel()),
                    pa.array(np.tile(fitted.explained, rows)),
                    pa.array(np.full(rows * k, fitted.identity_error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return run


def whiten(
    df: DataFrame,
    components: int = COMPONENTS,
    scale: int = SCALE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """A row for each row that takes part and each component.

    ``vec_id, component, n, deviation, whitened, explained, identity_error``;
    ``deviation`` is a decimal, exact to 38 digits.
    """
    rows, dim = quantised(df, id_col, vector_col, scale)
    fitted = fit(fit_list(rows), dim, components)
    if fitted is None:
        return df.sparkSession.createDataFrame([], _RESULT)
    return rows.mapInArrow(_project(dim, fitted), _RESULT)
