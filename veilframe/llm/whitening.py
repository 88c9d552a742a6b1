"""Whitening of vectors by refined eigenvectors of their covariance.

Entries become integers, so that counts and sums are exact. The covariance of
the distinct vectors is gathered by tasks, centred first. Its eigenvectors are
found in single precision and then corrected by matrix products in extended
precision (Ogita and Aishima): each round squares the error. Where eigenvalues
lie too close for that, the vectors of such a cluster are turned within their
span by solving the small problem of the cluster alone, in the same way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilframe.functions import named
from veilframe.sources import materialize

SCALE = 256
COMPONENTS = 4
# Products beyond double precision; 80 bits on common machines.
WIDE = np.longdouble
ROUNDS = 30
# A component whose share of the variance is below this is taken for none.
NOTHING = 1e-13


def refined_eigenvectors(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as columns, of a symmetric matrix, to double precision.

    The start is in float32; only where eigenvalues of a large matrix are too
    crowded for that is it in float64.
    """
    size = len(matrix)
    norm = np.abs(matrix).max(initial=0.0)
    if norm == 0:
        return np.zeros(size), np.eye(size)
    a = matrix.astype(WIDE) / WIDE(norm)
    a = (a + a.T) / 2
    for start in (np.float32, np.float64):
        x = _eigenvectors(a, size * np.finfo(WIDE).eps, start)
        values = (x * (a @ x)).sum(axis=0)
        if np.abs(a @ x - x * values).max() < 8 * np.finfo(np.float64).eps:
            order = np.argsort(-values, kind="stable")
            return (values[order] * WIDE(norm)).astype(np.float64), x[:, order].astype(np.float64)
    raise ArithmeticError("the eigenvectors of the covariance did not converge")


def _eigenvectors(a: np.ndarray, noise: float, start) -> np.ndarray:
    """Eigenvectors of a matrix whose largest entry is about 1, known to ``noise``.

    The vectors of a cluster, a run of eigenvalues each close to the next, come
    out as some basis of their span. The matrix within the span, less its mean
    eigenvalue and scaled up, is then solved in the same way: what was close is
    apart there. A cluster whose eigenvalues differ by no more than the noise
    keeps the basis that it has.
    """
    size = len(a)
    x = np.linalg.eigh(a.astype(start))[1].astype(WIDE)
    if size == 1:
        return np.ones((1, 1), WIDE)
    close = 1 / (64 * size)
    for _ in range(ROUNDS):
        x, values, change = _round(a, x, close)
        if change < np.finfo(np.float64).eps:
            break
    x = _round(a, x, close)[0]
    x += x @ (np.eye(size, dtype=WIDE) - x.T @ x) / 2
    order = np.argsort(values, kind="stable")
    for run in np.split(order, np.flatnonzero(np.diff(values[order]) >= close) + 1):
        if len(run) < 2:
            continue
        basis = x[:, run]
        small = basis.T @ (a @ basis - values[run].mean() * basis)
        small = (small + small.T) / 2
        scale = np.abs(small).max()
        if 4 * noise < scale < 0.5:
            x[:, run] = basis @ _eigenvectors(small / scale, noise / scale, start)
    return x


def _round(a: np.ndarray, x: np.ndarray, close: float) -> tuple[np.ndarray, np.ndarray, float]:
    """One correction: the better basis, the eigenvalues, and the largest change.

    With ``R = I - X'X`` and ``S = X'AX`` the better basis is ``X + XE``, where
    ``E`` has ``(S_ij + l_j R_ij) / (l_j - l_i)`` for eigenvalues that lie apart
    and ``R_ij / 2`` for others, which only makes their vectors orthogonal.
    """
    r = np.eye(len(a), dtype=WIDE) - x.T @ x
    s = x.T @ (a @ x)
    values = np.diag(s) / (1 - np.diag(r))
    gap = values[None, :] - values[:, None]
    step = s + values[None, :] * r
    # A large turn is no correction.
    apart = (np.abs(gap) >= close) & (np.abs(step) < np.abs(gap) / 4)
    e = np.where(apart, step / np.where(apart, gap, 1), r / 2)
    return x + x @ e, values, float(np.abs(e).max())


def _matrices(batches, column: str) -> Iterator[np.ndarray]:
    """Batches of lists of equal length as matrices."""
    for batch in batches:
        if batch.num_rows:
            yield np.asarray(batch.column(column).flatten()).reshape(batch.num_rows, -1)


def _summed(df: DataFrame, column: str, products) -> np.ndarray:
    """The sum over all rows of ``products(matrix)``, an array of one shape for all batches.

    A task sends one row an entry, so what is shuffled grows with the tasks and
    the square of the dimension, and the result is one number an entry.
    """

    def run(batches) -> Iterator[pa.RecordBatch]:
        total = None
        for matrix in _matrices(batches, column):
            found = products(matrix)
            total = found if total is None else total + found
        if total is not None:
            flat = total.reshape(-1)
            place = np.arange(len(flat), dtype=np.int32)
            yield pa.record_batch([pa.array(place), pa.array(flat)], ["place", "value"])

    kind = products(np.zeros((1, _width(df, column)))).dtype
    schema = "place int, value " + ("long" if kind.kind == "i" else "double")
    parts = df.select(column).mapInArrow(run, schema).groupBy("place").agg(F.sum("value").alias("value"))
    return parts.toArrow().sort_by("place").column("value").to_numpy()


def _width(df: DataFrame, column: str) -> int:
    return df.select(F.size(column)).first()[0]


def _centred_covariance(fit: DataFrame, count: int, mean: np.ndarray, turn=None) -> np.ndarray:
    """The covariance of the rows, or of what ``turn`` makes of them centred; divisor ``count``."""

    def centred(matrix: np.ndarray) -> np.ndarray:
        moved = matrix.astype(np.float64) - mean
        return moved if turn is None else moved @ turn

    if turn is None:
        shift = np.zeros(len(mean))
    else:
        shift = _summed(fit, "x", lambda m: centred(m).sum(axis=0)) / count
    total = _summed(fit, "x", lambda m: (centred(m) - shift).T @ (centred(m) - shift))
    return total.reshape(len(shift), len(shift)) / count


def whiten(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    components: int = COMPONENTS,
    scale: int = SCALE,
) -> DataFrame:
    """``(key, component, n, deviation, whitened, explained, identity_error)``.

    Rows whose vector is NULL, empty, or holds a NULL or a number that is not
    finite are left out; copies and NULL keys stay. The others become whole
    numbers ``floor(scale * entry)``. Mean and covariance are those of the ``n``
    distinct vectors, so many copies of one weigh no more than it. There is a
    row for each vector and component, the components numbered from 1 by
    falling eigenvalue; a vector of fewer dimensions than ``components`` has as
    many as it has dimensions.

    ``deviation`` is the squared distance to the mean in units of ``1 / n``, an
    exact integer; one beyond 64 bits is an error. ``whitened`` is the centred
    vector along the component, with unit variance over the distinct vectors;
    it is NULL for a component without variance, as when all vectors are
    equal. ``explained`` is the component's share of the variance, 0 if there is none.
    An entry of which ``scale`` times does not fit 32 bits is an error.
    ``identity_error`` is the largest entry of the whitened vectors' measured
    covariance minus the identity, over components that have variance; NULL if
    none has. Vectors of different lengths are an error. An empty table gives
    no rows.

    ``vectors`` is read twice. What comes to the driver is the covariance, whose
    size is the square of the dimension.
    """
    rows = vectors.select(named(key).alias("key"), named(vector).cast("array<double>").alias("v"))
    fine = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = rows.filter((F.size("v") > 0) & fine)
    huge = F.raise_error(F.lit("an entry does not fit 32 bits")).cast("long")
    whole = F.transform("v", lambda c: F.when(F.abs(c * scale) < 2.0**31, F.floor(c * scale)).otherwise(huge))
    rows = rows.select("key", whole.alias("x"))
    columns = ["component", "n", "deviation", "whitened", "explained", "identity_error"]
    fit = materialize(rows.select("x").distinct())
    shapes = fit.agg(F.count("*"), F.min(F.size("x")), F.max(F.size("x"))).first()
    count, width = shapes[0], shapes[1]
    if count and shapes[1] != shapes[2]:
        raise ValueError(f"vectors have {shapes[1]} to {shapes[2]} dimensions")
    schema = (
        f"key {rows.schema['key'].dataType.simpleString()}, component int, n long, deviation long,"
        " whitened double, explained double, identity_error double"
    )
    if not count:
        return vectors.sparkSession.createDataFrame([], schema).select(F.col("key").alias(key), *columns)
    sums = _summed(fit, "x", lambda m: m.astype(np.int64).sum(axis=0))
    mean = (sums.astype(WIDE) / count).astype(np.float64)
    values, axes = refined_eigenvectors(_centred_covariance(fit, count, mean))
    trace = float(values.astype(WIDE).sum())
    wanted = min(components, width)
    values, axes = values[:wanted], axes[:, :wanted]
    real = values > NOTHING * trace
    turn = axes / np.sqrt(np.where(real, values, 1))
    error = None
    if real.any():
        spread = _centred_covariance(fit, count, mean, turn[:, real])
        error = float(np.abs(spread - np.eye(int(real.sum()))).max())
    explained = values / trace if trace > 0 else np.zeros(wanted)
    numbers = np.arange(1, wanted + 1, dtype=np.int32)

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            (matrix,) = _matrices([batch], "x")
            found = (matrix.astype(np.float64) - mean) @ turn
            found = pa.array(found.reshape(-1), mask=np.tile(~real, batch.num_rows))
            deviation = np.repeat(_deviations(matrix, sums, count), wanted)
            total = len(deviation)
            yield pa.record_batch(
                [
                    batch.column("key").take(pa.array(np.repeat(np.arange(batch.num_rows), wanted))),
                    pa.array(np.tile(numbers, batch.num_rows)),
                    pa.array(np.full(total, count, np.int64)),
                    pa.array(deviation),
                    found,
                    pa.array(np.tile(explained, batch.num_rows)),
                    pa.array([error] * total, pa.float64()),
                ],
                ["key", *columns],
            )

    return rows.mapInArrow(run, schema).select(F.col("key").alias(key), *columns)


def _deviations(matrix: np.ndarray, sums: np.ndarray, count: int) -> np.ndarray:
    """Per row the sum of ``(count * x - sums) ** 2``, exactly."""
    distance = np.abs(matrix.astype(np.float64) * count - sums).max(initial=0.0)
    if distance * distance * matrix.shape[1] < 2**62:
        moved = matrix.astype(np.int64) * count - sums
        return (moved * moved).sum(axis=1)
    moved = matrix.astype(object) * int(count) - sums.astype(object)
    found = (moved * moved).sum(axis=1)
    if max(found) >= 2**63:
        raise ArithmeticError("a vector's deviation does not fit 64 bits")
    return found.astype(np.int64)
