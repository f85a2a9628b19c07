"""Embedding whitening: pivoted Cholesky of the covariance, then one-sided Jacobi on its factor.

Spark sums what grows with the rows: the distinct vectors, their number and totals, the matrix of
centred products. What is left is a matrix of the vectors' dimension, whatever the number of rows.
Its pivoted Cholesky factor G has G G' = V; rotating pairs of G's columns until all are orthogonal
leaves components as normalised columns and eigenvalues as squared norms. V itself is never
squared or rotated, so small eigenvalues keep their digits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensity.session import stored

EPS = float(np.finfo(np.float64).eps)
PIECE = 1 << 20          # numbers of a block that numpy works on at once
SCALE, SHIFT = 64, 1_000_000
BOUND = 2.0 ** 62        # of a whole number that is made from an entry


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """G (d x rank) with G G' = a for a positive semidefinite a; rows stand in the order of ``a``.

    Stops where the largest pivot left is within rounding of nothing.
    """
    d = len(a)
    rest, order = a.astype(np.float64).copy(), np.arange(d)
    g = np.zeros((d, d))
    floor = d * EPS * max(float(rest.diagonal().max(initial=0.0)), 0.0)
    for k in range(d):
        at = k + int(np.argmax(rest.diagonal()[k:]))
        if rest[at, at] <= floor:
            return g[np.argsort(order), :k]
        for m in (rest, g):
            m[[k, at]] = m[[at, k]]
        rest[:, [k, at]] = rest[:, [at, k]]
        order[[k, at]] = order[[at, k]]
        g[k, k] = np.sqrt(rest[k, k])
        g[k + 1:, k] = rest[k + 1:, k] / g[k, k]
        rest[k + 1:, k + 1:] -= np.outer(g[k + 1:, k], g[k + 1:, k])
    return g[np.argsort(order)]


def jacobi(g: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (columns) of g g', by rotating pairs of g's columns.

    Pairs of a round have no column in common and are rotated together; a sweep meets every pair once.
    """
    r = g.shape[1]
    columns = g.T.copy()
    seats = list(range(r + r % 2))  # one seat stays empty where r is odd
    for _ in range(sweeps):
        turned = False
        for _ in range(len(seats) - 1):
            pairs = [(p, q) for p, q in zip(seats[:len(seats) // 2], reversed(seats[len(seats) // 2:])) if max(p, q) < r]
            seats = [seats[0], seats[-1], *seats[1:-1]]
            if not pairs:
                continue
            i, j = map(list, zip(*pairs))
            x, y = columns[i], columns[j]
            xx, yy, xy = (x * x).sum(1), (y * y).sum(1), (x * y).sum(1)
            bad = np.abs(xy) > 4 * EPS * np.sqrt(xx * yy)
            if not bad.any():
                continue
            turned = True
            safe = np.where(bad, xy, 1.0)
            zeta = (yy - xx) / (2 * safe)
            t = np.where(bad, np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1.0, zeta)), 0.0)
            c = 1 / np.sqrt(1 + t * t)
            s = c * t
            columns[i] = c[:, None] * x - s[:, None] * y
            columns[j] = s[:, None] * x + c[:, None] * y
        if not turned:
            break
    values = (columns * columns).sum(1)
    order = np.argsort(-values, kind="stable")
    return values[order], (columns[order] / np.sqrt(values[order])[:, None]).T


def _lists(column: pa.Array, width: int) -> np.ndarray:
    """A column of lists of ``width`` numbers as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _pieces(rows: int, width: int) -> Iterator[slice]:
    step = max(1, PIECE // max(1, width))
    return (slice(i, i + step) for i in range(0, rows, step))


def products(df: DataFrame, column: str, width: int, into: Callable[[np.ndarray], np.ndarray], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sum of y y' and of y over all rows, y = ``into`` of the vectors as a matrix with ``size`` columns.

    Each task adds up its own rows and hands on size x (size + 1) sums; Spark adds those by place.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size + 1, size))
        for batch in batches:
            x = _lists(batch.column(0), width)
            for part in _pieces(len(x), width):
                y = into(x[part])
                total[:size] += y.T @ y
                total[size] += y.sum(0)
        yield pa.RecordBatch.from_pydict({"at": pa.array(np.arange(total.size), pa.int32()), "v": pa.array(total.ravel())})

    got = df.select(column).mapInArrow(run, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).toArrow()
    total = np.zeros((size + 1) * size)
    total[got.column("at").to_numpy()] = got.column("v").to_numpy()  # one number for each pair of dimensions
    total = total.reshape(size + 1, size)
    return total[:size], total[size]


def whiten(df: DataFrame, most: int = 16, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Per row and component: id, component, n, deviation, whitened, explained, identity_error.

    Rows whose vector is null, empty or holds a null or an entry that is not finite are left out. Every
    entry c, as a double, becomes x = floor(64 c) + 1000000. Each distinct x counts once for the number n, the mean
    and the covariance V (divisor n). Components are numbered from 1 by falling eigenvalue; only those
    that V has beyond rounding are returned, so copies of one vector give none. ``deviation`` is the sum of
    (n x - total)^2 over the dimensions, exact; where it does not fit 64 bits the query fails, as it does for an
    entry of 2^56 or more. Where vectors have different lengths, those of the length most rows have
    (of equally many the longest) are taken, the others left out. Rows that repeat repeat; ids may be null.
    An empty table gives no rows. Other columns are not read.
    """
    spark = df.sparkSession
    entries = df.select(df[id_col].alias("id"), df[vector].cast("array<double>").alias("c")).where(
        F.col("c").isNotNull() & (F.size("c") > 0)
        & ~F.exists("c", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))))
    schema = f"{id_col} {dict(df.dtypes)[id_col]}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    lengths = entries.groupBy(F.size("c").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if lengths is None:
        return spark.createDataFrame([], schema)
    d = int(lengths["d"])
    whole = F.transform("c", lambda v: F.floor(v * SCALE).cast("long") + SHIFT)
    rows = stored(entries.where(F.size("c") == d).select("id", whole.alias("x")), "vectors")
    fit = stored(rows.select("x").distinct(), "distinct")
    sums = fit.select(F.posexplode("x").alias("at", "v")).groupBy("at").agg(F.sum(F.col("v").cast("decimal(20,0)")).alias("v"))
    totals = np.array([int(r["v"]) for r in sums.orderBy("at").collect()], dtype=object)  # one number for each dimension
    n = fit.count()
    mean = np.array([int(t) // n for t in totals]), np.array([int(t) % n / n for t in totals])

    def centred(x: np.ndarray) -> np.ndarray:
        return (x - mean[0]) - mean[1]  # whole numbers first: no digit is lost

    scatter, _ = products(fit, "x", d, centred, d)
    covariance = scatter / n
    values, vectors = jacobi(pivoted_cholesky((covariance + covariance.T) / 2))
    k = min(most, len(values))
    if not k:
        return spark.createDataFrame([], schema)
    axes = vectors[:, :k] / np.sqrt(values[:k])
    explained = values[:k] / np.trace(covariance)

    def projected(x: np.ndarray) -> np.ndarray:
        return centred(x) @ axes

    squares, line = products(fit, "x", d, projected, k)
    # Coordinates are centred already; what is left of their mean is rounding.
    error = float(np.abs(squares / n - np.outer(line / n, line / n) - np.eye(k)).max())

    def deviations(x: np.ndarray) -> list[int]:
        far = np.abs(x - mean[0]).max(0).astype(object) + 1
        if int((far * far).sum()) * n * n < 2 ** 63:
            gap = (x - mean[0]) * n - np.array([int(t) % n for t in totals])
            return (gap * gap).sum(1).tolist()
        gap = (x - mean[0]).astype(object) * n - np.array([int(t) % n for t in totals], dtype=object)
        return (gap * gap).sum(1).tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, x = batch.column("id"), _lists(batch.column("x"), d)
            for part in _pieces(len(x), max(d, 8 * k)):
                w = projected(x[part])
                m = len(w)
                yield pa.RecordBatch.from_arrays([
                    ids.slice(part.start, m).take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, n)), pa.array(np.repeat(np.array(deviations(x[part]), object), k).tolist(), pa.int64()),
                    pa.array(w.ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                    [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return rows.mapInArrow(run, schema)
