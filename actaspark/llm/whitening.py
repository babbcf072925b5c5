"""Embedding whitening by matrix-free block subspace iteration.

An entry c counts as the long x = floor(64 c) + 1,000,000. With a block Q of orthonormal columns every Spark
pass computes V Q = X'(X Q) / n on centred rows, and V itself is never formed. The driver, which holds nothing
but d-by-block matrices, does QR and Rayleigh-Ritz and looks at the residuals V q - e q of the k largest pairs.
While one of them is above ``tolerance`` (times the largest eigenvalue) the block takes in the new directions of
V Q beside the ones it has, up to ``most`` columns, and starts again from its best Ritz vectors beyond that, so a
small gap in the spectrum costs few passes. A last pass measures the covariance of the whitened rows.

Sums over rows are taken in the tasks, one row for each cell of the d-by-block matrix leaves a task, and Spark adds
the cells up in a shuffle on the cell's number: no key of the data decides where a row goes, and the driver gets
d times block numbers, however many rows or tasks there are.

Defined results: a null vector, an empty one, one with null, NaN or infinite entries, or entries of 2**50 and more
(their x would not be exact) is dropped; so are vectors whose length isn't the commonest (of ties the greatest),
which have no covariance with the others. Ids may be null and repeat: every row is whitened by itself. Components whose
eigenvalue is zero to double precision can't be scaled to one and have no rows, so equal vectors, or a single
one, give none. Components of equal eigenvalues are any orthonormal basis. A deviation that a long can't hold is null; the
column ``deviation_text`` always has its digits. Empty tables give no rows; other columns are ignored."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_bytes

SCALE, SHIFT = 64, 1_000_000
#: Entries beyond are dropped: 64 c is then no exact long beside the shift, or its products with counts overflow.
BOUND = float(1 << 50)
OUT = "vec_id long, component int, n long, deviation long, deviation_text string, whitened double, explained double, identity_error double"
#: Rows that are worked on at once in a task.
ROWS = 4096
_BIG = 1 << 27


@dataclass
class Whitening:
    """What a fit gives: rows n, sums by dimension (exact), unit eigenvectors as columns, eigenvalues, trace, the number
    of passes and the largest residual over the largest eigenvalue."""

    n: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    trace: float
    passes: int
    residual: float

    @property
    def base(self) -> np.ndarray:
        """The mean rounded down, by dimension."""
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rest(self) -> np.ndarray:
        """What the mean has above that, times n."""
        return np.array([s % self.n for s in self.sums], np.int64)

    @property
    def projection(self) -> np.ndarray:
        return self.components / np.sqrt(self.values)


def vectors(table: DataFrame, column: str = "embedding", vec_id: str = "vec_id") -> DataFrame:
    """(vec_id, v array<double>) of what can be whitened: finite entries, and the commonest length."""
    rows = table.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("v"))
    rows = rows.filter((F.size("v") > 0) & F.forall("v", lambda c: F.coalesce(F.abs(c) < BOUND, F.lit(False))))
    most = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.filter(F.size("v") == most["d"]) if most else rows.limit(0)


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches of at most ROWS rows with their x as a matrix of longs."""
    for whole in batches:
        for first in range(0, whole.num_rows, ROWS):
            batch = whole.slice(first, ROWS)
            flat = batch.column("v").flatten().to_numpy(zero_copy_only=False)
            yield batch, np.floor(flat * SCALE).astype(np.int64).reshape(batch.num_rows, -1) + SHIFT


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each dimension: the exact sum of x, in two halves that can't overflow; cell -1 counts."""
    n, low, high = 0, 0, 0
    for _, x in blocks(batches):
        n, low, high = n + len(x), low + (x & 0xFFFFFFFF).sum(axis=0), high + (x >> 32).sum(axis=0)
    if n:
        yield pa.RecordBatch.from_pydict({"cell": pa.array([-1, *range(len(low))], pa.int32()), "low": pa.array([n, *low.tolist()], pa.int64()), "high": pa.array([0, *high.tolist()], pa.int64())})


def _centred(x: np.ndarray, base: np.ndarray, offset: np.ndarray) -> np.ndarray:
    return (x - base) - offset


def _cells(batches, base: np.ndarray, offset: np.ndarray, product: Callable[[np.ndarray], np.ndarray]) -> Iterator[pa.RecordBatch]:
    total = None
    for _, x in blocks(batches):
        own = product(_centred(x, base, offset))
        total = own if total is None else total + own
    if total is not None:
        yield pa.RecordBatch.from_pydict({"cell": pa.array(np.arange(total.size, dtype=np.int32)), "value": pa.array(total.ravel())})


def summed(rows: DataFrame, base: np.ndarray, offset: np.ndarray, product: Callable[[np.ndarray], np.ndarray], shape: tuple[int, int]) -> np.ndarray:
    """The sum over all rows of a matrix product of centred rows; ``shape`` is the result's."""
    cells = rows.mapInArrow(lambda batches: _cells(batches, base, offset, product), "cell int, value double")
    out = np.zeros(shape[0] * shape[1])
    for r in cells.groupBy("cell").agg(F.sum("value").alias("value")).toLocalIterator():
        out[r["cell"]] = r["value"]
    return out.reshape(shape)


def fit(rows: DataFrame, k: int = 32, extra: int = 8, most: int | None = None, tolerance: float = 1e-13, passes: int = 200, seed: int = 0) -> Whitening | None:
    """The ``k`` largest eigenpairs of the covariance of ``vectors``; None if there is none but zero.

    ``most`` bounds the block (4 k by default, and at most the dimension)."""
    cells = rows.mapInArrow(_sums, "cell int, low long, high long")
    total = {r["cell"]: (int(r["high"]) << 32) + int(r["low"]) for r in cells.groupBy("cell").agg(*[F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in ("low", "high")]).collect()}
    n = total.pop(-1, 0)
    if not n:
        return None
    d = len(total)
    sums = [total[i] for i in range(d)]
    base = np.array([s // n for s in sums], np.int64)
    offset = np.array([(s % n) / n for s in sums])
    k = min(k, d)
    most = min(d, max(most or 4 * k, k + 1))
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, min(most, k + extra))))[0]
    for turn in range(1, passes + 1):
        both = summed(rows, base, offset, _times(q), (d + 1, q.shape[1]))
        y, squares = both[:-1] / n, float(both[-1, 0]) / n
        small = q.T @ y
        values, turned = np.linalg.eigh((small + small.T) / 2)
        order = np.argsort(values)[::-1]
        values, turned = values[order], turned[:, order]
        ritz, image = q @ turned, y @ turned
        top = max(float(values[0]), 0.0)
        real = int((values[:k] > d * np.finfo(float).eps * squares).sum())
        gaps = np.linalg.norm(image[:, :k] - ritz[:, :k] * values[:k], axis=0)
        if top == 0.0 or gaps.max() <= tolerance * top or q.shape[1] == d:
            break
        new = image if q.shape[1] + k <= most else image[:, :k]
        old = ritz[:, : most - min(new.shape[1], k)] if q.shape[1] + k > most else ritz
        q = np.linalg.qr(np.hstack([old, new - old @ (old.T @ new)])[:, :most])[0]
    else:
        raise ArithmeticError(f"residual {gaps.max() / top:.3g} after {passes} passes")
    if top == 0.0 or not real:
        return None
    return Whitening(n, sums, ritz[:, :real], values[:real], squares, turn, float(gaps[:real].max() / top))


def _times(q: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    """X'(X Q), with a last row that starts with the sum of squares."""

    def product(x: np.ndarray) -> np.ndarray:
        last = np.zeros((1, q.shape[1]))
        last[0, 0] = np.einsum("ij,ij->", x, x)
        return np.vstack([x.T @ (x @ q), last])

    return product


def _gram(p: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    """W'W of whitened rows W, with their sums as a last row."""

    def product(x: np.ndarray) -> np.ndarray:
        w = x @ p
        return np.vstack([w.T @ w, w.sum(axis=0)])

    return product


def identity_error(rows: DataFrame, found: Whitening) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity."""
    k = len(found.values)
    both = summed(rows, found.base, found.rest / found.n, _gram(found.projection), (k + 1, k)) / found.n
    return float(np.abs(both[:-1] - np.outer(both[-1], both[-1]) - np.eye(k)).max())


def deviations(x: np.ndarray, n: int, base: np.ndarray, rest: np.ndarray) -> list[int]:
    """Sum over dimensions of (n x - S)**2, exact: n x - S is n (x - base) - rest."""
    far = x - base
    if np.abs(far).max(initial=0) < _BIG and x.shape[1] <= 256 and n < 1 << 27:  # each sum below 2**62
        squares, mixed = np.einsum("ij,ij->i", far, far), far @ rest
    else:
        far = far.astype(object)
        squares, mixed = (far * far).sum(axis=1), (far * rest.astype(object)).sum(axis=1)
    own = sum(int(r) ** 2 for r in rest)
    return [n * n * a - 2 * n * b + own for a, b in zip(squares.tolist(), mixed.tolist(), strict=True)]


def whiten(rows: DataFrame, found: Whitening) -> DataFrame:
    """A row for each vector of ``rows`` and component, columns OUT; a map, without a shuffle."""
    n, base, rest, p, k = found.n, found.base, found.rest, found.projection, len(found.values)
    error, explained = identity_error(rows, found), found.values / found.trace

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in blocks(batches):
            exact = deviations(x, n, base, rest)
            count = len(x) * k
            where = pa.array(np.repeat(np.arange(len(x)), k))
            longs = pa.array([e if e < 1 << 63 else None for e in exact], pa.int64())
            yield pa.RecordBatch.from_pydict(
                {
                    "vec_id": batch.column("vec_id").take(where),
                    "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    "n": pa.array(np.full(count, n, np.int64)),
                    "deviation": longs.take(where),
                    "deviation_text": pa.array([str(e) for e in exact], pa.string()).take(where),
                    "whitened": pa.array((_centred(x, base, rest / n) @ p).ravel()),
                    "explained": pa.array(np.tile(explained, len(x))),
                    "identity_error": pa.array(np.full(count, error)),
                }
            )

    return rows.mapInArrow(apply, OUT)


def whitened(table: DataFrame, k: int = 32) -> DataFrame:
    """Fit on all vectors of ``table`` (vec_id, embedding) and whiten each of them."""
    batch_bytes(table.sparkSession)
    rows = vectors(table)
    found = fit(rows, k)
    return whiten(rows, found) if found else table.sparkSession.createDataFrame([], OUT)
