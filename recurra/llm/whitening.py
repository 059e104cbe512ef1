"""Embedding whitening by shifted Cholesky QR.

The rows, centred, are a tall matrix Y. It is made orthogonal in passes: a
distributed Gram pass adds up Q'Q over all rows (every task sends one matrix of
dimension x dimension), its Cholesky factor R is taken, and the next pass works
on Q R^-1, found row by row through triangular solves.

* Pass 1 adds a small shift to the Gram matrix, so that its factor exists
  however ill-conditioned Y is. Two more passes without a shift bring the rows
  to orthogonality in double precision.
* The composed factors R = R3 R2 R1 have R'R = Y'Y without that the condition
  number is squared. The singular values of R are those of Y, its right singular
  vectors the components, and whitening projects on them and divides by the
  square root of the eigenvalue.
* Where directions have no variance (constant or dependent dimensions, fewer
  rows than dimensions), pass 2 leaves them out; they are no components.

Entries become whole numbers first, x = floor(scale * c) + offset, so counts,
sums and the deviation of every row are exact, and a row is centred as
(n * x - S) / n from exact whole numbers.

All that leaves the tasks are sums per dimension and Gram matrices, which do not
grow with the rows; their size is the square of the dimension. Every pass reads
the same written table, so a lost task costs its own rows only.

Rows: vectors that are null or hold a null, NaN or infinite entry are left out,
and so are vectors whose length is not the commonest one (on ties the greater);
entries beyond 2^34 count as 2^34. Null ids and repeated rows are rows like any
other. An empty table, and one whose rows are all equal, give an empty result. A
deviation beyond a long is null. Columns other than the id and the vector are
not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recurra.llm.common import cut

SCALE, OFFSET = 64, 1_000_000
FARTHEST = float(1 << 34)      # of an entry
COMPONENTS = 32
NO_VARIANCE = 1e-14            # of the eigenvalues after the first pass, which are 1 at most
MOST_SHIFT = 1e-4              # of the largest eigenvalue
CELLS = 1 << 18                # values worked on at once

Step = Callable[[np.ndarray], np.ndarray]


def scaled(rows: DataFrame, vector: str = "embedding", row_id: str = "vec_id") -> tuple[DataFrame, int]:
    """(vec_id, x) of the vectors that count, written once; and their length, 0 without rows."""
    v = F.transform(F.col(f"`{vector}`"), lambda c: c.cast("double"))
    odd = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    held = rows.where(F.col(f"`{vector}`").isNotNull()).select(F.col(f"`{row_id}`").alias("vec_id"), v.alias("v")).where(~odd)
    common = held.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = common["d"] if common else 0
    near = lambda c: F.least(F.greatest(c, F.lit(-FARTHEST)), F.lit(FARTHEST))      # noqa: E731
    x = F.transform("v", lambda c: F.floor(near(c) * SCALE) + F.lit(OFFSET).cast("long"))
    return cut(held.where(F.size("v") == d).select("vec_id", x.alias("x")), "whole-vectors"), d


def _matrix(batch: pa.RecordBatch, d: int) -> np.ndarray:
    return batch.column(batch.num_columns - 1).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _blocks(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[pa.RecordBatch]:
    step = max(1, CELLS // d)
    for b in batches:
        for at in range(0, b.num_rows, step):
            yield b.slice(at, step)


class Centre(NamedTuple):
    """Number of rows, and exact sums per dimension as whole part and rest: S = n * base + rest."""

    n: int
    base: np.ndarray
    rest: np.ndarray

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exactly: 64-bit where it fits, else Python's whole numbers."""
        x = x - self.base
        if len(x) and int(np.abs(x).max()) * self.n + self.n >= 1 << 62:
            x = x.astype(object)
        return x * self.n - self.rest

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.deviations(x).astype(np.float64) / self.n

    def squares(self, x: np.ndarray) -> list[int | None]:
        """The sum of the squared deviations of every row; None beyond a long."""
        dev = self.deviations(x)
        most = int(np.abs(dev).max()) if dev.size else 0
        if most * most * max(1, dev.shape[1]) >= 1 << 62:
            dev = dev.astype(object)
        return [s if s < 1 << 63 else None for s in (dev * dev).sum(1).tolist()]


def centre(table: DataFrame, d: int) -> Centre:
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _blocks(batches, d):
            total = np.append(_matrix(b, d).sum(0), b.num_rows)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(d + 1)), pa.array(total)], names=["at", "s"])

    total = [0] * (d + 1)
    for r in table.select("x").mapInArrow(sums, "at long, s long").groupBy("at") \
            .agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect():
        total[r["at"]] = int(r["s"])
    n = total[d]
    return Centre(n, np.array([s // n for s in total[:d]], np.int64), np.array([s % n for s in total[:d]], np.int64))


def gram(table: DataFrame, d: int, prepare: Step, width: int) -> np.ndarray:
    """Q'Q of the prepared rows, ``width`` columns wide, added up over all tasks."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for b in _blocks(batches, d):
            q = prepare(_matrix(b, d))
            total += q.T @ q
        at = np.flatnonzero(np.triu(total).ravel())
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel()[at])], names=["at", "g"])

    out = np.zeros(width * width)
    for r in table.select("x").mapInArrow(partial, "at long, g double").groupBy("at").agg(F.sum("g").alias("g")).collect():
        out[r["at"]] = r["g"]
    upper = out.reshape(width, width)
    return upper + np.triu(upper, 1).T


def solve(y: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Q with Q R = Y for an upper triangular R, column by column."""
    q = np.empty_like(y)
    for j in range(r.shape[1]):
        q[:, j] = (y[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
    return q


def triangular(table: DataFrame, d: int, mid: Centre) -> np.ndarray:
    """R with R'R = Y'Y, one row for every direction that has variance."""
    unit = np.finfo(np.float64).eps / 2
    g = gram(table, d, mid.centred, d)
    largest = float(np.linalg.eigvalsh(g)[-1]) if d else 0.0
    if largest <= 0:
        return np.zeros((0, d))
    shift = largest * min(11 * (mid.n * d + d * (d + 1)) * unit, MOST_SHIFT)
    r1 = np.linalg.cholesky(g + shift * np.eye(d)).T

    def first(x: np.ndarray) -> np.ndarray:
        return solve(mid.centred(x), r1)

    g = gram(table, d, first, d)
    e, u = np.linalg.eigh(g)
    kept = e > NO_VARIANCE
    if kept.all():
        r2 = np.linalg.cholesky(g).T

        def second(x: np.ndarray) -> np.ndarray:
            return solve(first(x), r2)
    else:
        r2, back = np.sqrt(e[kept])[:, None] * u[:, kept].T, u[:, kept] / np.sqrt(e[kept])

        def second(x: np.ndarray) -> np.ndarray:
            return first(x) @ back

    r3 = np.linalg.cholesky(gram(table, d, second, len(r2))).T
    return r3 @ r2 @ r1


class Whitening(NamedTuple):
    """The fitted transform: a row's whitened values are centred(x) @ project."""

    mid: Centre
    components: np.ndarray      # one unit vector a row, by falling eigenvalue
    eigenvalues: np.ndarray
    explained: np.ndarray
    identity_error: float

    @property
    def project(self) -> np.ndarray:
        return self.components.T / np.sqrt(self.eigenvalues)


def fit(table: DataFrame, d: int, components: int = COMPONENTS) -> Whitening:
    """Components of a written table of whole vectors with at least one row; none where no direction has variance."""
    mid = centre(table, d)
    _, s, v = np.linalg.svd(triangular(table, d, mid), full_matrices=False)
    e = s * s / mid.n
    v = v * np.where(np.take_along_axis(v, np.abs(v).argmax(1)[:, None], 1) < 0, -1.0, 1.0)     # either sign: this one
    k = min(components, len(e))
    found = Whitening(mid, v[:k], e[:k], e[:k] / e.sum(), 0.0)
    if not k:
        return found
    project = found.project

    # the whitened rows have the mean 0, as the centred ones add up to exactly 0
    white = gram(table, d, lambda x: mid.centred(x) @ project, k) / mid.n
    return found._replace(identity_error=float(np.abs(white - np.eye(k)).max()))


def whiten(rows: DataFrame, vector: str = "embedding", row_id: str = "vec_id",
           components: int = COMPONENTS) -> DataFrame:
    """One row per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    schema = T.StructType([T.StructField("vec_id", rows.schema[row_id].dataType), T.StructField("component", T.IntegerType()),
                           T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType()),
                           T.StructField("whitened", T.DoubleType()), T.StructField("explained", T.DoubleType()),
                           T.StructField("identity_error", T.DoubleType())])
    table, d = scaled(rows, vector, row_id)
    fitted = fit(table, d, components) if d else None
    if fitted is None or not len(fitted.eigenvalues):
        return rows.sparkSession.createDataFrame([], schema)
    mid, project, explained, error = fitted.mid, fitted.project, fitted.explained, fitted.identity_error
    k = len(explained)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _blocks(batches, max(d, k)):
            x, m = _matrix(b, d), b.num_rows
            each = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays([
                b.column(0).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, mid.n)), pa.array(mid.squares(x), pa.int64()).take(each),
                pa.array((mid.centred(x) @ project).ravel()), pa.array(np.tile(explained, m)),
                pa.array(np.full(m * k, error))], names=[f.name for f in schema.fields])

    return table.mapInArrow(apply, schema)
