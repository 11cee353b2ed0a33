"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

Entries become integers ``x = floor(scale * c) + shift``, so sums and centred
rows ``n * x - S`` are exact; a task divides them by ``n`` only when it
multiplies.  One step is one pass over the rows: each task forms its part of
``u = Xw`` and at once adds up ``X'u``, ``u'u`` and the overlaps ``U'u`` with the
earlier left vectors.  Left vectors are rows of ``X`` times small coefficient
columns ``W``, so none is stored: a task makes its part of them again.  Both
sides are reorthogonalised against all earlier vectors, the left one twice (by
the products ``Z = X'U`` at hand, then by the overlaps measured).  The small
bidiagonal matrix is decomposed on the driver: right vectors give components,
singular values the deviations.

A Krylov space holds one direction of a repeated singular value, so a run that
ends early is followed by runs orthogonal to what was found, until their
largest value is no larger than the least one wanted.  A run of as many steps
as dimensions needs none.

What is held in memory: a task one Arrow batch of rows; the driver matrices of
``d`` rows and at most ``d`` columns, for ``d`` dimensions.

Defined results: rows whose vector is null, empty, or holds null or non-finite
entries are left out; so are rows whose vector has not the most frequent length
(ties: the longer).  Entries beyond +-2^62 after scaling count as that bound.
Repeated rows, rows that share an id and rows without id count each.  Components
without variance (beyond rounding) are not returned, so equal rows or a single
row give none, and an empty table gives an empty result.  Equal eigenvalues:
any orthonormal directions of their space, the same for all rows.  A deviation
beyond a long is null.  Input columns called ``deviation`` or ``whitened`` (any
case) are replaced; texts take no part, whatever their length.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rastertab.llm.common import read, written

EPS = float(np.finfo(float).eps)
MADE = ("deviation", "whitened")


@dataclass
class Whitening:
    """A fitted transformation: ``components`` (d x k, unit columns) with
    ``eigenvalues`` of the covariance (divisor n) and their share of its trace."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray
    identity_error: float
    steps: int


# --------------------------------------------------------------------------- rows
def integer_rows(vectors: DataFrame, vector: str, scale: int, shift: int) -> DataFrame:
    """Usable rows with ``__x array<long>`` beside them, written once."""
    v, bound = F.col(f"`{vector}`"), float(2 ** 62)

    def unusable(c: Column) -> Column:
        return c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))

    def entry(c: Column) -> Column:
        return F.floor(F.greatest(F.least(c.cast("double") * scale, F.lit(bound)), F.lit(-bound))) + F.lit(shift)

    usable = v.isNotNull() & ~F.exists(v, unusable) & (F.size(v) > 0)
    rows = vectors.where(usable).withColumn("__x", F.transform(v, entry).cast("array<long>"))
    rows = written(rows, "whitening-rows")
    size = F.size("__x")
    common = rows.groupBy(size.alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()  # one row
    return rows.where(size == (common["d"] if common else 0))


def matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def gaps(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n * x - S``, exact: in 64 bits where they hold it, else as Python integers."""
    largest = max((abs(int(x.min(initial=0))), abs(int(x.max(initial=0)))))
    if n * largest + max(map(abs, sums), default=0) < 2 ** 62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def squares(gap: np.ndarray) -> list[int | None]:
    """Exact sum of squares of each row; None beyond a long."""
    largest = max(abs(int(gap.min(initial=0))), abs(int(gap.max(initial=0))))
    if largest ** 2 * max(1, gap.shape[1]) >= 2 ** 63:
        gap = gap.astype(object)
    return [s if s < 2 ** 63 else None for s in (gap * gap).sum(axis=1).tolist()]


def added_up(rows: DataFrame, part: Callable[[np.ndarray], np.ndarray], kind: str = "double") -> list:
    """Sum over all rows of a vector that ``part`` makes of a batch of ``__x``.
    A task adds up its batches, Spark adds up the tasks' vectors by place."""
    arrow = pa.float64() if kind == "double" else pa.decimal128(38, 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                own = part(matrix(b.column(0)))
                total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total.tolist(), arrow)], names=["i", "v"])

    sums = rows.select("__x").mapInArrow(run, f"i int, v {kind}").groupBy("i").agg(F.sum("v").alias("v"))
    return [r["v"] for r in sorted(sums.collect(), key=lambda r: r["i"])]  # as many as part's vector has places


# --------------------------------------------------------------------------- bidiagonalisation
def _away(v: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """``v`` without its part in the span of orthonormal columns (twice is enough)."""
    for _ in range(2):
        for basis in bases:
            v = v - basis @ (basis.T @ v)
    return v


def bidiagonalise(product: Callable[[np.ndarray, np.ndarray], tuple[float, np.ndarray, np.ndarray]], d: int, wanted: int,
                  found: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray, int]:
    """Largest ``wanted`` singular values with right vectors of the centred rows
    restricted to what is orthogonal to ``found``, and the number of steps.

    ``product(W, w)`` gives ``u'u``, ``U'u`` and ``X'u`` for ``u = Xw`` and ``U = XW``."""
    def fresh() -> np.ndarray:
        while True:
            v = _away(rng.standard_normal(d), found, right)
            if np.linalg.norm(v) > 1e-8:
                return v / np.linalg.norm(v)

    right = left = back = np.zeros((d, 0))  # V, W, Z
    diagonal: list[float] = []
    above: list[float] = []
    room, largest = d - found.shape[1], 0.0
    wanted = min(wanted, room)
    while True:
        v = fresh() if not above or above[-1] == 0 else following
        right = np.column_stack([right, v])
        w = v - left @ (back.T @ v)
        norm, overlap, y = product(left, w)
        w, y = w - left @ overlap, y - back @ overlap
        alpha = float(np.sqrt(max(0.0, norm - overlap @ overlap)))
        largest = max(largest, alpha)
        if alpha <= EPS * d * largest:
            alpha, w, y = 0.0, np.zeros(d), np.zeros(d)  # v has no variance left: an invariant space
        else:
            w, y = w / alpha, y / alpha
        left, back = np.column_stack([left, w]), np.column_stack([back, y])
        diagonal.append(alpha)
        rest = _away(y - alpha * v, found, right)
        beta = float(np.linalg.norm(rest))
        largest = max(largest, beta)
        beta = 0.0 if beta <= EPS * d * largest else beta
        steps = len(diagonal)
        p, s, qt = np.linalg.svd(np.diag(diagonal) + np.diag(above, 1))
        done = steps >= wanted and bool(np.all(beta * np.abs(p[-1, :wanted]) <= EPS * s[0]))
        if steps == room or done:
            return s[:wanted], right @ qt[:wanted].T, steps
        above.append(beta)
        following = rest / beta if beta else rest


def fit(rows: DataFrame, components: int, seed: int = 7) -> Whitening:
    """Fit on all rows of ``integer_rows``."""
    count = added_up(rows, lambda x: np.array([len(x), x.shape[1] * len(x)], object), "decimal(38,0)")
    n = int(count[0]) if count else 0
    if not n:
        return Whitening(0, [], np.zeros((0, 0)), np.zeros(0), np.zeros(0), 0.0, 0)
    d = int(count[1]) // n

    def sums_of(x: np.ndarray) -> np.ndarray:
        small = max(abs(int(x.min())), abs(int(x.max()))) * len(x) < 2 ** 62
        return x.sum(axis=0).astype(object) if small else x.astype(object).sum(axis=0)

    sums = [int(s) for s in added_up(rows, sums_of, "decimal(38,0)")]

    def centred(x: np.ndarray) -> np.ndarray:
        return (gaps(x, n, sums) / n).astype(float)

    def product(left: np.ndarray, w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        def part(x: np.ndarray) -> np.ndarray:
            c = centred(x)
            u = c @ w
            return np.concatenate([[u @ u], (c @ left).T @ u, c.T @ u])

        out = np.array(added_up(rows, part))
        return float(out[0]), out[1:-d], out[-d:]

    rng, wanted = np.random.default_rng(seed), min(components, d)
    values, found, steps = bidiagonalise(product, d, wanted, np.zeros((d, 0)), rng)
    complete = steps == d
    while not complete and found.shape[1] < d:
        value, more, last = bidiagonalise(product, d, 1, found, rng)
        steps, complete = steps + last, value[0] <= values[wanted - 1] * (1 + 1e-12)
        order = np.argsort(-np.concatenate([values, value]), kind="stable")
        values, found = np.concatenate([values, value])[order], np.column_stack([found, more])[:, order]
    real = values[:wanted] > values[0] * EPS * max(d, 16) * 4
    parts = found[:, :wanted][:, real]
    parts = parts / np.linalg.norm(parts, axis=0)
    eigen = values[:wanted][real] ** 2 / n
    k = len(eigen)

    def check(x: np.ndarray) -> np.ndarray:
        c = centred(x)
        y = c @ parts / np.sqrt(eigen)
        return np.concatenate([[(c * c).sum()], y.sum(axis=0), (y.T @ y).ravel()])

    out = np.array(added_up(rows, check))
    trace, mean = out[0] / n, out[1:1 + k] / n
    covariance = out[1 + k:].reshape(k, k) / n - np.outer(mean, mean)
    error = float(np.abs(covariance - np.eye(k)).max(initial=0.0))
    return Whitening(n, sums, parts, eigen, eigen / trace if k else eigen, error, steps)


def transform(rows: DataFrame, model: Whitening) -> DataFrame:
    """Input columns, ``deviation`` (exact) and ``whitened`` (array of k)."""
    kept = rows.drop(*MADE)
    at = kept.columns.index("__x")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            gap = gaps(matrix(b.column(at)), model.n, model.sums)
            y = (gap / model.n).astype(float) @ model.components / np.sqrt(model.eigenvalues)
            ends = pa.array(np.arange(len(y) + 1) * y.shape[1], pa.int32())
            white = pa.ListArray.from_arrays(ends, pa.array(np.ascontiguousarray(y).ravel()))
            own = [c for i, c in enumerate(b.columns) if i != at]
            names = [c for i, c in enumerate(b.schema.names) if i != at]
            yield pa.RecordBatch.from_arrays([*own, pa.array(squares(gap), pa.int64()), white], names=[*names, *MADE])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields if f.name != "__x"]
    return kept.mapInArrow(run, ", ".join([*fields, "deviation long", "whitened array<double>"]))


def whiten(vectors: DataFrame, vector: str = "embedding", components: int = 32, scale: int = 64,
           shift: int = 1_000_000) -> tuple[DataFrame, Whitening]:
    """Whitened rows of a table of vectors, and the fitted transformation."""
    rows = integer_rows(vectors, vector, scale, shift)
    model = fit(rows, components)
    return transform(rows, model), model


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, model = whiten(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    shares = F.array(*[F.lit(float(e)) for e in model.explained]).cast("array<double>")
    return rows.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened")).select(
        "vec_id", (F.col("place") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("place")).alias("explained"), F.lit(model.identity_error).alias("identity_error"))
