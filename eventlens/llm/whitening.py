"""Whitening of embeddings from a polarisation covariance.

The covariance of two columns is had from variances alone:
2 cov(a, b) = var(a + b) - var(a) - var(b).  Entries are made integers
(``floor(SCALE * c) + SHIFT``) and centred on the integer below their mean; each
task adds up exact squares of every centred dimension and of the sum of every
pair of dimensions, Spark adds the tasks' figures as decimals, and the driver,
which receives one number a pair whatever the number of rows, takes the
differences, puts the fraction of the mean right exactly and divides once.  So
no digit is lost to a large mean.  The assembled matrix goes to ``eigh``; rows
are projected in tasks, and the covariance of what came out is measured on all
of them.

Edge cases: rows whose vector is null, or holds a null, a NaN or an infinity,
are dropped, and so are those with an entry whose integer would not fit 62 bits;
vectors of another length than the commonest (of equally common ones the
longest) are dropped, as they have no common covariance; empty vectors count as
length 0 and give no component; a component without variance (its eigenvalue
nothing but rounding) whitens to 0, explains what it does and is left out of
the identity error; null or repeated ids and repeated rows stay rows of their
own; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlens.session import materialize

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Below this magnitude the squares of a batch of 10,000 rows add up within 64 bits.
_SMALL = 1 << 23
_FIGURES = "i int, j int, total decimal(38,0)"


class Model(NamedTuple):
    """What was learnt: rows, integer centres, remainders of the sums (S = n *
    centre + rest), eigenvalues (falling), components as columns, trace."""

    n: int
    centre: np.ndarray
    rest: np.ndarray
    values: np.ndarray
    components: np.ndarray
    trace: float


def usable(vector: Column) -> Column:
    """The vector has no null and no entry beyond the integers' range (or not finite)."""
    c = lambda x: x.cast("double")
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(c(x)) | (F.abs(c(x)) * SCALE >= float(1 << 62)))
    return vector.isNotNull() & ~bad


def integers(column: pa.ListArray) -> np.ndarray:
    """Rows of ``floor(SCALE * c) + SHIFT``."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return (np.floor(flat * SCALE).astype(np.int64) + SHIFT).reshape(len(column), -1)


def _exact(centred: np.ndarray) -> np.ndarray:
    """64-bit integers where squares of a batch cannot overflow, else Python's."""
    return centred if centred.size == 0 or np.abs(centred).max() < _SMALL else centred.astype(object)


def _rows(figures: dict[tuple[int, int], int]) -> pa.RecordBatch:
    keys, totals = list(figures), [Decimal(int(x)) for x in figures.values()]
    cols = [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()), pa.array(totals, pa.decimal128(38))]
    return pa.RecordBatch.from_arrays(cols, ["i", "j", "total"])


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's count (at i = -1) and sums of every dimension."""
    n, total = 0, None
    for batch in batches:
        x = integers(batch.column("vector"))
        low, high = x & 0xFFFFFFFF, x >> 32
        part = [int(h) * (1 << 32) + int(s) for h, s in zip(high.sum(axis=0), low.sum(axis=0), strict=True)]
        n, total = n + len(x), part if total is None else [a + b for a, b in zip(total, part, strict=True)]
    if n:
        yield _rows({(-1, 0): n, **{(i, i): t for i, t in enumerate(total)}})


def _squares(centre: np.ndarray) -> Callable:
    """A task's exact sums of squares of every centred dimension (i, i) and of
    the sum of every pair (i, j)."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = len(centre)
        totals = [[0] * (d - i) for i in range(d)]
        some = False
        for batch in batches:
            y = _exact(integers(batch.column("vector")) - centre)
            some |= len(y) > 0
            for i in range(d):
                pair = y[:, i:] + y[:, i : i + 1]
                pair[:, 0] = y[:, i]
                totals[i] = [a + int(b) for a, b in zip(totals[i], (pair * pair).sum(axis=0), strict=True)]
        if some:
            for i in range(d):
                yield _rows({(i, i + k): t for k, t in enumerate(totals[i])})

    return sums


def _added(vectors: DataFrame, task: Callable) -> dict[tuple[int, int], int]:
    """The tasks' figures added up: one row a pair of dimensions."""
    figures = vectors.select("vector").mapInArrow(task, _FIGURES).groupBy("i", "j").agg(F.sum("total").alias("total"))
    return {(r["i"], r["j"]): int(r["total"]) for r in figures.collect()}


def covariance(n: int, rest: list[int], squares: dict[tuple[int, int], int]) -> np.ndarray:
    """Covariances (divisor n) from variances: exact integers until the last division."""
    d = len(rest)
    scaled = lambda i, j: n * squares[i, j] - (rest[i] + (rest[j] if i != j else 0)) ** 2
    variance = [scaled(i, i) for i in range(d)]
    matrix = np.empty((d, d))
    for i in range(d):
        matrix[i, i] = variance[i] / n**2
        for j in range(i + 1, d):
            matrix[i, j] = matrix[j, i] = (scaled(i, j) - variance[i] - variance[j]) / (2 * n**2)
    return matrix


def fit(vectors: DataFrame) -> Model | None:
    """The model of all ``vectors`` (usable, of one length); None without any."""
    sums = _added(vectors, _sums)
    n = sums.pop((-1, 0), 0)
    if not n or not sums:
        return None
    totals = [sums[i, i] for i in range(len(sums))]
    centre, rest = [t // n for t in totals], [t % n for t in totals]
    matrix = covariance(n, rest, _added(vectors, _squares(np.array(centre, np.int64))))
    values, components = np.linalg.eigh(matrix)
    values, components = values[::-1], components[:, ::-1]
    signs = np.sign(components[np.abs(components).argmax(axis=0), np.arange(len(values))])
    return Model(n, np.array(centre, np.int64), np.array(rest, object), values, components * signs, float(np.trace(matrix)))


def varying(model: Model, count: int) -> np.ndarray:
    """Which of the first components have variance beyond rounding."""
    values = model.values[:count]
    return values > max(model.values[0], 0) * len(model.values) * np.finfo(float).eps


def _whiten(model: Model, count: int) -> Callable:
    n, d = model.n, len(model.centre)
    some = varying(model, count)
    divisor = np.where(some, np.sqrt(np.where(some, model.values[:count], 1)), np.inf)
    fraction = np.array([int(r) / n for r in model.rest])
    square_of_rest = sum(int(r) ** 2 for r in model.rest)
    long_rest = model.rest.astype(np.int64) if n < 1 << 28 else model.rest

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = _exact(integers(batch.column("vector")) - model.centre)
            white = (y.astype(np.float64) - fraction) @ model.components[:, :count] / divisor
            squares, crossed = (y * y).sum(axis=1), (y * long_rest).sum(axis=1)
            apart = [Decimal(n * n * int(a) - 2 * n * int(b) + square_of_rest) for a, b in zip(squares, crossed, strict=True)]
            flat = pa.array(white.ravel())
            offsets = pa.array(np.arange(0, len(flat) + 1, count, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(apart, pa.decimal128(38)), pa.ListArray.from_arrays(offsets, flat)], ["vec_id", "deviation", "white"]
            )

    return rows


def identity_error(white: DataFrame, some: np.ndarray) -> float:
    """Largest absolute entry of the measured covariance minus the identity."""
    at = [i for i, x in enumerate(some) if x]
    if not at:
        return 0.0
    z = lambda i: F.get("white", F.lit(i))
    pairs = [(i, j) for i in at for j in at if i <= j]
    figures = white.agg(*[F.covar_pop(z(i), z(j)).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(figures[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def whiten(embeddings: DataFrame, components: int = COMPONENTS, vector: str = "embedding") -> DataFrame:
    """Per usable row: vec_id, n, deviation (decimal; the sum over dimensions of
    (n * x - S)^2, exact), and ``parts``, an array of (component, whitened,
    explained); identity_error is one value."""
    spark = embeddings.sparkSession
    kept = embeddings.select("vec_id", F.col(vector).cast("array<double>").alias("vector")).filter(usable(F.col("vector")))
    lengths = kept.groupBy(F.size("vector").alias("d")).count().orderBy(F.col("count").desc(), F.col("d").desc()).first()
    kept = kept.filter(F.size("vector") == (lengths["d"] if lengths else 0))
    model = fit(kept) if lengths and lengths["d"] else None
    kind = embeddings.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, n long, deviation decimal(38,0), parts array<struct<component: int, whitened: double, explained: double>>, identity_error double"
    if model is None:
        return spark.createDataFrame([], schema)
    count = min(components, len(model.values))
    white = materialize(kept.mapInArrow(_whiten(model, count), f"vec_id {kind}, deviation decimal(38,0), white array<double>"), "whitened")
    error = identity_error(white, varying(model, count))
    shares = [float(max(v, 0.0) / model.trace) if model.trace > 0 else 0.0 for v in model.values[:count]]
    explained = F.array(*[F.lit(s) for s in shares])
    parts = F.transform(
        "white", lambda z, i: F.struct((i + 1).cast("int").alias("component"), z.alias("whitened"), F.get(explained, i).alias("explained"))
    )
    return white.select("vec_id", F.lit(model.n).cast("long").alias("n"), "deviation", parts.alias("parts"), F.lit(error).alias("identity_error"))
