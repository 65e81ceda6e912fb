"""Embedding whitening: covariance by Chan's pairwise merging in a tree, eigenvectors on the driver, a second pass that verifies the result."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, column, cut, read

#: Entries become floor(SCALE * c) + SHIFT; components of a row that are returned.
SCALE, SHIFT, KEEP = 1024, 100_000, 8
#: Entries of a larger size are refused, as sums and products of them would not be exact.
LARGEST = 1 << 40
#: Partial results that one task of the tree merges.
FAN = 16


@dataclass
class Moments:
    """Count, exact sums and centred scatter of some vectors; ``merge`` needs no vector again."""

    n: int = 0
    sums: np.ndarray | None = None  # Python integers, which do not overflow
    scatter: np.ndarray | None = None

    @staticmethod
    def of(x: np.ndarray) -> Moments:
        """Of the rows of a matrix of whole or real numbers."""
        if not len(x):
            return Moments()
        mean = x.sum(0) / len(x)
        centred = x - mean
        return Moments(len(x), np.array([v.item() for v in x.sum(0)], object), centred.T @ centred)

    def merge(self, other: Moments) -> Moments:
        """Chan's formula: scatters add up, and the two means' distance adds a part of rank one."""
        if not self.n or not other.n:
            return self if self.n else other
        if len(self.sums) != len(other.sums):
            raise ValueError(f"vectors of {len(self.sums)} and of {len(other.sums)} entries")
        n = self.n + other.n
        delta = ((other.sums * self.n - self.sums * other.n) / (self.n * other.n)).astype(np.float64)  # of exact sums, rounded once
        return Moments(n, self.sums + other.sums, self.scatter + other.scatter + np.outer(delta, delta) * (self.n * other.n / n))


def _rows(batch: pa.RecordBatch, name: str, kind: pa.DataType) -> np.ndarray:
    """An array column as a matrix."""
    a = column(batch, name)
    lengths = np.unique(np.asarray(a.value_lengths())) if len(a) else np.zeros(0)
    if len(lengths) > 1:
        raise ValueError(f"vectors of {lengths[0]} and of {lengths[-1]} entries")
    flat = np.asarray(a.flatten().cast(kind))
    return flat.reshape(len(a), -1) if len(a) else np.zeros((0, 0), flat.dtype)


def moments(df: DataFrame, name: str, kind: pa.DataType) -> Moments:
    """Of a whole array column: each task merges its batches, and tasks are merged pairwise in a tree.

    The driver gets a few matrices of the vectors' length squared, whatever the number of rows.
    """

    def run(batches: Iterator[pa.RecordBatch]):
        mine = Moments()
        for b in batches:
            mine = mine.merge(Moments.of(_rows(b, name, kind)))
        sums = [str(v) if isinstance(v, int) else repr(v) for v in ([] if mine.sums is None else mine.sums)]
        scatter = b"" if mine.scatter is None else mine.scatter.tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([mine.n], pa.int64()), pa.array([sums], pa.list_(pa.string())), pa.array([scatter], pa.binary())], ["n", "sums", "scatter"])

    def unpacked(row) -> Moments:
        if not row.n:
            return Moments()
        number = float if any(c in s for s in row.sums for c in ".en") else int
        return Moments(row.n, np.array([number(s) for s in row.sums], object), np.frombuffer(bytes(row.scatter)).reshape(len(row.sums), -1))

    parts = arrow_map(df.select(name), run, "n long, sums array<string>, scatter binary").rdd
    tasks = parts.getNumPartitions()
    if not tasks:
        return Moments()
    return parts.map(unpacked).treeReduce(Moments.merge, depth=max(2, math.ceil(math.log(tasks, FAN)) if tasks > 1 else 2))


@dataclass
class Whitening:
    """A fitted transformation: exact sums of the fit list, unit eigenvectors (as columns) by falling eigenvalue, and their shares of the trace."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray

    @staticmethod
    def of(m: Moments, keep: int) -> Whitening:
        """The first ``keep`` components that have any variance beyond rounding; each sign is such that the entry of largest size is positive."""
        covariance = m.scatter / m.n
        values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
        values, vectors = values[::-1], vectors[:, ::-1]
        some = values > len(values) * np.finfo(float).eps * max(values[0], 0) if len(values) else values > 0
        values, vectors = values[some][:keep], vectors[:, some][:, :keep]
        sign = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(len(values))])
        return Whitening(m.n, m.sums, values, vectors * sign, values / np.trace(covariance))


def scaled(embeddings: DataFrame, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """``(vec_id, x array<long>)``: floor(scale * c) + shift of each entry, as double.

    Vectors that are null or have no entries, or hold null or non-finite ones, go.
    Null and repeated ids stay.  An entry beyond 2^40 is an error.
    """
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda e: e.cast("double")).alias("c"))
    rows = rows.where("c is not null and size(c) > 0").where(F.forall("c", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))))
    far = F.raise_error(F.lit(f"a scaled entry is beyond {LARGEST}"))
    return rows.select("vec_id", F.transform("c", lambda e: F.when(F.abs(e * scale) < LARGEST, F.floor(e * scale).cast("long") + shift).otherwise(far)).alias("x"))


def distances(x: np.ndarray, model: Whitening) -> tuple[np.ndarray, np.ndarray]:
    """n * x - sums of each row, and the sum of its squares, both exact; a sum beyond a long is refused."""
    exact = np.array([int(v) for v in model.sums], object)
    largest = int(np.abs(x).max(initial=0)) * model.n + max(abs(v) for v in exact)
    if largest**2 * x.shape[1] < 1 << 63:
        d = x * model.n - exact.astype(np.int64)
        return d, (d * d).sum(1)
    d = x.astype(object) * model.n - exact
    squares = (d * d).sum(1)
    if len(squares) and max(squares) >= 1 << 63:
        raise ValueError("a deviation does not fit in a long")
    return d, squares.astype(np.int64)


def apply(vectors: DataFrame, model: Whitening) -> DataFrame:
    """``vectors(vec_id, x)`` -> ``(vec_id, deviation, w array<double>)``: whitened components of each row."""
    turn = model.vectors / np.sqrt(model.values)

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            x = _rows(b, "x", pa.int64())
            if not len(x):
                continue
            d, squares = distances(x, model)
            w = (d / model.n).astype(np.float64) @ turn
            yield pa.RecordBatch.from_arrays(
                [column(b, "vec_id"), pa.array(squares.astype(np.int64)), pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * w.shape[1], pa.array(w.reshape(-1)))], ["vec_id", "deviation", "w"]
            )

    return arrow_map(vectors, run, "vec_id long, deviation long, w array<double>")


def whiten(embeddings: DataFrame, keep: int = KEEP, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """``embeddings(vec_id, embedding)`` -> a row for each vector and component: ``(vec_id, component, n, deviation, whitened, explained, identity_error)``.

    Fitted on all vectors that remain (see ``scaled``), repeats included, and
    applied to each of them.  ``deviation`` is the sum over dimensions of
    (n * x - S)^2, exact; ``explained`` the component's share of the variance;
    ``identity_error`` the largest entry of the whitened rows' covariance minus
    the identity, measured over the rows as they were written.

    Components without variance (fewer vectors than dimensions, equal vectors)
    are left out, so a single vector and an empty table give no rows.  Vectors of
    different lengths, entries beyond 2^40 after scaling, and deviations beyond a
    long are errors.  Equal eigenvalues keep the order in which they are found.
    Other columns are left out.
    """
    spark = embeddings.sparkSession
    vectors = scaled(embeddings, scale, shift)
    m = moments(vectors, "x", pa.int64())
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    model = Whitening.of(m, keep) if m.n else None
    if model is None or not len(model.values):
        return spark.createDataFrame([], schema)
    rows = cut(apply(vectors, model), "whitened")
    second = moments(rows, "w", pa.float64())
    error = float(np.abs(second.scatter / second.n - np.eye(len(model.values))).max())
    share = F.array(*(F.lit(float(v)) for v in model.explained))
    out = rows.select("vec_id", "deviation", F.posexplode("w").alias("i", "whitened"))
    return out.select("vec_id", (F.col("i") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", F.get(share, F.col("i")).alias("explained"), F.lit(error).alias("identity_error"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first eight whitened components of all embeddings; see ``whiten`` for nulls, repeats and empty tables."""
    return whiten(read(spark, sf_dir, "embeddings"))
