"""Embedding whitening by a bidiagonal qd solver (operator 13).

The distinct vectors, as whole numbers, are centred exactly.  Each task reduces
its rows block by block to a triangle by QR, and triangles are reduced in a
tree of bounded fan-in until one is left.  Of that one ``bidiagonal`` takes the
singular values (dqds) and the right singular vectors (twisted factorisations):
the variances and the whitening directions.  The covariance is never formed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from florapipe.llm.bidiagonal import EPS, right_singular
from florapipe.llm.vectors import matrix, vector_length, whole_vectors
from florapipe.session import materialize

#: Vectors in one QR step, and partial results that are reduced together.
ROWS = 2_048
FAN_IN = 32
#: Vectors whose output rows are held at a time.
OUT_ROWS = 1_024

OUT = ("vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of vectors (dimension -1) and sum per dimension."""
    for batch in batches:
        for i in range(0, batch.num_rows, ROWS):
            x = matrix(batch.column(0).slice(i, ROWS).to_pylist())
            if int(np.abs(x).max()) * len(x) >= 2 ** 63:
                raise OverflowError("sums of components do not fit whole numbers of 64 bits")
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, x.shape[1])), pa.array(np.append(len(x), x.sum(axis=0)))],
                                             ["dim", "n"])


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n * x - sums``, exactly: 64 bits, or Python's whole numbers beyond them."""
    most = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums))
    kind = np.int64 if most < 2 ** 63 else object
    return n * x.astype(kind) - np.array(sums, kind)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return _deviations(x, n, sums).astype(np.float64) / n


def _triangles(n: int, sums: list[int]):
    """A task's rows as one triangle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, len(sums)))
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                x = matrix(batch.column(0).slice(i, ROWS).to_pylist())
                r = np.linalg.qr(np.vstack([r, _centred(x, n, sums)]), mode="r")
        if len(r):
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes()])], ["part"])
    return run


def _join_triangles(parts: list[bytes], width: int) -> bytes:
    return np.linalg.qr(np.vstack([np.frombuffer(p).reshape(-1, width) for p in parts]), mode="r").tobytes()


def _whitened(x: np.ndarray, n: int, sums: list[int], axes: np.ndarray) -> np.ndarray:
    return _centred(x, n, sums) @ axes


def _moments(n: int, sums: list[int], axes: np.ndarray):
    """Number, mean and centred products of a task's whitened rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = []
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                w = _whitened(matrix(batch.column(0).slice(i, ROWS).to_pylist()), n, sums, axes)
                mean = w.mean(axis=0)
                parts.append(np.concatenate([[len(w)], mean, ((w - mean).T @ (w - mean)).ravel()]).tobytes())
                if len(parts) == FAN_IN:
                    parts = [_join_moments(parts, w.shape[1])]
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array([_join_moments(parts, axes.shape[1])])], ["part"])
    return run


def _join_moments(parts: list[bytes], width: int) -> bytes:
    """Centred products about a common mean from those about each part's own."""
    p = np.stack([np.frombuffer(x) for x in parts])
    count, means = p[:, 0], p[:, 1:width + 1]
    mean = count @ means / count.sum()
    products = p[:, width + 1:].sum(axis=0).reshape(width, width) + (means - mean).T @ ((means - mean) * count[:, None])
    return np.concatenate([[count.sum()], mean, products.ravel()]).tobytes()


def _reduced(parts: DataFrame, join: Callable[[list[bytes], int], bytes], width: int, name: str) -> bytes:
    """One part of all, ``FAN_IN`` at a time; in an order that the tasks' numbers fix."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("at")
        return pa.table({"at": pa.array([table["at"][0].as_py() // FAN_IN], pa.int64()),
                         "part": pa.array([join(table["part"].to_pylist(), width)], pa.binary())})

    parts = materialize(parts.select(F.spark_partition_id().cast("bigint").alias("at"), "part"), name)
    while True:
        last = parts.agg(F.max("at")).first()[0]
        parts = materialize(parts.groupBy(F.floor(F.col("at") / FAN_IN).alias("group")).applyInArrow(run, "at bigint, part binary"), name)
        if last < FAN_IN:
            return bytes(parts.first()["part"])


def _output(n: int, sums: list[int], axes: np.ndarray, explained: np.ndarray, error: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = axes.shape[1]
        for batch in batches:
            for i in range(0, batch.num_rows, OUT_ROWS):
                ids = batch.column(0).slice(i, OUT_ROWS)
                x = matrix(batch.column(1).slice(i, OUT_ROWS).to_pylist())
                d = _deviations(x, n, sums)
                if d.dtype == np.int64 and int(np.abs(d).max(initial=0)) ** 2 * d.shape[1] >= 2 ** 63:
                    d = d.astype(object)
                squares = [int(s) for s in (d * d).sum(axis=1)]
                each = np.repeat(np.arange(len(x)), k)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                     pa.array(np.full(len(each), n)),
                     pa.array([s if s < 2 ** 63 else None for s in squares], pa.int64()).take(pa.array(each)),
                     pa.array(_whitened(x, n, sums, axes).ravel()), pa.array(np.tile(explained, len(x))),
                     pa.array(np.full(len(each), error))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return run


def whiten(embeddings: DataFrame, components: int = 16, scale: float = 64.0, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """One row per vector and leading component: ``vec_id, component, n, deviation, whitened, explained, identity_error``.

    A vector is ``x = floor(scale * c)`` of its components; adding a constant to
    all of them changes no result, so none is added.  ``n`` and the sums ``S``
    are over the distinct vectors, each counted once, as are all covariances.
    ``deviation`` is the exact sum of ``(n*x - S)^2`` (null beyond 64 bits),
    ``whitened`` the centred vector along the component over its deviation.

    Vectors that are null, empty or hold a null or non-finite component are left
    out; where lengths differ, the most frequent one stays (of equally frequent
    ones the longest).  A component without variance beyond rounding has no
    rows, so a table of one distinct vector, or an empty one, gives an empty
    result.  Equal rows give equal rows, null ids stay, extra columns are
    ignored.  The driver holds one matrix of dimensions by dimensions: fit for
    some thousand dimensions."""
    spark = embeddings.sparkSession
    rows = whole_vectors(embeddings, id_col, vector_col, scale)
    rows = materialize(rows.withColumn("length", vector_length(F.col("x"))).filter("length > 0"), "whiten_rows")
    most = rows.groupBy("length").count().orderBy(F.desc("count"), F.desc("length")).first()
    nothing = spark.createDataFrame([], OUT)
    if most is None:
        return nothing
    rows = rows.filter(F.col("length") == most["length"]).drop("length")
    fit = materialize(rows.select("x").distinct(), "whiten_fit")
    total = fit.mapInArrow(_sums, "dim bigint, n bigint").groupBy("dim").agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n"))
    total = {r["dim"]: int(r["n"]) for r in total.collect()}            # one row per dimension
    n, sums = total[-1], [total[i] for i in range(most["length"])]
    width = len(sums)
    r = _reduced(fit.mapInArrow(_triangles(n, sums), "part binary"), _join_triangles, width, "whiten_triangles")
    r = np.frombuffer(r).reshape(-1, width)
    r = np.vstack([r, np.zeros((width - len(r), width))])
    squares, vectors = right_singular(r, components)
    some = squares[:vectors.shape[1]] > (64 * width * EPS) ** 2 * squares[0]
    if not some.any():
        return nothing
    squares, vectors, trace = squares[:vectors.shape[1]][some], vectors[:, some], float((r * r).sum())
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    axes = vectors / np.sqrt(squares / n)
    k = axes.shape[1]
    moments = np.frombuffer(_reduced(fit.mapInArrow(_moments(n, sums, axes), "part binary"), _join_moments, k, "whiten_moments"))
    error = float(np.abs(moments[k + 1:].reshape(k, k) / n - np.eye(k)).max())
    return rows.mapInArrow(_output(n, sums, axes, squares / trace, error), OUT)
