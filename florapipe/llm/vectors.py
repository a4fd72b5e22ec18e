"""Vectors in whole numbers, packed in bytes: equal vectors have equal bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The first byte of a packed vector, and its components.
KINDS = {b"h": np.dtype("<i2"), b"i": np.dtype("<i4"), b"q": np.dtype("<i8")}


def kind_of(most: float) -> bytes:
    """The least width that holds components up to ``most``."""
    return b"h" if most < 2 ** 15 else b"i" if most < 2 ** 31 else b"q"


def _packed(scale: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            ends = np.asarray(column.offsets, np.int64)
            v = column.values.slice(ends[0], ends[-1] - ends[0]).to_numpy(zero_copy_only=False).astype(np.float64)
            ends -= ends[0]
            bad = ~np.isfinite(v)                             # a null component is not a number here
            before = np.concatenate([[0], np.cumsum(bad)])
            keep = np.flatnonzero(~np.asarray(column.is_null()) & (before[ends[1:]] == before[ends[:-1]]))
            x = np.floor(scale * np.where(bad, 0.0, v))
            if not np.abs(x).max(initial=0.0) < 2.0 ** 62:
                raise OverflowError("a component does not fit a whole number of 64 bits")
            most = np.zeros(len(column))
            some = np.flatnonzero(ends[1:] > ends[:-1])
            if len(some):
                most[some] = np.maximum.reduceat(np.abs(x), ends[some])
            with np.errstate(invalid="ignore"):               # the widths that are too small for a row are not read
                wide = {k: x.astype(t) for k, t in KINDS.items()}
            out = [(k := kind_of(most[i])) + wide[k][ends[i]:ends[i + 1]].tobytes() for i in keep]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep)), pa.array(out, pa.binary())], ["vec_id", "x"])
    return run


def whole_vectors(embeddings: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """``vec_id, x``: ``floor(scale * component)`` of every vector that is not null and holds only finite components.

    A component beyond 64 bits is an error."""
    rows = embeddings.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>"))
    return rows.mapInArrow(_packed(scale), "vec_id bigint, x binary")


def vector_length(x: Column) -> Column:
    """Components of a packed vector."""
    kind = F.substring(x, 1, 1)
    width = F.when(kind == F.lit(b"h"), 2).when(kind == F.lit(b"i"), 4).otherwise(8)
    return ((F.octet_length(x) - 1) / width).cast("int")


def matrix(rows: list[bytes]) -> np.ndarray:
    """Packed vectors of one length as rows of whole numbers."""
    return np.stack([np.frombuffer(r, KINDS[r[:1]], offset=1) for r in rows]).astype(np.int64)
