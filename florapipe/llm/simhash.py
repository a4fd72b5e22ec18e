"""SimHash near-duplicates by multi-index hashing (operator 5).

The 64-bit fingerprint is cut into segments.  Two fingerprints within ``bits``
differ by at most ``bits // segments`` in at least one segment, so each
fingerprint enumerates the small Hamming ball around every segment's value and
looks the values up in the table of segments; what is found is verified on the
whole distance.  Only the smaller value of two looks for the larger one, which
halves the look-ups and loses nothing.  Links are between distinct
fingerprints, so equal texts never meet as pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from florapipe.llm.common import UID, keep_rows
from florapipe.llm.components import connected_components
from florapipe.session import materialize

BLOCK = 100_000
#: A segment value of more fingerprints than a ball has points is linked through ball points instead of pairs.
DENSE = 64


def simhash(text: bytes | None, shingle: int = 3, seed: int = 42) -> int:
    """Unsigned 64-bit SimHash of a text's UTF-8 bytes; 0 if it has no word.

    Bit i is 1 if over half of the shingles' XXH64 values have it, repeats
    counted.  Works through the shingles in blocks, so a text of any length
    needs memory for its words and one block of hashes only."""
    words = (text or b"").lower().split()          # bytes: A-Z only, and exactly the white space of the contract
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(shingle, len(words))
    starts, ends = starts[:len(words) - width + 1], ends[width - 1:]
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for i in range(0, len(starts), BLOCK):
        h = np.array([digest(joined[s:e], seed) for s, e in zip(starts[i:i + BLOCK].tolist(), ends[i:i + BLOCK].tolist())],
                     np.uint64)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(starts), bitorder="little").view(np.uint64)[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([simhash(t.as_py(), shingle) for t in batch.column(3)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(fps, pa.int64())],
                                             [UID, "doc_id", "text_hash", "fp"])
    return run


def fingerprints(keyed: DataFrame, shingle: int = 3) -> DataFrame:
    """``(UID, doc_id, text_hash, fp)`` of rows ``(UID, doc_id, text_hash, text)``; ``fp`` is the SimHash as a signed long."""
    return keyed.withColumn("text", F.col("text").cast("binary")).mapInArrow(
        _fingerprints(shingle), f"{UID} bigint, doc_id bigint, text_hash bigint, fp bigint")


def _masks(width: int, radius: int) -> list[int]:
    return [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(width), r)]


def _values(segments: int) -> list[tuple[int, int, Column]]:
    """Number, width and value of each segment of column ``fp``."""
    cuts = [64 * i // segments for i in range(segments + 1)]
    return [(i, hi - lo, F.shiftrightunsigned("fp", lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1)))
            for i, (lo, hi) in enumerate(zip(cuts, cuts[1:]))]


def _ball(value: Column, masks: list[int]) -> Column:
    """The values that differ from ``value`` by one of the masks, and are not below it."""
    changed = F.transform(F.array(*[F.lit(m).cast("bigint") for m in masks]), lambda m: value.bitwiseXOR(m))
    return F.filter(changed, lambda x: x >= value)


def near_links(distinct: DataFrame, bits: int = 2, segments: int = 2, dense: int = DENSE) -> DataFrame:
    """Edges ``(a, b)`` between the distinct fingerprints ``fp`` whose components are those of all
    pairs within ``bits``.

    A segment value that more than ``dense`` fingerprints share would meet in
    too many pairs.  Its fingerprints, and those that look for it, are linked
    exactly in another way: two of them are within ``bits`` just when their
    balls of half that radius over all 64 bits share a point, so each is joined
    to the least one at each of its points, a number of rows in proportion to
    the fingerprints."""
    if bits % 2 or segments < 2 or bits < 0:
        raise ValueError("bits must be even, segments at least 2")
    key = 1 << 40
    parts = [(F.lit(i * key) + v, w) for i, w, v in _values(segments)]
    table = distinct.select("fp", F.explode(F.array(*[p for p, _ in parts])).alias("key"))
    ball = F.concat(*[_ball(p, _masks(w, bits // segments)) for p, w in parts])
    own = F.array(*[p for p, _ in parts])
    probes = (distinct.select("fp", own.alias("own"), F.explode(ball).alias("key"))
              .select("fp", "key", F.array_contains("own", F.col("key")).alias("same")))
    crowded = materialize(table.groupBy("key").count().filter(F.col("count") > dense).select("key"), "crowded")
    sparse = table.join(crowded, "key", "left_anti")
    found = probes.join(sparse.withColumnRenamed("fp", "other"), "key")
    links = (found.filter((~F.col("same") | (F.col("fp") < F.col("other")))
                          & (F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= bits))
             .select(F.col("fp").alias("a"), F.col("other").alias("b")))
    close = probes.join(crowded, "key", "left_semi").select("fp").distinct()
    points = close.select("fp", F.explode(F.transform(
        F.array(*[F.lit(_signed(m)).cast("bigint") for m in _masks(64, bits // 2)]),
        lambda m: F.col("fp").bitwiseXOR(m))).alias("point"))
    least = points.groupBy("point").agg(F.min("fp").alias("least"), F.count("*").alias("n")).filter("n > 1")
    stars = points.join(least, "point").filter("fp <> least").select(F.col("least").alias("a"), F.col("fp").alias("b"))
    return links.unionByName(stars)


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _classes(prints: DataFrame, bits: int, segments: int) -> DataFrame:
    """``(fp, component_id, keep_uid)`` for every distinct fingerprint."""
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", UID))
    classes = materialize(prints.groupBy("fp").agg(best.alias("best")), "fingerprints_distinct")
    members = connected_components(near_links(classes.select("fp"), bits, segments))
    classes = classes.join(members, classes["fp"] == members["vertex"], "left").select(
        "fp", "best", F.coalesce("component", "fp").alias("component"))
    classes = materialize(classes, "simhash_classes")
    keep = materialize(classes.groupBy("component").agg(F.min("best").alias("keep")), "simhash_components")
    return classes.join(keep, "component").select("fp", F.col("keep.doc_id").alias("component_id"),
                                                  F.col(f"keep.{UID}").alias("keep_uid"))


def _prints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    keyed = docs.select(F.monotonically_increasing_id().alias(UID), F.col(id_col).cast("bigint").alias("doc_id"),
                        F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    return materialize(fingerprints(keyed, shingle), "fingerprints")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                   bits: int = 2, segments: int = 2) -> DataFrame:
    """One row per document: ``doc_id, fingerprint`` (16 hex digits), ``component_id`` (smallest id reachable),
    ``kept`` (one row of each component, of the smallest id) and the hash of the text as it is.

    Null, empty and blank texts have fingerprint zero and link like any other.
    Null ids are never a component's id unless all its ids are null.  Repeated
    rows give repeated rows, one of them kept; an empty table an empty one;
    extra columns are ignored."""
    prints = _prints(docs, id_col, text_col, shingle)
    return prints.join(_classes(prints, bits, segments), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
        (F.col(UID) == F.col("keep_uid")).alias("kept"), "text_hash")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                         bits: int = 2, segments: int = 2) -> DataFrame:
    """The rows of ``docs`` with one document of each group, the one with the smallest id (one row, if repeated)."""
    return keep_rows(docs, simhash_groups(docs, id_col, text_col, shingle, bits, segments), id_col, text_col)
