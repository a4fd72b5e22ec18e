"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from florapipe.session import materialize


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the edges of a task by stars with the same components: never more edges than vertices."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while (up := parent.setdefault(root, root)) != root:
            root = up
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = find(a), find(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    pairs = [(find(x), x) for x in parent]
    pairs = [(a, b) for a, b in pairs if a != b]
    for i in range(0, len(pairs), 50_000):
        a, b = zip(*pairs[i:i + 50_000])
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def connected_components(edges: DataFrame) -> DataFrame:
    """``(vertex, component)`` for every vertex of ``edges (a, b)`` (two bigints); the component is its
    smallest vertex.

    Each task first reduces its own edges to stars.  Then large-star and
    small-star steps alternate until nothing changes, which takes a number of
    rounds that grows with the logarithm of the largest component.  A step is a
    minimum per vertex, combined before the shuffle, and a join back that Spark
    splits when a vertex is hot.  Each round is a written table, so a lost
    executor costs one round.  Loops ``a = b`` and repeated edges are fine; a
    vertex without an edge to another one is not in the result."""
    edges = edges.select(F.col("a").cast("bigint"), F.col("b").cast("bigint"))
    stars = edges.filter("a <> b").mapInArrow(_forest, "a bigint, b bigint")
    stars = materialize(_linked(stars), "component_edges")
    state = _state(stars)
    while True:
        low = _minimum(stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b"))))
        large = low.filter("b > a").select(F.col("low").alias("a"), "b")         # larger neighbours to the minimum
        large = materialize(_linked(large), "component_edges")
        down = large.select(F.col("b").alias("a"), F.col("a").alias("b"))        # each vertex to its smaller ones
        low = _minimum(down)
        small = low.select(F.col("low").alias("a"), "b").unionByName(
            low.select(F.col("low").alias("a"), F.col("a").alias("b")))
        stars = materialize(_linked(small), "component_edges")
        before, state = state, _state(stars)
        if state == before:
            break
    members = stars.select(F.col("b").alias("vertex"), F.col("a").alias("component"))
    return members.unionByName(stars.select(F.col("a").alias("vertex"), F.col("a").alias("component")).distinct())


def _linked(edges: DataFrame) -> DataFrame:
    return edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct()


def _minimum(directed: DataFrame) -> DataFrame:
    """Edges ``a -> b`` with ``low``, the least of ``a`` and all its ``b``."""
    low = directed.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    # a written table, so that both sides are dealt out anew and a hot vertex can be split
    return directed.join(materialize(low, "component_minima"), "a")


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return (row["n"], row["x"])
