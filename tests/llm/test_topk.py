"""Exact top-k search against all inner products, and the threshold algorithm's bound."""

import math

import numpy as np
import pytest
from pyspark.sql import types as T

from florapipe.llm.topk import threshold_search, top_k

VECTOR = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
                       *[T.StructField(n, T.StringType()) for n in ("x", "uid", "rows", "rank", "score", "block")]])


def frame(spark, rows):
    return spark.createDataFrame([(i, v, *"abcdef") for i, v in rows], VECTOR)


def fifty(vec_id):
    return vec_id % 50 == 0


def brute(rows, k=5, scale=256.0):
    good = [(i, [math.floor(scale * c) for c in v]) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for at, (i, q) in enumerate(good):
        if i is None or i % 50:
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, x)), j is None, j or 0)
                        for other, (j, x) in enumerate(good) if other != at and len(x) == len(q))
        out += [(i, rank, None if none else j, -s) for rank, (s, none, j) in enumerate(scored[:k], 1)]
    return sorted(out, key=repr)


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_given_vectors(spark):
    embeddings = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in embeddings.collect()]
    assert found(top_k(embeddings, fifty)) == brute(rows)


def test_odd_input(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, -0.5, 0.25]), (50, [1.0, -0.5, 0.25]), (50, [0.1, 0.1, 0.1]), (3, None), (100, None), (4, [1.0, None, 0.0]),
            (5, [nan, 0.0, 1.0]), (6, [inf, 0.0, 1.0]), (7, [0.0, 0.0, 0.0]), (150, [0.0, 0.0, 0.0]), (8, [1.0, 2.0]), (200, [2.0, 1.0]),
            (9, []), (250, []), (None, [1.0, -0.5, 0.25]), (None, [9.0, 9.0, 9.0]), (10, [-1.0, 0.5, -0.25]), (11, [300.0, 1e6, -70000.0]),
            (1, [1.0, -0.5, 0.25]), (1, [1.0, -0.5, 0.25]), (-50, [-0.001, 0.0039, 0.004])]
    got = found(top_k(frame(spark, rows), fifty))
    assert got == brute(rows)
    assert top_k(frame(spark, []), fifty).count() == 0
    assert top_k(frame(spark, [(1, [1.0])]), fifty).count() == 0
    assert top_k(frame(spark, [(50, [1.0])]), fifty).columns == ["query_id", "rank", "vec_id", "score"]


def test_copies_and_blocks(spark):
    """A hot vector, equal scores, many small blocks of candidates and of queries."""
    rng = np.random.default_rng(3)
    rows = [(i, rng.integers(-3, 4, 6).astype(float).tolist()) for i in range(400)] + [(1000 + i, [1.0, 2.0, 0.0, -1.0, 0.0, 1.0]) for i in range(300)]
    want = brute(rows, scale=1.0)
    asked = []
    assert found(top_k(frame(spark, rows), fifty, scale=1.0, block_bytes=64, query_bytes=40, on_block=asked.append)) == want
    assert len(asked) > 1
    assert found(top_k(frame(spark, rows), fifty, scale=1.0)) == want


def test_the_bound_stops_the_search():
    """Where a few vectors stand out, most of a block is never looked up, and what is found is exact."""
    rng = np.random.default_rng(5)
    x = rng.integers(-20, 20, (4000, 16))
    x[:30] *= 20
    lists = np.argsort(x, axis=0, kind="stable").T
    exact = x.astype(float)
    looked = 0
    for q in x[:30].astype(float):
        numbers, scores, met = threshold_search(exact, lists, q, np.iinfo(np.int64).min, 5)
        whole = exact @ q
        kth = np.sort(whole)[-5]
        assert sorted(numbers.tolist()) == np.flatnonzero(whole >= kth).tolist()
        assert (scores == whole[numbers]).all()
        looked += met
    assert looked < 0.5 * 30 * len(x)


def test_a_far_block_is_not_opened():
    x = np.array([[1, 2], [2, 1], [0, 0]], float)
    lists = np.argsort(x, axis=0, kind="stable").T
    assert threshold_search(x, lists, np.array([10.0, 10.0]), 100, 5)[2] == 0


def test_whole_numbers_beyond_doubles(spark):
    rows = [(50, [float(2**30), 1.0]), (1, [float(2**30), 3.0]), (2, [float(2**30), 2.0]), (3, [-float(2**30), 2.0])]
    assert found(top_k(frame(spark, rows), fifty, scale=1.0)) == brute(rows, scale=1.0)
    with pytest.raises(Exception, match="64 bits"):
        top_k(frame(spark, [(50, [1e18]), (1, [1e18])]), fifty, scale=1.0).collect()
