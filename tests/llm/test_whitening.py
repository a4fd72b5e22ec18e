"""Whitening against numpy, and the bidiagonal solver alone."""

import math

import numpy as np
import pytest
from pyspark.sql import types as T

from florapipe.llm.bidiagonal import bidiagonalise, dqds, right_singular
from florapipe.llm.whitening import whiten

VECTOR = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
                       *[T.StructField(n, T.StringType()) for n in ("x", "n", "length", "component")]])


def frame(spark, rows):
    return spark.createDataFrame([(i, v, *"abcd") for i, v in rows], VECTOR)


def cases():
    rng = np.random.default_rng(1)
    wilkinson = np.diag(np.abs(np.arange(21) - 10.0) + 0.1) + np.diag(np.ones(20), 1)
    turn = np.linalg.qr(rng.standard_normal((30, 30)))[0]
    yield from [(f"random{n}", rng.standard_normal((n, n))) for n in (1, 2, 3, 17, 64)]
    yield "turn", turn
    yield "near turn", turn @ np.diag(1 + 1e-12 * np.arange(30)) @ turn.T
    yield "wilkinson", wilkinson
    yield "identity", np.eye(9)
    yield "zero", np.zeros((5, 5))
    yield "rank one", np.outer(np.ones(6), np.arange(6.0))
    yield "few rows", np.vstack([rng.standard_normal((3, 12)), np.zeros((9, 12))])
    yield "graded", np.triu(rng.standard_normal((30, 30))) * 10.0 ** -np.arange(30)[:, None]


@pytest.mark.parametrize("name,r", [pytest.param(*c, id=c[0]) for c in cases()])
def test_right_singular(name, r):
    values, z = right_singular(r)
    want = np.linalg.svd(r, compute_uv=False) ** 2
    top = max(want[0], 1e-300)
    assert np.abs(values - want).max() <= 1e-13 * top
    assert np.abs(z.T @ z - np.eye(len(r))).max() < 1e-12
    assert np.abs(r.T @ (r @ z) - z * values).max() <= 1e-13 * top
    some = right_singular(r, 2)[1]
    assert some.shape[1] == min(2, len(r)) and np.abs(some - z[:, :2]).max() < 1e-9


def test_small_singular_values_are_accurate():
    """dqds keeps the relative accuracy of the smallest value of a bidiagonal matrix, known here exactly."""
    n = 12
    diagonal, above = 2.0 ** -np.arange(n), 2.0 ** -np.arange(1, n)
    got = np.sort(dqds(diagonal**2, above**2))
    inverse = np.linalg.inv(np.diag(diagonal) + np.diag(above, 1))
    assert abs(got[0] * np.linalg.norm(inverse, 2) ** 2 - 1) < 1e-12
    assert abs(np.log2(got).sum() - 2 * np.log2(diagonal).sum()) < 1e-10


def test_bidiagonal_form():
    r = np.random.default_rng(2).standard_normal((7, 7))
    diagonal, above, _ = bidiagonalise(r)
    b = np.diag(diagonal) + np.diag(above, 1)
    assert np.allclose(np.linalg.svd(b, compute_uv=False), np.linalg.svd(r, compute_uv=False), rtol=1e-13)


def check(rows, got, k=16):
    """Rows as the contract says, with numpy's eigenvectors."""
    good = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in good})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[(n * c - s) / n for c, s in zip(x, sums)] for x in fit])
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    assert len(got) == len(good) * k
    by = {}
    for r in got:
        by.setdefault(r["vec_id"], {}).setdefault(r["component"], []).append(r)
    signs = {}
    for i, x in good:
        exact = sum((n * c - s) ** 2 for c, s in zip(x, sums))
        w = np.array([(n * c - s) / n for c, s in zip(x, sums)]) @ vectors / np.sqrt(values)
        for j in range(1, k + 1):
            same = [r for r in by[i][j] if r["deviation"] == exact]
            assert same and all(r["n"] == n for r in same)
            assert all(abs(r["explained"] - values[j - 1] / np.trace(covariance)) < 1e-8 * r["explained"] for r in same)
            assert all(0 <= r["identity_error"] < 1e-9 for r in same)
            if abs(w[j - 1]) > 1e-3:
                sign = signs.setdefault(j, np.sign(w[j - 1] * same[0]["whitened"]))
                assert min(abs(r["whitened"] * sign - w[j - 1]) for r in same) < 1e-8


def test_given_vectors(spark):
    embeddings = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in embeddings.collect()]
    check(rows, whiten(embeddings.repartition(7)).collect())


def test_many_partitions_reduce_in_a_tree(spark):
    embeddings = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in embeddings.collect()]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "70")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    spark.conf.set("spark.sql.files.openCostInBytes", "4k")
    try:
        check(rows, whiten(embeddings).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        for c in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
            spark.conf.unset(c)


def test_odd_input(spark):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(4)
    base = [(i, rng.standard_normal(5).tolist()) for i in range(60)]
    rows = base + [(None, rng.standard_normal(5).tolist()), (3, base[3][1]), (3, base[3][1]), (70, None), (71, [1.0, None, 0.0, 0.0, 0.0]),
                   (72, [nan] * 5), (73, [inf, 0.0, 0.0, 0.0, 0.0]), (74, [0.0] * 5)] + [(100 + i, base[9][1]) for i in range(50)]
    check(rows, whiten(frame(spark, rows)).collect(), k=5)
    assert whiten(frame(spark, rows + [(80, [1.0, 2.0]), (81, [])])).count() == whiten(frame(spark, rows)).count()
    for few in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, [])]):
        assert whiten(frame(spark, few)).count() == 0
    assert whiten(frame(spark, [])).columns == whiten(frame(spark, rows)).columns


def test_components_without_variance_have_no_rows(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [a, a, 0.5, b]) for i, (a, b) in enumerate(rng.standard_normal((80, 2)).tolist())]
    got = whiten(frame(spark, rows)).collect()
    assert {r["component"] for r in got} == {1, 2} and max(r["identity_error"] for r in got) < 1e-9


def test_large_components(spark):
    """Sums that 64 bits don't hold are whole numbers all the same; a deviation beyond them is null."""
    rows = [(i, [float(i) * 2**40, 1.0]) for i in range(5)]
    got = whiten(frame(spark, rows), scale=1.0).filter("component = 1").collect()
    assert [r["deviation"] for r in sorted(got, key=lambda r: r["vec_id"])] == [None, None, 0, None, None]
    assert {round(abs(r["whitened"]), 9) for r in got} == {0.0, round(math.sqrt(0.5), 9), round(math.sqrt(2), 9)}
