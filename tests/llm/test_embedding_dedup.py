import math
import random

import numpy as np
import pytest

from florapipe.llm import embedding_dedup
from florapipe.llm.embedding_dedup import embedding_groups


def brute(rows, threshold):
    def unit(v):
        x = np.array([math.nan if c is None else c for c in v or []], float)
        if not len(x) or not np.isfinite(x).all() or not np.abs(x).max() > 0:
            return None
        return x / np.abs(x).max() / np.linalg.norm(x / np.abs(x).max())
    units = [unit(v) for _, v in rows]
    near = [[j for j, b in enumerate(units) if j != i and a is not None and b is not None and len(a) == len(b) and a @ b >= threshold]
            for i, a in enumerate(units)]
    label = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i, js in enumerate(near):
            low = min([label[i], *(label[j] for j in js)])
            changed |= low != label[i]
            label[i] = low
    least = {}
    for (i, _), c in zip(rows, label):
        if i is not None:
            least[c] = min(i, least.get(c, i))
    return sorted(((i, len(js), least.get(c), i == least.get(c)) for (i, _), js, c in zip(rows, near, label)), key=repr)


def vectors(seed, n, dims):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dims))
    rows = [(i, (centres[rng.integers(12)] + rng.choice([0.02, 0.15, 0.3]) * rng.normal(size=dims)).tolist()) for i in range(n)]
    rows += [(n + i, rows[7][1]) for i in range(40)]                              # equal vectors
    rows += [(n + 40 + i, [3.0 * c for c in rows[8][1]]) for i in range(5)]       # the same direction
    random.Random(seed).shuffle(rows)
    return rows


@pytest.mark.parametrize("interval,tile", [(1 << 20, 1 << 23), (300 * 8 * 16, 700 * 8 * 16), (20 * 8 * 16, 300 * 8 * 16)])
def test_against_brute_force(spark, monkeypatch, interval, tile):
    monkeypatch.setattr(embedding_dedup, "TOP", 4)
    monkeypatch.setattr(embedding_dedup, "HELD_BYTES", 50 * 8 * 16)
    rows = vectors(1, 1500, 16)
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    said = []
    found = embedding_groups(df, 0.95, interval_bytes=interval, tile_bytes=tile, on_join=lambda *n: said.append(n))
    assert 0 < said[0][1] < 0.6 * said[0][0] or interval > 1 << 19
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute(rows, 0.95)


def test_table_against_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    assert sorted((tuple(r) for r in embedding_groups(df, 0.6).collect()), key=repr) == brute(rows, 0.6)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, 2.0]), (7, [1.0, 2.0]), (8, [2.0, 4.0]),
            (9, [1.0, 2.0, 0.0]), (10, [-1.0, -2.0]), (None, [1.0, 2.0]), (None, [5.0, -1.0]), (11, [0.0, -0.0]), (12, [1e-300, 2e-300]), (13, [1e300, 2e300])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id bigint, embedding array<double>, n_links string")
    found = sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in embedding_groups(df).collect()), key=repr)
    assert found == sorted((x[:3] for x in brute(rows, 0.95)), key=repr)
    assert embedding_groups(df.limit(0)).count() == 0
    assert embedding_groups(df.filter("vec_id = 1")).collect()[0]["component_id"] == 1


def test_the_bound_leaves_few_pairs(spark):
    """Vectors close to isotropic, as the given ones: no box is far from another, but single vectors are."""
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    said = []
    embedding_groups(df, 0.95, on_join=lambda *n: said.append(n))
    [(pairs, compared)] = said
    assert 0 < compared < 0.2 * pairs
