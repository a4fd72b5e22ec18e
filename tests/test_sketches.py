"""Sketches of loads against the exact audits."""

from pyspark.sql import functions as F

from florapipe.operators.audit import describe
from florapipe.operators.sketches import audit_sketches, load_sketches
from florapipe.sources import store


def table(spark, n=60_000):
    return spark.range(n, numPartitions=3).selectExpr(
        "CASE WHEN id % 11 = 0 THEN NULL WHEN id % 13 = 0 THEN double('NaN') ELSE exp(3 * rand(7)) + id / 9e4 END AS x",
        "CASE WHEN id % 5 > 0 THEN concat('k', id % 7001) END AS name", "id % 6 AS load", "CAST(NULL AS double) AS nothing")


def test_loads_against_the_exact_audit(spark, tmp_path):
    rows, path = table(spark).cache(), str(tmp_path / "sketches")
    for load in range(6):
        one = load_sketches(rows.filter(F.col("load") == load), numbers=["x", "nothing"], keys=["name"])
        for _ in range(1 + (load == 2)):                      # a load that is retried counts once
            store.append_batch(one, path, fmt="parquet", batch=str(load))
    stored = spark.read.parquet(path)
    assert stored.count() == 6 * 3                            # what the audit reads, whatever the table's size
    got = {r["column_name"]: r for r in audit_sketches(stored).collect()}
    exact = describe(rows, "x").first()
    x = got["x"]
    assert (x["n"], x["min"], x["max"]) == (exact["count"], exact["min"], exact["max"]) and x["n_missing"] == 60_000 - x["n"]
    assert abs(x["mean"] / exact["mean"] - 1) < 1e-9 and abs(x["std"] / exact["std"] - 1) < 1e-9
    for p, c in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75")):
        rank = rows.filter(~F.isnan("x") & (F.col("x") <= x[c])).count() / x["n"]
        assert abs(rank - p) < 0.02
    distinct = rows.agg(F.count_distinct("name")).first()[0]
    assert abs(got["name"]["n_distinct"] / distinct - 1) < 0.04 and got["name"]["n_missing"] == 12_000
    assert (got["nothing"]["n"], got["nothing"]["n_missing"], got["nothing"]["p50"]) == (0, 60_000, None)


def test_one_load_and_none(spark):
    one = load_sketches(spark.createDataFrame([(1.0, "a"), (3.0, None)], "v double, k string"), ["v"], ["k"])
    got = {r["column_name"]: r.asDict() for r in audit_sketches(one).collect()}
    assert (got["v"]["mean"], got["v"]["std"], got["v"]["n_distinct"]) == (2.0, 2.0 ** 0.5, None) and got["k"]["n_distinct"] == 1
    empty = load_sketches(spark.createDataFrame([], "v double, k string"), ["v"], ["k"])
    assert {r["n"] for r in audit_sketches(empty.unionByName(one)).collect()} == {2, 1}
    assert {r["n"] for r in audit_sketches(empty).collect()} == {0}
