"""Audits, paging, attempts and keyed-table rules."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from florapipe.operators import audit
from florapipe.operators.attempts import accept_status, first_acceptable
from florapipe.operators import enumeration
from florapipe.operators.enumeration import first_bounds, left_out, limit_per_group, page_prefix
from florapipe.operators.numbering import running_sums
from florapipe.sources import store
from tests.conftest import rows


def test_describe_fixture(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (10.0,), (None,)], "x double")
    r = audit.describe(df, "x").first()
    assert r["count"] == 4
    assert (r["p25"], r["p50"], r["p75"]) == (1.75, 3.0, 5.5)
    assert r["std"] == pytest.approx(4.031128874149275)


def test_exact_quantiles_across_buckets(spark):
    rng = np.random.default_rng(7)
    vals = np.concatenate([rng.normal(size=3000), np.full(2000, 0.5)])  # one hot value
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    r = audit.describe(df.repartition(5), "x").first()
    q = np.percentile(vals, [25, 50, 75])
    assert (r["p25"], r["p50"], r["p75"]) == pytest.approx(tuple(q), abs=1e-12)


def test_grid_symmetry(spark):
    even = spark.createDataFrame([("o1", "a"), ("o1", "b"), ("o2", "c"), ("o2", "d")], "order string, scientific_name string")
    odd = spark.createDataFrame([("o1", "a"), ("o2", "b"), ("o2", "c"), ("o2", "d"), (None, "e")],
                                "order string, scientific_name string")
    assert audit.grid_symmetry(even).first()["grid"] == "Perfect Grid (2 species per order)"
    assert audit.grid_symmetry(odd).first()["grid"] == "Asymmetric (Ranges from 1 to 3 species per order)"


def test_value_counts_keeps_null_failure_reasons_drop_it(spark):
    df = spark.createDataFrame([("success",), ("timeout",), (None,), ("timeout",)], "s string")
    assert rows(audit.value_counts(df, "s")) == sorted([(None, 1), ("success", 1), ("timeout", 2)], key=repr)
    assert rows(audit.failure_reasons(df, "s")) == [("timeout", 2)]


def test_load_metrics_running_totals(spark):
    df = spark.range(0, 5000).select((F.col("id") % 2500).alias("k"))
    out = audit.load_metrics(df, "k", chunk_rows=100).orderBy("chunk").collect()
    assert out[-1]["rows_loaded"] == 5000 and out[-1]["progress_pct"] == 100.0
    assert out[0]["rows_in"] == 200 and out[0]["unique_keys"] == 100
    assert [r["rows_loaded"] for r in out] == [200 * (i + 1) for i in range(25)]


def test_running_sums_cross_partitions(spark):
    df = spark.range(0, 3000).withColumn("v", F.lit(1)).repartition(7)
    out = running_sums(df, ["id"], ["v"]).orderBy("id").collect()
    assert [r["cum_v"] for r in out] == list(range(1, 3001))


def test_describe_skips_nan_and_reports_on_empty_inputs(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,), (None,)], "x double")
    r = audit.describe(df, "x").first()
    assert (r["count"], r["mean"], r["max"], r["p50"]) == (2, 2.0, 3.0, 2.0)
    none = df.limit(0).selectExpr("x", "CAST(x AS STRING) AS image_url", "CAST(x AS STRING) AS `o'dd`")
    assert [(r["n_missing"], r["pct_missing"]) for r in audit.missing_counts(none, ["x", "o'dd", "absent"]).collect()] == [(0, 0.0)] * 3
    assert audit.fill_rate(none).first()["fill_pct"] == 0.0
    assert audit.describe(none, "x").first()["p50"] is None
    assert audit.load_metrics(none, "x").count() == 0


def test_keys_count_at_their_first_chunk(spark):
    df = spark.createDataFrame([(1, 0, 2), (2, 0, 0), (1, 1, 3), (2, 1, None)], "k int, c int, i int")
    out = audit.load_metrics(df, "k", chunk_col="c", images_col="i").orderBy("chunk").collect()
    assert [(r["unique_keys"], r["keys_loaded"], r["images_loaded"], r["progress_pct"]) for r in out] == [(2, 2, 2, 50.0), (0, 2, 5, 100.0)]


def test_value_counts_sorted_and_approximate_distincts(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "order string")
    assert [r["n"] for r in audit.value_counts(df, "order").collect()] == [2, 1, 1]
    assert audit.distinct_counts(df, approximate=True).first()["n_orders"] == 2


def test_first_acceptable(spark):
    df = spark.createDataFrame([(1, 1, "timeout"), (1, 2, "no_images"), (1, 3, "success"),
                                (2, 1, "timeout"), (2, 2, "timeout"), (2, 3, "timeout"), (2, 4, "success")],
                               "k int, attempt_no int, status string")
    out = {r["k"]: (r["attempt"], r["status"]) for r in first_acceptable(
        df, "k", ["attempt_no"], accept_status("status"), ["status"], max_attempts=3).collect()}
    assert out == {1: (2, "no_images"), 2: (None, "max_retries_exhausted")}


def test_page_prefix_stop_and_skip(spark):
    pages = spark.createDataFrame([("o", 0, 200, 100), ("o", 100, None, None), ("o", 200, 200, 100),
                                   ("o", 300, 500, 0), ("o", 400, 200, 100), ("p", 0, 200, 0),
                                   ("q", 0, 200, 5), ("q", 200100, 200, 5)],
                                  "g string, offset int, st int, n int")
    kept = rows(page_prefix(pages, "g", "offset", "st", "n"), "g", "offset")
    assert kept == [("o", 0), ("o", 200), ("q", 0), ("q", 200100)]
    assert ("q", 200100) not in rows(page_prefix(pages, "g", "offset", "st", "n", ceiling=200_000), "g", "offset")


def test_no_limit_is_applied_unless_asked_for(spark):
    df = spark.range(0, 60_000, numPartitions=3).selectExpr("'one' AS g", "id")
    assert limit_per_group(df, "g", ["id"]).count() == 60_000
    cut = limit_per_group(df, "g", ["id"], n=50_000)
    assert cut.count() == 50_000 and cut.agg(F.max("id")).first()[0] == 49_999
    assert left_out(df, "g", 50_000).first()["n_left_out"] == 10_000
    pages = spark.range(0, 4000).selectExpr("'one' AS g", "id * 100 AS offset", "200 AS st", "100 AS n")
    assert page_prefix(pages, "g", "offset", "st", "n").count() == 4000


def test_limit_per_group(spark):
    df = spark.createDataFrame([("a", i) for i in range(10)] + [("b", i) for i in range(3)], "g string, o int")
    assert rows(limit_per_group(df, "g", ["o"], n=2), "g", "o") == [("a", 0), ("a", 1), ("b", 0), ("b", 1)]


def test_first_bounds_leave_few_rows(spark, monkeypatch):
    """Two rounds of ranges: of a large group hardly more than the first n rows are left to be ranked, ties and nulls right."""
    assert first_bounds(spark.range(1000).selectExpr("1 AS g", "id"), ["g"], ["id"], 10) is None
    monkeypatch.setattr(enumeration, "SORT_ROWS", 300)
    df = spark.range(0, 300_000, numPartitions=4).selectExpr(
        "CASE WHEN id % 3 = 0 THEN NULL WHEN id % 1000 = 1 THEN 'small' ELSE 'large' END AS g", "hash(id) % 5000 AS o", "id",
        "CASE WHEN id % 7 = 0 THEN NULL ELSE hash(id) END AS maybe")
    for order, n in ((["o", "id"], 10), (["maybe", "id"], 5), (["o", "id"], 20_000)):
        bounds = {r["_g0"]: r["_bound"] for r in first_bounds(df, ["g"], order, n).collect()}
        got = limit_per_group(df, "g", order, n=n)
        w = Window.partitionBy("g").orderBy(*order)
        want = df.withColumn("rank_in_group", F.row_number().over(w)).filter(F.col("rank_in_group") <= n)
        assert rows(got, "g", "id", "rank_in_group") == rows(want, "g", "id", "rank_in_group")
        if n == 10:
            left = df.filter(F.col("g") == "large").filter(
                (F.col("o") < bounds["large"]["o0"]) | (F.col("o") == bounds["large"]["o0"]) & (F.col("id") <= bounds["large"]["o1"]))
            assert n <= left.count() < 0.01 * 200_000
    assert limit_per_group(df.limit(0), "g", ["o"], n=3).count() == 0


def test_upsert_overwrites_with_null_and_keeps_id(spark):
    target = spark.createDataFrame([("k", 1, "a", 100), ("j", 2, "b", 200)], "key string, v int, t string, id bigint")
    source = spark.createDataFrame([("k", None, "b", 1), ("n", 5, "x", 1), ("n", 6, "y", 2)],
                                   "key string, v int, t string, seq int")
    out = {r["key"]: (r["v"], r["t"], r["id"]) for r in store.upsert(
        target, source, ["key"], "seq", id_fn=lambda k: F.lit(999).cast("bigint")).collect()}
    assert out == {"k": (None, "b", 100), "j": (2, "b", 200), "n": (6, "y", 999)}


def test_insert_ignore_and_lookup(spark):
    target = spark.createDataFrame([(1, "u1", True)], "sid int, url string, prim boolean")
    source = spark.createDataFrame([(1, "u1", False, 0), (1, "u2", False, 1), (1, "u2", True, 2)],
                                   "sid int, url string, prim boolean, o int")
    out = rows(store.insert_ignore(target, source.drop("o").withColumn("o", F.col("prim").cast("int")),
                                   ["sid", "url"], ["o"]).select("sid", "url", "prim"))
    assert out == [(1, "u1", True), (1, "u2", False)]
    ids = spark.createDataFrame([("a", 10)], "key string, id int")
    batch = spark.createDataFrame([("a",), ("b",)], "key string")
    assert rows(store.lookup_ids(batch, ids, ["key"])) == [("a", 10)]


def test_snapshot_versions(spark, tmp_path):
    p = str(tmp_path / "t")
    assert store.read_snapshot(spark, p) is None
    store.write_snapshot(spark.createDataFrame([(1,)], "a int"), p)
    v = store.write_snapshot(spark.createDataFrame([(2,), (3,)], "a int"), p)
    assert v == 2 and rows(store.read_snapshot(spark, p)) == [(2,), (3,)]
