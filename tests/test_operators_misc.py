"""Remaining operator rules: targets, clades, probes, headers, schema
enforcement, JSON lists, name standardisation, audit edge cases."""

import pytest
from pyspark.sql import functions as F

from florapipe.operators import audit
from florapipe.operators import enumeration as en
from florapipe.operators import records as rec
from florapipe.operators.probe import order_probe_report, probe_summary
from tests.conftest import rows


def test_select_targets_precedence_and_unknown_batch(spark):
    dim = spark.createDataFrame([(1, "Rosales"), (1, "Fagales"), (2, "Poales")], "batch int, order_name string")
    assert rows(en.select_targets(dim, batch=2, orders=["Rosales"]), "order_name") == [("Poales",)]
    assert rows(en.select_targets(dim, orders=["Rosales"]), "order_name") == [("Rosales",)]
    assert en.select_targets(dim, batch=2, all_targets=True).count() == 3
    with pytest.raises(Exception, match="unknown batch 9"):
        en.select_targets(dim, batch=9).collect()
    fixed = en.order_dimension(spark)
    assert fixed.count() == 21 and en.order_dimension(spark, sample=True).count() == 22 and rows(en.select_targets(fixed, batch=3), "order_name") == [("Asterales",)]


def test_classify_clade(spark):
    d = spark.createDataFrame([(1, 200, "Plantae", "Liliopsida"), (2, 200, "Plantae", "Pinopsida"),
                               (3, 200, "Fungi", "Liliopsida"), (4, 404, "Plantae", "Liliopsida")],
                              "order_key int, http_status int, kingdom string, class string")
    out = {r["order_key"]: r["is_angiosperm"] for r in en.classify_clade(d).collect()}
    assert out == {1: True, 2: False, 3: None, 4: None}


def test_probe_report_and_summary(spark):
    orders = spark.createDataFrame([("A", 1), ("B", 2), ("C", 3)], "order_name string, order_key int")
    species = spark.createDataFrame([(1, i, f"s{i}", f"f{i % 2}") for i in range(5)] + [(2, 9, "x", "f1")],
                                    "order_key int, pos int, name string, family string")
    clades = spark.createDataFrame([(1, True), (2, False)], "order_key int, is_angiosperm boolean")
    rep = {r["order_name"]: r for r in order_probe_report(orders, species, clades, limit=3).collect()}
    assert rep["A"]["total_available"] == 5 and rep["A"]["retrieved"] == 3
    assert rep["A"]["sample_names"] == "s0|s1|s2" and rep["C"]["status"] == "No results"
    samples = spark.createDataFrame([(1, 1, "f0"), (1, 2, "f1"), (1, 3, "f0"), (2, 1, "f1"), (2, 2, "f2")],
                                    "order_pos int, sample_pos int, family string")
    s = probe_summary(order_probe_report(orders, species, clades, limit=3), samples, top=2).first()
    assert (s["n_success"], s["n_failed"], s["total_available"], s["n_angiosperm"]) == (2, 1, 6, 1)
    # f0 and f1 both twice; f0 seen first
    assert s["n_families"] == 3 and s["top_families"] == "f0|f1"


def test_normalize_headers(spark):
    df = spark.createDataFrame([(1, 2)], "` A `int, `b ` int")
    assert rec.normalize_headers(df).columns == ["a", "b"]
    with pytest.raises(ValueError):
        rec.normalize_headers(spark.createDataFrame([(1, 2)], "`A` int, `a ` int"))


def test_enforce_schema_columns_and_json(spark):
    df = spark.createDataFrame([("12", None, "x"), ("abc", "7", "y")], "n string, m string, extra string")
    spec = [rec.Field("n", "bigint", 0), rec.Field("m", "bigint", -1, required=True),
            rec.Field("missing", "string", "none"),
            rec.Field("n2", "bigint", 5, transform=lambda c: F.try_multiply(c, F.lit(10)))]
    out = [tuple(r) for r in rec.enforce_schema(df, spec).collect()]
    assert out == [(12, -1, "none", 50), (0, 7, "none", 50)]
    j = spark.createDataFrame([('{"k": 1, "s": "a"}',), ('{"k": "1", "s": "b"}',), ("{bad",)], "t string")
    out = [tuple(r) for r in rec.enforce_schema(j, [rec.Field("k", "bigint", -1), rec.Field("s", "string", "")],
                                                json_col="t").collect()]
    assert out == [(1, "a"), (-1, "b"), (-1, "")]     # a wrong-typed field does not blank the others


def test_parse_json_arrays_flags(spark):
    df = spark.createDataFrame([('["a","b"]',), ("[bad",), (None,)], "l string")
    out = [(r["l"], r["l_malformed"]) for r in rec.parse_json_arrays(df, ["l"]).collect()]
    assert out == [(["a", "b"], False), ([], True), ([], False)]


def test_standardize_names_dedupes_and_rejects(spark):
    df = spark.createDataFrame([(1, "Rosa canina L."), (2, "Rosa canina L."), (3, "Rosa x alba"), (4, None)],
                               "id int, name string")
    out = {r["id"]: (r["binomial"], r["query_name"], r["is_valid"], r["reject_reason"])
           for r in rec.standardize_names(df, "name").collect()}
    assert out[1] == out[2] == ("Rosa canina", "Rosa canina", True, None)
    assert out[3] == ("Rosa x", "Rosa alba", False, "invalid_name")
    assert out[4] == (None, None, False, "invalid_name")


def test_audit_absent_columns(spark):
    df = spark.createDataFrame([("a", None), ("b", "x")], "species string, source string")
    r = audit.distinct_counts(df).first()
    assert (r["n_species"], r["n_orders"], r["n_families"], r["n_genera"]) == (2, 0, 0, 0)
    m = {r["column_name"]: r["n_missing"] for r in audit.missing_counts(df, ["source", "common_name"]).collect()}
    assert m == {"source": 1, "common_name": 2}
    f = audit.fill_rate(df).first()
    assert f["image_column"] is None and f["n_filled"] == 0
    assert audit.grid_symmetry(df.withColumn("order", F.lit(None).cast("string"))).first()["grid"] == "Symmetric"


def test_source_share_flags_wiki(spark):
    df = spark.createDataFrame([("wiki", "u")] * 3 + [("inat", "u"), ("inat", None), (None, "u")],
                               "source string, image_url string")
    out = {r["source"]: (r["n"], round(r["share_pct"], 3), r["licence_risk"])
           for r in audit.source_share(df).collect()}
    assert out == {"wiki": (3, 75.0, True), "inat": (1, 25.0, False)}


def test_accepted_species_of_a_dataset(spark):
    t = spark.createDataFrame([(1, "SPECIES", "ACCEPTED", "d1", "o1"), (2, "SPECIES", "ACCEPTED", "d2", "o1"),
                               (3, "SPECIES", "SYNONYM", "d1", "o1"), (4, "SPECIES", "ACCEPTED", "d1", "o2")],
                              "key int, rank string, status string, dataset_key string, order_key string")
    assert rows(en.accepted_species(t, ["o1"], dataset="d1"), "key") == [(1,)]
    orders = spark.createDataFrame([("o2",)], "order_key string")
    assert rows(en.accepted_species(t, orders, dataset="d1"), "key") == [(4,)]
