"""J1-J4, J12, J13 fixtures."""

from pyspark.sql import functions as F

from florapipe.operators.enumeration import resolve_orders
from florapipe.operators.resolve import (best_match, first_result, preferred_label, resolve_accepted_name,
                                         top_taxon)

MATCH_SCHEMA = ("name string, http_status int, usageKey bigint, status string, synonym boolean, "
                "canonicalName string, acceptedUsage struct<canonicalName:string>")
SEARCH_SCHEMA = ("q string, http_status int, results array<struct<id:bigint,name:string,observations_count:bigint,"
                 "preferred_common_name:string,english_common_name:string,"
                 "taxon_photos:array<struct<photo:struct<large_url:string,medium_url:string,square_url:string>>>>>")


def test_resolve_orders_null_match_type_passes(spark):
    names = spark.createDataFrame([("Rosales",), ("Fagales",), ("Unknown",), ("Bad",)], "order_name string")
    matches = spark.createDataFrame(
        [("Rosales", 200, None, "Plantae", "ORDER", 1), ("Fagales", 200, "NONE", "Plantae", "ORDER", 2),
         ("Bad", 500, "EXACT", "Plantae", "ORDER", 3)],
        "name string, http_status int, matchType string, kingdom string, rank string, orderKey bigint")
    out = {r["order_name"]: (r["order_key"], r["status"]) for r in resolve_orders(names, matches).collect()}
    assert out == {"Rosales": (1, "resolved"), "Fagales": (None, "unresolved"), "Unknown": (None, "error"),
                   "Bad": (None, "http_error")}


def test_resolve_accepted_name(spark):
    names = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), ("e",)], "n string")
    m = spark.createDataFrame(
        [("a", 200, 5, "SYNONYM", True, "C d", ("A b",)), ("b", 200, 7, "ACCEPTED", False, "B b", None),
         ("c", 404, 1, "ACCEPTED", False, "X", None), ("d", 200, 0, "ACCEPTED", False, "", None)], MATCH_SCHEMA)
    out = {r["n"]: r["resolved_name"] for r in resolve_accepted_name(names, m, "n").collect()}
    assert out == {"a": "A b", "b": "B b", "c": "c", "d": "d", "e": "e"}


def test_repeated_responses_do_not_multiply_and_failures_end_the_lookup(spark):
    names = spark.createDataFrame([("a",)], "n string")
    m = spark.createDataFrame([("a", None, None, None, None, None, None), ("a", 200, 7, "ACCEPTED", False, "B b", None),
                               ("a", 500, None, None, None, None, None)], MATCH_SCHEMA)
    assert [r["resolved_name"] for r in resolve_accepted_name(names, m, "n").collect()] == ["B b"]
    hit = [(5, "Rosa canina", 1, None, None, None)]
    search = spark.createDataFrame([("Rosa x-y", None, None), ("Rosa", 200, hit), ("Rosa", 503, None), ("Tilia", 200, hit)], SEARCH_SCHEMA)
    ents = spark.createDataFrame([(1, "Rosa x-y"), (2, "Tilia"), (3, "Rosa z")], "k int, n string")
    out = {r["k"]: (r["inat_status"], r["q_used"]) for r in best_match(ents, search, "k", "n").collect()}
    assert out == {1: ("timeout", None), 2: ("success", "Tilia"), 3: ("success", "Rosa")}


def test_preferred_label(spark):
    df = spark.createDataFrame([(1, 0, "fra", "rose"), (1, 1, "eng", "Dog rose"), (2, 0, "fra", "rose"),
                                (3, 0, None, "x"), (3, 1, "eng", None)], "k int, pos int, lang string, label string")
    out = {r["k"]: r["label"] for r in preferred_label(df, ["k"], "lang", "label", "pos").collect()}
    assert out == {1: "Dog rose", 2: "rose", 3: ""}


def _result(i, name, obs=1):
    return (i, name, obs, None, "eng", [((None, f"m{i}", f"s{i}"),)])


def test_best_match_first_candidate_wins(spark):
    ents = spark.createDataFrame([(1, "Rosa canina"), (2, "Rosa alba"), (3, None)], "id int, name string")
    search = spark.createDataFrame(
        [("Rosa canina", 200, [_result(10, "Other"), _result(11, "Another")]),
         ("Rosa", 200, [_result(20, "Rosa canina")]),
         ("Rosa alba", 500, [_result(30, "Rosa alba")])], SEARCH_SCHEMA)
    out = {r["id"]: (r["q_used"], r["taxon"]["id"] if r["taxon"] else None, r["inat_status"])
           for r in best_match(ents, search, "id", "name").collect()}
    # candidate 1 has results none containing the name -> its first result
    assert out[1] == ("Rosa canina", 10, "success")
    assert out[2] == ("Rosa", 20, "success")
    assert out[3] == (None, None, "invalid_name")


def test_top_taxon_and_first_result(spark):
    ents = spark.createDataFrame([(1, "Rosa canina"), (2, "Quercus robur")], "id int, name string")
    search = spark.createDataFrame(
        [("Rosa canina", 200, [_result(1, "a", 5), _result(2, "b", 9), _result(3, "c", 9)]),
         ("Quercus", 200, [])], SEARCH_SCHEMA)
    out = {r["id"]: (r["inat_id"], r["observations_count"], r["image_primary"])
           for r in top_taxon(ents, search, "id", "name").collect()}
    assert out == {1: (2, 9, "m2"), 2: (None, 0, "")}
    fr = {r["q"]: (r["inat_id"], r["images"], r["common_name"], r["inat_status"])
          for r in first_result(search).collect()}
    assert fr == {"Rosa canina": (1, ["m1"], "eng", None), "Quercus": (None, [], "", "unknown")}


def test_first_word_candidate_uses_any_whitespace(spark):
    ents = spark.createDataFrame([(1, "Rosa \tcanina")], "id int, name string")
    search = spark.createDataFrame([("Rosa", 200, [_result(5, "Rosa")])], SEARCH_SCHEMA)
    r = best_match(ents, search, "id", "name").first()
    assert (r["q_used"], r["taxon"]["id"]) == ("Rosa", 5)


def test_best_match_broadcasts_no_entities(spark, tmp_path):
    """Names that repeat make a small file of many rows: answers alone may be the broadcast side."""
    (spark.range(20_000).select(F.col("id"), F.concat(F.lit("Rosa x"), (F.col("id") % 4).cast("string")).alias("name"))
     .coalesce(1).write.parquet(str(tmp_path / "e")))
    ents = spark.read.parquet(str(tmp_path / "e"))
    search = spark.createDataFrame([("Rosa", 200, [(1, "Rosa", 5, None, None, []), (2, "rosa x1 y", 5, None, None, [])])], SEARCH_SCHEMA)
    out = best_match(ents, search, "id", "name")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BuildLeft" not in plan and "Inner" not in plan
    got = {tuple(r): r["count"] for r in out.groupBy(F.col("id") % 4, "q_used", "taxon.id", "inat_status").count().collect()}
    assert got == {(k, "Rosa", 2 if k == 1 else 1, "success", 5_000): 5_000 for k in range(4)}


def test_best_match_of_repeated_and_null_ids(spark):
    """One winner per id, also where its rows have several names; a NULL id has none."""
    ents = spark.createDataFrame([(1, "b c"), (1, "a"), (1, "a"), (None, "a"), (2, None)], "id bigint, name string")
    search = spark.createDataFrame([("a", 200, [(7, "a", 5, None, None, [])]), ("b", 200, [(8, "b", 5, None, None, [])])], SEARCH_SCHEMA)
    got = sorted(tuple(r) for r in best_match(ents, search, "id", "name").select(
        F.coalesce("id", F.lit(0)), F.coalesce("name", F.lit("")), F.coalesce("q_used", F.lit("")), "inat_status").collect())
    assert got == [(0, "a", "", "taxon_not_found"), (1, "a", "a", "success"), (1, "a", "a", "success"), (1, "b c", "a", "success"),
                   (2, "", "", "invalid_name")]
