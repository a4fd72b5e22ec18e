"""J5 / J5b description chain and S12 cache."""

from florapipe.operators.responses import asked, one_response
from florapipe.operators.text import cache_new_hits, flag_text_quality, text_fallback

SUMM = "title string, http_status int, extract string"
SRCH = "srsearch string, http_status int, results array<struct<title:string>>"


def test_binomial_too_short_species_wins(spark):
    ents = spark.createDataFrame([(1, "Rosa canina L.", "Rosa")], "id int, name string, genus string")
    summ = spark.createDataFrame([("Rosa_canina", 200, "b" * 50), ("Rosa_canina_L.", 200, "s" * 51),
                                  ("Rosa", 200, "g" * 60)], SUMM)
    r = text_fallback(ents, "id", "name", summ, genus_col="genus").first()
    assert (r["description"], r["description_source"]) == ("s" * 51, "species")


def test_same_name_is_species_not_binomial(spark):
    ents = spark.createDataFrame([(1, "Rosa canina", "Rosa")], "id int, name string, genus string")
    summ = spark.createDataFrame([("Rosa_canina", 200, "x" * 80)], SUMM)
    r = text_fallback(ents, "id", "name", summ, genus_col="genus").first()
    assert r["description_source"] == "species"


def test_search_stage_transport_failure_and_cache(spark):
    ents = spark.createDataFrame([(1, "Abc def", "Abc"), (2, "Ghi jkl", "Ghi"), (3, "Mno pqr", "Mno")],
                                 "id int, name string, genus string")
    summ = spark.createDataFrame([("Abc_def", 404, None), ("Top_hit", 200, "t" * 70),
                                  ("Ghi_jkl", None, None), ("Ghi", 200, "short")], SUMM)
    srch = spark.createDataFrame([("Abc def", 200, [("Top hit",)]), ("Ghi jkl", 200, [("Top hit",)])], SRCH)
    cache = spark.createDataFrame([("Mno pqr", "cached text", "genus")], "name string, description string, source string")
    out = {r["id"]: (r["description"], r["description_source"])
           for r in text_fallback(ents, "id", "name", summ, srch, cache, genus_col="genus").collect()}
    assert out[1] == ("t" * 70, "species")                 # page 404 -> top search hit's page
    assert out[2] == ("Description not found.", "none")    # transport failure ends the candidate
    assert out[3] == ("cached text", "genus")              # a cache hit is used (restart fix)
    new_cache = {r["name"]: r["source"] for r in cache_new_hits(cache, text_fallback(
        ents, "id", "name", summ, srch, cache, genus_col="genus"), "name").collect()}
    assert new_cache == {"Mno pqr": "genus", "Abc def": "species"}


def test_short_variant(spark):
    ents = spark.createDataFrame([(1, "Rosa canina var. x"), (2, "Nothing here")], "id int, name string")
    summ = spark.createDataFrame([("Rosa_canina_var._x", 200, "   "), ("Rosa_canina", 200, "  ok  ")], SUMM)
    out = {r["id"]: r["description"] for r in text_fallback(
        ents, "id", "name", summ, candidates=(("species", "species"), ("two_tokens", "cleaned"), ("genus", "genus")),
        min_len=0, strip=True, not_found=("", "none")).collect()}
    assert out == {1: "ok", 2: ""}


def test_flag_text_quality(spark):
    df = spark.createDataFrame([("x" * 50,), ("x" * 51,), (None,)], "t string")
    assert [r["has_wiki"] for r in flag_text_quality(df, "t").collect()] == ["No", "Yes", "No"]


def test_the_newest_write_of_the_cache_wins(spark):
    ents = spark.createDataFrame([(1, "Abc def", "Abc"), (2, "Ghi jkl", "Ghi")], "id int, name string, genus string")
    cache = spark.createDataFrame([("Abc def", "z old and larger", "genus", 1), ("Abc def", "new", "species", 2)],
                                  "name string, description string, source string, landed_at int")
    summ = spark.createDataFrame([("Ghi_jkl", 200, "g" * 60)], SUMM)
    found = text_fallback(ents, "id", "name", summ, cache=cache, genus_col="genus")
    assert {r["id"]: r["description"] for r in found.collect()} == {1: "new", 2: "g" * 60}
    after = cache_new_hits(cache, found, "name")
    assert {r["name"]: (r["description"], r["landed_at"]) for r in after.collect()} == {"Abc def": ("new", 3), "Ghi jkl": ("g" * 60, 3)}
    # a second run with that cache has nothing to ask, and finds the same
    again = text_fallback(ents, "id", "name", summ.limit(0), cache=after, genus_col="genus")
    assert sorted(again.collect()) == sorted(found.collect())


def test_the_latest_answer_of_a_landing_log(spark):
    log = spark.createDataFrame([("a", 200, "old", 1), ("a", 200, "new", 2), ("a", None, None, 3), ("b", 500, None, 1), ("b", None, None, 2)],
                                "k string, http_status int, v string, landed_at int")
    assert sorted(map(tuple, one_response(asked(log, "k", "http_status", "v"), ["k"]).collect())) == [("a", 200, "new"), ("b", 500, None)]
