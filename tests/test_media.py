"""M1-M4 media rules, J11 expansion, P7, P14."""

import pytest
from pyspark.sql import functions as F

from florapipe.operators import media
from tests.conftest import rows


def score(spark, url, w, h, desc, cats, name):
    df = spark.createDataFrame([(url, w, h, desc, cats, name)],
                               "u string, w int, h int, d string, c string, n string")
    return df.select(media.score_media("u", "w", "h", "d", "c", "n")).first()[0]


def test_score_goldens(spark):
    assert score(spark, "https://upload.wikimedia.org/a.jpg", 2000, 1500, "Rosa canina in bloom",
                 "Rosa canina", "Rosa canina L.") == pytest.approx(5.9)
    assert score(spark, "https://upload.wikimedia.org/b.png", 800, 600, "distribution map", "",
                 "Rosa canina") == pytest.approx(0.34)
    assert score(spark, "https://x.org/c.gif", None, None, None, None, "Rosa canina") == pytest.approx(-0.5)
    # extension is tested before the query string is removed
    assert score(spark, "https://x.org/c.jpg?x=1", 0, 0, None, None, "x") == pytest.approx(-0.5)


def test_rank_media_stable_and_deduped(spark):
    df = spark.createDataFrame([("k", "a?x=1", 2.0, 0), ("k", "b", 3.0, 1), ("k", "a?x=2", 2.0, 2),
                                ("k", "", 9.0, 3)], "k string, u string, s double, p int")
    out = media.rank_media(df, "k", "u", "s", "p", n=5)
    assert [r["url"] for r in out.orderBy("rank").collect()] == ["b", "a"]


def _obs(spark, results, status=200, curated=None):
    schema = ("id int, http_status int, curated array<string>, "
              "results array<struct<quality_grade:string,photos:array<struct<url:string>>>>")
    return spark.createDataFrame([(1, status, curated or [], results)], schema)


def test_select_media_needs_id_only(spark):
    res = [("needs_id", [(f"n{i}/square",)]) for i in range(1, 5)]
    out = media.select_media(media.tier_media(_obs(spark, res))).first()
    assert out["research_images"] == ["n1/medium", "n2/medium", "n3/medium"]
    assert out["needs_id_images"] == ["n1/medium", "n2/medium", "n3/medium"]
    assert out["inat_status"] == "success" and out["media_tier"] == "needs_id"


def test_select_media_empty_and_timeout(spark):
    out = media.select_media(media.tier_media(_obs(spark, []))).first()
    assert out["research_images"] == [] and out["inat_status"] == "no_images"
    res = [("research", [("r1",)])]
    out = media.select_media(media.tier_media(_obs(spark, res, status=None, curated=["c1"]))).first()
    assert out["research_images"] == ["c1"] and out["media_tier"] == "curated"


def test_expand_media_fixture(spark):
    rows_df = spark.createDataFrame([(1, 7, ["x", "x"]), (2, 7, ["a", "b", "c"]), (3, 0, [])],
                                    "id int, tid bigint, images array<string>")
    obs = spark.createDataFrame(
        [(7, 200, [([("y",), ("y",)],), ([("x",), ("w",)],)])],
        "taxon_id bigint, http_status int, results array<struct<photos:array<struct<url:string>>>>")
    out = {r["id"]: r["images"] for r in media.expand_media(rows_df, obs, "images", "tid").collect()}
    assert out == {1: ["x", "x", "y"], 2: ["a", "b", "c"], 3: []}


def test_needs_enrichment_and_license(spark):
    df = spark.createDataFrame([(1, 5, ["a"]), (2, 0, []), (3, None, []), (4, 9, ["a", "b", "c"])],
                               "id int, ext bigint, images array<string>")
    assert rows(media.needs_enrichment(df, "images", "ext"), "id") == [(1,)]
    lic = spark.createDataFrame([("CC0",), ("cc-by-nc",), ("CC-BY-SA",), (None,)], "l string")
    assert rows(media.filter_allowed_license(lic, "l")) == [("CC-BY-SA",), ("CC0",)]
