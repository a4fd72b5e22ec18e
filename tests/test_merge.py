"""A1 duplicate merging, J10 child rows, M5 primary image."""

from pyspark.sql import functions as F

from florapipe.operators.merge import explode_media, explode_media_rows, longest_text, merge_entities
from tests.conftest import rows


def test_merge_entities_fixture(spark):
    df = spark.createDataFrame(
        [("k", 1, " B ", "aa", "r1", ["u1", "u2"], ["w1"]),
         ("k", 2, "A", "bb", "r2", ["u2", "u3"], []),
         ("k", 3, None, "c", "r3", None, ["w1", "w2"]),
         (None, 4, "Z", "zzzz", "r4", ["x"], [])],
        "name string, pos int, common string, descr string, other string, inat array<string>, wiki array<string>")
    out = merge_entities(df, "name", "pos", name_col="common", text_col="descr", list_cols=["inat", "wiki"])
    r = out.collect()
    assert len(r) == 1
    r = r[0]
    assert r["common_names"] == ["A", "B"]
    assert r["descr"] == "aa"                       # first of the longest
    assert r["other"] == "r1" and r["common"] == " B "  # first row
    assert r["inat"] == ["u1", "u2", "u3"]
    assert r["wiki"] == ["w1", "w2"]


def test_longest_text_blank_ignored(spark):
    df = spark.createDataFrame([("g", 1, "   "), ("g", 2, "ab"), ("g", 3, "cd"), ("h", 4, " ")],
                               "g string, pos int, t string")
    assert rows(longest_text(df, ["g"], "t", "pos")) == [("g", 2, "ab")]


def test_explode_media_fixtures(spark):
    df = spark.createDataFrame([(1, ["u1", "u2"], ["u2", "u3"]), (2, [], ["w1"])],
                               "id int, inat array<string>, wiki array<string>")
    got = rows(explode_media(df, "id", "inat", "wiki"))
    assert got == [(1, "u1", "inat", True, 0), (1, "u2", "inat", False, 1), (1, "u3", "wiki", False, 2),
                   (2, "w1", "wiki", False, 0)]


def test_explode_media_rows_equals_array_form(spark):
    df = spark.createDataFrame([(1, ["a", "b", "a"], ["b", "c"]), (2, ["x"], ["x", "y"]), (3, [], [])],
                               "id int, inat array<string>, wiki array<string>")
    long = (df.select("id", F.posexplode("inat").alias("pos", "url"), F.lit("inat").alias("src"))
            .unionByName(df.select("id", F.posexplode("wiki").alias("pos", "url"), F.lit("wiki").alias("src"))))
    a = rows(explode_media(df, "id", "inat", "wiki"))
    b = rows(explode_media_rows(long, "id", "url", "src", ["pos"]))
    assert a == b
