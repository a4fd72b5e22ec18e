"""Scalar rules F1-F18, P2, P4, P5 on hand-derived cases."""

from pyspark.sql import functions as F

from florapipe.functions import expr as X


def one(spark, value, fn, dtype="string"):
    df = spark.createDataFrame([(value,)], f"v {dtype}")
    return df.select(fn(F.col("v")).alias("o")).first()["o"]


def test_extract_binomial(spark):
    cases = {"Rosa canina L.": "Rosa canina", "Rosa × alba L.": "Rosa alba", "Rosa x alba": "Rosa x",
             "rosa canina": None, None: None, "": None, "  Rosa canina": "Rosa canina"}
    for k, v in cases.items():
        assert one(spark, k, X.extract_binomial) == v, k


def test_normalize_query_name(spark):
    assert one(spark, "Rosa x alba", X.normalize_query_name) == "Rosa alba"
    assert one(spark, "Rosa canina L.", X.normalize_query_name) == "Rosa canina"


def test_is_valid_species_name(spark):
    cases = {"x": False, "Rosa x alba": False, "Rosa × alba": True, None: False, "   ": False, " X ": False,
             "Rosa canina": True}
    for k, v in cases.items():
        assert one(spark, k, X.is_valid_species_name) is v, k


def test_clean_common_name(spark):
    assert one(spark, "  rED Bird ", X.clean_common_name) == "Red bird"
    assert one(spark, None, X.clean_common_name) == ""


def test_tokens(spark):
    assert one(spark, "Rosa canina L.", X.species_epithet) == "canina"
    assert one(spark, "Rosa", X.species_epithet) == ""
    assert one(spark, "Rosa canina L.", X.genus_token) == "Rosa"
    assert one(spark, "Rosa canina var. alba", lambda c: X.first_tokens(c, 2)) == "Rosa canina"
    assert one(spark, "Rosa canina", X.page_title) == "Rosa_canina"


def test_tolerant_bigint_and_truthy(spark):
    assert one(spark, "12345.0", X.tolerant_bigint) == 12345
    assert one(spark, "12", X.tolerant_bigint) == 12
    assert one(spark, "12.9", X.tolerant_bigint) == 12
    assert one(spark, "abc", X.tolerant_bigint) is None
    assert one(spark, "TRUE", X.truthy) is True
    assert one(spark, "nan", X.truthy) is False


def test_clean_text(spark):
    assert one(spark, " NaN ", X.clean_text) is None
    assert one(spark, "  ", X.clean_text) is None
    assert one(spark, " a ", X.clean_text) == "a"
    assert one(spark, "none", X.clean_text) == "none"


def test_na_tokens(spark):
    assert one(spark, "NA", X.na_to_null) is None
    assert one(spark, "None", X.na_to_null) is None
    assert one(spark, "none", X.na_to_null) == "none"


def test_parse_json_list(spark):
    assert one(spark, None, X.parse_json_list) == []
    assert one(spark, "[bad", X.parse_json_list) == []
    assert one(spark, '["u1"]', X.parse_json_list) == ["u1"]


def test_media_url(spark):
    assert one(spark, "https://x/square/1.jpg?a=1", X.normalize_media_url) == "https://x/medium/1.jpg"
    assert one(spark, "https://x/square/1.jpg?a=1", lambda c: X.normalize_media_url(c, False)) == \
        "https://x/medium/1.jpg?a=1"


def test_photo_and_common_name_fallback(spark):
    df = spark.createDataFrame([(None, "", "s"), ("l", "m", "s")], "a string, b string, c string")
    assert [r[0] for r in df.select(X.photo_url("a", "b", "c")).collect()] == ["s", "l"]
    assert [r[0] for r in df.select(X.common_name_fallback("a", "b")).collect()] == ["", "l"]
