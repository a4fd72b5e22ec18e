import re
import zlib

import zstandard

from florapipe.llm.language_id import BLOCK_BYTES, LEVEL, Classifier, identify_language, keep_identified, letters, train
from pyspark.sql import functions as F


def test_held_out_accuracy_and_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    learn = docs.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2)
    dictionaries = train(learn, F.col("text"), F.col("lang"))
    found = {r["doc_id"]: r for r in identify_language(docs, dictionaries).collect()}
    model = Classifier(dictionaries)
    right = total = 0
    for r in docs.collect():
        f = found[r["doc_id"]]
        if r["doc_id"] % 20 == 0:
            assert (f["lang_pred"], f["score"], f["accepted"]) == model.decide(r["text"])
        assert 0.0 <= f["score"] <= 1.0
        if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2:
            right, total = right + (f["lang_pred"] == r["lang"]), total + 1
    assert right / total > 0.95


def test_odd_rows(spark, odd, empty):
    dictionaries = train(odd, F.col("text"), F.col("lang"))
    found = sorted((r["doc_id"] or -1, r["lang_pred"], r["accepted"]) for r in identify_language(odd, dictionaries).collect())
    assert len(found) == odd.count()
    und = {i for i, lang, _ in found if lang == "und"}
    assert und == {3, 4, 5, 8}
    kept = keep_identified(odd, dictionaries)
    assert kept.columns == odd.columns and not und & {r["doc_id"] for r in kept.collect()}
    assert identify_language(empty, dictionaries).count() == 0
    nothing = train(empty, F.col("text"), F.col("lang"))
    assert nothing == {} and {r["lang_pred"] for r in identify_language(odd, nothing).collect()} == {"und"}


def test_narrow_margins_are_rejected():
    model = Classifier({"aa": b"lorem ipsum dolor sit amet " * 20, "bb": b"lorem ipsum dolor sit amet " * 20})
    lang, score, accepted = model.decide("lorem ipsum dolor")
    assert (lang, score, accepted) == ("aa", 0.5, False)
    assert Classifier({"aa": b"abc"}).decide("é")[:1] == ("aa",)


def test_equal_texts_weigh_once(spark):
    df = spark.createDataFrame([(i, "the same text again" if i < 300 else f"text number {i}", "en") for i in range(330)],
                               "doc_id bigint, text string, lang string")
    assert train(df, F.col("text"), F.col("lang"))["en"].count(b"the same") <= 1
    assert letters("AÉ 1,b") == "aé b".encode()


def test_against_a_compressor_loop_of_its_own(spark):
    """Every document's language from sizes taken here, with zstandard's raw dictionaries and nothing of the operator but
    its settings."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    dictionaries = train(docs, F.col("text"), F.col("lang"))
    compressors = {lang: zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
                                                  write_content_size=False, write_checksum=False, write_dict_id=False) for lang, d in dictionaries.items()}
    found = {r["doc_id"]: r["lang_pred"] for r in identify_language(docs, dictionaries).collect()}
    same = total = 0
    for r in docs.filter("text is not null").collect():
        plain = re.sub(r"[\W\d_]+", " ", r["text"].lower()).encode()
        if not plain.strip():
            continue
        sizes = {lang: sum(len(c.compress(plain[i:i + BLOCK_BYTES])) for i in range(0, len(plain), BLOCK_BYTES)) for lang, c in compressors.items()}
        total += 1
        same += found[r["doc_id"]] == min(sorted(sizes), key=sizes.get)
    assert total > 900 and same == total
