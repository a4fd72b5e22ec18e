import corpus_pipeline
from florapipe.llm.language_id import Classifier, train
from florapipe.llm.mixing import mix_counts
from pyspark.sql import functions as F
from test_exact_dedup import brute
from test_simhash import expect

DIR = "/root/testdata/sf0.01"


def test_stages_one_by_one(spark, tmp_path):
    """Every stage against brute force on all that its predecessor kept."""
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, DIR).write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        assert docs.columns == columns
        kept[name] = (before.collect(), docs.collect())
    before, after = kept["language_id"]
    model = Classifier(train(spark.createDataFrame(before), F.col("text"), F.col("lang")))
    assert sorted(r["doc_id"] for r in after) == sorted(r["doc_id"] for r in before if model.decide(r["text"])[2])
    assert len(after) > 0.98 * len(before)
    before, after = kept["exact_dedup"]
    assert sorted(r["doc_id"] for r in after) == sorted(x[0] for x in brute([(r["doc_id"], r["text"]) for r in before]) if x[3])
    before, after = kept["simhash_near_dedup"]
    assert sorted(r["doc_id"] for r in after) == sorted({x[2] for x in expect([(r["doc_id"], r["text"]) for r in before])})
    before, after = kept["mix_sources"]
    copies = {r["doc_id"]: r["copies"] for r in mix_counts(spark.createDataFrame(before)).collect()}
    assert sorted(r["doc_id"] for r in after) == sorted(i for i, n in copies.items() for _ in range(n))
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, DIR)
    assert packed.filter("piece = 0").count() == len(after)


def test_run(spark):
    found = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert found.count() > 0 and found.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 2048").count() == 0


def test_stage_list():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "simhash_near_dedup", "mix_sources", "best_fit_packing"]
    assert corpus_pipeline.ORACLE_SQL is None


def documents(spark, rows):
    """Rows (doc_id, text, lang, source) as a table of documents with extra columns that the operators use themselves."""
    return spark.createDataFrame([(*r, *"abcdef") for r in rows], "doc_id bigint, text string, lang string, source string, n_chars string, digest string, "
                                                                   "size string, row string, copies string, fp string")


def test_odd_and_empty_documents(spark, tmp_path):
    """Null, empty and very long texts, repeated rows, null ids and clashing columns: every stage keeps the columns, the
    last returns whole sequences; an empty table runs through."""
    english = "the cat sat on the mat and the dog ran after it through the long green garden of the house "
    rows = [(i, f"{english} number {i} {english[i:]}", "en", "a") for i in range(12)]
    rows += [(1, rows[1][1], "en", "a"), (20, None, None, None), (21, "", "en", "b"), (22, "12 34 !!", None, "b"), (None, english * 3, "en", "b"),
             (23, english * 2_000, "en", None), (24, english * 2_000 + " end", "en", None), (25, rows[0][1] + "\n", "en", "c")]
    for name, given in (("odd", rows), ("empty", [])):
        folder = str(tmp_path / name)
        documents(spark, given).write.parquet(f"{folder}/documents.parquet")
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        for stage, f in corpus_pipeline.STAGES[:-1]:
            f(spark, docs, folder).write.parquet(f"{folder}/{stage}")
            before, docs = docs, spark.read.parquet(f"{folder}/{stage}")
            assert docs.columns == before.columns
            kept = {r["doc_id"] for r in docs.select("doc_id").collect()}
            assert kept <= {r["doc_id"] for r in before.select("doc_id").collect()}
            if stage == "language_id" and given:
                assert not kept & {20, 21, 22} and {23, 24, None} <= kept        # no letter, no language
            if stage == "exact_dedup" and given:
                assert 25 in kept and 0 not in kept and docs.filter("doc_id = 1").count() == 1
        found = corpus_pipeline.run(spark, folder)
        over = found.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 2048")
        assert over.isEmpty() and (found.count() > 0) == bool(given)
