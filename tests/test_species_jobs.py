"""End-to-end jobs: each checked against its SQL on the smallest tables, plus
what SQL cannot see: a second load, the order of rows, the outcome labels."""

import json

import duckdb
import pytest
from pyspark.sql import functions as F

from florapipe.plans import ORACLE
from florapipe.plans import species_jobs as J
from florapipe.sources import store
from florapipe.sources.tables import DRIVER_TABLES
from tests.conftest import SF_SMOKE, rows

STATUSES = {"success", "no_images", "no_research_images", "max_retries_exhausted"}


@pytest.fixture(scope="module")
def full_records(spark):
    return J.extract_species(spark, SF_SMOKE).cache()


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMOKE}/{t}.parquet')")

    def run(name):
        cur = con.execute(ORACLE[name])
        return [d[0] for d in cur.description], sorted(cur.fetchall(), key=repr)
    return run


def test_extraction_matches_sql(full_records, sql):
    columns, want = sql("extract_species")
    assert rows(J.records_text(full_records).select(*columns)) == want


def test_one_record_per_new_accepted_species(full_records):
    expected = duckdb.sql(f"""
        SELECT count(*) FROM read_parquet('{SF_SMOKE}/part.parquet') WHERE p_size <= 45 AND p_type <> 'PROMO'
        AND p_partkey NOT IN (SELECT doc_id FROM read_parquet('{SF_SMOKE}/labels.parquet') WHERE quality = 0)
    """).fetchall()[0][0]
    assert full_records.count() == expected
    assert full_records.select("gbif_id").distinct().count() == expected


def test_record_invariants(full_records):
    for r in full_records.collect():
        assert r["inat_status"] in STATUSES
        assert (r["inat_id"] is None) == (r["inat_status"] == "max_retries_exhausted")
        assert r["has_images"] == (len(r["inat_research_images"]) > 0 or len(r["wiki_images"]) > 0)
        assert len(r["inat_research_images"]) <= 3 and len(r["wiki_images"]) <= 5
        assert r["description_source"] in {"binomial", "species", "genus", "none", "cache"}
        assert len(r["wikipedia_description"]) > 50 or r["description_source"] == "none"


def test_limit_is_opt_in(spark, full_records):
    per = J.extract_species(spark, SF_SMOKE, limit=2).groupBy("order").count().collect()
    assert per and all(r["count"] <= 2 for r in per)
    assert max(r["count"] for r in full_records.groupBy("order").count().collect()) > 2


def test_second_load_changes_nothing(spark, full_records, tmp_path, sql):
    paths = str(tmp_path / "parent"), str(tmp_path / "child")
    told = {}
    first = J.load_species(spark, full_records, *paths, report=told.__setitem__)
    parent, child = rows(first["parent"]), rows(first["child"])
    last = first["metrics"].orderBy(F.desc("chunk")).first()          # what the writes told is what the report says afterwards
    assert told["load_rows"] == {"n_rows": last["rows_loaded"], "n_images": last["images_loaded"]}
    assert told["load_merged"]["n_rows"] == last["keys_loaded"] == len(parent) + told["load_merged"]["n_invalid"]
    assert told["load_images"] == {"n_rows": len(child)}
    again = J.load_species(spark, full_records, *paths)
    assert rows(again["parent"]) == parent and rows(again["child"]) == child
    assert len(parent) == full_records.select("scientific_name").distinct().count()
    per = again["child"].groupBy("species_id").agg(F.count("*").alias("n"), F.max("image_order").alias("mx"), F.count_if("is_primary").alias("p"))
    assert per.filter((F.col("mx") != F.col("n") - 1) | (F.col("p") > 1)).count() == 0
    assert again["child"].join(again["parent"].select(F.col("id").alias("species_id")), "species_id", "left_anti").count() == 0
    columns, want = sql("load_species")
    got = again["parent"].drop("id").withColumn("common_names", F.array_join("common_names", "|"))
    assert rows(got.select(*columns)) == want


def test_conflicts_overwrite_parents_and_keep_children(spark, sql):
    columns, want = sql("load_images")
    assert rows(J.q_load_images(spark, SF_SMOKE).select(*columns)) == want


def test_first_row_is_the_first_in_the_listing(spark, full_records, tmp_path):
    r = full_records.limit(1).collect()[0].asDict()
    schema = full_records.schema
    place = lambda i: type(full_records.first()["pos"])(*["A", 0, i])
    two = [{**r, "scientific_name": n, "pos": place(i), "gbif_id": i, "inat_research_images": [f"u{i}"], "wiki_images": []}
           for i, n in ((1, " Rosa canina "), (0, "Rosa canina"))]
    df = spark.createDataFrame([[x[f.name] for f in schema] for x in two], schema).repartition(2)
    out = J.load_species(spark, df, str(tmp_path / "p"), str(tmp_path / "c"))
    assert [(x["scientific_name"], x["gbif_id"], x["primary_image_url"]) for x in out["parent"].collect()] == [("Rosa canina", 0, "u0")]
    assert [(x["image_url"], x["image_order"], x["is_primary"]) for x in out["child"].orderBy("image_order").collect()] == [
        ("u0", 0, True), ("u1", 1, False)]


def test_loading_nothing(spark, full_records, tmp_path):
    out = J.load_species(spark, full_records.limit(0), str(tmp_path / "p"), str(tmp_path / "c"))
    assert out["parent"].count() == out["child"].count() == out["metrics"].count() == 0
    assert sorted(r["n_rows"] for r in out["counts"].collect()) == [0, 0]
    bare = full_records.withColumn("wiki_images", F.array().cast("array<string>")).withColumn(
        "inat_research_images", F.array().cast("array<string>"))
    out = J.load_species(spark, bare, str(tmp_path / "p"), str(tmp_path / "c"))
    assert out["parent"].count() > 0 and out["child"].count() == 0


def test_audit_and_sample(spark, full_records, sql):
    columns, want = sql("audit_species")
    got = J.audit_species(full_records).withColumn("image_coverage_pct", F.round("image_coverage_pct", 6))
    assert rows(got.select(*columns)) == [tuple(float(x) if isinstance(x, float) else x for x in w) for w in want]
    assert J.audit_species(full_records.limit(0)).first()["n_rows"] == 0
    s = J.sample_dataset(spark, SF_SMOKE)
    per = s.groupBy("order").count().collect()
    assert per and all(r["count"] <= 10 for r in per)
    for r in s.collect():
        assert r["has_wiki"] == ("Yes" if r["description_length"] > 50 else "No")
        assert r["color_primary"] == "" and r["native_region"] == ""


def test_csv_shape(full_records):
    out = J.records_text(full_records).first()
    assert isinstance(json.loads(out["inat_research_images"]), list)


@pytest.fixture(scope="module")
def few_rows(spark, tmp_path_factory):
    """Tables whose files are so small that Spark would broadcast any of them."""
    d = str(tmp_path_factory.mktemp("few"))
    n = spark.range(300)
    i, t = F.col("id"), lambda name: f"{d}/{name}.parquet"
    n.select(i.alias("p_partkey"), F.concat(F.lit("red ring"), i % 40).alias("p_name"), F.lit("Brand#2").alias("p_brand"),
             F.lit("SMALL").alias("p_type"), (i % 50).cast("int").alias("p_size"), F.lit(1.0).alias("p_retailprice")).write.parquet(t("part"))
    n.select(i.alias("doc_id"), F.repeat(F.lit("a word "), (i % 20).cast("int")).alias("text"), F.lit("en").alias("lang"),
             F.lit("web").alias("source"), i.alias("n_chars")).write.parquet(t("documents"))
    n.select(i.alias("doc_id"), (i % 2).cast("int").alias("quality"), (i % 3 == 0).cast("int").alias("toxic")).write.parquet(t("labels"))
    n.select(i.alias("page_id"), F.lit("u").alias("url"), F.format_string('<a href="/x%s">x</a>', i).alias("html")).write.parquet(t("pages"))
    return d


def files_broadcast(df):
    """The broadcasts of a plan that are chosen by the size of a file: nothing is gathered or dealt out below them."""
    found = []

    def gathers(node):
        name, children = node.nodeName(), node.children()
        kids = [node.initialPlan()] if name.startswith("AdaptiveSparkPlan") else [children.apply(i) for i in range(children.size())]
        below = any([gathers(k) for k in kids])
        if name == "BroadcastExchange" and not below:
            found.append(node.toString())
        return below or name == "Exchange" or "Aggregate" in name
    gathers(df._jdf.queryExecution().executedPlan())
    return found


def test_landed_tables_are_not_broadcast_by_their_files(spark, few_rows):
    """A file says little of its rows' size: 7.2 million parts are 40 MB as a file and fill a driver's heap."""
    page_images, searches, _ = J.landed_page_images(spark, few_rows)
    tables = {"name matches": J.landed_name_matches(spark, few_rows, True), "page images": page_images, "searches": searches,
              "observations": J.landed_observations(spark, few_rows), "species": J.species_to_extract(spark, few_rows),
              "cache": J.text_landing(spark, few_rows, canonical=True)[3]}
    for name, df in tables.items():
        assert files_broadcast(df) == [], name
    assert tables["name matches"].filter("landed_at = 2").count() == 40 and tables["observations"].count() == 15
    assert searches.filter("landed_at = 2").count() == 40 and tables["species"].count() == 46 * 3


def test_the_extraction_reads_its_landing_logs_as_tables(spark, few_rows):
    """A plan that makes each log wherever it is looked up grows to thousands of nodes, which the driver holds."""
    out = J.extract_species(spark, few_rows)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "p_partkey" not in plan and plan.count("\n") < 1_000
    assert out.count() == 46 * 3


def test_stored_keys_are_not_broadcast_by_their_files(spark, tmp_path):
    spark.range(300).selectExpr("id AS k", "-id AS id").write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    batch = spark.range(200, 400).withColumnRenamed("id", "k")
    found = store.lookup_ids(batch, stored, ["k"])
    new = store.insert_new(stored, batch.withColumn("id", F.lit(0)), ["k"], ["id"])
    assert files_broadcast(found) == [] and files_broadcast(new) == []
    assert found.count() == 100 and new.count() == 100


def test_texts_that_repeat_are_not_broadcast(spark, tmp_path):
    """A text of many species is written once in a file, which tells Spark little of its rows' size."""
    taxa = spark.range(5_000).select(F.col("id").alias("key"), F.lit("o").alias("order"))
    text = F.repeat(F.lit("text "), 100).alias("description")
    spark.range(4_000).select(F.col("id").alias("key"), text, F.lit("species").alias("description_source")).write.parquet(str(tmp_path / "t"))
    out = J.assemble_records(taxa, "key", {"text": spark.read.parquet(str(tmp_path / "t"))})
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert out.count() == 5_000 and out.filter(F.length("wikipedia_description") > 400).count() == 4_000
