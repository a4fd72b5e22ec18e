"""Plan checks: the registered jobs stay inside the JVM (no Python UDF
nodes), per-group limits are planned as partial WindowGroupLimit, filters and
column pruning reach the Parquet scan."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from florapipe.plans import QUERIES
from florapipe.operators.enumeration import accepted_species
from tests.conftest import SF_SMOKE

EAGER = {"stream_extract", "stream_dedup", "stream_upsert", "stream_progress", "species_csv_roundtrip",
         "upsert", "lookup_ids", "extract_species", "load_species", "load_images", "load_report", "audit_species",
         "sample_dataset"}


def plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_python_udf(spark, name):
    p = plan(E.queries()[name](spark, SF_SMOKE))
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF"):
        assert node not in p, f"{name} uses {node}"


@pytest.mark.parametrize("name", ["rank_media", "first_acceptable", "order_probe_report", "expand_media"])
def test_window_group_limit(spark, name):
    assert "WindowGroupLimit" in plan(E.queries()[name](spark, SF_SMOKE))


def test_filters_pushed_to_scan(spark, tmp_path):
    p = str(tmp_path / "taxa")
    spark.createDataFrame([(1, "SPECIES", "ACCEPTED", "o1"), (2, "GENUS", "ACCEPTED", "o1")],
                          "key bigint, rank string, status string, order_key string").write.parquet(p)
    out = plan(accepted_species(spark.read.parquet(p), ["o1"]))
    assert "PushedFilters" in out and "EqualTo(rank,SPECIES)" in out and "EqualTo(status,ACCEPTED)" in out


def test_column_pruning(spark):
    out = plan(E.queries()["clean_urls"](spark, SF_SMOKE))
    assert "ReadSchema: struct<page_id:bigint,url:string>" in out


def test_merge_has_no_collect_of_whole_groups(spark):
    # the list merge first reduces (key, item) pairs: a hash aggregate keyed by both
    p = plan(E.queries()["merge_entities"](spark, SF_SMOKE))
    assert "collect_list" in p and "min(struct" in p.replace("min(named_struct", "min(struct")


def test_assembly_exchanges_entities_once(spark):
    # with size-based broadcasts off, the taxa side is hash-partitioned on the
    # entity key once and every enrichment join reuses that partitioning
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            E.queries()["assemble_records"](spark, SF_SMOKE).explain()
        p = buf.getvalue()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert p.count("SortMergeJoin") == 3        # two enrichments, and the nation names
    assert len(re.findall(r"Exchange hashpartitioning\(key#", p)) == 1


def _plan_with_text(spark, name):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        QUERIES[name](spark, SF_SMOKE).explain()
    return buf.getvalue()


def test_page_media_scores_once(spark):
    # the scored images are ranked and counted in one pass: their join is in the plan once
    p = _plan_with_text(spark, "page_media")
    assert len(re.findall(r"Generate posexplode", p)) == 1
    assert "html" not in p                       # taken apart once, in the landing


def test_merge_scans_its_input_twice_at_most(spark):
    p = _plan_with_text(spark, "merge_entities")
    assert len(re.findall(r"FileScan parquet", p)) <= 2


def test_names_are_standardised_without_a_shuffle(spark):
    assert "Exchange" not in _plan_with_text(spark, "standardize_names")


def test_one_json_parse_per_document(spark):
    p = _plan_with_text(spark, "enforce_schema")
    assert "from_json" not in p


def test_describe_has_one_path_without_nested_loops(spark):
    p = _plan_with_text(spark, "describe")
    assert "NestedLoop" not in p and "Cartesian" not in p
