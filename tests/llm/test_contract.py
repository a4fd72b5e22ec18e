"""The registered queries: names, columns, and SQL where there is some."""

import duckdb
import pytest

import __spark_entry__ as E
from florapipe.llm.queries import LLM_ORACLE, LLM_QUERIES
from florapipe.sources.tables import DRIVER_TABLES

DIR = "/root/testdata/sf0.001"
COLUMNS = {1: "doc_id size text_crc32 law shard slot grown_shard", 2: "doc_id size source_size target taken", 3: "page_id url text n_chars",
           4: "doc_id keep_id group_size kept text_sha256", 5: "doc_id fingerprint component_id",
           7: "doc_id piece start length ids_crc32 sequence_id offset", 8: "doc_id held_out lang_pred score",
           9: "page_id host path rule verdict", 10: "vec_id n_links component_id kept", 11: "item_id rank doc_id score",
           12: "query_id rank vec_id score", 13: "vec_id component n deviation whitened explained identity_error"}


def test_all_registered():
    names = [n for n in E.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names if n in LLM_QUERIES) == list(range(1, 14)) and "pipeline" in E.queries()


@pytest.mark.parametrize("n", sorted(COLUMNS))
def test_columns(spark, n):
    name = next(q for q in LLM_QUERIES if q.startswith(f"op{n}_"))
    found = LLM_QUERIES[name](spark, DIR)
    assert set(COLUMNS[n].split()) <= set(found.columns) and found.count() > 0


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DIR}/{t}.parquet')")
    cur = con.execute(LLM_ORACLE[name])
    columns = [d[0] for d in cur.description]
    found = LLM_QUERIES[name](spark, DIR).select(*columns)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(cur.fetchall(), key=repr)
