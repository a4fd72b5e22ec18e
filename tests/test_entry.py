"""Driver contract: entry(), queries() and oracle_sql() agree."""

import duckdb
import pytest

import __spark_entry__ as E
from florapipe.plans import ORACLE, QUERIES
from florapipe.sources.tables import DRIVER_TABLES
from tests.conftest import SF_SMOKE


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "common_names" in df.columns


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", ["merge_entities", "page_prefix", "describe", "best_match", "text_fallback",
                                  "page_media", "assemble_records", "rank_media"])
def test_matches_duckdb(spark, name):
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMOKE}/{t}.parquet')")
    df = E.queries()[name](spark, SF_SMOKE)
    cur = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)

    def norm(cols, recs):
        order = sorted(range(len(cols)), key=lambda i: cols[i])
        return sorted((tuple(round(r[i], 6) if isinstance(r[i], float) else r[i] for i in order) for r in recs),
                      key=repr)
    assert norm(df.columns, [tuple(r) for r in df.collect()]) == norm(dcols, cur.fetchall())
