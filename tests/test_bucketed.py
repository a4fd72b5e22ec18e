"""Tables with Spark's buckets: no exchange of the stored side, batches that
replace themselves, another session, growth."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from florapipe.operators.enumeration import exclude_processed, retry_candidates
from florapipe.plans.stored_joins import listed_orders, stored_joins, stored_tables
from florapipe.sources import bucketed, store
from tests.conftest import SF_SMOKE, rows


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


@pytest.fixture()
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def ids(spark, *a):
    return spark.range(*a).select(F.col("id").alias("key"), F.concat(F.lit("v"), F.col("id")).alias("v"))


@pytest.mark.parametrize("partitions", ["4", "64"])
def test_the_stored_side_is_not_exchanged(spark, tmp_path, no_broadcast, partitions):
    path = str(tmp_path / "sink")
    bucketed.write_batch(ids(spark, 500), path, ["key"], "a", buckets=16)
    bucketed.write_batch(ids(spark, 500, 900), path, ["key"], "b")
    sink = bucketed.read(spark, path)
    other = spark.range(0, 2000, 3).withColumnRenamed("id", "key")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        for joined in (exclude_processed(other, sink, "key"), retry_candidates(other, sink, "key"),
                       store.lookup_ids(other, sink, ["key"], "v"), other.join(sink.drop("batch"), "key", "left")):
            p = plan(joined)
            assert len(re.findall(r"Exchange hashpartitioning\(\w+#\w+, 16\)", p)) == p.count("Exchange ") == 1, p
            stored = next(line for line in p.splitlines() if "FileScan parquet" in line)
            assert "Bucketed: true" in stored
        assert "Exchange" not in plan(sink.groupBy("key").count())
        assert {r["key"] for r in exclude_processed(other, sink, "key").collect()} == set(range(900, 2000, 3))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_three_stored_tables_and_one_exchange_per_key(spark, no_broadcast):
    p = plan(stored_joins(listed_orders(spark, SF_SMOKE), *stored_tables(spark, SF_SMOKE)))
    moved = re.findall(r"Exchange hashpartitioning\((\w+)#", p)
    assert sorted(moved) == ["key", "o_orderkey"]       # the listing, by its own id and by its entity
    assert p.count("Bucketed: true") == 3


def test_a_batch_written_again_replaces_itself_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    assert bucketed.read(spark, path) is None
    bucketed.write_batch(ids(spark, 100), path, ["key"], "run-1", buckets=4)
    bucketed.write_batch(ids(spark, 100, 130), path, ["key"], "run-2")
    bucketed.write_batch(ids(spark, 100, 150).select("v", "key"), path, ["key"], "run-2")
    got = bucketed.read(spark, path)
    assert rows(got.groupBy("batch").count()) == [("run-1", 100), ("run-2", 50)]
    assert rows(got.select("key", "v")) == rows(ids(spark, 150))
    bucketed.write_batch(ids(spark, 0), path, ["key"], "run-2")
    assert bucketed.read(spark, path).count() == 100


def test_a_crash_after_the_layout_leaves_an_empty_table_and_a_rerun_is_right(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    bad = ids(spark, 50).withColumn("v", F.when(F.col("key") == 7, F.raise_error(F.lit("lost"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        bucketed.write_batch(bad, path, ["key"], "a", buckets=4)
    assert bucketed.read(spark, path).count() == 0
    bucketed.write_batch(ids(spark, 50), path, ["key"], "a")
    assert bucketed.read(spark, path).count() == 50


def test_another_session_finds_layout_and_batches(spark, tmp_path, no_broadcast):
    path = str(tmp_path / "it's a table")
    odd = ids(spark, 60).withColumn("tick`ed", F.array(F.struct(F.lit(1).alias("x")))).withColumn(
        "key", F.when(F.col("key") > 2, F.col("key")))       # null keys too
    bucketed.write_batch(odd, path, ["key"], "a", buckets=4)
    want = rows(bucketed.read(spark, path))
    name = bucketed._entered(spark, path, bucketed.layout(spark, path))
    spark.sql(f"DROP TABLE {name}")                            # as in a session with a catalog of its own
    assert rows(bucketed.read(spark, path)) == want and len(want) == 60
    assert bucketed.layout(spark, path).buckets == 4
    bucketed.write_batch(odd, path, ["key"], "b", buckets=99)     # the table's own layout holds
    assert bucketed.layout(spark, path).buckets == 4


def test_rebucketing_keeps_the_rows_and_the_old_table(spark, tmp_path):
    path, wider = str(tmp_path / "t"), str(tmp_path / "wider")
    for b in range(3):
        bucketed.write_batch(ids(spark, b * 10, b * 10 + 10), path, ["key"], f"b{b}", buckets=2)
    bucketed.rebucket(spark, path, wider, 8)
    assert rows(bucketed.read(spark, wider).drop("batch")) == rows(bucketed.read(spark, path).drop("batch")) == rows(ids(spark, 30))
    assert bucketed.layout(spark, wider).buckets == 8
    with pytest.raises(ValueError, match="no table"):
        bucketed.rebucket(spark, str(tmp_path / "none"), wider, 8)


def test_what_does_not_fit_is_an_error_before_anything_is_written(spark, tmp_path):
    path = str(tmp_path / "t")
    bucketed.write_batch(ids(spark, 5), path, ["key"], "a", buckets=2)
    with pytest.raises(ValueError, match="laid out by"):
        bucketed.write_batch(ids(spark, 5), path, ["v"], "b")
    with pytest.raises(ValueError, match="columns"):
        bucketed.write_batch(ids(spark, 5).drop("v"), path, ["key"], "b")
    with pytest.raises(ValueError, match="named by"):
        bucketed.write_batch(ids(spark, 5), path, ["key"], "../b")
    with pytest.raises(ValueError, match="clash"):
        bucketed.write_batch(ids(spark, 5).withColumn("batch", F.lit(1)), path, ["key"], "b")
    assert bucketed.read(spark, path).count() == 5
