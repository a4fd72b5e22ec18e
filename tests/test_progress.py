"""Figures while a stream or a load runs: observed by the job itself, equal to a count afterwards."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from florapipe.operators import audit
from florapipe.session import materialize_seen
from florapipe.sources import store
from florapipe.streaming import jobs
from florapipe.streaming.progress import ROWS, Watch, share_done
from tests.conftest import SF_SMOKE, rows


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


@pytest.fixture()
def landed(spark, tmp_path):
    ev = spark.read.parquet(f"{SF_SMOKE}/events.parquet")
    for i in range(3):
        ev.filter(F.col("event_id") % 3 == i).coalesce(1).write.parquet(str(tmp_path / "land" / f"part{i}"))
    return ev, lambda: jobs.file_stream(spark, str(tmp_path / "land") + "/*", ev.schema, max_files_per_trigger=1)


def test_a_stream_tells_its_figures_as_it_runs(spark, tmp_path, landed):
    ev, source = landed
    n, steps = ev.count(), []
    watch = Watch(n, lambda batch, sums: steps.append((batch, sums)), value=F.sum("value"))
    table, ck = str(tmp_path / "p"), str(tmp_path / "ck")
    jobs.stream_progress(source(), "event_type", table, ck, watch)
    assert [b for b, _ in steps] == [0, 1, 2] and watch.batches == 3
    assert [s[ROWS] for _, s in steps] == sorted(s[ROWS] for _, s in steps) and steps[-1][1][ROWS] == n
    assert 0 < steps[0][1]["done_pct"] < 50 and steps[-1][1]["done_pct"] == 100.0
    assert steps[-1][1]["value"] == pytest.approx(ev.agg(F.sum("value")).first()[0])
    assert rows(store.read_snapshot(spark, table).select("event_type", "n_processed")) == rows(ev.groupBy("event_type").count())

    again = Watch(n)                                     # a restart has nothing to do
    jobs.stream_progress(source(), "event_type", table, ck, again)
    assert again.batches == 0 and again.sums == {}


def test_another_stream_of_the_session_is_not_counted(spark, tmp_path, landed):
    ev, source = landed
    watch = Watch()
    with watch.listening(spark):
        watch._ended.set()
        jobs.stream_extract(source(), str(tmp_path / "s"), str(tmp_path / "ck"))
    assert watch.sums == {}


def test_share_done(spark):
    totals = spark.createDataFrame([("a", 4), ("b", 2), ("c", 0), (None, 5)], "g string, n_total bigint")
    progress = spark.createDataFrame([("a", 1), (None, 5), ("x", 3)], "g string, n_processed bigint")
    assert rows(share_done(progress, totals, "g")) == sorted(
        [("a", 1, 4, 25.0), ("b", 0, 2, 0.0), ("c", 0, 0, None), (None, 5, 5, 100.0)], key=repr)
    assert {r["done_pct"] for r in share_done(None, totals, "g").collect()} == {0.0, None}


def test_a_write_tells_its_own_figures(spark):
    told = []
    out = materialize_seen(spark.range(7), "seven", lambda step, figures: told.append((step, figures)),
                           F.count(F.lit(1)).alias("n"), F.max("id").alias("m"))
    assert told == [("seven", {"n": 7, "m": 6})] and out.count() == 7


def test_chunk_figures_with_known_firsts_move_no_keys(spark):
    df = spark.range(5000).select((F.pmod(F.xxhash64("id"), F.lit(900))).alias("key"), F.floor(F.col("id") / 400).alias("c"),
                                  (F.col("id") % 3).alias("n"))
    df = df.withColumn("key", F.when(F.col("key") > 10, F.col("key")))
    firsts = df.filter("key IS NOT NULL").groupBy("key").agg(F.min("c").alias("chunk"))
    want = rows(audit.load_metrics(df, "key", chunk_col="c", images_col="n"))
    assert rows(audit.load_metrics(df, "key", chunk_col="c", images_col="n", firsts=firsts)) == want
    stored = spark.createDataFrame(firsts.collect(), firsts.schema)
    p = plan(audit.chunk_figures(df, "key", 0, "c", "n", stored))
    assert "hashpartitioning(key" not in p
    assert "hashpartitioning(key" in plan(audit.chunk_figures(df, "key", 0, "c", "n", None))
