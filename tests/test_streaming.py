"""Streaming jobs: stream result = batch result; a restart on the same
checkpoint processes only new files; replays do not duplicate."""

import datetime
import os
import random

import pytest
from pyspark.sql import functions as F

from florapipe.operators.enumeration import page_prefix
from florapipe.sources import keyed, store
from florapipe.streaming import jobs
from florapipe.streaming.answers import stream_answers, to_retry
from florapipe.streaming.pager import state_store, stream_page_prefix
from tests.conftest import SF_SMOKE, rows


def _land(spark, folder, parts):
    ev = spark.read.parquet(f"{SF_SMOKE}/events.parquet")
    for i in parts:
        ev.filter(F.col("event_id") % 3 == i).coalesce(1).write.mode("overwrite").parquet(
            os.path.join(folder, f"part{i}"))
    return ev


def test_dedup_restart_and_upsert(spark, tmp_path):
    land = str(tmp_path / "land")
    ev = _land(spark, land, [0, 1])
    schema = ev.schema
    src = lambda: jobs.file_stream(spark, land + "/*", schema, max_files_per_trigger=1)
    sink, ck = str(tmp_path / "sink"), str(tmp_path / "ck")
    jobs.stream_dedup(src().select("user_id", "event_type"), ["user_id", "event_type"], sink, ck)
    first = jobs.read_sink(spark, sink).count()
    jobs.stream_dedup(src().select("user_id", "event_type"), ["user_id", "event_type"], sink, ck)
    assert jobs.read_sink(spark, sink).count() == first           # nothing new landed
    _land(spark, land, [2])
    jobs.stream_dedup(src().select("user_id", "event_type"), ["user_id", "event_type"], sink, ck)
    got = rows(jobs.read_sink(spark, sink).drop("batch_id"))
    assert got == rows(ev.select("user_id", "event_type").distinct())

    table, ck2 = str(tmp_path / "table"), str(tmp_path / "ck2")
    jobs.stream_upsert(src().select("user_id", "event_id", "ts"), table, ["user_id"], F.struct("ts", "event_id"), ck2)
    latest = ev.groupBy("user_id").agg(F.max_by("event_id", F.struct("ts", "event_id")).alias("event_id"))
    assert rows(keyed.read_table(spark, table).select("user_id", "event_id")) == rows(latest)


def test_dedup_state_expires_with_the_watermark(spark, tmp_path):
    land = str(tmp_path / "land")
    ev = _land(spark, land, [0, 1, 2])
    src = jobs.file_stream(spark, land + "/*", ev.schema, max_files_per_trigger=1)
    sink, ck = str(tmp_path / "sink"), str(tmp_path / "ck")
    jobs.stream_dedup(src.select("user_id", "event_type", "ts"), ["user_id", "event_type"], sink, ck, "ts", "10000 days")
    got = rows(jobs.read_sink(spark, sink).drop("batch_id"))
    assert got == rows(ev.select("user_id", "event_type").distinct())


def test_progress_matches_batch(spark, tmp_path):
    land = str(tmp_path / "land")
    ev = _land(spark, land, [0, 1, 2])
    src = jobs.file_stream(spark, land + "/*", ev.schema, max_files_per_trigger=1)
    table, ck = str(tmp_path / "p"), str(tmp_path / "ck")
    jobs.stream_progress(src, "event_type", table, ck)
    got = rows(store.read_snapshot(spark, table).select("event_type", "n_processed"))
    assert got == rows(ev.groupBy("event_type").count())


def test_extract_replay_is_idempotent(spark, tmp_path):
    land = str(tmp_path / "land")
    ev = _land(spark, land, [0, 1, 2])
    sink, ck = str(tmp_path / "s"), str(tmp_path / "ck")
    jobs.stream_extract(jobs.file_stream(spark, land + "/*", ev.schema, max_files_per_trigger=1), sink, ck)
    out = jobs.read_sink(spark, sink)
    assert out.select("batch_id").distinct().count() == 3
    assert out.count() == ev.count()


@pytest.fixture()
def maps_in_state(spark):
    with state_store(spark):
        yield spark


def _pages():
    """Listing pages of some orders: one read to its end, one cut by an error, one by an empty page, one with a failed
    request, one that stops at once, one whose failed page is answered later."""
    page = lambda o, i, st=200, n=2: (o, 100 * i, st, n, [(i, f"{o}{i}"), (i + 1, None)] if n else [])
    out = [page("whole", i) for i in range(6)] + [page("error", i, 500 if i == 3 else 200) for i in range(7)]
    out += [page("empty", i, 200, 0 if i in (2, 4) else 2) for i in range(6)] + [page("failed", i, None if i == 1 else 200) for i in range(4)]
    out += [page("none", 0, 404)] + [page("none", i) for i in range(1, 3)]
    return out


PAGE_SCHEMA = "order_name string, offset bigint, http_status int, count int, results array<struct<key: bigint, name: string>>"


@pytest.mark.parametrize("seed", [1, 2])
def test_stop_rule_over_shuffled_pages(maps_in_state, tmp_path, seed):
    """Pages landed in three shuffled files, the third after a restart, are those of the batch rule."""
    spark = maps_in_state
    pages = _pages()
    random.Random(seed).shuffle(pages)
    land, sink, ck = (str(tmp_path / n) for n in ("land", "sink", "ck"))
    schema = spark.createDataFrame(pages, PAGE_SCHEMA).schema

    def run():
        src = jobs.file_stream(spark, land + "/*", schema, max_files_per_trigger=1)
        jobs.stream_extract(stream_page_prefix(src, "order_name", "offset", "http_status", "count", step=100), sink, ck)

    given = []
    for i in range(3):
        spark.createDataFrame(pages[i::3] + pages[i::3][:3], schema).coalesce(1).write.parquet(f"{land}/{i}")
        if i:
            run()
            given.append(jobs.read_sink(spark, sink).count())
    want = page_prefix(spark.createDataFrame(pages, schema), "order_name", "offset", "http_status", "count")
    assert rows(jobs.read_sink(spark, sink).drop("batch_id").select(*want.columns)) == rows(want)
    assert given[0] < given[1]


def test_batches_of_a_stateful_stream_are_transformed_with_adaptive_execution(maps_in_state, tmp_path):
    """A stateful stream plans without it; the transform reads the rows in the stream's own session."""
    spark = maps_in_state
    land, sink, ck = (str(tmp_path / n) for n in ("land", "sink", "ck"))
    spark.createDataFrame(_pages(), PAGE_SCHEMA).coalesce(1).write.parquet(land)
    src = jobs.file_stream(spark, land, spark.createDataFrame(_pages(), PAGE_SCHEMA).schema)
    seen = []

    def transform(df):
        seen.append(df.sparkSession.conf.get("spark.sql.adaptive.enabled"))
        return df.join(df.groupBy("order_name").agg({"offset": "max"}), "order_name")
    jobs.stream_extract(stream_page_prefix(src, "order_name", "offset", "http_status", "count", step=100), sink, ck, transform)
    assert seen and set(seen) == {"true"}
    want = page_prefix(spark.createDataFrame(_pages(), PAGE_SCHEMA), "order_name", "offset", "http_status", "count")
    assert rows(jobs.read_sink(spark, sink).select("order_name", "offset")) == rows(want.select("order_name", "offset"))


def test_a_failed_page_that_is_answered_before_its_turn(maps_in_state, tmp_path):
    spark = maps_in_state
    land, sink, ck = (str(tmp_path / n) for n in ("land", "sink", "ck"))
    files = [[("o", 100, None, None, None), ("o", 200, 200, 1, [(2, "c")])], [("o", 100, 200, 1, [(1, "b")])], [("o", 0, 200, 1, [(0, "a")])]]
    for i, f in enumerate(files):
        spark.createDataFrame(f, PAGE_SCHEMA).coalesce(1).write.parquet(f"{land}/{i}")
    src = jobs.file_stream(spark, land + "/*", spark.createDataFrame(files[0], PAGE_SCHEMA).schema, max_files_per_trigger=1)
    jobs.stream_extract(stream_page_prefix(src, "order_name", "offset", "http_status", "count", step=100), sink, ck)
    assert rows(jobs.read_sink(spark, sink), "offset") == [(0,), (100,), (200,)]


def test_the_pager_asks_for_its_state_store(spark):
    with pytest.raises(RuntimeError, match="providerClass"):
        stream_page_prefix(spark.createDataFrame(_pages(), PAGE_SCHEMA), "order_name", "offset", "http_status", "count", step=100)


def test_answers_that_land_late(spark, tmp_path):
    """An answer two batches later, after a restart, is in the records; one beyond the delay, a failed one and none at all
    are in the retry table with their reasons."""
    land = {n: str(tmp_path / n) for n in ("asked", "landed", "sink", "retry", "ck")}
    at = lambda t: datetime.datetime.fromisoformat(f"2024-05-01T{t}:00")
    asked = [[(k, at("12:00")) for k in range(1, 6)] + [(9, at("12:00"))], [(6, at("12:10"))], [(7, at("14:00"))], [(8, at("17:00"))]]
    landed = [[(1, at("12:01"), 200, "a"), (9, at("12:02"), 500, None)], [(2, at("12:05"), 200, "b")],
              [(3, at("12:30"), 200, "c"), (4, at("13:30"), 200, "too late"), (9, at("12:40"), 200, "again")], [(8, at("17:01"), 200, "d")]]
    schemas = "k bigint, asked_at timestamp", "k bigint, landed_at timestamp, http_status int, v string"

    def run():
        q, a = (jobs.file_stream(spark, f"{land[n]}/*", spark.createDataFrame([], s).schema, max_files_per_trigger=1)
                for n, s in zip(("asked", "landed"), schemas))
        stream_answers(q, a, ["k"], land["sink"], land["retry"], land["ck"], delay="1 hour")

    for i in range(4):
        for n, rows_, s in (("asked", asked[i], schemas[0]), ("landed", landed[i], schemas[1])):
            spark.createDataFrame(rows_, s).coalesce(1).write.parquet(f"{land[n]}/{i}")
        if i in (1, 3):
            run()
    assert rows(jobs.read_sink(spark, land["sink"]).select("k", "v")) == [(1, "a"), (2, "b"), (3, "c"), (8, "d"), (9, "again")]
    said = rows(jobs.read_sink(spark, land["retry"]).select("k", "reason"))
    assert said == [(4, "no_answer"), (5, "no_answer"), (6, "no_answer"), (7, "no_answer"), (9, "status_500")]
    assert rows(to_retry(spark, land["retry"], land["sink"], ["k"]), "k") == [(4,), (5,), (6,), (7,)]
