"""Bindings for the streaming jobs (T1-T4): landed files as a stream, run to
completion with AvailableNow; each result must equal the batch SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from florapipe.operators.enumeration import accepted_species, exclude_processed, explode_pages
from florapipe.operators.numbering import number_in_groups
from florapipe.plans.registry import query
from florapipe.plans.species_jobs import EXTRACT_SQL, enrich, landed_logs, listed_species, records_text
from florapipe.session import scratch_path
from florapipe.sources import keyed, store
from florapipe.sources.tables import table
from florapipe.streaming import jobs
from florapipe.streaming.pager import state_store, stream_page_prefix
from florapipe.streaming.progress import Watch, share_done


def events_stream(spark, d):
    schema = table(spark, d, "events").schema
    # a glob, so the folder is the stream's base path and only events files match
    return jobs.file_stream(spark, f"{d.rstrip('/')}/events[.]parquet", schema, max_files_per_trigger=1)


def landed_pages(spark, d):
    """The listing as a pager reads it: pages of 100 species per order, without gaps, and an empty one after the last;
    landed in two files that hold pages of all orders in any order.  Returns folder and schema."""
    listed = number_in_groups(listed_species(table(spark, d, "part")).drop("pos"), ["order_name"], ["key"], "place")
    result = F.struct(*[c for c in listed.columns if c not in ("order_name", "place")])
    pages = listed.groupBy("order_name", (F.floor(F.col("place") / 100) * 100).alias("offset")).agg(
        F.count(F.lit(1)).alias("count"), F.array_sort(F.collect_list(F.struct("place", result.alias("r")))).alias("_l"))
    pages = pages.select("order_name", "offset", "count", F.transform("_l", lambda x: x["r"]).alias("results"))
    ends = pages.groupBy("order_name").agg((F.max("offset") + 100).alias("offset")).select(
        "order_name", "offset", F.lit(0).cast("bigint").alias("count"), F.array().cast(pages.schema["results"].dataType).alias("results"))
    pages = pages.unionByName(ends).withColumn("http_status", F.lit(200))
    folder = scratch_path(spark, "listing_pages")
    pages.withColumn("file", F.pmod(F.xxhash64("order_name", "offset"), F.lit(2))).repartition(2, "file").write.partitionBy("file").parquet(folder)
    return folder, pages.schema


# ---- T1: listing pages land shuffled; the stop rule holds pages until those
# before them are known, and every micro-batch runs the extraction on the
# species of the pages it gives out.
@query("stream_extract", EXTRACT_SQL)
def q_stream_extract(spark, d):
    def extraction(pages):
        s = pages.sparkSession
        taxa = accepted_species(explode_pages(pages, ["order_name"], "offset", "results"))
        done = table(s, d, "labels").filter(F.col("quality") == 0)
        taxa = exclude_processed(taxa, done, "key", "doc_id").withColumn("pos", F.struct("order_name", "offset", "index"))
        return records_text(enrich(s, d, taxa, landed=landed))

    landed = landed_logs(spark, d)
    folder, schema = landed_pages(spark, d)
    sink, ckpt = scratch_path(spark, "extract_sink"), scratch_path(spark, "extract_ckpt")
    src = jobs.file_stream(spark, f"{folder}/*", schema, max_files_per_trigger=1)
    with state_store(spark):
        read = stream_page_prefix(src, "order_name", "offset", "http_status", "count", step=100)
        jobs.stream_extract(read, sink, ckpt, transform=extraction)
    return jobs.read_sink(spark, sink).drop("batch_id")


@query("stream_dedup", "SELECT DISTINCT user_id, event_type FROM events")
def q_stream_dedup(spark, d):
    sink, ckpt = scratch_path(spark, "dedup_sink"), scratch_path(spark, "dedup_ckpt")
    jobs.stream_dedup(events_stream(spark, d).select("user_id", "event_type"), ["user_id", "event_type"],
                      sink, ckpt)
    return jobs.read_sink(spark, sink).drop("batch_id")


@query("stream_upsert", """
SELECT user_id, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1
""")
def q_stream_upsert(spark, d):
    path, ckpt = scratch_path(spark, "upsert_table"), scratch_path(spark, "upsert_ckpt")
    src = events_stream(spark, d).select("user_id", "event_id", "event_type", "value", "ts")
    jobs.stream_upsert(src, path, ["user_id"], F.struct("ts", "event_id"), ckpt)
    return keyed.read_table(spark, path).select("user_id", "event_id", "event_type", "value")


@query("stream_progress", "SELECT event_type, count(*) AS n_processed FROM events GROUP BY event_type")
def q_stream_progress(spark, d):
    path, ckpt = scratch_path(spark, "progress_table"), scratch_path(spark, "progress_ckpt")
    jobs.stream_progress(events_stream(spark, d), "event_type", path, ckpt)
    return store.read_snapshot(spark, path).select("event_type", "n_processed")


# ---- T4 against what is expected: the events of value 100 or less are processed, all of a type are expected.
@query("stream_share_done", """
SELECT event_type, count(*) FILTER (WHERE value <= 100) AS n_processed, count(*) AS n_total,
       round(count(*) FILTER (WHERE value <= 100) * 100.0 / count(*), 6) AS done_pct
FROM events GROUP BY event_type
""")
def q_stream_share_done(spark, d):
    path, ckpt = scratch_path(spark, "share_table"), scratch_path(spark, "share_ckpt")
    jobs.stream_progress(events_stream(spark, d).filter(F.col("value") <= 100), "event_type", path, ckpt, Watch())
    totals = table(spark, d, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n_total"))
    return share_done(store.read_snapshot(spark, path), totals, "event_type").withColumn("done_pct", F.round("done_pct", 6))
