"""Incremental jobs on Structured Streaming.

Landed files are a file stream read with an explicit schema; every job runs
with ``Trigger.AvailableNow`` (process what has landed, then stop) and a
checkpoint location under the shared checkpoint folder, so a restart picks up
exactly the files not yet committed.  Sinks are written in ``foreachBatch``
and are idempotent per ``batch_id``: a replayed batch overwrites its own
output instead of appending twice.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence
from contextlib import nullcontext

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from florapipe.session import materialize
from florapipe.sources import keyed, store
from florapipe.streaming.progress import Watch


def file_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """A stream over landed files (a folder or a glob)."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def run_available_now(stream: DataFrame, on_batch: Callable[[DataFrame, int], None], checkpoint: str,
                      output_mode: str = "append", name: str | None = None) -> None:
    """Run ``on_batch`` over everything landed so far, then return."""
    w = (stream.writeStream.foreachBatch(on_batch).outputMode(output_mode)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True))
    if name:
        w = w.queryName(name)
    q = w.start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def _batch_dir(sink: str, batch_id: int) -> str:
    return os.path.join(sink, f"batch_id={batch_id}")


def stream_extract(stream: DataFrame, sink: str, checkpoint: str,
                   transform: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Each micro-batch -> ``transform`` -> its own ``batch_id=N`` folder
    (overwrite, so a replay after a failure does not duplicate rows).

    The rows of a micro-batch are written once and ``transform`` reads them in
    the session of ``stream``: a stateful stream plans its batches without
    adaptive execution, which the joins of a long plan need for their sizes and
    hot keys, and what it computed is not computed again by every reader."""
    def on_batch(df: DataFrame, batch_id: int) -> None:
        out = df if transform is None else transform(materialize(df, "micro_batch", stream.sparkSession))
        out.write.mode("overwrite").parquet(_batch_dir(sink, batch_id))
    run_available_now(stream, on_batch, checkpoint)


def stream_dedup(stream: DataFrame, keys: Sequence[str], sink: str, checkpoint: str,
                 event_time: str | None = None, delay: str | None = None) -> None:
    """Each key is emitted once across batches and restarts.

    Without ``event_time`` the checkpointed state store keeps every key -- the
    processed-id set, which is what has to be remembered.  With ``event_time``
    and ``delay`` a key is remembered until the watermark has passed it, so
    the state is bounded by the keys of that span; a repetition later than
    that is new again."""
    def on_batch(df: DataFrame, batch_id: int) -> None:
        df.select(*kept).write.mode("overwrite").parquet(_batch_dir(sink, batch_id))
    kept = [c for c in stream.columns if c != event_time or c in keys]
    once = (stream.withColumn(event_time, F.col(event_time).cast("timestamp")).withWatermark(event_time, delay)
            .dropDuplicatesWithinWatermark(list(keys)) if event_time and delay else stream.dropDuplicates(list(keys)))
    run_available_now(once, on_batch, checkpoint)


def stream_upsert(stream: DataFrame, table_path: str, keys: Sequence[str], seq: str | Column,
                  checkpoint: str, id_col: str = "id", seq_col: str = "_seq") -> None:
    """Each micro-batch is upserted (S7) into the keyed table, of which only
    the buckets of its keys are rewritten.  The table keeps ``seq`` (as ``seq_col``) so a row only replaces an older
    one: the result does not depend on which file lands first, and
    re-applying a batch gives the same rows (idempotent)."""
    s = F.col(seq) if isinstance(seq, str) else seq

    def on_batch(df: DataFrame, batch_id: int) -> None:
        keyed.upsert_into(df.sparkSession, table_path, df.withColumn(seq_col, s), keys, seq_col, id_col=id_col,
                          keep_seq=True)
    run_available_now(stream, on_batch, checkpoint)


def stream_progress(stream: DataFrame, group: str, table_path: str, checkpoint: str, watch: Watch | None = None) -> None:
    """T4: running per-group totals.  A streaming ``groupBy.count`` in update
    mode emits only the groups a batch changed; they are upserted into the
    progress table, so it always holds the latest total per group
    (:func:`florapipe.streaming.progress.share_done` sets them against what is
    expected).  ``watch`` is told the figures of this run as it runs."""
    read = watch.on(stream) if watch else stream
    counts = read.groupBy(group).agg(F.count(F.lit(1)).alias("n_processed"))

    def on_batch(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        current = store.read_snapshot(spark, table_path)
        upd = df.withColumn("_seq", F.lit(batch_id))
        nxt = store.upsert(current, upd, [group], "_seq", id_col="id")
        store.write_snapshot(nxt, table_path)
        store.expire_versions(spark, table_path)
    with watch.listening(stream.sparkSession) if watch else nullcontext():
        run_available_now(counts, on_batch, checkpoint, output_mode="update")


def read_sink(spark: SparkSession, sink: str) -> DataFrame:
    """All batch folders of a per-batch sink (``batch_id`` is a partition column)."""
    return spark.read.parquet(sink)
