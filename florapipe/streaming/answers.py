"""Answers that land late (T1, J8, A16): requests and their responses as two streams.

A response may land many micro-batches after its request.  The two streams are
joined by key within a delay, with watermarks, so an open request is kept in
the state until it is answered or the delay has passed.  What was not answered
goes to a retry table with the reason, for a later run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from florapipe.sources.store import exists
from florapipe.streaming.jobs import _batch_dir, run_available_now

NO_ANSWER = "no_answer"


def stream_answers(requests: DataFrame, responses: DataFrame, keys: Sequence[str], sink: str, retry: str, checkpoint: str,
                   delay: str = "1 hour", asked_at: str = "asked_at", landed_at: str = "landed_at", status: str = "http_status") -> None:
    """Every request whose 200 response landed within ``delay`` of it goes to ``sink`` with the response's columns, however
    many micro-batches lie between; the others to ``retry``: the request and ``reason``, ``no_answer`` once the watermark
    has passed the delay, or ``status_<code>`` for another status (``failed`` for none).

    The state holds the requests and responses of about two delays.  A replayed batch overwrites its own folders."""
    asked = requests.withWatermark(asked_at, delay)
    theirs = [c for c in responses.columns if c not in keys]
    landed = responses.select(*[F.col(k).alias(f"_{k}") for k in keys], *theirs, F.lit(True).alias("_landed")).withWatermark(landed_at, delay)
    same = (F.col(landed_at) >= F.col(asked_at)) & (F.col(landed_at) <= F.col(asked_at) + F.expr(f"interval {delay}"))
    for k in keys:
        same = same & (F.col(k) == F.col(f"_{k}"))
    joined = asked.join(landed, same, "leftOuter").drop(*[f"_{k}" for k in keys])
    ok = F.coalesce(F.col(status) == 200, F.lit(False))
    reason = (F.when(F.col("_landed").isNull(), NO_ANSWER).when(F.col(status).isNull(), "failed")
              .otherwise(F.concat(F.lit("status_"), F.col(status).cast("string"))))

    def on_batch(df: DataFrame, batch_id: int) -> None:
        df = df.persist()
        df.filter(ok).drop("_landed").write.mode("overwrite").parquet(_batch_dir(sink, batch_id))
        df.filter(~ok).select(*requests.columns, reason.alias("reason")).write.mode("overwrite").parquet(_batch_dir(retry, batch_id))
        df.unpersist()
    run_available_now(joined, on_batch, checkpoint)


def to_retry(spark: SparkSession, retry: str, sink: str, keys: Sequence[str]) -> DataFrame:
    """The requests still to be asked again: those in the retry table that no later answer has settled, each once with the
    least of its reasons."""
    open_ = spark.read.parquet(retry).groupBy(*keys).agg(F.min("reason").alias("reason"))
    return open_.join(spark.read.parquet(sink).select(*keys), list(keys), "left_anti") if exists(spark, sink) else open_
