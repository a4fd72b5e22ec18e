"""Outcome of retried lookups, read from an attempts log.

The source retries a lookup until an attempt is acceptable or the budget is
spent.  Timing (backoff, jitter) is scheduling; what is kept is the rule that
decides the outcome, applied to all keys at once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EXHAUSTED = "max_retries_exhausted"
# statuses a lookup accepts as final (fixed values of the source pipeline)
LOOKUP_ACCEPTS = ["success", "no_research_images", "no_images"]


def accept_status(status_col: str = "status", accepted: Sequence[str] = tuple(LOOKUP_ACCEPTS)) -> Column:
    return F.coalesce(F.col(status_col).isin(list(accepted)), F.lit(False))


def lookup_outcome(status_col: str = "status") -> Column:
    """The status a retried lookup ends with when every attempt answers alike:
    an accepted one stays, any other exhausts the retries."""
    return F.when(accept_status(status_col), F.col(status_col)).otherwise(F.lit(EXHAUSTED))


def first_acceptable(attempts: DataFrame, key: str, order: Sequence[str | Column],
                     accept: Column | Callable[[], Column], payload: Sequence[str],
                     max_attempts: int = 3, status_col: str = "status",
                     exhausted: str = EXHAUSTED) -> DataFrame:
    """Per key, the first attempt in ``order`` (within the first
    ``max_attempts``) that ``accept`` admits; otherwise one row with
    ``status_col`` = ``exhausted`` and NULL payload.

    The attempt number is ``row_number() <= max_attempts`` (a partial
    WindowGroupLimit: each map task ships at most ``max_attempts`` rows per
    key), the choice a ``min_by`` partial aggregate."""
    ok = accept() if callable(accept) else accept
    w = Window.partitionBy(key).orderBy(*order)
    numbered = (attempts.withColumn("attempt", F.row_number().over(w))
                .filter(F.col("attempt") <= max_attempts)
                .withColumn("_ok", F.coalesce(ok, F.lit(False))))
    fields = [F.col("attempt")] + [F.col(c) for c in payload]
    best = numbered.groupBy(key).agg(
        F.min_by(F.when(F.col("_ok"), F.struct(*fields)), F.when(F.col("_ok"), F.col("attempt"))).alias("_b"))
    out = [F.col(key), F.col("_b.attempt").alias("attempt")]
    for c in payload:
        v = F.col(f"_b.{c}")
        if c == status_col:
            v = F.coalesce(v, F.lit(exhausted))
        out.append(v.alias(c))
    if status_col not in payload:
        out.append(F.when(F.col("_b").isNull(), F.lit(exhausted)).otherwise(F.lit("success")).alias(status_col))
    return best.select(*out)
