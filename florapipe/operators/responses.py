"""Landed lookup responses, as the operators read them.

A landing log repeats: a request that failed is asked again, a page is fetched
twice.  Operators look up *one* response per key, so a repeated one never
multiplies an entity.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: When a response landed, as a landing log may say.
LANDED_AT = "landed_at"


def asked(responses: DataFrame, *columns: Column | str) -> DataFrame:
    """What an operator reads of landed responses, with the time they landed, if the log has it."""
    return responses.select(*columns, *[c for c in responses.columns if c == LANDED_AT])


def one_response(responses: DataFrame, keys: Sequence[str], status: str | None = "http_status",
                 pos: str | Column | None = None) -> DataFrame:
    """One row per key: a 200 before another status, a status before a failed
    request (NULL), then the latest by ``pos`` (``landed_at``, where there is
    one); what still ties is told apart by a hash of the row, so that reruns
    agree.  One aggregate, combined before the shuffle."""
    pos = LANDED_AT if pos is None and LANDED_AT in responses.columns else pos
    others = [c for c in responses.columns if c not in keys and c != LANDED_AT]
    rank = []
    if status:
        rank += [(F.col(status) == 200).eqNullSafe(True).alias("ok"), F.col(status).isNotNull().alias("answered")]
    if pos is not None:
        rank.append((F.col(pos) if isinstance(pos, str) else pos).alias("pos"))
    rank.append(F.xxhash64(*others).alias("tie"))
    row = F.struct(*[F.col(c) for c in others])
    return responses.groupBy(*keys).agg(F.max_by(row, F.struct(*rank)).alias("_r")).select(*keys, "_r.*")


def first_page(rows: DataFrame, key: str, order: Sequence[str], per_page: int, item: str, out: str = "results") -> DataFrame:
    """A search answer as a service gives it: the first ``per_page`` items of
    each key in ``order``, as one list.  ``row_number() <= n`` is planned as a
    partial WindowGroupLimit: a map task ships at most ``per_page`` rows per key."""
    w = Window.partitionBy(key).orderBy(*order)
    return (rows.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= per_page)
            .groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_n", F.col(item).alias("r")))).alias("_l"))
            .select(key, F.transform("_l", lambda x: x["r"]).alias(out)))
