"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import math
import sys
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from florapipe.session import materialize

#: The white space of the contracts, ``[\\x20\\x09-\\x0D]``.
WHITE_SPACE = " \t\n\x0b\f\r"

UID = "__uid"


def spread(spark: SparkSession, rows: int, per_task: int) -> int:
    """Partitions for ``rows`` at ``per_task`` rows each, at least the session's own number."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / per_task), 1)


def without_white_space(text: Column) -> Column:
    """The text without every character of ``WHITE_SPACE``; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), WHITE_SPACE, "")


def identified(docs: DataFrame, id_col: str, text_col: str, *columns: Column, name: str, first: int = 0) -> DataFrame:
    """``columns`` beside ``doc_id``, a hash of the text, and a number ``UID`` from ``first`` on that no other row has,
    written once.

    Repeated rows (the same id, the same text) stay apart by the number, which
    holds for all later reads because the table is written."""
    return materialize(docs.select((F.monotonically_increasing_id() + F.lit(first).cast("bigint")).alias(UID), F.col(id_col).cast("bigint").alias("doc_id"),
                                   F.xxhash64(text_col).alias("text_hash"), *columns), name)


def keep_rows(docs: DataFrame, judged: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs`` that stay, by ``judged (doc_id, text_hash, kept)`` with a row for each of them.

    Whole rows move once, to meet the verdicts on id and text; only verdicts
    that change something take part.  Of rows repeated with one id and text of
    which one is kept, any one stays: these alone are grouped.  The row travels
    as one struct, so extra columns clash with nothing."""
    spoken = (judged.groupBy("doc_id", "text_hash").agg(F.max("kept").alias("keep"), F.count("*").alias("rows"))
              .filter("not keep or rows > 1"))
    spoken = materialize(spoken, "verdicts")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    own = F.col(f"row.{id_col}").cast("bigint"), F.xxhash64(f"row.{text_col}")
    same = (own[1] == F.col("text_hash")) & own[0].eqNullSafe(F.col("doc_id"))
    once = rows.join(spoken, same, "left_anti").select("row.*")
    repeated = spoken.filter("keep")
    if repeated.isEmpty():
        return once
    one = rows.join(repeated, same).groupBy("text_hash", "doc_id").agg(F.first("row").alias("row"))
    return once.unionByName(one.select("row.*"))


def per_worker(key: tuple, make: Callable[[], Any]) -> Any:
    """What ``make`` returns, kept for later tasks of the same Python worker, which Spark reuses.
    A worker keeps one such thing, the last one asked for."""
    memo = sys.__dict__.setdefault("_florapipe_worker_memo", {})
    if key not in memo:
        memo.clear()
        memo[key] = make()
    return memo[key]
