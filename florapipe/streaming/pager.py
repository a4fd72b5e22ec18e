"""The pager's stop rule on a stream of landed pages (T1 with S3).

A pager reads an order's pages by rising offset and stops at the first one
that fails or is empty.  Pages land in any order over many micro-batches, so a
page can be given out once every offset below it has landed and none of them
stops the order; until then its rows are held in the state of its order, with
the least stopping offset and the offset up to which all is known.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StringType, StructField, StructType

#: The state store that keeps a map per key.
STATE_STORE = {"spark.sql.streaming.stateStore.providerClass":
               "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


@contextmanager
def state_store(spark: SparkSession):
    """Streams started within use the state store with maps; the session is left as it was."""
    old = {k: spark.conf.get(k, None) for k in STATE_STORE}
    for k, v in STATE_STORE.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


_PLACE = StructType([StructField("known_to", LongType()), StructField("stop", LongType())])
_OFFSET = StructType([StructField("offset", LongType())])
_PAGE = StructType([StructField("kind", StringType()), StructField("page", StringType())])
KEEP, SKIP, STOP = "keep", "skip", "stop"


class _Pager(StatefulProcessor):
    """Per order: the pages that landed beyond the known prefix, by offset, and where that prefix ends."""

    def __init__(self, step: int, first: int):
        self.step, self.first = step, first

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.place = handle.getValueState("place", _PLACE)
        self.held = handle.getMapState("held", _OFFSET, _PAGE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer) -> Iterator[pd.DataFrame]:
        at, stop = self.place.get() if self.place.exists() else (self.first, None)
        for pdf in rows:
            for offset, kind, page in zip(pdf["offset"], pdf["kind"], pdf["page"]):
                if offset < at or (stop is not None and offset >= stop):
                    continue                               # given out before, or beyond the stop
                old = self.held.getValue((int(offset),)) if self.held.containsKey((int(offset),)) else None
                # a page that lands again after a failed request replaces it; an answer is never replaced by a failure
                if old is None or (old[0] == SKIP and kind != SKIP):
                    self.held.updateValue((int(offset),), (kind, page))
                if kind == STOP:
                    stop = int(offset)
        out = []
        while stop is None or at < stop:
            if not self.held.containsKey((at,)):
                break
            kind, page = self.held.getValue((at,))
            if kind == KEEP:
                out.append(page)
            self.held.removeKey((at,))
            at += self.step
        if stop is not None and at >= stop:                # what is held beyond the stop is of no use
            for offset in [k[0] for k, _ in self.held.iterator()]:
                self.held.removeKey((offset,))
        self.place.update((at, stop))
        if out:
            yield pd.DataFrame({"page": out})

    def close(self) -> None:
        pass


def _kind(status: Column, n_results: Column) -> Column:
    """A failed request is skipped, another status or an empty page stops the order."""
    empty = F.coalesce(n_results, F.lit(0)) == 0
    return F.when(status.isNull(), SKIP).when((status != 200) | empty, STOP).otherwise(KEEP)


def stream_page_prefix(pages: DataFrame, group: str, offset: str, status: str, n_results: str, step: int,
                       first: int = 0) -> DataFrame:
    """The pages of a stream that a sequential pager would have read, each given out once, as soon as all offsets
    ``first, first + step, ...`` below it are known.

    Pages may land in any order, several times, over any number of micro-batches and restarts.  After all have landed
    the rows are those of ``page_prefix``; an offset that never lands holds back what lies beyond it.  The state of an
    order is its pages beyond the known prefix: none once it is read through.  The session must use a state store with
    maps (:func:`state_store`)."""
    if pages.sparkSession.conf.get(next(iter(STATE_STORE)), None) != next(iter(STATE_STORE.values())):
        raise RuntimeError(f"set {STATE_STORE} for this stream")
    whole = F.struct(*[F.col(c) for c in pages.columns])
    slim = pages.select(F.col(group).alias("group"), F.col(offset).cast("bigint").alias("offset"),
                        _kind(F.col(status), F.col(n_results)).alias("kind"), F.to_json(whole, {"ignoreNullFields": "false"}).alias("page"))
    slim = slim.filter(F.col("offset").isNotNull()).withColumn("page", F.when(F.col("kind") == KEEP, F.col("page")))
    out = slim.groupBy("group").transformWithStateInPandas(
        _Pager(step, first), StructType([StructField("page", StringType())]), "Append", "None")
    return out.select(F.from_json("page", pages.schema).alias("p")).select("p.*")
