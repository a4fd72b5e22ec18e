"""Figures of a stream while it runs (T4, S10): observed by its own micro-batches and told by a listener.

The rows are counted as they are read, in the job that processes them; nothing
is read twice.  The driver keeps sums and the last figures, whatever the
number of micro-batches.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

#: Name of the observed number of rows.
ROWS = "n_rows"


class Watch(StreamingQueryListener):
    """Sums of a stream's figures over the micro-batches of this run.

    ``figures`` are named aggregates that add up over batches (counts, sums).
    ``on_step`` is told, after each micro-batch with rows, its id and the sums
    so far; with ``total``, the number of rows expected, also ``done_pct``."""

    def __init__(self, total: int | None = None, on_step: Callable[[int, Mapping], None] = lambda batch, sums: None,
                 **figures: Column) -> None:
        self.total, self.on_step, self.figures = total, on_step, figures
        self.sums: dict = {}
        self.batches = 0
        self._name = f"watch_{uuid.uuid4().hex}"
        self._query, self._ended = None, threading.Event()

    def on(self, stream: DataFrame) -> DataFrame:
        """The stream with its figures observed.  Put it before what filters or aggregates."""
        return stream.observe(self._name, F.count(F.lit(1)).alias(ROWS), *[c.alias(n) for n, c in self.figures.items()])

    @contextmanager
    def listening(self, spark: SparkSession) -> Iterator[None]:
        """While a stream runs to its end; the figures are whole when this is left."""
        self._ended.clear()
        spark.streams.addListener(self)
        try:
            yield
            self._ended.wait(30)        # events are told after the fact
        finally:
            spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics.get(self._name)
        if seen is None:
            return                      # another stream of the session
        self._query = event.progress.id
        said = seen.asDict()
        if not said[ROWS]:
            return                      # a batch without rows
        for n, v in said.items():
            self.sums[n] = self.sums.get(n, 0) + (v or 0)
        if self.total is not None:
            self.sums["done_pct"] = 100.0 * self.sums[ROWS] / self.total if self.total else 100.0
        self.batches += 1
        self.on_step(event.progress.batchId, dict(self.sums))

    def onQueryTerminated(self, event) -> None:
        if self._query is None or event.id == self._query:
            self._ended.set()


def share_done(progress: DataFrame | None, totals: DataFrame, group: str, total_col: str = "n_total") -> DataFrame:
    """Per group of ``totals`` (one row each) what the progress table says is done: ``n_processed`` (0 where it has no row)
    and ``done_pct``, null where nothing was expected.  Groups that nothing is expected of are left out."""
    t = totals.select(group, total_col)
    done = (t.select(group).withColumn("n_processed", F.lit(0).cast("bigint")).limit(0) if progress is None
            else progress.select(group, "n_processed")).withColumnRenamed(group, "_g")
    n = F.coalesce("n_processed", F.lit(0)).cast("bigint")
    return t.join(done, F.col(group).eqNullSafe(F.col("_g")), "left").select(
        group, n.alias("n_processed"), total_col, F.try_divide(n * 100.0, F.col(total_col)).alias("done_pct"))
