"""Spark session defaults and the shared scratch location.

Every job in this package is a plain DataFrame plan, so the only session
settings that matter are the ones that make plans deterministic (UTC, ANSI)
and let the runtime re-plan around data it cannot see in advance (AQE,
skew-join splitting, runtime broadcast conversion from measured shuffle
sizes).
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app: str = "florapipe",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the package defaults.

    ``master`` and ``shuffle_partitions`` are for tests and local benches;
    on a cluster they come from the submit configuration.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, as the URI given.

    On a cluster the deployment sets it (a path every executor can reach) and
    a missing setting is an error: files in one machine's temporary folder are
    out of the other machines' reach.  Only a ``local[...]`` master -- tests
    and benches, one machine by definition -- gets a private folder, made once
    and registered so later calls agree.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="florapipe-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


#: Scratch folders handed out by this process, for :func:`clear_scratch`.
_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the shared checkpoint location."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders this process made, once no DataFrame that
    reads them is needed any more (the caller knows).  Returns how many."""
    n = len(_SCRATCH)
    while _SCRATCH:
        p = spark._jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    return n


def materialize(df: DataFrame, name: str, session: SparkSession | None = None) -> DataFrame:
    """Cut lineage by writing ``df`` as a Parquet table in the shared
    checkpoint folder and reading it back.

    One computation (a reliable ``checkpoint()`` of an unpersisted plan runs
    it twice), columnar output for the readers downstream, and files that
    outlive a lost executor.  The schema is passed on, so that reading back
    starts no job and an empty result keeps its columns.  ``session``: the one
    that reads it, if not that of ``df``."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return (session or df.sparkSession).read.schema(df.schema).parquet(path)


def materialize_seen(df: DataFrame, name: str, report: Callable[[str, dict], None], *figures: Column) -> DataFrame:
    """:func:`materialize`, and ``report`` is told the ``figures`` (named aggregates) that the write itself has
    observed: no second read of the rows."""
    seen = Observation(name)
    out = materialize(df.observe(seen, *figures), name)
    report(name, seen.get)
    return out
