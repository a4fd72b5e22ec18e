"""Tables laid out for joins on their key (J7, J8, S9, J9): catalog tables with Spark's buckets.

A sink, a parent or an enrichment that many runs are joined with is written
once by key and read without an exchange: the other side alone is shuffled, to
the table's buckets.  The catalog may be the session's own, so a table is its
folder: ``_layout.json`` names keys, buckets and schema, and a session that
does not know the table yet enters it by them.  The layout is fixed by the first write;
:func:`rebucket` makes another table of it.

For keys that few rows share, as ids are: a bucket of a batch is one task's.
Rows come in named batches, each a partition that is written whole: writing a
batch again replaces it, so a retried run gives its rows once.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from florapipe.sources.store import _folder

BATCH = "batch"
#: Buckets of a new table; a task reads one bucket, so a large table asks for more.
BUCKETS = 64


class Layout(NamedTuple):
    keys: list[str]
    buckets: int
    schema: StructType


def layout(spark: SparkSession, path: str) -> Layout | None:
    """The layout kept with a table, or None where there is none."""
    fs, p = _folder(spark, f"{path}/_layout.json")
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        said = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return Layout(said["keys"], said["buckets"], StructType.fromJson(said["schema"]))


def _keep_layout(spark: SparkSession, path: str, new: Layout) -> None:
    """Written aside and renamed, so that a table has a whole layout or none."""
    fs, target = _folder(spark, f"{path}/_layout.json")
    _, aside = _folder(spark, f"{path}/_{uuid.uuid4().hex}")
    out = fs.create(aside, False)
    try:
        out.write(bytearray(json.dumps({"keys": new.keys, "buckets": new.buckets, "schema": new.schema.jsonValue()}).encode()))
    finally:
        out.close()
    if not fs.rename(aside, target):
        raise RuntimeError(f"another writer has laid out {path}")


def _quoted(names: Sequence[str]) -> str:
    return ", ".join("`" + n.replace("`", "``") + "`" for n in names)


def _entered(spark: SparkSession, path: str, lay: Layout) -> str:
    """The table's name in the catalog, entered if it is not there, with the batches that its folder holds."""
    name = f"florapipe_{hashlib.sha256(path.encode()).hexdigest()[:24]}"
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"{_quoted([f.name])} {f.dataType.simpleString()}" for f in lay.schema)
        where = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}, `{BATCH}` string) USING parquet PARTITIONED BY (`{BATCH}`) "
                  f"CLUSTERED BY ({_quoted(lay.keys)}) SORTED BY ({_quoted(lay.keys)}) INTO {lay.buckets} BUCKETS LOCATION '{where}'")
    spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)
    return name


def write_batch(df: DataFrame, path: str, keys: Sequence[str], batch: str, buckets: int = BUCKETS) -> None:
    """Write ``df`` as the rows of ``batch``, in place of those it had.

    ``buckets`` is the layout of a table's first write.  Later batches have its columns, in any
    order.  One exchange deals the rows out to the buckets, so that a bucket of a batch is one sorted
    file.  One writer of a batch at a time."""
    spark = df.sparkSession
    if not re.fullmatch(r"[A-Za-z0-9_-]+", batch):
        raise ValueError(f"a batch is named by letters, digits, _ and -, not {batch!r}")
    if BATCH in df.columns:
        raise ValueError(f"a column named {BATCH} would clash with the batch's name")
    lay = layout(spark, path)
    if lay is None:
        lay = Layout(list(keys), buckets, df.schema)
        _keep_layout(spark, path, lay)
    if list(keys) != lay.keys:
        raise ValueError(f"{path} is laid out by {lay.keys}, not {list(keys)}")
    if sorted(df.columns) != sorted(lay.schema.names):
        raise ValueError(f"{path} has the columns {lay.schema.names}, the batch has {df.columns}")
    rows = (df.select(*[_quoted([c]) for c in lay.schema.names])
            .repartition(lay.buckets, *[F.col(_quoted([k])) for k in lay.keys]))      # the write sorts them
    spark.sql(f"INSERT OVERWRITE TABLE {_entered(spark, path, lay)} PARTITION (`{BATCH}` = '{batch}') SELECT * FROM {{rows}}",
              rows=rows)


def read(spark: SparkSession, path: str) -> DataFrame | None:
    """The table with the batch of each row; None before the first write.  A join or an aggregate on its keys needs no exchange of it."""
    lay = layout(spark, path)
    return None if lay is None else spark.table(_entered(spark, path, lay))


def rebucket(spark: SparkSession, path: str, to: str, buckets: int, batch: str = "rebucketed") -> None:
    """The table's rows as one batch of another table with another number of buckets: for one that has outgrown its layout,
    or has so many batches that its buckets are many files.  Readers of the old one keep it."""
    lay = layout(spark, path)
    if lay is None:
        raise ValueError(f"no table at {path}")
    write_batch(read(spark, path).drop(BATCH), to, lay.keys, batch, buckets)
