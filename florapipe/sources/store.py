"""Parent/child tables without a row-level-update catalog.

The upsert and insert-ignore of whole tables as DataFrames (``keyed`` applies
them to stored tables, bucket by bucket), and *snapshots*: immutable versions
``v=<n>``; the current one is the highest with Spark's own ``_SUCCESS`` mark.  A
version is never written twice, so a crash in the middle of a write leaves the
last committed one current, and a damaged file is an error, never an empty
table.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def _folder(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _folder(spark, path)
    return fs.exists(p)


def _versions(spark: SparkSession, path: str) -> dict[int, bool]:
    """The version folders of a snapshot and whether each is committed."""
    fs, p = _folder(spark, path)
    if not fs.exists(p):
        return {}
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return {int(n[2:]): exists(spark, f"{path}/{n}/_SUCCESS") for n in names if n[:2] == "v=" and n[2:].isdigit()}


def read_snapshot(spark: SparkSession, path: str) -> DataFrame | None:
    """The current version of a snapshot, or None when none is committed."""
    done = [v for v, ok in _versions(spark, path).items() if ok]
    return spark.read.parquet(f"{path}/v={max(done)}") if done else None


def write_snapshot(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> int:
    """Full export as a new version.  Returns the version; one that a
    crashed writer left behind is passed over, not overwritten."""
    v = max(_versions(df.sparkSession, path), default=0) + 1
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(f"{path}/v={v}")
    return v


def expire_versions(spark: SparkSession, path: str, keep: int = 3) -> int:
    """Delete all but the last ``keep`` committed versions of a snapshot (those its readers may hold) and what crashed
    writers left before them; returns how many."""
    versions = _versions(spark, path)
    done = sorted(v for v, ok in versions.items() if ok)[-keep:]
    old = [v for v in versions if done and v < done[0]]
    for v in old:
        fs, p = _folder(spark, f"{path}/v={v}")
        fs.delete(p, True)
    return len(old)


def append_batch(df: DataFrame, path: str, fmt: str = "csv", batch: str | None = None) -> bool:
    """Append a batch; says whether it had rows (counted while writing).
    CSV part files each carry their own header (read back with
    ``header=True``); spaces at the edges of a text stay.

    With ``batch``, a name that the caller gives the batch, it is a folder
    ``batch=<name>`` of its own, written whole: appending the batch again
    replaces it, so a retry gives it once."""
    seen = Observation("append_batch")
    w = df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append" if batch is None else "overwrite")
    path = path if batch is None else f"{path}/batch={batch}"
    if fmt == "csv":
        (w.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
         .option("ignoreTrailingWhiteSpace", False).csv(path))
    else:
        w.format(fmt).save(path)
    return seen.get["n"] > 0


def last_per_key(source: DataFrame, keys: Sequence[str], seq: str | Column) -> DataFrame:
    """Within one batch the later row of a key wins (``max_by`` over a
    sequence column; a partial aggregate)."""
    s = F.col(seq) if isinstance(seq, str) else seq
    others = [c for c in source.columns if c not in keys]
    return (source.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in others]), s).alias("_r"))
            .select(*keys, *[F.col(f"_r.{c}").alias(c) for c in others]))


def default_id(keys: Sequence[str]) -> Column:
    """Surrogate id for a new key: a 64-bit hash of the key (no global
    numbering, which would need one task to see every key)."""
    return F.xxhash64(*[F.col(k) for k in keys])


def upsert(target: DataFrame | None, source: DataFrame, keys: Sequence[str], seq: str | Column,
           id_col: str = "id", id_fn: Callable[[Sequence[str]], Column] = default_id,
           keep_seq: bool = False) -> DataFrame:
    """Insert; on key conflict overwrite every non-key column (NULLs
    included); within the batch the later row (``seq``) wins.  Existing rows
    keep their surrogate id, new keys get ``id_fn``.

    ``keep_seq`` (``seq`` must then be a column name): the table stores the
    sequence and a batch row replaces a stored row only when its sequence is
    not lower -- so late or replayed batches cannot roll a key back.

    One pass over target and batch together: per key an aggregate picks the
    winning row and the id, combined before the shuffle."""
    batch = last_per_key(source, keys, seq)
    if not keep_seq and isinstance(seq, str) and seq in batch.columns:
        batch = batch.drop(seq)
    new = batch.withColumn(id_col, id_fn(keys))
    if target is None:
        return new
    both = target.select(*target.columns, F.lit(0).alias("_batch")).unionByName(
        new.select(*target.columns, F.lit(1).alias("_batch")))
    others = [c for c in target.columns if c not in (*keys, id_col)]
    order = F.struct(F.col(seq), F.col("_batch")) if keep_seq else F.col("_batch")
    merged = both.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in others]), order).alias("_r"),
                                     F.min_by(id_col, "_batch").alias(id_col))
    return merged.select(*[F.col(f"_r.{c}").alias(c) if c in others else F.col(c) for c in target.columns])


def insert_new(target: DataFrame | None, source: DataFrame, keys: Sequence[str],
               order: Sequence[str | Column]) -> DataFrame:
    """S8, the rows to append: those whose key the target has not, the first per key in ``order``.  The target's keys are
    merged, never broadcast: their number is not seen from the size of a file."""
    cols = source.columns
    first = (source.groupBy(*keys)
             .agg(F.min_by(F.struct(*[F.col(c) for c in cols if c not in keys]),
                           F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])).alias("_r"))
             .select(*keys, *[F.col(f"_r.{c}").alias(c) for c in cols if c not in keys]).select(*cols))
    return first if target is None else first.join(target.select(*keys).hint("merge"), list(keys), "left_anti").select(*cols)


def insert_ignore(target: DataFrame | None, source: DataFrame, keys: Sequence[str],
                  order: Sequence[str | Column]) -> DataFrame:
    """``ON CONFLICT DO NOTHING`` as a whole table: the target and the rows :func:`insert_new` adds."""
    new = insert_new(target, source, keys, order)
    return new if target is None else target.unionByName(new.select(*target.columns))


def lookup_ids(batch: DataFrame, target: DataFrame, keys: Sequence[str], id_col: str = "id") -> DataFrame:
    """Surrogate ids of the batch's keys; keys without an id drop out.  The ids are merged, never broadcast."""
    return batch.join(target.select(*keys, id_col).hint("merge"), list(keys), "inner")


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One (table_name, n_rows) row per table, as one DataFrame."""
    out = None
    for name, df in tables.items():
        c = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        out = c if out is None else out.unionByName(c)
    return out
