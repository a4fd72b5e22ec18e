"""Keyed tables on disk (S7-S9, T3): upsert and insert-ignore with one commit for all buckets.

A table is a folder of two parts:

* ``data/w=<write>/bucket=<bucket>/``: Parquet files that no later write
  changes;
* ``commits/<n>.json``: a small file that names, for every bucket, the writes
  whose files are its rows.  The highest ``n`` is the table.  A commit file is
  written aside and renamed into place, so a reader sees the table before a
  write or after it, whatever the number of buckets and wherever a writer died;
  what a dead writer left in ``data`` no commit names.

A bucket ``m<M>r<R>`` holds the keys whose hash is ``R`` modulo ``M``.  When its
rows outgrow the bound, the write that rewrites it anyway writes two buckets of
modulus ``2M`` instead (or four, ...), by the next bits of the hash; the others
stay as they are.  The layout is part of the commit, never an argument of a
later call.  One writer at a time, on a file system that renames atomically.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from florapipe.session import materialize
from florapipe.sources.store import _folder, default_id, insert_new, last_per_key, upsert

BUCKET = "bucket"
#: Buckets of a new table, and rows of a bucket from which it is split.
BUCKETS = 8
BUCKET_ROWS = 2_000_000
#: Appended writes of a bucket from which they are written together, and commits that readers may still hold.
PARTS = 16
KEEP = 3


class Commit(NamedTuple):
    """``parts``: the writes of each bucket, in order; ``rows``: their rows. Buckets without rows are named too."""
    number: int
    parts: dict[str, list[str]]
    rows: dict[str, int]


def _numbers(spark: SparkSession, path: str) -> list[int]:
    fs, folder = _folder(spark, f"{path}/commits")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _load(spark: SparkSession, path: str, number: int) -> Commit:
    fs, p = _folder(spark, f"{path}/commits/{number}.json")
    stream = fs.open(p)
    try:
        said = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return Commit(number, said["parts"], said["rows"])


def current(spark: SparkSession, path: str) -> Commit | None:
    """The last commit of a table, or None before the first one."""
    numbers = _numbers(spark, path)
    return _load(spark, path, numbers[-1]) if numbers else None


def _commit(spark: SparkSession, path: str, commit: Commit) -> None:
    """The step that makes a write the table's state."""
    fs, target = _folder(spark, f"{path}/commits/{commit.number}.json")
    _, aside = _folder(spark, f"{path}/commits/.{uuid.uuid4().hex}")
    out = fs.create(aside, False)
    try:
        out.write(bytearray(json.dumps({"parts": commit.parts, "rows": commit.rows}).encode()))
    finally:
        out.close()
    if fs.exists(target) or not fs.rename(aside, target):
        raise RuntimeError(f"another writer has made commit {commit.number} of {path}")


def read_table(spark: SparkSession, path: str, buckets: Sequence[str] | None = None) -> DataFrame | None:
    """A keyed table (or some of its buckets) with its bucket column; None where nothing is committed."""
    now = current(spark, path)
    return None if now is None else _read(spark, path, now, buckets)


def _read(spark: SparkSession, path: str, commit: Commit, buckets: Sequence[str] | None = None) -> DataFrame | None:
    names = commit.parts if buckets is None else buckets
    paths = [f"{path}/data/w={w}/{BUCKET}={b}" for b in names for w in commit.parts[b]]
    return spark.read.option("basePath", f"{path}/data").parquet(*paths).drop("w") if paths else None


def _name(modulus: int, rest: Column) -> Column:
    return F.concat(F.lit(f"m{modulus}r"), rest.cast("string"))


def _level(bucket: str) -> tuple[int, int]:
    modulus, _, rest = bucket[1:].partition("r")
    return int(modulus), int(rest)


def _bucketed(df: DataFrame, keys: Sequence[str], buckets: Sequence[str]) -> DataFrame:
    """Each row with the bucket that its key falls in: of its candidates, one per modulus in use, the one there is."""
    h = F.xxhash64(*[F.col(k) for k in keys])
    moduli = sorted({_level(b)[0] for b in buckets})
    names = [_name(m, F.pmod(h, F.lit(m))) for m in moduli]
    if len(moduli) == 1:
        return df.withColumn(BUCKET, names[0])
    spark = df.sparkSession
    there = spark.createDataFrame([(b,) for b in buckets], f"`{BUCKET}` string")
    # the commit's own list of names, which the driver holds
    return df.withColumn(BUCKET, F.explode(F.array(*names))).join(F.broadcast(there), BUCKET, "left_semi")


def _touched(df: DataFrame) -> list[str]:
    """The buckets of a batch: at most the table's number of buckets."""
    return sorted(r[BUCKET] for r in df.select(BUCKET).distinct().collect())


def _counts(df: DataFrame) -> dict[str, int]:
    return {r[BUCKET]: r["n"] for r in df.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("n")).collect()}


def _grown(rows: Mapping[str, int], bucket_rows: int) -> dict[str, list[str]]:
    """The buckets that take the place of those with too many rows."""
    out = {}
    for bucket, n in rows.items():
        modulus, rest = _level(bucket)
        times = 1
        while n > bucket_rows * times:
            times *= 2
        if times > 1:
            out[bucket] = [f"m{modulus * times}r{rest + modulus * i}" for i in range(times)]
    return out


def _write_parts(rows: DataFrame, path: str) -> str:
    """Write rows as files of their buckets, a large bucket by several tasks; returns the write's name."""
    write = uuid.uuid4().hex
    rows.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{path}/data/w={write}")
    return write


def _next(now: Commit, replaced: Mapping[str, Sequence[str]], added: Mapping[str, int], appended: Mapping[str, int],
          write: str) -> Commit:
    """The commit after ``now``: of ``replaced`` buckets others take the place, with ``added`` rows; ``appended`` grow."""
    parts = {b: list(w) for b, w in now.parts.items() if b not in replaced}
    rows = {b: n for b, n in now.rows.items() if b not in replaced}
    for b in (c for children in replaced.values() for c in children):
        parts[b] = [write] if added.get(b) else []
        rows[b] = added.get(b, 0)
    for b, n in appended.items():
        parts[b].append(write)
        rows[b] += n
    return Commit(now.number + 1, parts, rows)


def _first(buckets: int) -> Commit:
    names = [f"m{buckets}r{i}" for i in range(buckets)]
    return Commit(0, {b: [] for b in names}, dict.fromkeys(names, 0))


def _placed(rows: DataFrame, keys: Sequence[str], now: Commit, replaced: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rows of buckets that are split go to those that take their place."""
    buckets = [b for b in now.parts if b not in replaced] + [c for children in replaced.values() for c in children]
    return _bucketed(rows.drop(BUCKET), keys, buckets)


def upsert_into(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], seq: str | Column,
                id_col: str = "id", id_fn: Callable[[Sequence[str]], Column] = default_id,
                keep_seq: bool = False, buckets: int = BUCKETS, bucket_rows: int = BUCKET_ROWS,
                index_ids: bool = True) -> list[str]:
    """S7 on a stored table: only the buckets the batch touches are read and
    rewritten, and all of them become visible with one commit.  Returns them.
    Applying a batch again gives the same table.

    With ``index_ids`` the ids of keys new to the table are looked up in an
    index of ids (a keyed table of its own, of which only the buckets of these
    ids are read); two keys with one id are an error, before anything is
    committed.  ``buckets`` is the layout of a table's first write."""
    now = current(spark, path) or _first(buckets)
    batch = materialize(_bucketed(last_per_key(source, keys, seq), keys, list(now.parts)), "upsert_batch")
    touched = _touched(batch)
    if not touched:
        return []
    target = _read(spark, path, now, touched)
    target = target.drop(BUCKET) if target is not None else None
    if index_ids:
        # stored keys and ids are as many as the table's rows: merged, never broadcast by the size of their files
        added = (batch.select(*keys) if target is None
                 else batch.select(*keys).join(target.select(*keys).hint("merge"), list(keys), "left_anti"))
        _index(spark, path, materialize(added.withColumn(id_col, id_fn(keys)), "upsert_added"), keys, id_col, buckets)
    new = upsert(target, batch.drop(BUCKET), keys, seq if isinstance(seq, str) else F.lit(0), id_col, id_fn, keep_seq)
    new = materialize(_bucketed(new, keys, list(now.parts)), "upsert_buckets")
    counts = _counts(new)
    grown = _grown(counts, bucket_rows)
    replaced = {b: [b] for b in touched} | grown
    if grown:
        new = _placed(new, keys, now, replaced)
        counts = _counts(new)
    write = _write_parts(new, path)
    _commit(spark, path, _next(now, replaced, counts, {}, write))
    expire(spark, path)
    return touched


def insert_into(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str],
                order: Sequence[str | Column], buckets: int = BUCKETS, bucket_rows: int = BUCKET_ROWS) -> None:
    """S8 on a stored table: append the rows whose key it has not, with one
    commit.  Inserting a batch again adds nothing.  A bucket that outgrows its
    bound, or has many small writes, is written anew with its new rows."""
    now = current(spark, path) or _first(buckets)
    batch = materialize(_bucketed(source, keys, list(now.parts)), "insert_batch")
    touched = _touched(batch)
    target = _read(spark, path, now, touched) if touched else None
    new = materialize(insert_new(target, batch, keys, order), "insert_new")
    added = _counts(new)
    if not added:
        return
    after = {b: now.rows[b] + n for b, n in added.items()}
    replaced = {b: [b] for b in added if len(now.parts[b]) >= PARTS} | _grown(after, bucket_rows)
    old = _read(spark, path, now, list(replaced)) if replaced else None
    rows = new if old is None else new.unionByName(old)
    rows = _placed(rows, keys, now, replaced) if replaced else rows
    write = _write_parts(rows, path)
    counts = _counts(rows.filter(~F.col(BUCKET).isin([b for b in added if b not in replaced]))) if replaced else {}
    _commit(spark, path, _next(now, replaced, counts, {b: n for b, n in added.items() if b not in replaced}, write))
    expire(spark, path)


def _index(spark: SparkSession, path: str, added: DataFrame, keys: Sequence[str], id_col: str, buckets: int) -> None:
    """Enter the ids of new keys, unless one is another key's."""
    index = f"{path}/ids"
    twice = added.groupBy(id_col).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    now = current(spark, index)
    clash = not twice.isEmpty()
    if now is not None and not clash:
        known = _read(spark, index, now, _touched(_bucketed(added, [id_col], list(now.parts))))
        if known is not None:
            other = known.select(F.col(id_col), F.struct(*keys).alias("_other")).hint("merge")
            clash = not added.join(other, id_col).filter(~F.struct(*keys).eqNullSafe(F.col("_other"))).isEmpty()
    if clash:
        raise ValueError(f"two keys share one {id_col}: give upsert another id_fn")
    insert_into(spark, index, added.select(id_col, *keys), [id_col], list(keys), buckets)


def rows_of_keys(spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str]) -> DataFrame | None:
    """The buckets of a stored table that the batch's keys fall in: what a lookup by key has to read."""
    now = current(spark, path)
    if now is None:
        return None
    touched = _touched(_bucketed(batch.select(*keys), keys, list(now.parts)))
    return _read(spark, path, now, touched) if touched else None


def expire(spark: SparkSession, path: str, keep: int = KEEP) -> int:
    """Delete all but the last ``keep`` commits and the files that only they name; returns how many files' folders.

    For the table's one writer, after its commit: a write that is not yet committed is named by none."""
    numbers = _numbers(spark, path)
    fs, data = _folder(spark, f"{path}/data")
    held = {(w, b) for n in numbers[-keep:] for b, writes in _load(spark, path, n).parts.items() for w in writes}
    for n in numbers[:-keep]:
        fs.delete(_folder(spark, f"{path}/commits/{n}.json")[1], False)
    gone = 0
    for write in (s.getPath() for s in (fs.listStatus(data) if fs.exists(data) else [])):
        name = write.getName()[2:]
        if not any(w == name for w, _ in held):
            fs.delete(write, True)
            gone += 1
            continue
        for bucket in (s.getPath() for s in fs.listStatus(write)):
            if bucket.getName().startswith(f"{BUCKET}=") and (name, bucket.getName()[len(BUCKET) + 1:]) not in held:
                fs.delete(bucket, True)
                gone += 1
    return gone
