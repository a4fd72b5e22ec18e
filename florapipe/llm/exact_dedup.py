"""Exact duplicates by a cuckoo-filter index (operator 4).

An index holds the *live digests*: SHA-256 of the text without white space.
Each task that owns a shard of digests keeps a cuckoo filter of 16-bit
fingerprints and, under the same bucket numbers, the stored content keys.  A
lookup that misses the filter is new and is inserted; a hit is verified against
the content of its bucket, so a filter collision never merges two texts.  When
an insertion finds no free slot after the allowed evictions, the filter doubles
and is rebuilt from the stored keys.  A digest whose last reference is deleted
leaves filter and content; where rows are left, the one that stays is looked up
among them.

Hot texts: every map task first runs the same index over its own rows, so a
text that makes up a third of the corpus reaches its shard as one row per map
task.  The way back to documents is a join that Spark splits when skewed.
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from florapipe.llm.common import UID, identified, keep_rows, spread, without_white_space

SLOTS = 4
MAX_EVICTIONS = 200
FILL = 0.9

#: The row that stays is to be looked up, whatever rows are added until then.
UNKNOWN = (math.inf, False, 0, 0)

INDEX_SCHEMA = "digest binary, refs bigint, best_len bigint, best_id bigint, best_uid bigint"


class Full(Exception):
    """No free slot after the allowed evictions."""


class CuckooFilter:
    """Approximate membership with deletion: buckets of ``SLOTS`` 16-bit fingerprints."""

    def __init__(self, capacity: int):
        buckets = 1
        while buckets * SLOTS * FILL < capacity:
            buckets *= 2
        self.mask = buckets - 1
        self.slots = array("H", bytes(2 * SLOTS * buckets))

    def places(self, digest: bytes) -> tuple[int, int, int]:
        """Fingerprint (never 0) and its two buckets, the lower one first."""
        h = int.from_bytes(digest[:8], "little")
        fingerprint = (h & 0xFFFF) or 1
        one = (h >> 16) & self.mask
        two = self.other(one, fingerprint)
        return (fingerprint, one, two) if one <= two else (fingerprint, two, one)

    def other(self, bucket: int, fingerprint: int) -> int:
        return (bucket ^ (fingerprint * 0x9E3779B1 >> 7)) & self.mask

    def _find(self, bucket: int, value: int) -> int:
        start = bucket * SLOTS
        for i in range(start, start + SLOTS):
            if self.slots[i] == value:
                return i
        return -1

    def __contains__(self, digest: bytes) -> bool:
        fingerprint, one, two = self.places(digest)
        return self._find(one, fingerprint) >= 0 or self._find(two, fingerprint) >= 0

    def insert(self, digest: bytes) -> None:
        fingerprint, one, two = self.places(digest)
        for bucket in (one, two):
            if (i := self._find(bucket, 0)) >= 0:
                self.slots[i] = fingerprint
                return
        bucket = two
        for turn in range(MAX_EVICTIONS):
            i = bucket * SLOTS + turn % SLOTS
            self.slots[i], fingerprint = fingerprint, self.slots[i]
            bucket = self.other(bucket, fingerprint)
            if (i := self._find(bucket, 0)) >= 0:
                self.slots[i] = fingerprint
                return
        raise Full  # one fingerprint is homeless now: the caller rebuilds from its stored keys

    def delete(self, digest: bytes) -> bool:
        fingerprint, one, two = self.places(digest)
        for bucket in (one, two):
            if (i := self._find(bucket, fingerprint)) >= 0:
                self.slots[i] = 0
                return True
        return False


class DigestIndex:
    """A cuckoo filter over live digests, with their content in its buckets.

    An entry is ``[digest, refs, best]``; ``best`` orders the rows of equal
    text: most code points, then smallest id (a null id last), then row. It is
    ``UNKNOWN`` once some of the rows were deleted, since that row may be one."""

    def __init__(self, capacity: int = 1024):
        self.filter = CuckooFilter(capacity)
        self.content: dict[int, list[list]] = {}
        self.size = 0
        self.resizes = 0

    def _entry(self, digest: bytes) -> list | None:
        if digest not in self.filter:
            return None
        for entry in self.content.get(self.filter.places(digest)[1], ()):
            if entry[0] == digest:
                return entry
        return None  # the fingerprint is another digest's

    def refs(self, digest: bytes) -> int:
        entry = self._entry(digest)
        return entry[1] if entry else 0

    def insert(self, digest: bytes, refs: int, best: tuple) -> bool:
        """Count ``refs`` more rows of this text; True if it was not live before."""
        entry = self._entry(digest)
        if entry is not None:
            entry[1] += refs
            entry[2] = max(entry[2], best)
            return False
        self.size += 1
        self.content.setdefault(self.filter.places(digest)[1], []).append([digest, refs, best])
        try:
            self.filter.insert(digest)
        except Full:
            self._grow()
        return True

    def delete(self, digest: bytes, refs: int = 1) -> bool:
        """Count ``refs`` rows less; True if the digest is gone by that."""
        entry = self._entry(digest)
        if entry is None:
            return False
        entry[1] -= refs
        if entry[1] > 0:
            entry[2] = UNKNOWN
            return False
        self.content[self.filter.places(digest)[1]].remove(entry)
        self.filter.delete(digest)
        self.size -= 1
        return True

    def _grow(self) -> None:
        entries = list(self)
        capacity = 2 * (self.filter.mask + 1) * SLOTS * FILL
        while True:
            self.resizes += 1
            self.filter = CuckooFilter(int(capacity))
            self.content = {}
            try:
                for entry in entries:
                    self.content.setdefault(self.filter.places(entry[0])[1], []).append(entry)
                    self.filter.insert(entry[0])
                return
            except Full:
                capacity *= 2

    def __iter__(self) -> Iterator[list]:
        for bucket in self.content.values():
            yield from bucket


def _rank(length: int | None, doc_id: int | None, uid: int | None) -> tuple:
    return UNKNOWN if length is None else (length, doc_id is not None, -(doc_id or 0), -uid)


def _batches(index: DigestIndex, rows: int = 20_000) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []
    for digest, refs, (length, has_id, neg_id, neg_uid) in index:
        known = length != math.inf
        out.append((digest, refs, length if known else None, -neg_id if has_id else None, -neg_uid if known else None))
        if len(out) == rows:
            yield _record(out)
            out = []
    if out:
        yield _record(out)


def _record(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
    names = ["digest", "refs", "best_len", "best_id", "best_uid"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def _fold(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Run an index over rows of ``INDEX_SCHEMA``: negative refs delete, and come after what they delete."""
    index = DigestIndex()
    deletions: list[tuple[bytes, int]] = []
    for batch in batches:
        for digest, refs, length, doc_id, uid in zip(*(batch.column(i).to_pylist() for i in range(5))):
            if refs > 0:
                index.insert(digest, refs, _rank(length, doc_id, uid))
            else:
                deletions.append((digest, -refs))
    for digest, refs in deletions:
        index.delete(digest, refs)
    yield from _batches(index)


def _fold_here(keys: int):
    """Run indexes over a task's own rows, which insert only: one that holds ``keys`` digests is emitted and the next begun."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = DigestIndex()
        for batch in batches:
            for digest, refs, length, doc_id, uid in zip(*(batch.column(i).to_pylist() for i in range(5))):
                index.insert(digest, refs, _rank(length, doc_id, uid))
                if index.size == keys:
                    yield from _batches(index)
                    index = DigestIndex()
        yield from _batches(index)
    return run


def _sharded(entries: DataFrame, rows: int, keys_per_shard: int) -> DataFrame:
    """Fold rows of ``INDEX_SCHEMA`` in shards of digests, each one task with a bounded number of keys."""
    n = spread(entries.sparkSession, rows, keys_per_shard)
    return entries.repartition(n, "digest").mapInArrow(_fold, INDEX_SCHEMA)


def build_index(keyed: DataFrame, keys_per_shard: int = 200_000) -> DataFrame:
    """The live digests of rows ``(UID, doc_id, digest, n_chars)``: one row per text with its
    number of rows and the row that stays.  ``keyed`` should be a written table: it is counted.
    No task's index holds more than about ``keys_per_shard`` digests, over its own rows or over a shard."""
    rows = keyed.select("digest", F.lit(1).cast("bigint").alias("refs"), F.col("n_chars").alias("best_len"),
                        F.col("doc_id").alias("best_id"), F.col(UID).alias("best_uid"))
    return _sharded(rows.mapInArrow(_fold_here(keys_per_shard), INDEX_SCHEMA), keyed.count(), keys_per_shard)


def update_index(index: DataFrame, inserted: DataFrame | None = None, deleted: DataFrame | None = None,
                 keys_per_shard: int = 200_000, remaining: DataFrame | None = None) -> DataFrame:
    """A stored index after a batch of insertions (rows of ``INDEX_SCHEMA``, as ``build_index`` returns)
    and deletions (``digest, refs``: so many rows less; a digest without rows leaves the index).

    Where some rows of a digest were deleted, the row that stays is looked up in ``remaining``: the keyed rows of all
    batches that are left after this one.  Without it ``best_len``, ``best_id`` and ``best_uid`` are null there, until
    an update has it."""
    entries, rows = index, index.count()
    if inserted is not None:
        entries, rows = entries.unionByName(inserted), rows + inserted.count()
    unknown = entries.filter("best_len IS NULL").select("digest")
    if deleted is not None:
        gone = deleted.groupBy("digest").agg(F.sum("refs").alias("refs"))
        unknown = unknown.unionByName(gone.select("digest"))
        none = F.lit(None).cast("bigint")
        entries = entries.unionByName(gone.select("digest", (-F.col("refs")).alias("refs"),
                                                  F.lit(0).cast("bigint").alias("best_len"),
                                                  none.alias("best_id"), F.lit(0).cast("bigint").alias("best_uid")))
    updated = _sharded(entries, rows, keys_per_shard)
    if remaining is None:
        return updated
    order = F.struct(F.col("n_chars"), F.col("doc_id").isNotNull(), -F.col("doc_id"), -F.col(UID))     # as in _rank
    stays = F.struct(F.col("n_chars").alias("best_len"), F.col("doc_id").alias("best_id"), F.col(UID).alias("best_uid"))
    best = remaining.join(unknown, "digest", "left_semi").groupBy("digest").agg(F.max_by(stays, order).alias("stays"))
    looked_up = [F.when(F.col("best_len").isNull(), F.col(f"stays.{c}")).otherwise(F.col(c)).alias(c)
                 for c in ("best_len", "best_id", "best_uid")]
    return updated.join(best, "digest", "left").select("digest", "refs", *looked_up)


def last_row_number(keyed: DataFrame) -> int:
    """The highest row number of keyed rows, -1 of none."""
    last = keyed.agg(F.max(UID)).first()[0]
    return -1 if last is None else last


def keyed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", after: int = -1) -> DataFrame:
    """Rows ``(UID, doc_id, text_hash, digest, n_chars)``, written; row numbers are higher than ``after``. For a batch to
    add to an index, that is the ``last_row_number`` of the batches before."""
    return identified(docs, id_col, text_col, F.unhex(F.sha2(without_white_space(F.col(text_col)), 256)).alias("digest"),
                      F.char_length(F.coalesce(F.col(text_col), F.lit(""))).cast("bigint").alias("n_chars"), name="digests", first=after + 1)


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document, dropped ones too: ``doc_id, keep_id, group_size, kept, text_sha256`` (and the hash of
    the text as it is).

    Texts are equal when identical without white space.  The row with the most
    code points stays, then the smallest id.  Null text is empty text and equal
    to it; a null id loses every tie; of rows repeated with one id, one is kept.
    An empty table gives an empty result, extra columns are ignored."""
    keyed = keyed_documents(docs, id_col, text_col)
    return keyed.join(build_index(keyed), "digest").select(
        "doc_id", F.col("best_id").alias("keep_id"), F.col("refs").alias("group_size"),
        (F.col(UID) == F.col("best_uid")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"), "text_hash")


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns (the rules of ``exact_duplicates``)."""
    return keep_rows(docs, exact_duplicates(docs, id_col, text_col), id_col, text_col)
