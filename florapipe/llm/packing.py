"""Best-fit packing of token sequences by hierarchical residual packing (operator 7).

Every task tokenizes its documents, cuts the long ones into full pieces and
best-fits the rest into bins of its own.  Nearly full bins are emitted.  The
underfull ones become items of a tree: groups of tasks, then groups of those,
best-fit them again, until one node is left.

What climbs the tree is not bins but counts of bins by fill, at most one row
per length and child, however many bins there are; a node packs the counts and
writes down which ranks of a fill go into which of its bins.  Bins then look up
their place by rank, level by level.
"""

from __future__ import annotations

import math
import os
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from florapipe.llm.common import per_worker
from florapipe.session import materialize

END_ID = 0
#: Bins at least so full are emitted by the node that made them.
NEARLY_FULL = 0.995
#: Children of a node of the tree.
FAN_IN = 16
#: Words whose ids a task remembers at a time.
CACHE_WORDS = 500_000

PIECES = ("doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, "
          "leaf bigint, fill bigint, rank bigint, offset bigint")


class WordTokens:
    """Token ids of whole texts, as bytes of little-endian unsigned 32-bit numbers.

    For lower-casing tokenizers whose tokens never cross white space, which
    they drop, nor the step from a letter or digit to punctuation (but an
    apostrophe, which may begin a token with letters): texts are cut there,
    and each distinct word is encoded once and then looked up."""

    STEP = re.compile(rb"(?<=[A-Za-z0-9])(?=[!-&(-/:-@\[-`{-~])")
    #: A capital and a character that may be a mark on it (from U+0300 on): the tokenizer composes them before it
    #: lower-cases, and some pairs compose in lower case only, so a word with one is not lower-cased here.
    MARKED = re.compile(rb"[A-Z][\xcc-\xff]")
    #: Bytes of text looked up together, and words encoded together.
    CHUNK, BATCH = 1 << 20, 2_000

    def __init__(self, path: str, cache_words: int = CACHE_WORDS, separator: str = "<|endoftext|>"):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.cache_words = cache_words
        self.separator, self.separator_id = separator, self.tokenizer.token_to_id(separator)
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.ends_word[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.known: dict[bytes, bytes] = {}

    def encode_all(self, texts: Iterable[bytes | None]) -> Iterator[bytes]:
        chunk, size = [], 0
        for t in texts:
            chunk.append(t or b"")
            size += len(chunk[-1])
            if size >= self.CHUNK:
                yield from self._chunk(chunk)
                chunk, size = [], 0
        yield from self._chunk(chunk)

    def _chunk(self, texts: list[bytes]) -> Iterator[bytes]:
        # a text with what may be a special token's string is encoded whole
        words = [None if b"<|" in t else self._words(t) for t in texts]
        distinct = set().union(*(w for w in words if w))
        missing = distinct - self.known.keys()
        if len(self.known) + len(missing) > self.cache_words:
            # the words met first are the frequent ones: that half stays
            self.known = dict(islice(self.known.items(), self.cache_words // 2))
            missing = distinct - self.known.keys()
        self._learn(missing)
        get = self.known.__getitem__
        for t, w in zip(texts, words):
            yield self._whole(t) if w is None else b"".join(map(get, w))

    def _words(self, text: bytes) -> list[bytes]:
        if text.isascii() or not self.MARKED.search(text):
            return self.STEP.sub(b" ", text.lower()).split()
        return [w if self.MARKED.search(w) else w.lower() for w in self.STEP.sub(b" ", text).split()]

    def _whole(self, text: bytes) -> bytes:
        return self._ids(text.decode("utf-8", "replace")).tobytes()

    def _learn(self, missing: set[bytes]) -> None:
        known = self.known
        plain, other = [], []
        for w in missing:
            text = w.decode("utf-8", "replace")
            (plain if text.isalpha() else other).append((w, text))
        for i in range(0, len(plain), self.BATCH):
            part = plain[i:i + self.BATCH]
            ids = self._ids(" ".join(text for _, text in part))
            ends = (4 * (np.flatnonzero(self.ends_word[ids]) + 1)).tolist()
            if len(ends) == len(part):      # a word of letters is one unit, whose last token ends a word
                data = ids.tobytes()
                for (w, _), start, end in zip(part, [0, *ends], ends):
                    known[w] = data[start:end]
            else:
                other += part
        for i in range(0, len(other), self.BATCH):
            part = other[i:i + self.BATCH]
            ids = self._ids(self.separator.join(text for _, text in part))
            cuts, data = (4 * np.flatnonzero(ids == self.separator_id)).tolist(), ids.tobytes()
            for (w, _), start, end in zip(part, [-4, *cuts], [*cuts, len(data)]):
                known[w] = data[start + 4:end]

    def _ids(self, text: str) -> np.ndarray:
        # the fast form gives the same ids without their places in the text
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")


def best_fit(sizes: list[tuple[int, int]], capacity: int) -> tuple[list[tuple], list[list]]:
    """Best-fit decreasing of classes ``(size, count)`` into bins of ``capacity``.

    Returns placements ``(size, rank from, rank to, bin class, first bin's rank
    in it, offset)`` and the classes ``[fill, count]``.  All bins of a class
    have the same content; a run of equal items goes into a run of equal bins,
    so the work follows the number of classes, not of items."""
    classes: list[list] = []                   # [fill, count]
    placed: list[list[tuple]] = []             # per class: (size, rank of the item in its first bin, offset)
    free: list[tuple[int, int]] = []           # (room, class), classes that hold bins, by room
    for size, count in sorted(sizes, reverse=True):
        rank = 0
        while rank < count:
            at = bisect_left(free, (size, -1))
            if at == len(free):                # no room: new bins, as many items of this size in each as fit
                each = min(capacity // size, count - rank)
                bins = (count - rank) // each
                classes.append([size * each, bins])
                placed.append([(size, rank + bins * i, size * i) for i in range(each)])
                rank += bins * each
                if capacity > size * each:
                    insort(free, (capacity - size * each, len(classes) - 1))
                continue
            room, c = free.pop(at)
            bins, left = classes[c]
            each = min(room // size, count - rank)   # a bin that just took one is the tightest for the next
            use = min(left, (count - rank) // each)
            if use < left:                     # the last bins of the class stay as they are
                classes[c] = [bins, left - use]
                moved = [(s, r, o) for s, r, o in placed[c]]
                placed[c] = [(s, r + use, o) for s, r, o in placed[c]]
                insort(free, (room, c))
                classes.append([bins, use])
                placed.append(moved)
                c = len(classes) - 1
            placed[c] = placed[c] + [(size, rank + use * i, bins + size * i) for i in range(each)]
            rank += use * each
            classes[c] = [bins + size * each, use]
            if room > size * each:
                insort(free, (room - size * each, c))
    out = [(s, r, r + classes[c][1], c, 0, o) for c, items in enumerate(placed) for s, r, o in items]
    return out, classes


def _leaf(path: str, capacity: int):
    """Tokenize, cut and pack the documents of one task; the leaf is the task's partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = per_worker(("word tokens", path), lambda: WordTokens(path))
        columns: list[list] = [[], [], [], [], []]
        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), tokens.encode_all(t.as_py() for t in batch.column(1))):
                ids += END_ID.to_bytes(4, "little")
                for piece, start in enumerate(range(0, len(ids), 4 * capacity)):
                    cut = ids[start:start + 4 * capacity]
                    for column, value in zip(columns, (doc_id, piece, start // 4, len(cut) // 4, zlib.crc32(cut))):
                        column.append(value)
        length = np.array(columns[3], np.int64)
        if not len(length):
            return
        order = np.argsort(-length, kind="stable")
        sizes, first, counts = np.unique(-length[order], return_index=True, return_counts=True)
        begin = {int(-s): int(f) for s, f in zip(sizes, first)}
        placements, classes = best_fit([(int(-s), int(c)) for s, c in zip(sizes, counts)], capacity)
        # bins of equal fill are numbered on across their classes: (fill, rank) names a bin of this leaf
        base, seen = [], {}
        for fill, n in classes:
            base.append(seen.get(fill, 0))
            seen[fill] = seen.get(fill, 0) + n
        fill, rank, offset = (np.empty(len(length), np.int64) for _ in range(3))
        for size, lo, hi, c, _, at in placements:
            items = order[begin[size] + lo:begin[size] + hi]
            fill[items], rank[items], offset[items] = classes[c][0], base[c] + np.arange(hi - lo), at
        leaf = np.full(len(length), TaskContext.get().partitionId(), np.int64)
        table = pa.table([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()),
                          pa.array(columns[2], pa.int64()), pa.array(length), pa.array(columns[4], pa.int64()),
                          pa.array(leaf), pa.array(fill), pa.array(rank), pa.array(offset)],
                         ["doc_id", "piece", "start", "length", "ids_crc32", "leaf", "fill", "rank", "offset"])
        yield from table.to_batches(max_chunksize=50_000)
    return run


NODE = ("node bigint, child bigint, fill bigint, lo bigint, hi bigint, to_fill bigint, to_rank bigint, shift bigint")


def _node(capacity: int):
    """Pack one node's counts ``(child, fill, n)``: which ranks of a child's fill go to which bins of the node."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["fill", "child"], ascending=[False, True])
        totals = pdf.groupby("fill")["n"].sum()
        placements, classes = best_fit([(int(f), int(n)) for f, n in totals.items()], capacity)
        base, seen = [], {}
        for fill, n in classes:
            base.append(seen.get(fill, 0))
            seen[fill] = seen.get(fill, 0) + n
        by_fill: dict[int, list[tuple]] = {}
        for size, lo, hi, c, _, at in placements:
            by_fill.setdefault(size, []).append((lo, hi, classes[c][0], base[c], at))
        out = []
        for fill, group in pdf.groupby("fill", sort=False):
            spans, i, begin = sorted(by_fill[int(fill)]), 0, 0
            for child, n in zip(group["child"], group["n"]):     # the children's bins of a fill, one after the other
                end = begin + int(n)
                while i < len(spans):
                    lo, hi, to_fill, to_rank, at = spans[i]
                    a, b = max(lo, begin), min(hi, end)
                    if a < b:
                        out.append((child, fill, a - begin, b - begin, to_fill, to_rank + a - lo, at))
                    if hi > end:
                        break
                    i += 1
                begin = end
        frame = pd.DataFrame(out, columns=["child", "fill", "lo", "hi", "to_fill", "to_rank", "shift"])
        frame.insert(0, "node", pdf["node"].iloc[0])
        return frame.astype("int64")
    return run


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text",
         nearly_full: float = NEARLY_FULL, fan_in: int = FAN_IN) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    A document's ids end in id 0; only documents longer than ``capacity`` are
    cut, into pieces of ``capacity`` and a rest.  Null and empty texts are the
    single id 0.  Repeated rows are packed each on its own; an empty table
    gives an empty result; extra columns are ignored."""
    threshold = math.ceil(nearly_full * capacity)
    leaves = materialize(docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("binary"))
                         .mapInArrow(_leaf(tokenizer_path, capacity), PIECES), "pack_leaves")
    bins = leaves.groupBy("leaf", "fill").agg((F.max("rank") + 1).alias("n")).withColumnRenamed("leaf", "child")
    bins = materialize(bins, "pack_bins")
    placed = leaves.withColumns({"level": F.lit(0), "at": F.col("leaf")})
    level, nodes = 0, (bins.agg(F.max("child")).first()[0] or 0) + 1
    bases = [0]
    while nodes > 1:
        bases.append(bases[-1] + nodes)
        level, nodes = level + 1, -(-nodes // fan_in)
        steps = materialize(
            bins.filter(F.col("fill") < threshold).withColumn("node", F.floor(F.col("child") / fan_in))
            .groupBy("node").applyInPandas(_node(capacity), NODE), "pack_steps")
        s = steps.select(F.col("child").alias("at"), F.col("fill"), "lo", "hi", "node", "to_fill", "to_rank", "shift")
        # only bins that the last level made and left underfull are moved
        moving = placed.filter((F.col("level") == level - 1) & (F.col("fill") < threshold))
        moved = (moving.join(s, ["at", "fill"]).filter("rank >= lo and rank < hi")
                 .select(*leaves.drop("leaf", "fill", "rank", "offset").columns,
                         F.col("leaf"), F.col("to_fill").alias("fill"), (F.col("to_rank") + F.col("rank") - F.col("lo")).alias("rank"),
                         (F.col("offset") + F.col("shift")).alias("offset"), F.lit(level).alias("level"), F.col("node").alias("at")))
        still = placed.filter((F.col("level") < level - 1) | (F.col("fill") >= threshold))
        placed = materialize(still.unionByName(moved), "pack_placed")
        bins = materialize(steps.groupBy(F.col("node").alias("child"), F.col("to_fill").alias("fill"))
                           .agg(F.max(F.col("to_rank") + F.col("hi") - F.col("lo")).alias("n")), "pack_bins")
    # a bin's name (node of the tree, fill, rank) in one number; nodes are numbered on from level to level
    node = F.element_at(F.array(*[F.lit(b) for b in bases]), F.col("level") + 1) + F.col("at")
    sequence = (node * F.lit(capacity + 1) + F.col("fill")) * F.lit(1 << 31) + F.col("rank")
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", sequence.alias("sequence_id"), "offset")
