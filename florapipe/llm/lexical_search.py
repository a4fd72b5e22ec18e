"""Ranked lexical search by an Aho-Corasick scan of the documents (operator 11).

The terms of the items make one automaton, each guarded by a boundary on both
sides, so that it finds whole terms only.  It is broadcast and run over the
texts themselves: no index of the documents is built, written or shuffled.  A
first scan counts what the weights need: documents, terms, and documents per
item term, added up in each task.  A second scan counts every term's
occurrences again, maps them to the items that hold the term, and keeps each
task's best documents per item; only these meet in a shuffle.

Items come in blocks of a bounded number and of a bounded size of terms; each
block is one automaton and two scans.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from florapipe.session import materialize

#: What is no part of a term, and the lower-casing of the contract.
NOT_TERM = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: One byte for each byte of a text in UTF-8: terms in lower case, a space for all else.
PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))

#: A block of items: bytes of terms, and items. An item is never cut, so the block of a larger one holds that item alone.
BLOCK_BYTES = 1 << 22
BLOCK_ITEMS = 1 << 12
#: Scores held at a time in a task, and documents at a time.
CELLS = 1 << 20
DOCS = 1 << 9
#: Tasks whose best documents meet in one group, before all of an item's do.
FAN_IN = 64


class Block(NamedTuple):
    """Items, their terms' automaton (a term's value is its number), and the items of each term as flat lists."""
    items: list[int | None]
    terms: int
    automaton: ahocorasick.Automaton
    starts: np.ndarray
    holders: np.ndarray


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(item_id, term)``, each once, an item's together."""
    lower = F.translate(F.col(text_col).cast("string"), UPPER, LOWER)
    return (items.select(F.col(id_col).cast("bigint").alias("item_id"),
                         F.explode(F.regexp_extract_all(lower, F.lit(f"[^{NOT_TERM}]+"), F.lit(0))).alias("term"))
            .distinct().orderBy("item_id", "term"))


def _blocks(terms: DataFrame, block_bytes: int) -> Iterator[Block]:
    """Blocks as the driver reads them, one at a time."""
    held: list[tuple[int | None, list[str]]] = []
    size = 0
    for item, rows in groupby(terms.toLocalIterator(), key=itemgetter("item_id")):
        own = [r["term"] for r in rows]
        more = sum(len(t.encode()) + 2 for t in own)
        if held and (size + more > block_bytes or len(held) == BLOCK_ITEMS):
            yield _block(held)
            held, size = [], 0
        held.append((item, own))
        size += more
    if held:
        yield _block(held)


def _block(held: list[tuple[int | None, list[str]]]) -> Block:
    numbers: dict[str, list[int]] = {}
    for i, (_, own) in enumerate(held):
        for term in own:
            numbers.setdefault(term, []).append(i)
    automaton = ahocorasick.Automaton()
    for k, term in enumerate(numbers):
        automaton.add_word(" " + term.encode().decode("latin-1") + " ", k)
    automaton.make_automaton()
    lengths = [len(v) for v in numbers.values()]
    return Block([item for item, _ in held], len(numbers), automaton,
                 np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64),
                 np.array([i for v in numbers.values() for i in v], np.int64))


def _counted(automaton: ahocorasick.Automaton, text: bytes | None) -> tuple[int, Counter]:
    """Terms of a text, and how often each of the automaton's stands in it."""
    if not text:
        return 0, Counter()
    plain = b" " + text.translate(PLAIN) + b" "
    blank = np.frombuffer(plain, np.uint8) == 32
    n = int(np.count_nonzero(blank[:-1] & ~blank[1:]))
    return n, Counter(map(itemgetter(1), automaton.iter(plain.decode("latin-1"))))


def _statistics(block):
    """First scan: documents with a term (-2), all their terms (-1), documents per item term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = block.value
        documents = total = 0
        holding: Counter = Counter()
        for batch in batches:
            for text in batch.column(1).cast(pa.binary()):
                n, found = _counted(b.automaton, text.as_py())
                documents += n > 0
                total += n
                holding.update(found.keys())
        yield pa.RecordBatch.from_arrays([pa.array([-2, -1, *holding.keys()], pa.int64()),
                                          pa.array([documents, total, *holding.values()], pa.int64())], ["term", "n"])
    return run


class _Best:
    """The ``k`` best documents per item so far: score from the highest, then doc_id, null last."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.rows = np.empty((4, 0), np.int64)             # item, score, 1 if the id is null, id
        self.least = np.ones(items, np.int64)              # a score below it comes too late

    def add(self, scores: np.ndarray, null: np.ndarray, ids: np.ndarray) -> None:
        doc, item = np.nonzero(scores >= self.least)
        if not len(doc):
            return
        rows = np.concatenate([self.rows, np.stack([item, scores[doc, item], null[doc], ids[doc]])], axis=1)
        rows = rows[:, np.lexsort((rows[3], rows[2], -rows[1], rows[0]))]
        first = np.searchsorted(rows[0], rows[0])
        place = np.arange(rows.shape[1]) - first
        last = place == self.k - 1
        self.least[rows[0, last]] = rows[1, last]
        self.rows = rows[:, place < self.k]


def _scores(b: Block, found: list[Counter], weight: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Documents by items, in whole numbers."""
    doc = np.repeat(np.arange(len(found)), [len(f) for f in found])
    term = np.fromiter((t for f in found for t in f), np.int64, len(doc))
    tf = np.fromiter((n for f in found for n in f.values()), np.int64, len(doc))
    part = weight[term] * ((1_000_000_000 * tf) // (1_000 * tf + 8 * m[doc]))
    size = b.starts[term + 1] - b.starts[term]             # a term's part goes to each of its items
    at = np.repeat(b.starts[term] - (np.cumsum(size) - size), size) + np.arange(size.sum())
    scores = np.zeros(len(found) * len(b.items), np.int64)
    np.add.at(scores, np.repeat(doc, size) * len(b.items) + b.holders[at], np.repeat(part, size))
    return scores.reshape(len(found), len(b.items))


def _rank(block, weight, documents: int, total: int, k: int):
    """Second scan: each task's best documents per item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b, w = block.value, weight.value
        best = _Best(len(b.items), k)
        step = max(1, min(DOCS, CELLS // len(b.items)))
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            null = np.array(batch.column(0).is_null(), np.int64)
            ids = np.array(batch.column(0).fill_null(0), np.int64)
            for i in range(0, batch.num_rows, step):
                found, m = [], []
                for text in texts.slice(i, step):
                    n, hits = _counted(b.automaton, text.as_py())
                    found.append(hits)
                    m.append(10 + 90 * n * documents // max(total, 1))
                best.add(_scores(b, found, w, np.array(m, np.int64)), null[i:i + step], ids[i:i + step])
        item, score, none, ids = best.rows
        names = [b.items[i] for i in item]
        yield pa.RecordBatch.from_arrays(
            [pa.array(item), pa.array(names, pa.int64()), pa.array(ids, pa.int64(), mask=none.astype(bool)), pa.array(score)],
            ["item", "item_id", "doc_id", "score"])
    return run


def search(docs: DataFrame, items: DataFrame, k: int = 10, doc_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The ``k`` best documents of each item: ``item_id, rank, doc_id, score``.

    Rows of ``items`` with one id (null too) are one item with the terms of
    all; an item without a term, or whose terms no document holds, has no row.
    Every row of ``docs`` is a document of its own, repeated rows and null ids
    included; null and empty texts hold no term and do not count as documents.
    Equal scores go by ascending ``doc_id``, null last; rows that still tie are
    alike.  Empty tables give an empty result; extra columns are ignored."""
    spark = docs.sparkSession
    texts = docs.select(F.col(doc_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    parts = []
    for b in _blocks(materialize(item_terms(items, item_col, item_text_col), "search_terms").orderBy("item_id", "term"), block_bytes):
        block = spark.sparkContext.broadcast(b)            # bounded by the block
        counts = texts.mapInArrow(_statistics(block), "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
        n = {r["term"]: r["n"] for r in counts.collect()}  # one row per term of the block
        documents, total = n.get(-2, 0), n.get(-1, 0)
        weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * n.get(t, 0) + 1))) for t in range(b.terms)], np.int64)
        weights = spark.sparkContext.broadcast(weight)
        found = texts.mapInArrow(_rank(block, weights, documents, total, k),
                                 "item bigint, item_id bigint, doc_id bigint, score bigint")
        order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
        near = Window.partitionBy("item", "part").orderBy(*order)
        found = (found.withColumn("part", F.floor(F.spark_partition_id() / FAN_IN))
                 .withColumn("place", F.row_number().over(near)).filter(F.col("place") <= k))
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= k)
        parts.append(materialize(found.select("item_id", "rank", "doc_id", "score"), "search_ranks"))
        block.unpersist()
        weights.unpersist()
    if not parts:
        return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
