"""Ranked lexical search against a brute-force ranking."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import types as T

from florapipe.llm.lexical_search import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    have = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    sizes = [sum(c.values()) for _, c in have]
    n_docs, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in have for t in c)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    out = []
    for item, own in wanted.items():
        scored = []
        for (doc_id, c), n in zip(have, sizes):
            m = 100 - 90 + (90 * n * n_docs) // max(total, 1)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in own if c[t])
            if s > 0:
                scored.append((-s, doc_id is None, doc_id or 0))
        for rank, (s, none, doc_id) in enumerate(sorted(scored)[:k], 1):
            out.append((item, rank, None if none else doc_id, -s))
    return sorted(out, key=repr)


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


ITEM = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("term", T.StringType()), T.StructField("rank", T.StringType())])
ITEMS = [(1, "The CAT sat"), (2, "été 中文"), (3, None), (4, ""), (5, "nowhere-to-be-found"), (6, "word1 word2 word1"), (1, "mat"),
         (None, "row id"), (7, "ÉTÉ"), (8, "a\U0001f44db \x00 12"), (9, "\U0001f44d")]


def test_given_tables(spark, documents):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    want = brute([(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()],
                 [(r["item_id"], r["text"]) for r in items.collect()])
    assert len(want) > 100 and found(search(documents, items)) == want


def test_odd_input(spark, odd, empty):
    docs = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    items = spark.createDataFrame([(i, t, "x", "y") for i, t in ITEMS], ITEM)
    got = found(search(odd, items))
    assert got == brute(docs, ITEMS)
    assert {1, 2, 6, 7, 9, None} <= {r[0] for r in got} and not {3, 4, 5} & {r[0] for r in got}
    assert found(search(odd, items, k=1)) == brute(docs, ITEMS, k=1)
    assert search(empty, items).count() == 0 and search(odd, items.limit(0)).count() == 0
    assert search(empty, items).columns == search(odd, items.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]


def test_blocks_of_items_change_nothing(spark, odd):
    items = spark.createDataFrame([(i, t, "x", "y") for i, t in ITEMS], ITEM)
    assert found(search(odd, items, block_bytes=1)) == found(search(odd, items))


def test_boundaries(spark):
    """A term inside a longer one is no match, and neighbours share the blank between them."""
    docs = [(1, "cat"), (2, "cats concat cat_cat cat-cat"), (3, "catcat"), (4, "CAT cat Cat"), (5, "cat\x00dog\x7fcat"), (6, "catÉ É")]
    items = [(1, "cat"), (2, "dog cat"), (3, "É")]
    schema = "doc_id bigint, text string"
    got = found(search(spark.createDataFrame(docs, schema), spark.createDataFrame(items, "item_id bigint, text string")))
    assert got == brute(docs, items)
    assert {r[2] for r in got if r[0] == 1} == {1, 2, 4, 5} and {r[2] for r in got if r[0] == 3} == {6}


def test_ties_go_by_id(spark):
    docs = [(i, "same words here") for i in (9, 3, None, 7, 3, 1)] + [(100, "other")]
    got = search(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5),
                 spark.createDataFrame([(1, "words")], "item_id bigint, text string"), k=5).orderBy("rank").collect()
    assert [r["doc_id"] for r in got] == [1, 3, 3, 7, 9] and len({r["score"] for r in got}) == 1


@pytest.mark.parametrize("long", [200_000])
def test_very_long_text(spark, long):
    docs = [(1, "needle " + "hay " * long + "needle"), (2, "needle hay"), (3, "hay")]
    got = found(search(spark.createDataFrame(docs, "doc_id bigint, text string"),
                       spark.createDataFrame([(1, "needle")], "item_id bigint, text string")))
    assert got == brute(docs, [(1, "needle")]) and len(got) == 2
