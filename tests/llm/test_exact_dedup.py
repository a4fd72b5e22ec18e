import hashlib
import random
import re

from florapipe.llm.exact_dedup import (INDEX_SCHEMA, CuckooFilter, DigestIndex, Full, build_index, drop_exact_duplicates,
                                       _fold_here, exact_duplicates, keyed_documents, update_index)


def brute(rows):
    groups = {}
    for place, r in enumerate(rows):
        text = r[1] or ""
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text), []).append((-len(text), r[0] is None, r[0] or 0, place, r[0]))
    out = []
    for norm, g in groups.items():
        keep = min(g)
        out += [(x[4], keep[4], len(g), x is keep, hashlib.sha256(norm.encode()).hexdigest()) for x in g]
    return sorted(out, key=repr)


def test_against_brute_force(spark, odd, documents):
    for df in (odd, documents):
        rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
        assert sorted((tuple(r)[:5] for r in exact_duplicates(df).collect()), key=repr) == brute(rows)


def test_kept_rows_keep_their_columns(spark, odd, empty):
    kept = drop_exact_duplicates(odd)
    assert kept.columns == odd.columns
    # ids 1, 1 and 2 are equal and as long: one row of the smallest id; null, empty and blank: the longest
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == [-1, 1, 5, 6, 7, 8, 9]
    assert drop_exact_duplicates(empty).columns == odd.columns and drop_exact_duplicates(empty).count() == 0
    assert exact_duplicates(empty).count() == 0


def test_hot_text(spark):
    df = spark.range(3000, numPartitions=6).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'the same', concat('text ', id)) AS text")
    found = exact_duplicates(df)
    assert found.filter("kept").count() == 2001 and found.filter("keep_id = 0").count() == 1000


def digest(i):
    return hashlib.sha256(str(i).encode()).digest()


def test_filter_inserts_and_deletes():
    f = CuckooFilter(2000)
    for i in range(1500):
        f.insert(digest(i))
    assert all(digest(i) in f for i in range(1500))
    assert sum(digest(i) in f for i in range(1500, 21500)) < 100       # false hits of 16-bit fingerprints
    for i in range(0, 1500, 2):
        assert f.delete(digest(i))
    assert all(digest(i) in f for i in range(1, 1500, 2))
    assert sum(digest(i) in f for i in range(0, 1500, 2)) < 20


def test_filter_overflows_and_index_resizes():
    f = CuckooFilter(1)
    try:
        for i in range(10):
            f.insert(digest(i))
        raise AssertionError("never full")
    except Full:
        pass
    index = DigestIndex(capacity=1)
    for i in range(3000):
        assert index.insert(digest(i), 1, (1, True, -i, -i))
    assert index.resizes > 3 and index.size == 3000 and all(index.refs(digest(i)) == 1 for i in range(3000))


def test_index_against_a_dictionary():
    rng, index, live = random.Random(5), DigestIndex(4), {}
    for _ in range(8000):
        i = rng.randrange(700)
        if rng.random() < 0.6:
            assert index.insert(digest(i), 1, (1, True, -i, 0)) == (i not in live)
            live[i] = live.get(i, 0) + 1
        elif i in live:
            live[i] -= 1
            assert index.delete(digest(i)) == (live[i] == 0)
            live = {k: v for k, v in live.items() if v}
        else:
            assert not index.delete(digest(i))
    assert index.size == len(live) and all(index.refs(digest(i)) == live.get(i, 0) for i in range(700))


def test_a_small_bound_on_the_index_changes_nothing(spark):
    """Indexes of 100 digests at most, over a task's own rows and over shards, are the unbounded one."""
    docs = spark.range(3000, numPartitions=2).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('t ', id % 777) END AS text")
    keyed = keyed_documents(docs)
    parts = keyed.selectExpr("digest", "1L AS refs", "n_chars AS best_len", "doc_id AS best_id", "__uid AS best_uid").mapInArrow(_fold_here(100), INDEX_SCHEMA)
    assert 519 < parts.count() < 3000                          # flushed many times, and not row by row
    few, all_ = (sorted(map(tuple, build_index(keyed, n).collect())) for n in (100, 1 << 30))
    assert few == all_ and len(few) == 519


def test_stored_index_updates(spark):
    def keyed(values):
        df = spark.createDataFrame([(i, t) for i, t in values], "doc_id bigint, text string")
        return keyed_documents(df)
    index = build_index(keyed([(1, "a"), (2, "a"), (3, "b"), (4, "c")]))
    more = build_index(keyed([(5, "a"), (6, "d")]))
    gone = spark.createDataFrame([(hashlib.sha256(b"b").digest(), 1), (hashlib.sha256(b"a").digest(), 1)], "digest binary, refs bigint")
    found = {bytes(r["digest"]): r["refs"] for r in update_index(index, more, gone).collect()}
    assert found == {hashlib.sha256(t).digest(): n for t, n in ((b"a", 2), (b"c", 1), (b"d", 1))}


def test_deleting_the_row_that_stays(spark):
    from florapipe.llm.exact_dedup import last_row_number

    def keyed(rows, after=-1):
        return keyed_documents(spark.createDataFrame(rows, "doc_id bigint, text string"), after=after)

    def best(index):
        return {bytes(r["digest"]): (r["refs"], r["best_len"], r["best_id"], r["best_uid"]) for r in index.collect()}

    def of(text):
        return hashlib.sha256(text).digest()
    one = keyed([(1, "a"), (2, "a"), (3, "b"), (4, "c c"), (None, "cc"), (None, "cc")])
    two = keyed([(1, "a"), (2, " a"), (6, "d")], after=last_row_number(one))
    live = one.unionByName(two)
    assert live.select("__uid").distinct().count() == 9                 # no row of a batch is numbered as one of another
    number = {(r["doc_id"], r["n_chars"], bytes(r["digest"])): r["__uid"] for r in sorted(live.collect(), key=lambda r: -r["__uid"])}
    index = update_index(build_index(one), build_index(two))
    assert best(index)[of(b"a")] == (4, 2, 2, number[2, 2, of(b"a")])
    gone = spark.createDataFrame([(of(b"a"), 1), (of(b"cc"), 1), (of(b"b"), 1)], "digest binary, refs bigint")
    left = live.filter("not (doc_id <=> 2 and n_chars = 2 or doc_id <=> 3 or doc_id <=> 4)")
    want = {of(b"a"): (3, 1, 1, number[1, 1, of(b"a")]), of(b"cc"): (2, 2, None, number[None, 2, of(b"cc")]),
            of(b"d"): (1, 1, 6, number[6, 1, of(b"d")])}
    assert best(update_index(index, None, gone, remaining=left)) == want
    # without the rows that are left none is named, also after more insertions, until they are given
    later = update_index(index, None, gone)
    assert best(later)[of(b"a")] == (3, None, None, None) and best(later)[of(b"d")] == want[of(b"d")]
    three = keyed([(9, "a")], after=last_row_number(live))
    more = update_index(later, build_index(three))
    assert best(more)[of(b"a")] == (4, None, None, None)
    assert best(update_index(more, remaining=left.unionByName(three)))[of(b"a")] == (4, 1, *want[of(b"a")][2:])
