import zlib
from collections import Counter, defaultdict

from florapipe.llm.sharding import shard


def cut_links(groups, place):
    """Links between equal texts whose ends are in two shards."""
    cut = 0
    for ids in groups.values():
        counts = Counter(place[i] for i in ids)
        cut += (len(ids) ** 2 - sum(n * n for n in counts.values())) // 2
    return cut


def propagate(groups, start, shards, quota, rounds=20):
    """Label propagation one document at a time: each moves to the shard of most of its neighbours that has room."""
    place, size = dict(start), Counter(start.values())
    for _ in range(rounds):
        moved = 0
        for ids in groups.values():
            counts = Counter(place[i] for i in ids)
            for i in ids:
                for s, n in counts.most_common():
                    if s == place[i] or n <= counts[place[i]]:
                        break
                    if size[s] < quota:
                        counts[place[i]] -= 1
                        size[place[i]] -= 1
                        place[i] = s
                        counts[s] += 1
                        size[s] += 1
                        moved += 1
                        break
        if not moved:
            break
    return place


def check(df, shards=24):
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    found = shard(df, shards).collect()
    size = lambda t: len((t or "").encode()) + 8
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == Counter(
        (i, size(t), zlib.crc32((t or "").encode())) for i, t in rows)
    slots = defaultdict(list)
    for r in found:
        slots[r["shard"]].append(r["slot"])
    counts = [len(slots[s]) for s in range(shards)]
    assert max(counts) - min(counts) <= 1 and set(slots) <= set(range(shards))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return found


def test_law_and_columns(documents, odd, empty):
    check(documents)
    check(odd)
    check(odd, shards=3)
    assert shard(empty).count() == 0


def test_equal_texts_stay_together(spark):
    df = spark.range(2400, numPartitions=6).selectExpr(
        "id AS doc_id", "CASE WHEN id < 800 THEN 'hot' WHEN id < 1600 THEN concat('group ', id % 200) ELSE concat('single ', id) END AS text")
    texts = {r["doc_id"]: r["text"] for r in df.collect()}
    places = defaultdict(set)
    for r in check(df):
        places[texts[r["doc_id"]]].add(r["shard"])
    groups = [len(p) for t, p in places.items() if t.startswith("group")]
    # at most one group is cut at each shard's end; the hot one needs 8 shards at least
    assert len(groups) == 200 and sum(n > 1 for n in groups) <= 24 and 8 <= len(places["hot"]) <= 12


def test_only_linked_documents(spark):
    df = spark.range(1200, numPartitions=3).selectExpr("id AS doc_id", "concat('pair ', id % 600) AS text")
    pairs = defaultdict(set)
    for r in check(df):
        pairs[r["text_crc32"]].add(r["shard"])
    assert sum(len(p) == 1 for p in pairs.values()) > 450


def test_fewer_links_are_cut_than_by_hashing(spark):
    """Against hashing, and against a propagation on the driver, document by document."""
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    groups = defaultdict(list)
    for r in df.collect():
        groups[r["text"]].append(r["doc_id"])
    groups = {t: ids for t, ids in groups.items() if len(ids) > 1}
    ids = [r["doc_id"] for r in df.select("doc_id").collect()]
    found = {r["doc_id"]: r["shard"] for r in check(df)}
    hashed = {i: zlib.crc32(str(i).encode()) % 24 for i in ids}
    links = sum(len(g) * (len(g) - 1) // 2 for g in groups.values())
    by_hash, by_moves = cut_links(groups, hashed), cut_links(groups, propagate(groups, hashed, 24, -(-len(ids) // 24)))
    cut = cut_links(groups, found)
    assert links > 20 and cut < 0.25 * by_hash and cut <= by_moves + 0.1 * links, (links, by_hash, by_moves, cut)
