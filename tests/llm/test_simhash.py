import random
import re

import pytest
import xxhash

from florapipe.llm.components import connected_components
from florapipe.llm.simhash import drop_near_duplicates, near_links, simhash, simhash_groups


def slow_simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, bits=2):
    label = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    return label


def expect(rows):
    prints = [slow_simhash(r[1]) for r in rows]
    label = components(prints)
    ids = {c: min((r[0] for r, x in zip(rows, label) if x == c and r[0] is not None), default=None) for c in set(label)}
    return sorted(((r[0], f"{p:016x}", ids[c]) for r, p, c in zip(rows, prints, label)), key=repr)


def test_against_brute_force(odd, documents):
    for df in (odd, documents):
        rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
        assert sorted((tuple(r)[:3] for r in simhash_groups(df).collect()), key=repr) == expect(rows)


def test_empty_and_columns(odd, empty):
    assert simhash_groups(empty).count() == 0
    assert drop_near_duplicates(empty).columns == odd.columns
    kept = drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    want = {r[2] for r in expect([tuple(r) for r in odd.select("doc_id", "text").collect()])}
    assert sorted((r["doc_id"] or -1 for r in kept.collect())) == sorted(x or -1 for x in want)


def clouds(n, seed):
    """Fingerprints in clouds around a few centres: many pairs at 0 to 4 bits."""
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(8)]
    out = {0, (1 << 64) - 1}
    while len(out) < n:
        x = rng.choice(centres)
        for _ in range(rng.randrange(5)):
            x ^= 1 << rng.randrange(64)
        out.add(x)
    return sorted(out)


@pytest.mark.parametrize("dense", [1, 10, 10_000])
def test_links_sparse_and_dense(spark, dense):
    prints = clouds(400, 3)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(s,) for s in signed], "fp bigint")
    edges = near_links(df, bits=2, segments=2, dense=dense)
    assert all(bin((r["a"] ^ r["b"]) & (2**64 - 1)).count("1") <= 2 or dense < 10_000 for r in edges.collect())
    found = {r["vertex"]: r["component"] for r in connected_components(edges).collect()}
    label, got = components(prints), {}
    for s, c in zip(signed, label):
        got.setdefault(c, set()).add(found.get(s, s))
    assert all(len(v) == 1 for v in got.values()) and len({next(iter(v)) for v in got.values()}) == len(got)


def test_three_segments_find_the_same(spark):
    signed = [p - (1 << 64) if p >> 63 else p for p in clouds(200, 9)]
    df = spark.createDataFrame([(s,) for s in signed], "fp bigint")
    pairs = [{(r["a"], r["b"]) if r["a"] < r["b"] else (r["b"], r["a"]) for r in near_links(df, 2, k).collect()} for k in (2, 3, 4)]
    assert pairs[0] == pairs[1] == pairs[2]


def test_components_of_a_long_chain(spark):
    n = 500
    edges = spark.createDataFrame([(i, i + 1) for i in range(n) if i % 100 != 99] + [(5, 5), (3, 4)], "a bigint, b bigint")
    found = {r["vertex"]: r["component"] for r in connected_components(edges.repartition(7)).collect()}
    assert found == {i: i // 100 * 100 for i in range(n + 1)} | {n: n} or found == {i: i // 100 * 100 for i in range(n)}


def test_long_text_in_blocks():
    text = " ".join(f"w{i % 991}" for i in range(250_000))
    assert simhash(text[:30_000].encode()) == slow_simhash(text[:30_000])
    assert simhash(text.encode()) == simhash(("  " + text.replace(" ", "\n\t")).upper().encode())
