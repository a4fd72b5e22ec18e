import re
from collections import Counter

from florapipe.llm.mixing import mix, mix_counts


def targets(sizes, weights=(1, 2, 3), most=3):
    """By repeated sharing, as the contract says it."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        rest = total - sum(fixed.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > most * sizes[s]]
        if not over:
            return {**share, **fixed}
        fixed.update({s: most * sizes[s] for s in over})


def check(df, tolerance):
    texts = [(r["doc_id"], len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")), r["source"]) for r in df.collect()]
    sizes = Counter()
    for _, n, s in texts:
        sizes[s] += n
    want = targets(dict(sizes))
    found = mix_counts(df).collect()
    assert Counter((r["doc_id"], r["size"], r["source_size"]) for r in found) == Counter((i, n, sizes[s]) for i, n, s in texts)
    by_id = {i: s for i, _, s in texts}
    taken = Counter()
    for r in found:
        s = by_id[r["doc_id"]]
        assert abs(r["target"] - want[s]) <= 1e-9 * max(1, want[s]) and 0 <= r["copies"] <= 3
        taken[s] += r["copies"] * r["size"]
    assert all(abs(taken[s] - want[s]) <= tolerance * want[s] + 5 for s in sizes)
    again = Counter(tuple(r) for r in mix_counts(df.repartition(5)).collect())
    assert again == Counter(tuple(r) for r in found)
    return found


def test_targets_and_copies(spark, documents):
    check(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), 0.05)
    check(documents, 0.5)


def test_limits_and_a_hot_source(spark):
    df = spark.range(6000, numPartitions=5).selectExpr(
        "id AS doc_id", "CASE WHEN id < 4000 THEN 'hot' WHEN id < 4010 THEN 'tiny' WHEN id < 5000 THEN NULL ELSE concat('s', id % 4) END AS source",
        "repeat('w ', 1 + cast(id % 7 AS int)) AS text")
    found = check(df, 0.03)
    tiny = [r for r in found if 4000 <= r["doc_id"] < 4010]
    assert all(r["copies"] == 3 and r["target"] == 3.0 * r["source_size"] for r in tiny)


def test_odd_rows(odd, empty):
    found = mix_counts(odd).collect()
    assert len(found) == odd.count()
    rows = mix(odd)
    assert rows.columns == odd.columns and rows.count() == sum(r["copies"] for r in found)
    assert mix_counts(empty).count() == 0 and mix(empty).count() == 0
