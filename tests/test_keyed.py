"""Keyed tables: one commit for all buckets, growth, crashes between any two steps, the index of ids."""

import os

import pytest
from pyspark.sql import functions as F

from florapipe.sources import keyed
from tests.conftest import rows


def base(spark, n=500):
    return spark.range(0, n).selectExpr("id AS k", "id * 2 AS v", "1 AS seq")


def numbers(df):
    return sorted(r["k"] for r in df.collect())


def files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(f"{path}/data") for f in names if f.endswith(".parquet")}


def test_small_batch_rewrites_its_buckets_only(spark, tmp_path):
    path = str(tmp_path / "t")
    assert keyed.read_table(spark, path) is None
    assert len(keyed.upsert_into(spark, path, base(spark), ["k"], "seq", buckets=16)) == 16
    ids = {r["k"]: r["id"] for r in keyed.read_table(spark, path).collect()}
    before = keyed.current(spark, path)
    batch = spark.createDataFrame([(7, None, 1), (7, -1, 2), (9001, 5, 1)], "k bigint, v bigint, seq int")
    touched = keyed.upsert_into(spark, path, batch, ["k"], "seq")
    assert 1 <= len(touched) <= 2
    after = keyed.current(spark, path)
    assert {b for b in before.parts if before.parts[b] != after.parts[b]} == set(touched)
    once = rows(keyed.read_table(spark, path).select("k", "v", "id"))
    assert len(once) == 501 and (7, -1, ids[7]) in once
    keyed.upsert_into(spark, path, batch, ["k"], "seq")
    assert rows(keyed.read_table(spark, path).select("k", "v", "id")) == once
    assert sum(keyed.current(spark, path).rows.values()) == 501


def test_insert_appends_new_keys_once(spark, tmp_path):
    path = str(tmp_path / "c")
    one = spark.createDataFrame([(1, "a", 0), (1, "b", 1), (1, "a", 2)], "s int, u string, o int")
    for _ in range(2):
        keyed.insert_into(spark, path, one, ["s", "u"], ["o"])
    more = spark.createDataFrame([(1, "b", 9), (2, "b", 0)], "s int, u string, o int")
    keyed.insert_into(spark, path, more, ["s", "u"], ["o"])
    assert rows(keyed.read_table(spark, path).select("s", "u", "o")) == [(1, "a", 0), (1, "b", 1), (2, "b", 0)]
    keyed.insert_into(spark, path, one.limit(0), ["s", "u"], ["o"])
    assert keyed.current(spark, path).number == 2


def test_layout_is_the_table_s_own(spark, tmp_path):
    """A later call with another number of buckets finds the keys where they are."""
    path = str(tmp_path / "t")
    keyed.upsert_into(spark, path, base(spark, 50), ["k"], "seq", buckets=8)
    keyed.upsert_into(spark, path, base(spark, 3), ["k"], "seq", buckets=16)
    keyed.insert_into(spark, path, keyed.read_table(spark, path).filter("k < 9").drop("bucket"), ["k"], ["v"], buckets=32)
    assert keyed.read_table(spark, path).count() == 50


@pytest.mark.parametrize("insert", [False, True])
def test_buckets_grow_with_the_table(spark, tmp_path, insert):
    """A bucket over the bound is split by the next bits of the hash; keys stay unique, however the table came to its size."""
    path = str(tmp_path / "t")
    sizes = []
    for n in (20, 330, 420):
        if insert:
            keyed.insert_into(spark, path, base(spark, n), ["k"], ["v"], buckets=2, bucket_rows=50)
        else:
            keyed.upsert_into(spark, path, base(spark, n), ["k"], "seq", buckets=2, bucket_rows=50)
        now = keyed.current(spark, path)
        sizes.append(len(now.parts))
        table = keyed.read_table(spark, path)
        assert numbers(table) == list(range(n))
        assert keyed._counts(table) == {b: c for b, c in now.rows.items() if c}
    assert sizes == sorted(sizes) and sizes[-1] > 8
    assert len({keyed._level(b)[0] for b in now.parts}) > 1, sizes
    found = keyed.rows_of_keys(spark, path, spark.createDataFrame([(3,), (417,)], "k bigint"), ["k"])
    assert {3, 417} <= {r["k"] for r in found.collect()} and found.count() < 150
    one = spark.createDataFrame([(400, -1, 9)], "k bigint, v bigint, seq int")
    if not insert:
        [touched] = keyed.upsert_into(spark, path, one, ["k"], "seq")
        assert keyed.read_table(spark, path, [touched]).filter("k = 400").first()["v"] == -1
        assert keyed.read_table(spark, path).count() == 420


def test_a_large_bucket_is_written_by_several_tasks(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8k")
    try:
        write = keyed._write_parts(spark.range(40_000).selectExpr(
            "id", "md5(cast(id AS string)) AS v", "if(id < 10, 'm1r1', 'm1r0') AS bucket").repartition(8), path)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    large, small = (len([f for f in files(path) if f"w={write}/bucket={b}/" in f]) for b in ("m1r0", "m1r1"))
    assert large > 3 and small == 1


def test_many_small_inserts_are_written_together(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    monkeypatch.setattr(keyed, "PARTS", 3)
    for i in range(keyed.PARTS + 2):
        keyed.insert_into(spark, path, spark.createDataFrame([(i,)], "k bigint"), ["k"], ["k"], buckets=1)
    assert len(keyed.current(spark, path).parts["m1r0"]) == 2
    assert numbers(keyed.read_table(spark, path)) == list(range(keyed.PARTS + 2))


STEPS = [("t", "_write_parts", True), ("t", "_commit", True), ("t/ids", "_write_parts", True), ("t/ids", "_commit", True)]


@pytest.mark.parametrize("where,step,late", STEPS)
def test_crash_between_steps(spark, tmp_path, monkeypatch, where, step, late):
    """A writer that dies before or after any step, of the table or of its ids, leaves the table as it was, or as the
    batch makes it; a rerun ends right."""
    path = str(tmp_path / "t")
    real = getattr(keyed, step)

    def dies(*args):
        here = str(tmp_path / where) in args
        done = real(*args) if late or not here else None
        if here:
            raise RuntimeError("died")
        return done

    batch = spark.createDataFrame([(3, -3, 2), (700, 7, 2)], "k bigint, v bigint, seq int")
    states = [[], [(i, 2 * i) for i in range(40)], sorted([(i, -3 if i == 3 else 2 * i) for i in range(40)] + [(700, 7)], key=repr)]
    for n, source in ((1, base(spark, 40)), (2, batch)):
        monkeypatch.setattr(keyed, step, dies)
        with pytest.raises(RuntimeError, match="died"):
            keyed.upsert_into(spark, path, source, ["k"], "seq", buckets=2, bucket_rows=16)
        monkeypatch.setattr(keyed, step, real)
        table = keyed.read_table(spark, path)
        now = [] if table is None else rows(table, "k", "v")
        committed = where == "t" and step == "_commit" and late
        assert now == sorted(states[n if committed else n - 1], key=repr)
        keyed.upsert_into(spark, path, source, ["k"], "seq", buckets=2, bucket_rows=16)
        assert rows(keyed.read_table(spark, path), "k", "v") == sorted(states[n], key=repr)


@pytest.mark.parametrize("step", ["_write_parts", "_commit"])
def test_crashed_insert(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "t")
    keyed.insert_into(spark, path, base(spark, 30), ["k"], ["v"], buckets=4, bucket_rows=10)
    real = getattr(keyed, step)
    monkeypatch.setattr(keyed, step, lambda *a: (real(*a) if step == "_write_parts" else None, 1 / 0))
    with pytest.raises(ZeroDivisionError):
        keyed.insert_into(spark, path, base(spark, 60), ["k"], ["v"], bucket_rows=10)
    monkeypatch.setattr(keyed, step, real)
    assert numbers(keyed.read_table(spark, path)) == list(range(30))
    keyed.insert_into(spark, path, base(spark, 60), ["k"], ["v"], bucket_rows=10)
    assert numbers(keyed.read_table(spark, path)) == list(range(60))


def test_two_writers_do_not_make_one_commit(spark, tmp_path):
    path = str(tmp_path / "t")
    keyed.upsert_into(spark, path, base(spark, 5), ["k"], "seq", buckets=1)
    with pytest.raises(RuntimeError, match="another writer"):
        keyed._commit(spark, path, keyed.current(spark, path))


def test_files_that_readers_hold_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    held = []
    for n in range(5):
        keyed.upsert_into(spark, path, base(spark, 10 + n), ["k"], "seq", buckets=2, index_ids=False)
        held.append(keyed.read_table(spark, path))
    assert [t.count() for t in held[-keyed.KEEP:]] == [15 - keyed.KEEP + i for i in range(keyed.KEEP)]
    assert len(keyed._numbers(spark, path)) == keyed.KEEP
    named = {w for n in keyed._numbers(spark, path) for p in keyed._load(spark, path, n).parts.values() for w in p}
    assert {f.split("/w=")[1].split("/")[0] for f in files(path)} == named


def test_an_id_collision_is_found_in_the_touched_buckets(spark, tmp_path):
    path = str(tmp_path / "t")
    by_tens = lambda keys: F.floor(F.col(keys[0]) / 10).cast("bigint")
    tens = spark.range(0, 1000, 10).selectExpr("id AS k", "id AS v", "1 AS seq")
    keyed.upsert_into(spark, path, tens, ["k"], "seq", id_fn=by_tens, buckets=4)
    keyed.upsert_into(spark, path, tens, ["k"], "seq", id_fn=by_tens)                       # the same keys again: no collision
    before = rows(keyed.read_table(spark, path))
    one = lambda *k: spark.createDataFrame([(i, 0, 2) for i in k], "k bigint, v bigint, seq int")
    for clash in (one(777), one(5001, 5002)):                                               # with an old key, within the batch
        with pytest.raises(ValueError, match="share"):
            keyed.upsert_into(spark, path, clash, ["k"], "seq", id_fn=by_tens)
        assert rows(keyed.read_table(spark, path)) == before
    touched = keyed._touched(keyed._bucketed(one(777).withColumn("id", by_tens(["k"])), ["id"], list(keyed.current(spark, f"{path}/ids").parts)))
    assert len(touched) == 1
    keyed.upsert_into(spark, path, one(5001), ["k"], "seq", id_fn=by_tens)
    assert keyed.read_table(spark, path).count() == 101
