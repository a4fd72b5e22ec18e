"""Keyed tables and snapshots: crashes, damage, bounded rewrites; the CSV edge."""

import os

import pytest
from pyspark.sql import functions as F

from florapipe.session import checkpoint_dir
from florapipe.sources import store
from florapipe.sources.species_csv import SPECIES_COLUMNS, read_species_csv, to_csv_record
from tests.conftest import rows


def test_snapshot_survives_crash_and_reports_damage(spark, tmp_path):
    path = str(tmp_path / "t")
    assert store.read_snapshot(spark, path) is None
    assert store.write_snapshot(spark.range(3), path) == 1
    os.makedirs(f"{path}/v=2")                                   # a writer that died before its commit
    open(f"{path}/v=2/part-0.parquet", "w").close()
    assert store.read_snapshot(spark, path).count() == 3
    assert store.write_snapshot(spark.range(4), path) == 3       # passed over, not overwritten
    assert store.read_snapshot(spark, path).count() == 4
    for name in os.listdir(f"{path}/v=3"):
        if name.endswith(".parquet"):
            with open(f"{path}/v=3/{name}", "wb") as f:
                f.write(b"damaged")
            crc = f"{path}/v=3/.{name}.crc"
            if os.path.exists(crc):
                os.remove(crc)
    with pytest.raises(Exception):                               # an error, never an empty table
        store.read_snapshot(spark, path).count()


def test_csv_keeps_spaces_and_says_whether_it_wrote(spark, tmp_path):
    path = str(tmp_path / "csv")
    df = spark.createDataFrame([("Rosa canina ", "  text, \"quoted\"\nline  ")], "scientific_name string, wikipedia_description string")
    assert store.append_batch(to_csv_record(df), path)
    assert not store.append_batch(to_csv_record(df.limit(0)), path)
    r = read_species_csv(spark, path).collect()
    assert [(x["scientific_name"], x["wikipedia_description"]) for x in r] == [("Rosa canina ", "  text, \"quoted\"\nline  ")]


def test_a_named_batch_is_appended_once(spark, tmp_path):
    path = str(tmp_path / "csv")
    one = spark.createDataFrame([("Rosa", 1), ("Viola", 2)], "scientific_name string, gbif_id int")
    for df, name in ((one, "first"), (one.limit(1), "second"), (one, "first")):
        assert store.append_batch(to_csv_record(df), path, batch=name)
    assert sorted(r["scientific_name"] for r in read_species_csv(spark, path).collect()) == ["Rosa", "Rosa", "Viola"]


def test_versions_that_readers_may_hold_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(1, 6):
        store.write_snapshot(spark.range(n), path)
    held = spark.read.parquet(f"{path}/v=3")
    assert store.expire_versions(spark, path, keep=3) == 2 and store.expire_versions(spark, path, keep=3) == 0
    assert held.count() == 3 and store.read_snapshot(spark, path).count() == 5
    assert store.write_snapshot(spark.range(6), path) == 6


def test_csv_columns_by_name_bad_rows_and_file_order(spark, tmp_path):
    swapped = ["family", "order", *SPECIES_COLUMNS[2:]]
    folder = tmp_path / "csv"
    folder.mkdir()
    line = lambda i: ",".join([f"fam{i}", f"ord{i}", *["x"] * 2, f"name {i}", *[""] * 12])
    (folder / "a.csv").write_text("\n".join([",".join(swapped), *[line(i) for i in range(3)]]) + "\n")
    (folder / "b.csv").write_text("\n".join([",".join(swapped), *[line(i) for i in range(3, 400)], "too,few"]) + "\n")
    got = read_species_csv(spark, str(folder))
    back = [(r["order"], r["family"]) for r in got.orderBy("row_id").collect()]
    assert back == [(f"ord{i}", f"fam{i}") for i in range(400)]
    assert read_species_csv(spark, str(folder), bad_rows=True).count() == 1
    with pytest.raises(ValueError, match="lacks"):
        read_species_csv(spark, str(folder), columns=["order", "absent"])
    (folder / "c.csv").write_text(",".join(SPECIES_COLUMNS) + "\n" + line(9) + "\n")
    with pytest.raises(Exception):                               # another header in one of the files
        read_species_csv(spark, str(folder)).agg(F.count("*")).collect()


def test_scratch_folder_is_required_on_a_cluster(spark, monkeypatch):
    assert checkpoint_dir(spark)

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())


def test_scratch_is_cleared_on_request(spark, monkeypatch):
    from florapipe import session
    monkeypatch.setattr(session, "_SCRATCH", [])
    df = session.materialize(spark.range(5), "gone")
    path = session._SCRATCH[0]
    assert df.count() == 5 and session.clear_scratch(spark) == 1
    assert not store.exists(spark, path)
    assert session.clear_scratch(spark) == 0
