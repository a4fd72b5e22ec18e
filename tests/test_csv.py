"""The splittable CSV reader against Spark's multi-line reader."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from florapipe.sources.species_csv import CORRUPT, SPECIES_COLUMNS, csv_records, read_species_csv

ABC = ["a", "b", "c"]


@pytest.fixture()
def small_splits(spark):
    """Files are cut every few hundred bytes."""
    for k, v in (("spark.sql.files.maxPartitionBytes", "300"), ("spark.sql.files.openCostInBytes", "1")):
        spark.conf.set(k, v)
    yield spark
    for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        spark.conf.unset(k)


def reference(spark, path, header=ABC):
    """Good and bad rows as one task per file reads them."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*header, CORRUPT]])
    r = (spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').option("enforceSchema", False)
         .option("columnNameOfCorruptRecord", CORRUPT).csv(path).select(*header, CORRUPT).collect())
    return sorted((tuple(x[c] for c in header) for x in r if x[CORRUPT] is None), key=repr), sorted(x[CORRUPT] for x in r if x[CORRUPT] is not None)


def ours(spark, path, header=ABC):
    good = read_species_csv(spark, path, columns=header).collect()
    return (sorted((tuple(x[c] for c in header) for x in good), key=repr),
            sorted(x[CORRUPT] for x in read_species_csv(spark, path, columns=header, bad_rows=True).collect()))


TEXTS = {
    "plain": "a,b,c\n1,2,3\n4,5,6\n",
    "no final line feed": "a,b,c\n1,2,3\n4,5,6",
    "quoted lines": 'a,b,c\n1,"two\nlines",3\n"x","y\n\n\nz",""\n4,5,6\n',
    "doubled quotes": 'a,b,c\n"say ""hi""","""","""\n"""\n1,"a "",""b"" c",3\n',
    "carriage returns": 'a,b,c\r\n1,"two\r\nlines",3\r\n4,5,6\r\n',
    "blank lines": '\n\na,b,c\n\n1,2,3\n\n\n"x\n\ny",5,6\n\n',
    "stray quotes": 'a,b,c\n5" tall,2,3\n1,x"y"z,3\n4,5,6"\n7,8,9\n',
    "text after a quote": 'a,b,c\n"1"x,2,3\n4,"5" ,6\n7,8,9\n',
    "too few and too many": 'a,b,c\n1,2\n1,2,3,4\n"x\ny"\n4,5,6\n',
    "never closed": 'a,b,c\n1,2,3\n4,"5,6\n7,8,9\n',
    "byte order mark": '﻿a,b,c\n1,"é\n中",3\n',
    "header only": "a,b,c\n",
    "empty fields": 'a,b,c\n,,\n"","",""\n1,,3\n',
    "no data": "",
}


@pytest.mark.parametrize("name", [n for n in TEXTS if n != "no data"])
def test_as_the_whole_file_reader(small_splits, tmp_path, name):
    (tmp_path / "x.csv").write_bytes(TEXTS[name].encode())
    assert ours(small_splits, str(tmp_path)) == reference(small_splits, str(tmp_path))


def test_empty_file_lacks_every_column(spark, tmp_path):
    (tmp_path / "x.csv").write_text("")
    with pytest.raises(ValueError, match="lacks"):
        read_species_csv(spark, str(tmp_path), columns=ABC)


@pytest.mark.parametrize("seed", range(2))
def test_random_files_in_many_splits(small_splits, tmp_path, seed):
    rng = random.Random(seed)

    def field():
        t = "".join(rng.choice(["x", "yy ", "\n", ",", '""', "é", "\n\n", "1"]) for _ in range(rng.randrange(12)))
        return f'"{t}"' if set(t) & set('\n,"') or rng.random() < 0.3 else t
    for name in "pqr":
        rows = [",".join(field() for _ in range(3 if rng.random() < 0.95 else rng.choice([2, 4]))) for _ in range(300)]
        (tmp_path / f"{name}.csv").write_text("\n".join(["a,b,c", *rows]) + "\n")
    got = ours(small_splits, str(tmp_path))
    assert got == reference(small_splits, str(tmp_path)) and len(got[0]) > 700 and got[1]


def test_one_file_is_read_by_many_tasks_in_order(small_splits, tmp_path):
    rows = [f'{i},"line one of {i}\nline two, with a comma\n",end' for i in range(500)]
    rows[250] = '250,"' + "a record over many splits\n" * 200 + '",end'
    (tmp_path / "x.csv").write_text("\n".join(["a,b,c", *rows]) + "\n")
    lines = small_splits.read.option("lineSep", "\n").text(str(tmp_path))
    assert lines.rdd.getNumPartitions() > 20
    got = read_species_csv(small_splits, str(tmp_path), columns=ABC).orderBy("row_id").collect()
    assert [int(r["a"]) for r in got] == list(range(500)) and got[250]["b"].count("\n") == 200
    assert [r["rec"] for r in csv_records(small_splits, str(tmp_path)).orderBy("rec").collect()] == list(range(501))


def test_headers_of_all_files_must_agree(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b,c\n1,2,3\n")
    (tmp_path / "y.csv").write_text('"a",b,c\n4,5,6\n')
    assert read_species_csv(spark, str(tmp_path), columns=["c", "a"]).agg(F.sum(F.col("c").cast("int"))).first()[0] == 9
    (tmp_path / "z.csv").write_text("b,a,c\n4,5,6\n")
    with pytest.raises(ValueError, match="differ"):
        read_species_csv(spark, str(tmp_path), columns=ABC)


def test_types_by_name(spark, tmp_path):
    (tmp_path / "x.csv").write_text(",".join(SPECIES_COLUMNS) + "\n" + ",".join(
        ["O", "F", "G", "S", "G s", "N/A", "12", "x", "ok", "True", "7", '"a\nb"', "src", "t", '"[""u"", ""v""]"', "[]", ""]) + "\n")
    r = read_species_csv(spark, str(tmp_path)).first()
    assert (r["common_name"], r["gbif_id"], r["inat_id"], r["has_images"], r["wikipedia_description"]) == (None, 12, None, True, "a\nb")
    assert list(r["inat_research_images"]) == ["u", "v"]
