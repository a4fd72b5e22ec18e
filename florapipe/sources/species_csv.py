"""The species CSV edge (S1, S5 shape, F17).

Read: columns by the header's names (all text, no inference), multi-line quoted
fields, doubled quotes, the source reader's NA tokens to NULL, then one typed
projection.  Write: arrays become JSON text only here.

A file is read in splits, as plain lines, although its records may span lines.
Whether a line begins inside a quoted field depends on every line before it,
but only through one bit, so each line is a function of that bit: it passes the
bit on, turns it, or sets it.  Running compositions of these functions within a
split, then over the few rows of the splits, say for every line where it
begins; the lines between two record starts are one record, which Spark's own
CSV expression takes apart.
"""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from florapipe.functions.expr import json_list, na_to_null, parse_json_list, tolerant_bigint, truthy
from florapipe.session import materialize

# the 17 columns of a species record, in file order (fixed values)
SPECIES_COLUMNS = ["order", "family", "genus", "species", "scientific_name", "common_name", "gbif_id",
                   "inat_id", "inat_status", "has_images", "observation_count", "wikipedia_description",
                   "description_source", "extraction_timestamp", "inat_research_images",
                   "inat_needs_id_images", "wiki_images"]
INT_COLUMNS = ["gbif_id", "inat_id", "observation_count"]
BOOL_COLUMNS = ["has_images"]
LIST_COLUMNS = ["inat_research_images", "inat_needs_id_images", "wiki_images"]
CORRUPT = "_corrupt"


#: Where a line may be: before a field, in a bare one, in a quoted one, after a quote in that.
_BEFORE, _BARE, _QUOTED, _CLOSING = range(4)


def _leaves_quoted(line: Column, begins: int) -> Column:
    """1 if a line ends inside a quoted field, given where it begins."""
    def step(state: Column, c: Column) -> Column:
        return (F.when(c == '"', F.when(state == _BEFORE, _QUOTED).when(state == _QUOTED, _CLOSING).when(state == _CLOSING, _QUOTED).otherwise(_BARE))
                .when(state == _QUOTED, _QUOTED).when(c == ",", _BEFORE).otherwise(_BARE))
    # a run of other characters is one step
    steps = F.split(F.regexp_replace(line, r'[^",]++', "x"), "")
    ends = F.aggregate(steps, F.lit(begins), step)
    plain = F.lit(1 if begins == _QUOTED else 0)
    return F.when(F.contains(line, F.lit('"')), (ends == _QUOTED).cast("int")).otherwise(plain)


def _after(turns: Column, fixed: Column, entry: int | Column) -> Column:
    """The bit after a row: that of the last row that sets it, or the entry's, and the turns since."""
    return F.pmod(F.coalesce(fixed, F.lit(entry) if isinstance(entry, int) else entry) + turns, F.lit(2))


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """``_file, rec, text``: the records of CSV files (comma, quotes doubled), numbered from 0 in each file; the header is
    record 0, blank lines between records are none, and every line ends in a line feed alone.

    Lines are dealt out by split once.  What is gathered is one record, and per
    file one row per split; a quote that is never closed makes the rest of its
    file one record, as it does for any reader."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"), "value")
    value = F.when(F.col("split") == 0, F.regexp_replace("value", "^﻿", "")).otherwise(F.col("value"))
    lines = lines.withColumn("value", F.regexp_replace(value, "\r$", "")).select(
        "*", (F.col("value") == "").alias("blank"), _leaves_quoted(F.col("value"), _BEFORE).alias("from0"),
        _leaves_quoted(F.col("value"), _QUOTED).alias("from1"))
    within = Window.partitionBy("_file", "split").orderBy("at")
    so_far = within.rowsBetween(Window.unboundedPreceding, 0)
    lines = lines.withColumn("turns", F.sum((F.col("from0") > F.col("from1")).cast("int")).over(so_far))
    sets = F.when(F.col("from0") == F.col("from1"), F.pmod(F.col("from0") + F.col("turns"), F.lit(2)))
    lines = lines.withColumn("fixed", F.last(sets, ignorenulls=True).over(so_far))
    for bit in (0, 1):      # for either state at the split's begin: the state before the line, and the records begun up to it
        lines = lines.withColumn(f"before{bit}", F.lag(_after(F.col("turns"), F.col("fixed"), bit), 1, bit).over(within))
        lines = lines.withColumn(f"begun{bit}", F.sum(((F.col(f"before{bit}") == 0) & ~F.col("blank")).cast("int")).over(so_far))
    lines = materialize(lines, "csv_lines")

    last = F.struct("turns", "fixed", "begun0", "begun1")
    splits = lines.groupBy("_file", "split").agg(F.max_by(last, "at").alias("l")).select("_file", "split", "l.*")
    along = Window.partitionBy("_file").orderBy("split")
    up_to = along.rowsBetween(Window.unboundedPreceding, 0)
    turned = splits.withColumn("all_turns", F.sum(F.pmod("turns", F.lit(2))).over(up_to))
    sets = F.when(F.col("fixed").isNotNull(), F.pmod(_after(F.col("turns"), F.col("fixed"), 0) + F.col("all_turns"), F.lit(2)))
    turned = turned.withColumn("all_fixed", F.last(sets, ignorenulls=True).over(up_to))
    entry = F.lag(_after(F.col("all_turns"), F.col("all_fixed"), 0), 1, 0).over(along)
    turned = turned.withColumn("entry", entry).withColumn("begun", F.when(F.col("entry") == 0, F.col("begun0")).otherwise(F.col("begun1")))
    splits = materialize(turned.select(F.col("_file").alias("f"), F.col("split").alias("s"), "entry",
                                       (F.sum("begun").over(up_to) - F.col("begun")).alias("records_before")), "csv_splits")

    # one row per split of the scan above
    placed = lines.join(F.broadcast(splits), (F.col("_file") == F.col("f")) & (F.col("split") == F.col("s")))
    own = {c: F.when(F.col("entry") == 0, F.col(f"{c}0")).otherwise(F.col(f"{c}1")) for c in ("before", "begun")}
    placed = placed.select("_file", "split", "at", "value", own["before"].alias("inside"),
                           (F.col("records_before") + own["begun"] - 1).alias("rec"), "blank")
    placed = placed.filter((F.col("inside") == 1) | ~F.col("blank"))
    parts = placed.groupBy("_file", "rec").agg(F.array_sort(F.collect_list(F.struct("split", "at", "value"))).alias("lines"))
    text = F.array_join(F.transform("lines", lambda x: x["value"]), "\n")
    return parts.select("_file", "rec", text.alias("text"))


def _header(records: DataFrame) -> list[str]:
    """The names of the files' headers, which must agree."""
    found = [r["text"] for r in records.filter("rec = 0").select("text").distinct().limit(100).collect()]
    headers = {tuple(next(csv.reader([t], doublequote=True))) for t in found}
    if len(headers) > 1:
        raise ValueError(f"the files' headers differ: {sorted(headers)[:2]}")
    return list(headers.pop()) if headers else []


def read_species_csv(spark: SparkSession, path: str, columns: list[str] | None = None, row_id: str = "row_id",
                     bad_rows: bool = False) -> DataFrame:
    """Header CSV -> typed columns plus ``row_id``, which orders rows as
    (file name, place in the file).

    Columns are taken by name; one that the header lacks is an error, and so is
    a file whose header differs from the others'.  Rows that do not parse
    (too many or too few fields) are left out; ``bad_rows`` returns those
    instead, as ``(_file, _corrupt)``, to be counted and looked at.  A file of
    any size is read by as many tasks as it has splits (:func:`csv_records`)."""
    cols = columns or SPECIES_COLUMNS
    records = materialize(csv_records(spark, path), "csv_records")
    header = _header(records)
    missing = [c for c in cols if c not in header]
    if missing:
        raise ValueError(f"the header lacks {missing}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*header, CORRUPT]])
    options = {"escape": '"', "multiLine": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    ddl = ", ".join(f"`{f.name}` string" for f in schema)
    raw = (records.filter("rec > 0").select("_file", F.col("rec").alias("_at"), F.from_csv("text", ddl, options).alias("_r"))
           .select("_file", "_at", "_r.*"))
    # every column is asked of the parser, so that it judges whole rows whatever is selected later
    whole = F.coalesce(F.length(F.concat_ws("", *[F.col(f"`{c}`") for c in header])), F.lit(0)) >= 0
    if bad_rows:
        return raw.filter(whole & F.col(CORRUPT).isNotNull()).select("_file", CORRUPT)
    raw = raw.filter(whole & F.col(CORRUPT).isNull()).withColumn(row_id, F.struct("_file", "_at"))
    out = []
    for c in cols:
        v = na_to_null(F.col(f"`{c}`"))
        if c in INT_COLUMNS:
            v = tolerant_bigint(v)
        elif c in BOOL_COLUMNS:
            v = truthy(v)
        elif c in LIST_COLUMNS:
            v = parse_json_list(v)
        out.append(v.alias(c))
    return raw.select(*out, "_file", row_id)


def to_csv_record(df: DataFrame) -> DataFrame:
    """Species rows -> the 17 text-ready columns (lists as JSON text)."""
    out = []
    for c in SPECIES_COLUMNS:
        if c not in df.columns:
            out.append(F.lit(None).cast("string").alias(c))
        elif c in LIST_COLUMNS:
            out.append(json_list(c).alias(c))
        else:
            out.append(F.col(c).cast("string").alias(c))
    return df.select(*out)
