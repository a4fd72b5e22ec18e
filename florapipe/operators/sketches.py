"""Audits that grow with the table (A2, A5, A6, A8): sketches stored per load.

A load leaves one small row per column: how many rows and nulls, sum, sum of
squared distances from the mean, least and largest value, a quantile sketch
(KLL) of a number column and a distinct-count sketch (HyperLogLog) of a key
column.  All of them merge, so the audit of a table after n loads reads n rows
per column, not the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Size of a quantile sketch (a rank is off by about 1.65 / K ** 0.9, under 1 % here), and bits of a distinct-count
#: sketch (relative standard deviation about 1.04 / sqrt(2 ** BITS), 0.8 % here).
K, BITS = 400, 14

SKETCH = "column_name string, n bigint, n_missing bigint, mean double, m2 double, min double, max double, quantiles binary, distincts binary"


def load_sketches(rows: DataFrame, numbers: Sequence[str] = (), keys: Sequence[str] = ()) -> DataFrame:
    """The sketches of one load: a row per column, from one scan.  A value that is not a number counts as missing."""
    aggs, each = [F.count(F.lit(1)).alias("_n")], []
    null = F.lit(None)
    for i, c in enumerate(numbers):
        x = F.nanvl(F.col(c).cast("double"), null.cast("double"))
        aggs += [F.count(x).alias(f"_c{i}"), F.avg(x).alias(f"_a{i}"), F.var_pop(x).alias(f"_v{i}"), F.min(x).alias(f"_l{i}"), F.max(x).alias(f"_h{i}"),
                 F.kll_sketch_agg_double(x, F.lit(K)).alias(f"_q{i}")]
        n = F.col(f"_c{i}")
        each.append(F.struct(F.lit(c).alias("column_name"), n.alias("n"), (F.col("_n") - n).alias("n_missing"), F.col(f"_a{i}").alias("mean"),
                             (F.col(f"_v{i}") * n).alias("m2"), F.col(f"_l{i}").alias("min"), F.col(f"_h{i}").alias("max"),
                             F.when(n > 0, F.col(f"_q{i}")).alias("quantiles"), null.cast("binary").alias("distincts")))
    for i, c in enumerate(keys):
        aggs += [F.count(F.col(c)).alias(f"_k{i}"), F.hll_sketch_agg(F.col(c).cast("string"), F.lit(BITS)).alias(f"_d{i}")]
        n, nothing = F.col(f"_k{i}"), null.cast("double")
        each.append(F.struct(F.lit(c).alias("column_name"), n.alias("n"), (F.col("_n") - n).alias("n_missing"), nothing.alias("mean"),
                             nothing.alias("m2"), nothing.alias("min"), nothing.alias("max"), null.cast("binary").alias("quantiles"),
                             F.when(n > 0, F.col(f"_d{i}")).alias("distincts")))
    return rows.agg(*aggs).select(F.inline(F.array(*each)))


def audit_sketches(stored: DataFrame, quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """The audit of all loads from their sketches: ``column_name, n, n_missing, mean, std, min, p25, p50, p75, max,
    n_distinct``.  Counts, mean, deviation and ends are exact; quantiles and distincts are within the sketches' bounds."""
    column = Window.partitionBy("column_name")                # one row per load
    overall = F.try_divide(F.sum(F.col("mean") * F.col("n")).over(column), F.sum("n").over(column))
    # squared distances from each load's mean, and of those means from that of all
    off = F.col("mean") - F.col("_mean")
    merged = stored.withColumn("_mean", overall).groupBy("column_name").agg(
        F.sum("n").alias("n"), F.sum("n_missing").alias("n_missing"), F.first("_mean").alias("mean"),
        F.sum(F.col("m2") + off * off * F.col("n")).alias("_m2"), F.min("min").alias("min"), F.max("max").alias("max"),
        F.kll_merge_agg_double("quantiles").alias("_q"), F.hll_union_agg("distincts").alias("_d"))
    some = F.col("min").isNotNull()
    out = [F.when(some, F.kll_sketch_get_quantile_double("_q", F.lit(float(p)))).alias(f"p{round(100 * p)}") for p in quantiles]
    return merged.select("column_name", "n", "n_missing", "mean", F.when(F.col("n") > 1, F.sqrt(F.col("_m2") / (F.col("n") - 1))).alias("std"), "min",
                         *out, "max", F.when(F.col("mean").isNull() & (F.col("n") > 0), F.hll_sketch_estimate("_d")).alias("n_distinct"))
