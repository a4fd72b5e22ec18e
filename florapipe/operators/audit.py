"""Audit reports.

Each report is one DataFrame.  Reports over the whole dataset are single
global aggregates (partial on the map side, one small final merge); no report
pulls entity rows to the driver.  Exact quantiles (A5) are picked by rank from
one range sort of the distinct values, whatever their number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from florapipe.operators.numbering import running_sums
from florapipe.session import materialize


def value_counts(df: DataFrame, c: str, dropna: bool = False, out: str = "n") -> DataFrame:
    """A2: rows per value, most frequent first (ties by value); NULL is its own
    group unless ``dropna``."""
    src = df.filter(F.col(c).isNotNull()) if dropna else df
    return src.groupBy(c).agg(F.count(F.lit(1)).alias(out)).orderBy(F.desc(out), c)


def failure_reasons(df: DataFrame, status: str, success: str = "success", out: str = "n") -> DataFrame:
    """A3: counts of statuses other than ``success``; NULL status not listed."""
    return value_counts(df.filter(F.col(status) != success), status, dropna=True, out=out)


def coverage(df: DataFrame, flag: str) -> DataFrame:
    """A4: 100 * mean(flag) over non-NULL flags, and the number of false flags."""
    f = F.col(flag).cast("boolean")
    return df.agg(
        (F.avg(f.cast("double")) * 100.0).alias("coverage_pct"),
        F.count_if(f == F.lit(False)).alias("n_false"),
        F.count(F.lit(1)).alias("n_rows"))


def distinct_counts(df: DataFrame, species: Sequence[str] = ("scientific_name", "species"),
                    order: str = "order", family: str = "family", genus: str = "genus",
                    approximate: bool = False, rsd: float = 0.01) -> DataFrame:
    """Distinct species (first existing of ``species``), orders, families,
    genera; NULL excluded; an absent column counts 0.  ``approximate`` counts by
    sketches with relative standard deviation ``rsd``: one pass, no expansion."""
    cols = set(df.columns)
    sp = next((c for c in species if c in cols), None)

    def nd(c):
        if not c or c not in cols:
            return F.lit(0).cast("bigint")
        return F.approx_count_distinct(F.col(c), rsd) if approximate else F.count_distinct(F.col(c))
    return df.agg(nd(sp).alias("n_species"), nd(order).alias("n_orders"),
                  nd(family).alias("n_families"), nd(genus).alias("n_genera"))


def grid_symmetry(df: DataFrame, order: str = "order", species: str = "scientific_name") -> DataFrame:
    """Distinct species per order (NULL orders dropped; row count when
    there is no species column) -> one labelled row."""
    has_sp = species in df.columns
    per = (df.filter(F.col(order).isNotNull()).groupBy(order)
           .agg((F.count_distinct(F.col(species)) if has_sp else F.count(F.lit(1))).alias("n")))
    s = per.agg(F.min("n").alias("min_n"), F.max("n").alias("max_n"),
                F.count_distinct("n").alias("n_levels"), F.count(F.lit(1)).alias("n_orders"))
    label = (F.when(F.col("n_orders") == 0, F.lit("Symmetric"))
             .when(F.col("n_levels") == 1,
                   F.format_string("Perfect Grid (%d species per order)", F.col("min_n")))
             .otherwise(F.format_string("Asymmetric (Ranges from %d to %d species per order)",
                                        F.col("min_n"), F.col("max_n"))))
    return s.select(label.alias("grid"), "min_n", "max_n", "n_orders")


def missing_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NULLs per column and their share of rows; an absent column is all
    missing.  One scan, then a row per column: (column, n_missing, pct_missing);
    an empty input misses 0 %."""
    present = set(df.columns)
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(cols):
        aggs.append((F.count_if(F.col(c).isNull()) if c in present else F.count(F.lit(1))).alias(f"_m{i}"))
    each = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_m{i}").alias("n_missing")) for i, c in enumerate(cols)])
    return (df.agg(*aggs).select(F.inline(each), "_n")
            .select("column_name", "n_missing",
                    F.coalesce(F.try_divide(F.col("n_missing") * 100.0, F.col("_n")), F.lit(0.0)).alias("pct_missing")))


def fill_rate(df: DataFrame, candidates: Sequence[str] = ("image_url", "image", "url", "media_url")) -> DataFrame:
    """First existing image column; rows where it is set, and their share (0 of an empty input)."""
    c = next((x for x in candidates if x in df.columns), None)
    if c is None:
        return df.agg(F.lit(None).cast("string").alias("image_column"),
                      F.lit(0).cast("bigint").alias("n_filled"), F.lit(0.0).alias("fill_pct"))
    pct = F.try_divide(F.count(F.col(c)) * 100.0, F.count(F.lit(1)))
    return df.agg(F.lit(c).alias("image_column"), F.count(F.col(c)).alias("n_filled"),
                  F.coalesce(pct, F.lit(0.0)).alias("fill_pct"))


def source_share(df: DataFrame, source: str = "source", image: str = "image_url",
                 risk_term: str = "wiki", risk_pct: float = 50.0) -> DataFrame:
    """A10: share (%) of each non-NULL source among rows with an image; flag a
    source whose name contains ``risk_term`` and whose share exceeds ``risk_pct``."""
    counts = (df.filter(F.col(image).isNotNull() & F.col(source).isNotNull())
              .groupBy(source).agg(F.count(F.lit(1)).alias("n")))
    total = counts.agg(F.sum("n")).scalar()       # scalar subquery, evaluated once
    pct = F.col("n") * 100.0 / total
    return (counts.withColumn("share_pct", pct)
            .withColumn("licence_risk", F.contains(F.lower(F.col(source).cast("string")), F.lit(risk_term))
                        & (F.col("share_pct") > risk_pct)))


def yes_count(df: DataFrame, c: str = "has_wiki", yes: str = "Yes") -> DataFrame:
    """Number of rows flagged ``yes``."""
    return df.agg(F.count_if(F.col(c) == yes).alias("n_yes"))


def extraction_counts(df: DataFrame, group: str) -> DataFrame:
    """Processed rows per group."""
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("n_processed"))


def load_metrics(df: DataFrame, key: str | None, chunk_rows: int = 10_000, chunk_col: str | None = None,
                 images_col: str | None = None, firsts: DataFrame | None = None) -> DataFrame:
    """Per load chunk -- rows in, keys first seen in it, running rows and
    distinct keys loaded, running images loaded (``images_col``: a row's number
    of them) and % progress.  Chunks are given by ``chunk_col`` or by key ranges
    of width ``chunk_rows``.  A key counts at its first chunk, so the running
    count of keys is the global one.  Rows without a key count nowhere.

    ``firsts``, where a merge knows it already: a row per key with its first
    ``chunk``.  The rows are then read once, counted per chunk and not moved
    by their keys; without a ``key`` all of them count."""
    per = chunk_figures(df, key, chunk_rows, chunk_col, images_col, firsts)
    run = materialize(running_sums(per, ["chunk"], ["rows_in", "unique_keys", "images_in"]), "load_metrics")
    total = run.agg(F.sum("rows_in")).scalar()    # scalar subquery, evaluated once
    return run.select("chunk", "rows_in", "unique_keys",
                      F.col("cum_rows_in").alias("rows_loaded"),
                      F.col("cum_unique_keys").alias("keys_loaded"),
                      F.col("cum_images_in").alias("images_loaded"),
                      F.try_divide(F.col("cum_rows_in") * 100.0, total).alias("progress_pct"))


def chunk_figures(df: DataFrame, key: str | None, chunk_rows: int, chunk_col: str | None, images_col: str | None,
                  firsts: DataFrame | None) -> DataFrame:
    """(chunk, rows_in, unique_keys, images_in), what :func:`load_metrics` adds up."""
    ch = (F.col(chunk_col) if chunk_col else F.floor(F.col(key) / chunk_rows)).cast("bigint").alias("chunk")
    images = F.coalesce(F.col(images_col), F.lit(0)).cast("bigint") if images_col else F.lit(0).cast("bigint")
    keyed = df if key is None else df.filter(F.col(key).isNotNull())
    by = [ch] if firsts is not None else [F.col(key), ch]
    counted = keyed.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sum(images).alias("i"))
    if firsts is None:
        firsts = counted.groupBy(key).agg(F.min("chunk").alias("chunk"))
    zero = F.lit(0).cast("bigint")
    new = firsts.groupBy(F.col("chunk").cast("bigint").alias("chunk")).agg(F.count(F.lit(1)).alias("k"))
    return (counted.select("chunk", "n", "i", zero.alias("k"))
            .unionByName(new.select("chunk", zero.alias("n"), zero.alias("i"), "k"))
            .groupBy("chunk").agg(F.sum("n").alias("rows_in"), F.sum("k").alias("unique_keys"), F.sum("i").alias("images_in")))


# ---------------------------------------------------------------- describe (A5)

def exact_quantiles(df: DataFrame, c: str, probs: Sequence[float], names: Sequence[str]) -> DataFrame:
    """One row with the linear-interpolated quantiles (the ``describe``
    definition): h = p*(n-1); x[floor h] + (h - floor h)*(x[floor h + 1] - x[floor h]).

    Values are reduced to (value, multiplicity), range-sorted once with the
    running sum of the multiplicities, and each needed rank is picked by a
    range predicate inside one global aggregate.  A hot value is one row."""
    vals = df.select(F.col(c).cast("double").alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    weighted = vals.groupBy("v").agg(F.count(F.lit(1)).alias("w"))
    ranked = materialize(running_sums(weighted, ["v"], ["w"]), "ranked_values")
    n = ranked.agg(F.coalesce(F.max("cum_w"), F.lit(0)).cast("bigint")).scalar()
    aggs = []
    for p, name in zip(probs, names):
        h = F.lit(float(p)) * (n - 1)
        r0 = F.floor(h)
        r1 = F.least(r0 + 1, n - 1)

        def at(r):
            return F.max(F.when((F.col("cum_w") - F.col("w") <= r) & (F.col("cum_w") > r), F.col("v")))
        aggs.append((at(r0) + (h - r0) * (at(r1) - at(r0))).alias(name))
    return ranked.agg(*aggs)


def describe(df: DataFrame, c: str, exact: bool = True, accuracy: int = 10_000) -> DataFrame:
    """A5: count, mean, sample std, min, 25/50/75 % (linear interpolation), max
    of the values that are neither NULL nor NaN.

    ``exact=False`` uses ``percentile_approx`` (one pass, bounded memory)."""
    x = F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
    stats = [F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
             F.min(x).alias("min"), F.max(x).alias("max")]
    if not exact:
        q = F.percentile_approx(x, [0.25, 0.5, 0.75], accuracy)
        return df.agg(*stats, q.alias("q")).select(
            "count", "mean", "std", "min", F.col("q")[0].alias("p25"), F.col("q")[1].alias("p50"),
            F.col("q")[2].alias("p75"), "max")
    quant = exact_quantiles(df, c, [0.25, 0.5, 0.75], ["p25", "p50", "p75"])
    # two single-row aggregates side by side: the quantiles are one scalar subquery
    q = quant.select(F.struct("p25", "p50", "p75")).scalar()
    return df.agg(*stats).select("count", "mean", "std", "min", q["p25"].alias("p25"), q["p50"].alias("p50"),
                                 q["p75"].alias("p75"), "max")
