"""Target selection and paged enumeration.

Paged listings are landed as one row per (group, offset) page; the stop/skip
rules of a sequential pager become a per-group aggregate (first stopping
offset) joined back, so no group is ever walked row by row and a hot group is
just one aggregate row.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from florapipe.functions.expr import col
from florapipe.operators.numbering import number_in_groups
from florapipe.operators.responses import asked, one_response
from florapipe.session import materialize

# --- fixed values that must equal the source pipeline's ---------------------
ANGIOSPERM_CLASSES = ["Magnoliopsida", "Liliopsida"]
PLANT_KINGDOM = "Plantae"
ORDER_RANK = "ORDER"
SPECIES_RANK = "SPECIES"
ACCEPTED_STATUS = "ACCEPTED"
NO_MATCH = "NONE"
OFFSET_CEILING = 200_000          # the sequential pager's own limits; no operator applies one by itself
DEFAULT_LIMIT = 50_000
RESUME_LIMIT = 200_000
BATCH_ORDERS = {
    1: ["Asparagales", "Liliales"],
    2: ["Poales", "Arecales", "Alismatales"],
    3: ["Asterales"],
    4: ["Lamiales", "Gentianales"],
    5: ["Solanales", "Ericales", "Apiales"],
    6: ["Rosales", "Fabales"],
    7: ["Malpighiales", "Myrtales"],
    8: ["Brassicales", "Sapindales", "Malvales"],
    9: ["Magnoliales", "Ranunculales", "Caryophyllales"],
}
SAMPLE_ONLY = (1, "Dipsacales")   # listed by the sample build alone
# ---------------------------------------------------------------------------


def order_dimension(spark, sample: bool = False) -> DataFrame:
    """The (batch, order name) dimension of the fixed values above; ``sample``
    adds the order that only the sample build lists."""
    rows = [(b, n) for b, names in BATCH_ORDERS.items() for n in names] + [SAMPLE_ONLY] * sample
    return spark.createDataFrame(rows, "batch int, order_name string")


def select_targets(dim: DataFrame, batch: int | None = None, orders: Sequence[str] | None = None,
                   all_targets: bool = False, batch_col: str = "batch",
                   name_col: str = "order_name") -> DataFrame:
    """Rows of the (batch, order name) dimension to run.

    Precedence: ``all_targets`` > ``batch`` > ``orders``.  An unknown batch is
    an error when the plan runs."""
    if all_targets:
        return dim
    if batch is not None:
        mine = F.col(batch_col) == batch
        known = dim.agg(F.coalesce(F.bool_or(mine), F.lit(False)).alias("k")).scalar()
        return dim.filter(F.when(known, mine).otherwise(F.raise_error(F.lit(f"unknown batch {batch}")).cast("boolean")))
    if orders:
        return dim.filter(F.col(name_col).isin(list(orders)))
    return dim.limit(0)


def resolve_orders(names: DataFrame, matches: DataFrame, name_col: str = "order_name",
                   match_name: str = "name") -> DataFrame:
    """Order names -> order keys through landed name matches.

    Kept when the request succeeded, ``matchType`` is not "NONE" (a missing
    matchType passes), kingdom is Plantae and rank is ORDER.  Every name comes
    out once with ``order_key`` and ``status`` ("resolved" or the reject
    reason), so rejects are a filter away."""
    m = one_response(asked(matches, F.col(match_name).alias("_n"), "http_status", "matchType", "kingdom",
                                    "rank", F.col("orderKey").alias("order_key")), ["_n"])
    j = names.join(m, F.col(name_col) == F.col("_n"), "left")
    ok_http = F.col("http_status") == 200
    ok_match = ~F.col("matchType").eqNullSafe(NO_MATCH) & (F.col("kingdom") == PLANT_KINGDOM) \
        & (F.col("rank") == ORDER_RANK)
    status = (F.when(F.col("_n").isNull() | F.col("http_status").isNull(), F.lit("error"))
              .when(~ok_http, F.lit("http_error"))
              .when(F.coalesce(ok_match, F.lit(False)), F.lit("resolved"))
              .otherwise(F.lit("unresolved")))
    return j.select(*names.columns, F.when(status == "resolved", F.col("order_key")).alias("order_key"),
                    status.alias("status"))


def classify_clade(details: DataFrame, class_col: str = "class", kingdom_col: str = "kingdom",
                   status_col: str = "http_status") -> DataFrame:
    """``is_angiosperm`` for plant orders; NULL verification (all fields
    NULL) when the lookup failed or the kingdom is not Plantae."""
    ok = (F.col(status_col) == 200) & (F.col(kingdom_col) == PLANT_KINGDOM)
    ok = F.coalesce(ok, F.lit(False))
    return details.withColumn("is_angiosperm",
                              F.when(ok, F.coalesce(F.col(class_col).isin(ANGIOSPERM_CLASSES), F.lit(False)))) \
        .withColumn("verified", ok)


def explode_pages(pages: DataFrame, keys: Sequence[str], offset: str = "offset",
                  results: str = "results", id_field: str = "key") -> DataFrame:
    """One row per listed result with its global position (offset, index);
    results without an integer id are dropped."""
    out = pages.select(*keys, F.col(offset), F.posexplode(results).alias("index", "_r"))
    return (out.filter(F.col("_r")[id_field].isNotNull())
            .select(*keys, offset, F.col("index").cast("int").alias("index"), "_r.*"))


def page_prefix(pages: DataFrame, group: str, offset: str, status: Column | str,
                n_results: Column | str, ceiling: int | None = None) -> DataFrame:
    """S3: the pages a sequential pager would have read.

    Per group, pages are read by increasing offset, up to ``ceiling`` if one is
    given; the first non-200 page or the first 200 page without results stops the group; a
    page whose request failed (NULL status) is skipped and paging goes on.
    Returns the kept pages (those with results)."""
    st, nr = col(status), col(n_results)
    p = (pages if ceiling is None else pages.filter(F.col(offset) <= ceiling)).withColumn("_st", st).withColumn("_nr", nr)
    stop = F.col("_st").isNotNull() & ((F.col("_st") != 200) | (F.coalesce(F.col("_nr"), F.lit(0)) == 0))
    first_stop = (p.filter(stop).groupBy(group).agg(F.min(offset).alias("_stop")))
    kept = (p.filter(F.col("_st") == 200)
            .join(first_stop, group, "left")
            .filter(F.col("_stop").isNull() | (F.col(offset) < F.col("_stop"))))
    return kept.drop("_st", "_nr", "_stop")


def accepted_species(taxa: DataFrame, order_keys: Sequence[int] | DataFrame | None = None,
                     dataset: str | None = None, order_col: str = "order_key",
                     dataset_col: str = "dataset_key", rank_col: str = "rank",
                     status_col: str = "status") -> DataFrame:
    """The listing predicate -- species rank, accepted status, in the
    dataset, under one of the orders.  Plain filters, pushed to the scan."""
    out = taxa.filter((F.col(rank_col) == SPECIES_RANK) & (F.col(status_col) == ACCEPTED_STATUS))
    if dataset is not None:
        out = out.filter(F.col(dataset_col) == dataset)
    if isinstance(order_keys, DataFrame):
        out = out.join(order_keys, order_col, "left_semi")
    elif order_keys is not None:
        out = out.filter(F.col(order_col).isin(list(order_keys)))
    return out


def exclude_processed(taxa: DataFrame, sink: DataFrame, key: str, sink_key: str | None = None) -> DataFrame:
    """Drop ids already recorded in the sink (anti-join on the sink's
    distinct keys; the sink is the state, no separate id set).  Recorded ids
    are as many as species: merged, never broadcast."""
    sk = sink.select(F.col(sink_key or key).alias(key)).distinct().hint("merge")
    return taxa.join(sk, key, "left_anti")


def retry_candidates(enumerated: DataFrame, recorded: DataFrame, key: str) -> DataFrame:
    """Ids that were enumerated but have no record -- the rerun set.  Recorded
    ids are as many as species: merged, never broadcast."""
    return enumerated.select(key).distinct().join(recorded.select(key).distinct().hint("merge"), key, "left_anti")


#: Keys per group that cut its rows into ranges, and rows that are sorted without more cutting: each round leaves a group
#: about ``n`` rows and a ``RANGES``-th of those it had.
RANGES, SORT_ROWS = 64, 250_000


def first_bounds(df: DataFrame, group: Sequence[str], order: Sequence[str | Column], n: int) -> DataFrame | None:
    """Per group (columns ``_g0``, ...) a value ``_bound`` of its order at which or before which its first ``n`` rows stand;
    few more do.  A group that ends before has its last value or none.  None where so few rows need no cutting.

    Rounds of a histogram: a few keys of the group, drawn by hash, cut it into
    ranges, the ranges are counted, and the one that holds the n-th row is cut
    again.  What is shuffled is one row per task, group and range."""
    g = [F.col(c).alias(f"_g{i}") for i, c in enumerate(group)]
    names = [f"_g{i}" for i in range(len(group))]
    key = F.struct(*[(F.col(o) if isinstance(o, str) else o).alias(f"o{i}") for i, o in enumerate(order)])
    left = df.select(*g, key.alias("_key"))
    bounds = None
    for turn in range(math.ceil(math.log(max(1, df.count() / SORT_ROWS), RANGES))):
        drawn = Window.partitionBy(*names).orderBy(F.xxhash64(F.lit(turn), "_key"), "_key")
        cuts = (left.withColumn("_n", F.row_number().over(drawn)).filter(F.col("_n") <= RANGES)
                .groupBy(*names).agg(F.array_sort(F.collect_set("_key")).alias("_cuts")))
        cuts = materialize(cuts, "first_cuts")
        ranged = _same_group(left, cuts, names).select(*names, F.size(F.filter("_cuts", lambda c: c < F.col("_key"))).alias("_range"))
        counts = ranged.groupBy(*names, "_range").agg(F.count(F.lit(1)).alias("_c"))
        so_far = F.sum("_c").over(Window.partitionBy(*names).orderBy("_range"))          # at most RANGES + 1 rows a group
        last = (counts.withColumn("_to", so_far).filter(F.col("_to") >= n).groupBy(*names).agg(F.min("_range").alias("_range")))
        found = _same_group(cuts, last, names).select(*names, F.get("_cuts", F.col("_range")).alias("_bound"))
        if bounds is not None:          # the n-th row beyond the last cut: the bound of the round before holds
            found = _same_group(bounds, found.withColumnRenamed("_bound", "_new"), names, "left").select(
                *names, F.coalesce("_new", "_bound").alias("_bound"))
        bounds = materialize(found, "first_bounds")
        left = _same_group(left, bounds, names, "left").filter(F.col("_bound").isNull() | (F.col("_key") <= F.col("_bound"))).select(*names, "_key")
    return bounds


def _same_group(rows: DataFrame, figures: DataFrame, names: Sequence[str], how: str = "inner") -> DataFrame:
    """``rows`` with the one row of ``figures`` of their group; null groups are groups."""
    other = figures.withColumnsRenamed({c: f"_of{c}" for c in names})
    same = F.lit(True)
    for c in names:
        same = same & F.col(c).eqNullSafe(F.col(f"_of{c}"))
    return rows.join(other, same, how).drop(*[f"_of{c}" for c in names])


def limit_per_group(df: DataFrame, group: str | Sequence[str], order: Sequence[str | Column],
                    n: int | None = None) -> DataFrame:
    """O1: the first ``n`` rows of each group in ``order``, with their
    ``rank_in_group``; all rows when ``n`` is None.

    With ``n`` the rows that a bound of their group (:func:`first_bounds`)
    leaves are ranked, the others are read but not moved.  The rank is a global
    position less that of the group's first row, so no task sorts a whole group
    however few the groups are.  ``df`` is read once per round: best a table."""
    g = [group] if isinstance(group, str) else list(group)
    bounds = first_bounds(df, g, order, n) if n is not None else None
    if bounds is not None:
        keyed = df.select("*", *[F.col(c).alias(f"_g{i}") for i, c in enumerate(g)],
                          F.struct(*[(F.col(o) if isinstance(o, str) else o).alias(f"o{i}") for i, o in enumerate(order)]).alias("_key"))
        names = [f"_g{i}" for i in range(len(g))]
        near = _same_group(keyed, bounds, names, "left")
        df = near.filter(F.col("_bound").isNull() | (F.col("_key") <= F.col("_bound"))).select(*df.columns)
    ranked = number_in_groups(df, g, order, "_rank").withColumn("rank_in_group", (F.col("_rank") + 1)).drop("_rank")
    return ranked if n is None else ranked.filter(F.col("rank_in_group") <= n)


def left_out(df: DataFrame, group: str, n: int | None) -> DataFrame:
    """Per group the rows a limit of ``n`` leaves out: the report that goes with :func:`limit_per_group`."""
    over = F.count(F.lit(1)) - F.lit(n) if n is not None else F.lit(0)
    return df.groupBy(group).agg(F.greatest(over, F.lit(0)).cast("bigint").alias("n_left_out"))


def progress_state(sink: DataFrame, id_col: str, group: str, offset: str, ts: str) -> DataFrame:
    """Resumable state derived from the sink itself -- per group the
    processed count, distinct ids, furthest offset and last update."""
    return sink.groupBy(group).agg(
        F.count(F.lit(1)).alias("n_processed"), F.count_distinct(id_col).alias("n_ids"),
        F.max(offset).alias("last_offset"), F.max(ts).alias("last_update"))
