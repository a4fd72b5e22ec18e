"""Duplicate merging (A1) and child media rows.

``merge_entities`` never gathers a group's rows into one place: the scalar
parts use partial aggregates (``min_by``/``max_by``/``collect_set``), and the
ordered list merge first reduces every (key, item) pair to its first
position -- so a hot key only ever carries its *distinct* items, which is
the size of its output row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from florapipe.functions.expr import col, first_of, ustrip
from florapipe.operators.numbering import number_in_groups


def _ordered_distinct_items(df: DataFrame, key: str, pos: str, list_cols: Sequence[str]) -> DataFrame:
    """(key, lists...) rows -> one row per key holding, for every list column,
    the concatenation of its lists in ``pos`` order with each item's first
    occurrence kept.  One explode of the tagged items of all lists, one partial
    aggregate on (key, list, item) and one collect per key."""
    tagged = F.concat(*[_tagged(df, lc, j) for j, lc in enumerate(list_cols)])
    items = (df.select(key, pos, F.explode(tagged).alias("_x")).filter(F.col("_x.u").isNotNull())
             .select(key, pos, F.col("_x.l").alias("_lc"), F.col("_x.i").alias("_i"), F.col("_x.u").alias("_u")))
    first = items.groupBy(key, "_lc", "_u").agg(F.min(F.struct(F.col(pos), F.col("_i"))).alias("_f"))
    aggs = [F.array_sort(F.collect_list(F.when(F.col("_lc") == j, F.struct(F.col("_f"), F.col("_u")))))
            .alias(f"_l{j}") for j in range(len(list_cols))]
    return (first.groupBy(key).agg(*aggs)
            .select(key, *[F.transform(f"_l{j}", lambda x: x["_u"]).alias(lc) for j, lc in enumerate(list_cols)]))


def _tagged(df: DataFrame, list_col: str, number: int):
    """The items of a list with the list's number and their place in it."""
    items = F.coalesce(F.col(list_col), F.array().cast(df.schema[list_col].dataType))
    return F.transform(items, lambda u, i: F.struct(u.alias("u"), F.lit(number).alias("l"), i.alias("i")))


def merge_entities(df: DataFrame, key: str, pos: str, name_col: str | None = None,
                   text_col: str | None = None, list_cols: Sequence[str] = (),
                   names_out: str = "common_names", first_present: Sequence[str] = ()) -> DataFrame:
    """A1: one row per non-NULL ``key``.

    * every other column comes from the first row (lowest ``pos``);
    * ``names_out`` = sorted distinct stripped non-blank values of ``name_col``;
    * ``text_col`` = longest non-blank value, the first one on ties, unstripped
      (NULL when there is none);
    * each of ``list_cols`` = its lists concatenated in row order, first
      occurrence kept;
    * each of ``first_present`` = its first non-NULL value.

    Lists stay out of the aggregate; of the texts it carries one per key and map task.
    """
    base = df.filter(F.col(key).isNotNull())
    others = [c for c in df.columns if c != key]
    carried = [c for c in others if c != text_col and c not in list_cols and c not in first_present]
    aggs = [F.min_by(F.struct(*[F.col(c) for c in carried]), F.col(pos)).alias("_first")]
    if name_col:
        n = ustrip(F.col(name_col))
        aggs.append(F.array_sort(F.collect_set(F.when(n != "", n))).alias(names_out))
    if text_col:
        t = F.col(text_col)
        ok = ustrip(t) != ""
        aggs.append(F.min_by(F.when(ok, t), F.when(ok, F.struct(-F.length(t), F.col(pos)))).alias("_text"))
    aggs += [F.min_by(c, F.when(F.col(c).isNotNull(), F.col(pos))).alias(f"_p_{c}") for c in first_present]
    merged = base.groupBy(key).agg(*aggs)
    out = [F.col(key)]
    for c in others:
        if c == text_col:
            out.append(F.col("_text").alias(c))
        elif c in first_present:
            out.append(F.col(f"_p_{c}").alias(c))
        elif c not in list_cols:
            out.append(F.col("_first")[c].alias(c))
    if name_col:
        out.append(F.col(names_out))
    merged = merged.select(*out)
    if list_cols:
        lists = _ordered_distinct_items(base, key, pos, list_cols)
        merged = merged.join(lists, key, "left")
        for lc in list_cols:
            merged = merged.withColumn(lc, F.coalesce(F.col(lc), F.array().cast(base.schema[lc].dataType)))
    return merged


def longest_text(df: DataFrame, keys: Sequence[str], text_col: str, pos: str) -> DataFrame:
    """A1's description rule on its own: per group the longest non-blank text
    (first by ``pos`` on ties) with its position.

    The aggregate carries lengths and positions; the texts of the winners
    alone are fetched by a join on position (unique in its group)."""
    t = F.col(text_col)
    kept = df.filter(ustrip(t) != "")
    best = kept.groupBy(*keys).agg(F.min(F.struct((-F.length(t)).alias("n"), F.col(pos).alias("p"))).alias("_b"))
    best = best.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_b.p").alias("_p"))
    same = F.col(pos) == F.col("_p")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return kept.select(*keys, pos, text_col).join(best, same).select(*keys, pos, text_col)


def explode_media(df: DataFrame, id_col: str, primary: str, secondary: str,
                  primary_label: str = "inat", secondary_label: str = "wiki") -> DataFrame:
    """J10 on array columns: child rows (id, image_url, source, is_primary,
    image_order).  Primary-list items first, then secondary items not seen
    before; ``image_order`` is dense from 0; only primary index 0 is primary.
    Pure array expressions: no shuffle."""
    p = F.array_distinct(col(primary))
    s = F.array_except(F.array_distinct(col(secondary)), p)
    tagged = F.concat(
        F.transform(p, lambda u, i: F.struct(u.alias("image_url"), F.lit(primary_label).alias("source"),
                                             (i == 0).alias("is_primary"))),
        F.transform(s, lambda u: F.struct(u.alias("image_url"), F.lit(secondary_label).alias("source"),
                                          F.lit(False).alias("is_primary"))))
    return (df.select(F.col(id_col), F.posexplode(tagged).alias("image_order", "_m"))
            .select(id_col, "_m.image_url", "_m.source", "_m.is_primary",
                    F.col("image_order").cast("int").alias("image_order")))


def explode_media_rows(rows: DataFrame, id_col: str, url_col: str, source_col: str,
                       order_cols: Sequence[str], primary_label: str = "inat",
                       source_order: Sequence[str] = ("inat", "wiki")) -> DataFrame:
    """J10 on long rows (one row per listed image with its list and position).

    Same result as :func:`explode_media`, but the per-entity lists never have
    to be materialised: each (id, url) is reduced to its first occurrence by a
    partial aggregate, and the distinct images of an entity are numbered by
    global position, so an entity with very many is no single task's.
    """
    rank = F.array_position(F.array(*[F.lit(s) for s in source_order]), F.col(source_col))
    order = ["_r", *[f"_o{i}" for i in range(len(order_cols))]]
    key = F.struct(rank.alias("_r"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order_cols)])
    first = (rows.select(id_col, url_col, key.alias("_k")).groupBy(id_col, url_col).agg(F.min("_k").alias("_k"))
             .select(id_col, url_col, "_k.*"))
    numbered = number_in_groups(first, [id_col], order, "_n")
    source = F.element_at(F.array(*[F.lit(s) for s in source_order]), F.col("_r").cast("int"))
    return numbered.select(
        id_col, F.col(url_col).alias("image_url"), source.alias("source"),
        ((F.col("_n") == 0) & (source == primary_label)).alias("is_primary"),
        F.col("_n").cast("int").alias("image_order"))


def pick_primary(df: DataFrame, primary: str, secondary: str, out: str = "primary_image_url") -> DataFrame:
    """M5 as a projection."""
    return df.withColumn(out, first_of(primary, secondary))


def gallery_text(c, sep: str = "|"):
    """M6: a list as one text field."""
    return F.array_join(col(c), sep)
