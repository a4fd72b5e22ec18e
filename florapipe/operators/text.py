"""Description lookup through an ordered fallback chain.

Each entity has up to three candidate names.  Every *distinct* candidate is
resolved once against the landed summary pages (and, for the long chain, the
top search hit's page); the answers are joined back to the entities and the
best (candidate priority, stage) is kept by a partial ``min_by``.  Genus names
shared by many species are therefore resolved once, not once per species.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from florapipe.functions.expr import (NOT_FOUND_TEXT, col, extract_binomial, first_tokens, genus_token,
                                      page_title, ustrip)
from florapipe.operators.responses import LANDED_AT, asked, one_response

MIN_TEXT_LEN = 50   # a summary counts only when longer than this (fixed value)


def _candidate(rule: str, name: Column, genus: Column | None) -> Column:
    if rule == "binomial":
        b = extract_binomial(name)
        return F.when(b != name, b)
    if rule == "species":
        return name
    if rule == "genus":
        g = genus if genus is not None else genus_token(name)
        return F.when(g != "", g)
    if rule == "two_tokens":
        t = first_tokens(name, 2)
        return F.when(t != name, t)
    raise ValueError(rule)


def _accept(text: Column, min_len: int, strip: bool) -> Column:
    t = ustrip(text) if strip else text
    return F.when(F.length(t) > min_len, t)


def text_fallback(entities: DataFrame, id_col: str, name_col: str, summaries: DataFrame,
                  searches: DataFrame | None = None, cache: DataFrame | None = None,
                  genus_col: str | None = None,
                  candidates: Sequence[tuple[str, str]] = (("binomial", "binomial"), ("species", "species"),
                                                           ("genus", "genus")),
                  min_len: int = MIN_TEXT_LEN, strip: bool = False,
                  not_found: tuple[str, str] = (NOT_FOUND_TEXT, "none"),
                  transport_failure_ends_candidate: bool = True, final_min_len: int | None = None) -> DataFrame:
    """Adds ``description`` and ``description_source``.

    ``candidates`` = (rule, source label) in priority order; rules: binomial
    (only when it differs from the name), species (the name), genus (when
    non-empty), two_tokens (first two words, when different).  Each candidate
    tries its summary page (title = spaces to underscores; accepted when the
    text is longer than ``min_len``), then -- when ``searches`` is given --
    the summary of the top search hit.  A failed request (NULL status) on the
    summary page ends that candidate.  A ``cache`` hit (name, description,
    source; the newest write of a name by ``landed_at``) wins over everything,
    and its name is not looked up.  ``final_min_len`` is the caller's own
    check: a final text, also a cached one, that is not longer is not found.

    summaries: (title, http_status, extract); searches: (srsearch,
    http_status, results array<struct<title>>); cache: (name, description, source).
    """
    name = F.col(name_col)
    genus = F.col(genus_col) if genus_col else None
    labels = [lbl for _, lbl in candidates]
    known = None
    if cache is not None:
        known = one_response(asked(cache, F.col("name").alias("_cn"), F.col("description").alias("_cd"),
                                   F.col("source").alias("_cs")), ["_cn"], status=None).filter("_cd <> ''")
    base = entities if known is None else entities.join(known, name == F.col("_cn"), "left")
    cand = ((base if known is None else base.filter(F.col("_cd").isNull())).select(id_col, F.posexplode(F.array(*[_candidate(r, name, genus) for r, _ in candidates]))
                            .alias("_prio", "_q"))
            .filter(F.col("_q").isNotNull()))

    keys = cand.select("_q").distinct()
    # late materialisation: the candidate logic only moves titles and flags;
    # the (large) texts are fetched once, for the winning title per entity
    acceptable = F.coalesce((F.col("http_status") == 200) & _accept(F.col("extract"), min_len, strip).isNotNull(),
                            F.lit(False))
    meta = one_response(asked(summaries, F.col("title").alias("_t"), F.col("http_status").alias("_st"),
                                         acceptable.alias("_ok"), F.xxhash64("extract").alias("_h")), ["_t"], "_st")
    s1 = (keys.join(meta, page_title("_q") == F.col("_t"), "left")
          .select("_q", F.when(F.col("_ok"), F.col("_t")).alias("_title1"),
                  (F.col("_t").isNotNull() & F.col("_st").isNull()).alias("_fail1")))
    if searches is not None:
        top = (one_response(asked(searches, "srsearch", "http_status", "results"), ["srsearch"])
               .filter(F.col("http_status") == 200)
               .select(F.col("srsearch").alias("_q"), F.get(F.col("results"), 0)["title"].alias("_top"))
               .filter(F.col("_top").isNotNull()))
        s2 = (keys.join(top, "_q").join(meta.filter(F.col("_ok")), page_title("_top") == F.col("_t"))
              .select("_q", F.col("_t").alias("_title2")))
        resolved = s1.join(s2, "_q", "left")
    else:
        resolved = s1.withColumn("_title2", F.lit(None).cast("string"))
    stage2 = F.when(~F.col("_fail1") | F.lit(not transport_failure_ends_candidate), F.col("_title2"))
    resolved = (resolved.select("_q", F.when(F.col("_title1").isNotNull(),
                                             F.struct(F.lit(1).alias("s"), F.col("_title1").alias("t")))
                                .when(stage2.isNotNull(), F.struct(F.lit(2).alias("s"), stage2.alias("t")))
                                .alias("_hit"))
                .filter(F.col("_hit").isNotNull()))

    src = F.array(*[F.lit(lbl) for lbl in labels])
    # an outer join, so that the answers are the only side that may be broadcast
    best = (cand.join(resolved, "_q", "left")
            .groupBy(id_col)
            .agg(F.min_by(F.struct(F.col("_hit.t").alias("title"),
                                   F.element_at(src, F.col("_prio") + 1).alias("source")),
                          F.when(F.col("_hit").isNotNull(), F.struct("_prio", "_hit.s"))).alias("_best")))
    # the text of each winning title, of the response that was chosen for it
    won = best.select(F.col("_best.title").alias("_wt")).distinct().join(meta.select(F.col("_t").alias("_wt"), "_h"), "_wt")
    texts = (summaries.select(F.col("title").alias("_wt"), F.xxhash64("extract").alias("_h"), "extract")
             .join(won, ["_wt", "_h"], "left_semi").groupBy("_wt").agg(F.first("extract").alias("_e"))
             .select("_wt", (ustrip(F.col("_e")) if strip else F.col("_e")).alias("_text")))
    best = (best.join(texts, F.col("_best.title") == F.col("_wt"), "left")
            .select(id_col, F.struct(F.col("_text").alias("text"), F.col("_best.source").alias("source"))
                    .alias("_best")))
    # merged: texts that repeat are small as shuffled blocks, by which a broadcast is chosen, and large as rows
    out = base.join(best.hint("merge"), id_col, "left")
    desc = F.col("_best.text")
    source = F.col("_best.source")
    if known is not None:
        hit = F.col("_cd").isNotNull()
        desc = F.when(hit, F.col("_cd")).otherwise(desc)
        source = F.when(hit, F.col("_cs")).otherwise(source)
    if final_min_len is not None:
        long = F.coalesce(F.length(desc) > final_min_len, F.lit(False))
        source, desc = F.when(long, source), F.when(long, desc)
    return out.select(*entities.columns,
                      F.coalesce(desc, F.lit(not_found[0])).alias("description"),
                      F.coalesce(source, F.lit(not_found[1])).alias("description_source"))


def cache_new_hits(cache: DataFrame, looked_up: DataFrame, name_col: str, miss_source: str = "none") -> DataFrame:
    """The lookup cache after a run -- earlier entries plus this run's
    hits (misses are not stored); for a name written again the newest write
    wins.  Where entries say when they were written (``landed_at``), this run's
    come after all of them."""
    hits = (looked_up.filter(F.col("description_source") != miss_source)
            .groupBy(name_col).agg(F.max(F.struct("description", "description_source")).alias("_h"))
            .select(F.col(name_col).alias("name"), F.col("_h.description").alias("description"),
                    F.col("_h.description_source").alias("source")))
    if LANDED_AT in cache.columns:
        last = F.coalesce(cache.agg(F.max(LANDED_AT)).scalar(), F.lit(0))
        hits = hits.withColumn(LANDED_AT, (last + 1).cast(cache.schema[LANDED_AT].dataType))
        cache = cache.groupBy("name").agg(F.max_by(F.struct("description", "source", LANDED_AT), LANDED_AT).alias("_c")).select("name", "_c.*")
    return cache.join(hits.select("name"), "name", "left_anti").unionByName(hits)


def flag_text_quality(df: DataFrame, text_col: str, min_len: int = MIN_TEXT_LEN) -> DataFrame:
    """``description_length`` and ``has_wiki`` ("Yes" when longer than
    ``min_len``, strictly)."""
    n = F.coalesce(F.length(col(text_col)), F.lit(0))
    return (df.withColumn("description_length", n)
            .withColumn("has_wiki", F.when(n > min_len, F.lit("Yes")).otherwise(F.lit("No"))))
