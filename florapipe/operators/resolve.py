"""Name resolution through landed lookup responses.

A sequential fallback chain ("try key 1; if nothing, key 2; ...") becomes:
explode every entity's candidate keys with a priority, equi-join the keys of the
landed responses, and keep the best priority per entity with ``min_by``; a popular
key (a genus shared by many species) never concentrates work beyond AQE's
skew-split join.  Choices inside one response
(<= a page of results) are array expressions on that row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from florapipe.functions.expr import col, first_nonblank, genus_token, photo_url, ustrip
from florapipe.operators.responses import asked, one_response

ACCEPTED = "ACCEPTED"


def resolve_accepted_name(names: DataFrame, matches: DataFrame, name_col: str,
                          match_name: str = "name", out: str = "resolved_name") -> DataFrame:
    """Synonym -> accepted name from landed name matches.

    200 response: accepted usage (truthy usageKey and status ACCEPTED) gives
    canonicalName; else a synonym with an accepted usage gives that usage's
    canonicalName; else canonicalName.  Non-200 or no response gives NULL,
    and a NULL or empty answer keeps the input name."""
    m = one_response(asked(matches, F.col(match_name).alias("_mn"), "http_status", "usageKey", "status", "synonym",
                                    "canonicalName", "acceptedUsage"), ["_mn"])
    ok = F.col("http_status") == 200
    answer = (F.when(~F.coalesce(ok, F.lit(False)), F.lit(None).cast("string"))
              .when(F.coalesce(F.col("usageKey") != 0, F.lit(False)) & (F.col("status") == ACCEPTED),
                    F.col("canonicalName"))
              .when(F.coalesce(F.col("synonym"), F.lit(False)) & F.col("acceptedUsage").isNotNull(),
                    F.col("acceptedUsage.canonicalName"))
              .otherwise(F.col("canonicalName")))
    j = names.join(m, F.col(name_col) == F.col("_mn"), "left")
    return j.select(*names.columns, F.coalesce(first_nonblank(answer), F.col(name_col)).alias(out))


def preferred_label(labels: DataFrame, keys: Sequence[str], lang: str, label: str, pos: str,
                    preferred: str = "eng", out: str = "label") -> DataFrame:
    """Per key the first label in the preferred language, else the first
    label by position (unique within a key); a hit without text gives "".  The
    aggregate carries positions, the labels of the winners are joined back; a
    NULL language is simply "not preferred"."""
    rank = F.struct((~F.col(lang).eqNullSafe(preferred)).alias("np"), F.col(pos).alias("p"))
    best = labels.groupBy(*keys).agg(F.min(rank).alias("_b"))
    best = best.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_b.p").alias("_p"))
    same = F.col(pos).eqNullSafe(F.col("_p"))
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return labels.join(best, same).select(*keys, pos, F.coalesce(F.col(label), F.lit("")).alias(out))


def candidate_keys(name: Column | str, rules: Sequence[str] = ("name", "dash", "first_word")) -> Column:
    """Ordered lookup keys for a name: the name, the name with '-' as space,
    its first whitespace-separated word ("first_word") or the text before its
    first space ("genus")."""
    n = col(name)
    parts = {"name": n, "dash": F.replace(n, F.lit("-"), F.lit(" ")), "genus": genus_token(n),
             "first_word": F.get(F.split(ustrip(n), r"(?U)\s+"), 0)}
    return F.array(*[parts[r] for r in rules])


def best_match(entities: DataFrame, search: DataFrame, id_col: str, name_col: str,
               q_col: str = "q", rules: Sequence[str] = ("name", "dash", "first_word")) -> DataFrame:
    """First candidate key whose response is a 200 with results wins;
    inside it, the first result whose name contains the entity name
    (case-insensitive), else the first result.  A request that failed (a
    response with NULL status) before that ends the lookup as ``timeout``.
    Entities with no winning key get status ``taxon_not_found``; NULL names
    ``invalid_name``.

    Adds columns ``q_used``, ``taxon`` (the chosen result struct), ``inat_status``."""
    # dealt out by id first, so that a task explodes and groups its share however few splits the input has; an outer
    # join, so that the answers are the only side that may be broadcast
    cands = (entities.select(id_col, name_col).filter(F.col(id_col).isNotNull()).repartition(F.col(id_col))
             .select(id_col, name_col, F.posexplode(candidate_keys(name_col, rules)).alias("_prio", q_col))
             .filter(F.col(q_col).isNotNull()))
    # an answer that settles the lookup: a page with results, or a failed request
    found = (F.col("http_status") == 200) & (F.size("results") > 0)
    ok = (one_response(asked(search, q_col, "http_status", "results"), [q_col])
          .filter(F.col("http_status").isNull() | found)
          .select(q_col, F.when(found, F.col("results")).alias("results")))
    # the aggregate moves keys alone; the results are fetched once, for the key that won
    settled = ok.select(F.col(q_col).alias("_sq"))
    won = (cands.join(settled, F.col(q_col) == F.col("_sq"), "left")
           .groupBy(id_col)
           .agg(F.min_by(F.struct(F.col(q_col).alias("q"), F.col(name_col).alias("n")),
                         F.when(F.col("_sq").isNotNull(), F.struct("_prio", name_col))).alias("_w"))
           .select(id_col, F.col("_w.q").alias("_wq"), F.lower(F.col("_w.n")).alias("_wn")))
    hit = F.get(F.filter("results", lambda r: F.coalesce(F.contains(F.lower(r["name"]), F.col("_wn")), F.lit(False))), 0)
    picked = (won.join(ok.withColumnRenamed(q_col, "_rq"), F.col("_wq") == F.col("_rq"), "left")
              .select(id_col, F.when(F.col("_rq").isNotNull(), F.struct(
                  F.col("_wq").alias("q_used"), F.coalesce(hit, F.get(F.col("results"), 0)).alias("taxon"))).alias("_m")))
    # merged: taxa that repeat shrink to little when measured as files or shuffled blocks, but not as a broadcast
    out = entities.join(picked.hint("merge"), id_col, "left")
    status = (F.when(F.col(name_col).isNull(), F.lit("invalid_name"))
              .when(F.col("_m").isNull(), F.lit("taxon_not_found"))
              .when(F.col("_m.taxon").isNull(), F.lit("timeout")).otherwise(F.lit("success")))
    return out.select(*entities.columns,
                      F.when(F.col("_m.taxon").isNotNull(), F.col("_m.q_used")).alias("q_used"),
                      F.col("_m.taxon").alias("taxon"), status.alias("inat_status"))


def top_taxon(entities: DataFrame, search: DataFrame, id_col: str, name_col: str, q_col: str = "q",
              max_images: int = 3) -> DataFrame:
    """The most-observed result for the name, else for its genus; gallery
    of up to ``max_images`` photos (large, else medium, else square URL);
    defaults "" / 0 / [] when nothing is found."""
    cands = entities.select(id_col, F.posexplode(F.array(F.col(name_col), genus_token(name_col)))
                            .alias("_prio", q_col)).filter(F.col(q_col).isNotNull())
    ok = (one_response(asked(search, q_col, "http_status", "results"), [q_col])
          .filter((F.col("http_status") == 200) & (F.size("results") > 0)).select(q_col, "results"))
    # the response's most observed result (first on ties)
    best_i = F.array_max(F.transform("results", lambda r, i: F.struct(
        F.coalesce(r["observations_count"], F.lit(-1)).alias("o"), (-i).alias("ni"))))["ni"]
    top = F.get(F.col("results"), -best_i)
    picked = (cands.join(ok, q_col).select(id_col, "_prio", top.alias("_t"))
              .groupBy(id_col).agg(F.min_by("_t", "_prio").alias("_t")))
    urls = F.transform("_t.taxon_photos", lambda p: photo_url(p["photo"]["large_url"], p["photo"]["medium_url"],
                                                               p["photo"]["square_url"]))
    gallery = F.slice(F.filter(urls, lambda u: u.isNotNull()), 1, max_images)
    out = entities.join(picked, id_col, "left").withColumn("_g", F.coalesce(gallery, F.array().cast("array<string>")))
    return out.select(
        *entities.columns,
        F.col("_t.id").alias("inat_id"),
        F.coalesce(F.col("_t.preferred_common_name"), F.lit("")).alias("common_name"),
        F.coalesce(F.col("_t.observations_count"), F.lit(0)).cast("bigint").alias("observations_count"),
        F.coalesce(F.get(F.col("_g"), 0), F.lit("")).alias("image_primary"),
        F.col("_g").alias("image_gallery"))


def first_result(responses: DataFrame, max_images: int = 5) -> DataFrame:
    """The first result of a response -> id, observations, up to
    ``max_images`` medium photo URLs, common name (preferred, else English,
    else ""); an empty response gives the fallback with status ``unknown``."""
    t = F.get(F.col("results"), 0)
    imgs = F.slice(F.filter(F.transform(t["taxon_photos"], lambda p: p["photo"]["medium_url"]),
                            lambda u: F.coalesce(u != "", F.lit(False))), 1, max_images)
    has = t.isNotNull()
    return responses.select(
        *[c for c in responses.columns if c != "results"],
        F.when(has, t["id"]).alias("inat_id"),
        F.when(has, t["observations_count"]).alias("observations"),
        F.when(has, imgs).otherwise(F.array().cast("array<string>")).alias("images"),
        F.when(has, F.coalesce(first_nonblank(t["preferred_common_name"], t["english_common_name"]), F.lit("")))
        .otherwise(F.lit("")).alias("common_name"),
        F.when(has, F.lit(None).cast("string")).otherwise(F.lit("unknown")).alias("inat_status"))
