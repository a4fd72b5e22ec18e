"""Media: tiering, selection, scoring, ranking, page media, expansion
(M1-M4, M6, J6, J6b, J11, P5, P7, P14).

Per-entity image lists are bounded by the landed responses (a page of
observations, a page's image list), so tiering, selection and expansion are
array expressions on one row -- no explode, no shuffle.  Ranking across rows
(M4) deduplicates (key, url) with a partial aggregate and keeps the top n with
``row_number() <= n``, which Spark plans as a partial WindowGroupLimit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from florapipe.functions.expr import col, extract_binomial, normalize_media_url, page_title
from florapipe.operators.responses import asked, one_response

# --- fixed values that must equal the source pipeline's ---------------------
RESEARCH = "research"
NEEDS_ID = "needs_id"
MAX_IMAGES = 3
PAGE_IMAGE_LIMIT = 50
PAGE_TOP_N = 5
SEARCH_TITLE_LIMIT = 30
SEARCH_TOP_N = 3
COMMONS_HOST = "upload.wikimedia.org"
JUNK_TERMS = ["diagram", "map", "chart", "logo", "icon", "drawing", "illustration"]
ALLOWED_LICENSES = ["cc0", "cc-by", "cc-by-sa"]
SCORE_WEIGHTS = {
    "megapixel_divisor": 2.0, "size_cap": 2.5, "unknown_size": -0.5, "host": 0.8,
    "jpeg": 0.6, "png": 0.3, "name_in_description": 1.8, "name_in_categories": 1.2,
    "junk_in_description": -1.0, "junk_in_categories": -0.6,
}
# ---------------------------------------------------------------------------


def tier_media(obs: DataFrame, results: str = "results", status: str = "http_status") -> DataFrame:
    """M1: flatten the photos of an observations response in order, skip empty
    URLs, thumbnail -> medium, split by quality grade into ``research``,
    ``needs_id`` and ``fallback`` lists.  A failed or missing response gives
    empty tiers."""
    photos = F.flatten(F.transform(F.col(results), lambda r: F.transform(
        F.coalesce(r["photos"], F.array()), lambda p: F.struct(r["quality_grade"].alias("q"),
                                                                p["url"].alias("u")))))
    photos = F.when(F.col(status) == 200, F.coalesce(photos, F.array())).otherwise(F.array())
    kept = F.filter(photos, lambda x: F.coalesce(x["u"] != "", F.lit(False)))

    def urls(pred):
        return F.transform(F.filter(kept, pred), lambda x: normalize_media_url(x["u"], drop_query=False))
    return obs.select(
        *[c for c in obs.columns if c != results],
        urls(lambda x: F.coalesce(x["q"] == RESEARCH, F.lit(False))).alias("research"),
        urls(lambda x: F.coalesce(x["q"] == NEEDS_ID, F.lit(False))).alias("needs_id"),
        urls(lambda x: ~F.coalesce(x["q"].isin(RESEARCH, NEEDS_ID), F.lit(False))).alias("fallback"))


def select_media(tiers: DataFrame, curated: str = "curated", cap: int = MAX_IMAGES) -> DataFrame:
    """M2: first non-empty of research, needs_id, fallback, curated; cut to
    ``cap``; needs_id cut to ``cap`` on its own; ``media_tier`` records which
    list won (the research column may hold a lower tier); status success or
    no_images."""
    lists = [("research", F.col("research")), ("needs_id", F.col("needs_id")),
             ("fallback", F.col("fallback")), ("curated", F.coalesce(F.col(curated), F.array()))]
    chosen = F.lit(None)
    tier = F.lit("none")
    for name, arr in reversed(lists):
        chosen = F.when(F.size(arr) > 0, arr).otherwise(chosen)
        tier = F.when(F.size(arr) > 0, F.lit(name)).otherwise(tier)
    chosen = F.coalesce(chosen, F.array().cast("array<string>"))
    return tiers.select(
        *[c for c in tiers.columns if c not in ("research", "needs_id", "fallback")],
        F.slice(chosen, 1, cap).alias("research_images"),
        F.slice(F.col("needs_id"), 1, cap).alias("needs_id_images"),
        tier.alias("media_tier"),
        F.when(F.size(chosen) > 0, F.lit("success")).otherwise(F.lit("no_images")).alias("inat_status"))


def score_media(url: Column | str, width: Column | str, height: Column | str,
                description: Column | str, categories: Column | str, species_name: Column | str,
                weights: dict | None = None, junk_terms: Sequence[str] = tuple(JUNK_TERMS)) -> Column:
    """M3: the image score, added term by term in the source's order (so the
    double result is identical)."""
    w = dict(SCORE_WEIGHTS, **(weights or {}))
    u = col(url)
    wd, ht = F.coalesce(col(width), F.lit(0)), F.coalesce(col(height), F.lit(0))
    desc = F.lower(F.coalesce(col(description), F.lit("")))
    cats = F.lower(F.coalesce(col(categories), F.lit("")))
    bn = F.lower(extract_binomial(species_name))
    low = F.lower(u)
    s = F.lit(0.0)
    s = s + F.when((wd != 0) & (ht != 0),
                   F.least(wd.cast("double") * ht.cast("double") / 1_000_000 / w["megapixel_divisor"],
                           F.lit(w["size_cap"]))).otherwise(F.lit(w["unknown_size"]))
    s = s + F.when(F.contains(u, F.lit(COMMONS_HOST)), F.lit(w["host"])).otherwise(F.lit(0.0))
    s = s + (F.when(low.endswith(".jpg") | low.endswith(".jpeg"), F.lit(w["jpeg"]))
             .when(low.endswith(".png"), F.lit(w["png"])).otherwise(F.lit(0.0)))
    s = s + F.when(F.coalesce(F.contains(desc, bn), F.lit(False)), F.lit(w["name_in_description"])) \
        .otherwise(F.lit(0.0))
    s = s + F.when(F.coalesce(F.contains(cats, bn), F.lit(False)), F.lit(w["name_in_categories"])) \
        .otherwise(F.lit(0.0))
    for k in junk_terms:
        s = s + F.when(F.contains(desc, F.lit(k)), F.lit(w["junk_in_description"])).otherwise(F.lit(0.0))
        s = s + F.when(F.contains(cats, F.lit(k)), F.lit(w["junk_in_categories"])).otherwise(F.lit(0.0))
    return s


def rank_media(media: DataFrame, key: str | Sequence[str], url: str, score: str, pos: str,
               n: int = PAGE_TOP_N) -> DataFrame:
    """M4: per key drop empty URLs, order by score (descending, ties in
    ``pos`` order), cut the query string, keep each URL's first occurrence,
    keep the first ``n``.  Returns (key..., rank, url, score, pos)."""
    keys = [key] if isinstance(key, str) else list(key)
    m = (media.filter(F.col(url).isNotNull() & (F.col(url) != ""))
         .select(*keys, F.substring_index(F.col(url), "?", 1).alias("_u"),
                 F.struct((-F.col(score)).alias("ns"), F.col(pos).alias("p")).alias("_o")))
    first = m.groupBy(*keys, "_u").agg(F.min("_o").alias("_o"))
    w = Window.partitionBy(*keys).orderBy("_o")
    return (first.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
            .select(*keys, "rank", F.col("_u").alias("url"), (-F.col("_o.ns")).alias("score"),
                    F.col("_o.p").alias(pos)))


def ranked_lists(ranked: DataFrame, key: str | Sequence[str], out: str = "images") -> DataFrame:
    """Ranked rows back to one ordered list per key (at most n items each)."""
    keys = [key] if isinstance(key, str) else list(key)
    return (ranked.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("rank", "url"))).alias("_l"))
            .select(*keys, F.transform("_l", lambda x: x["url"]).alias(out)))


def _resolve_titles(titled: DataFrame, id_col: str, name_col: str, image_info: DataFrame,
                    limit: int | None) -> DataFrame:
    """(id, name, titles) -> scored rows for the first ``limit`` titles (None:
    all) that resolve to image info (a 200 response with at least one entry)."""
    info = (one_response(asked(image_info, "title", "http_status", "imageinfo"), ["title"])
            .filter((F.col("http_status") == 200) & (F.size("imageinfo") > 0))
            .select(F.col("title").alias("_title"), F.get(F.col("imageinfo"), 0).alias("_i")))
    t = titled.select(id_col, name_col, F.posexplode("titles" if limit is None else F.slice("titles", 1, limit)).alias("_pos", "_title"))
    r = t.join(info, "_title")
    sc = score_media(F.col("_i.url"), F.col("_i.width"), F.col("_i.height"),
                     F.col("_i.extmetadata.ImageDescription.value"), F.col("_i.extmetadata.Categories.value"),
                     F.col(name_col))
    return r.select(id_col, "_pos", F.col("_i.url").alias("_url"), sc.alias("_score"))


def _ranked_with_count(scored: DataFrame, id_col: str, n: int) -> DataFrame:
    """Resolved images per entity and its ``n`` best (M4), in one pass over the
    scored rows: images without a URL are one group of their own, so that they
    are counted, but it sorts last and is not listed."""
    blank = F.coalesce(F.col("_url"), F.lit("")) == ""
    first = (scored.select(id_col, F.substring_index(F.col("_url"), "?", 1).alias("_u"), blank.alias("_blank"),
                           F.struct((-F.col("_score")).alias("ns"), F.col("_pos").alias("p")).alias("_o"))
             .groupBy(id_col, "_u", "_blank").agg(F.min("_o").alias("_o"), F.count(F.lit(1)).alias("_c")))
    w = Window.partitionBy(id_col)
    ranked = (first.withColumn("_n", F.sum("_c").over(w)).withColumn("_k", F.row_number().over(w.orderBy("_blank", "_o")))
              .filter(F.col("_k") <= n))
    listed = F.when(~F.col("_blank"), F.struct("_k", "_u"))
    return (ranked.groupBy(id_col).agg(F.max("_n").alias("_n_resolved"), F.array_sort(F.collect_list(listed)).alias("_l"))
            .select(id_col, "_n_resolved", F.transform("_l", lambda x: x["_u"]).alias("wiki_images")))


def page_media(entities: DataFrame, id_col: str, name_col: str, page_images: DataFrame,
               searches: DataFrame, image_info: DataFrame, limit: int | None = PAGE_IMAGE_LIMIT,
               n: int = PAGE_TOP_N) -> DataFrame:
    """Images listed on the entity's page (else on the top search hit's
    page; of a page the first ``limit``, the service rule of the source, None:
    all), resolved, scored, ranked; adds ``wiki_images`` and ``wiki_status``
    (success / no_titles / no_images / exception).

    page_images: (title, http_status, images array<struct<title>>);
    searches: (srsearch, http_status, results array<struct<title>>);
    image_info: (title, http_status, imageinfo array<struct<url, width, height,
    extmetadata struct<ImageDescription struct<value>, Categories struct<value>>>>)."""
    pages = one_response(asked(page_images, F.col("title").alias("_pt"), F.col("http_status").alias("_ps"),
                                            F.transform("images", lambda i: i["title"]).alias("_pl")), ["_pt"], "_ps")

    def listed(df, title_col, prefix):
        j = df.join(pages, F.col(title_col) == F.col("_pt"), "left")
        return j.select(*df.columns,
                        F.when(F.col("_ps") == 200, F.coalesce("_pl", F.array())).otherwise(F.array())
                        .cast("array<string>").alias(f"{prefix}_titles"),
                        (F.col("_pt").isNotNull() & F.col("_ps").isNull()).alias(f"{prefix}_fail"))

    own = listed(entities.withColumn("_title", page_title(name_col)), "_title", "own")
    # entities without titles of their own: one lookup of their search
    # response gives both the fallback page and a transport failure
    need = own.filter((F.size("own_titles") == 0) & ~F.col("own_fail")).select(id_col, name_col)
    srch = one_response(asked(searches, F.col("srsearch").alias("_sq"), F.col("http_status").alias("_ss"),
                                        F.get(F.col("results"), 0)["title"].alias("_top")), ["_sq"], "_ss")
    alt = (need.join(srch, F.col(name_col) == F.col("_sq"), "left")
           .select(id_col,
                   F.when((F.col("_ss") == 200) & F.col("_top").isNotNull(), page_title("_top")).alias("_alt"),
                   (F.col("_sq").isNotNull() & F.col("_ss").isNull()).alias("search_fail")))
    alt = listed(alt, "_alt", "alt").select(id_col, "alt_titles", "alt_fail", "search_fail")
    # merged: lists that repeat are small as shuffled blocks, by which a broadcast is chosen, and large as rows
    titled = (own.join(alt.hint("merge"), id_col, "left")
              .withColumn("titles", F.when(F.size("own_titles") > 0, F.col("own_titles"))
                          .otherwise(F.coalesce("alt_titles", F.array().cast("array<string>"))))
              .withColumn("_exception", F.col("own_fail") | F.coalesce("alt_fail", F.lit(False))
                          | F.coalesce("search_fail", F.lit(False))))
    scored = _resolve_titles(titled.filter(~F.col("_exception")), id_col, name_col, image_info, limit)
    per = _ranked_with_count(scored, id_col, n)
    out = titled.join(per.hint("merge"), id_col, "left")
    status = (F.when(F.col("_exception"), F.lit("exception"))
              .when(F.size("titles") == 0, F.lit("no_titles"))
              .when(F.coalesce("_n_resolved", F.lit(0)) == 0, F.lit("no_images"))
              .otherwise(F.lit("success")))
    return out.select(*entities.columns,
                      F.when(status == "success", F.coalesce("wiki_images", F.array().cast("array<string>")))
                      .otherwise(F.array().cast("array<string>")).alias("wiki_images"),
                      status.alias("wiki_status"))


def search_media(entities: DataFrame, id_col: str, name_col: str, file_searches: DataFrame,
                 image_info: DataFrame, limit: int | None = SEARCH_TITLE_LIMIT, n: int = SEARCH_TOP_N) -> DataFrame:
    """Titles from a file-namespace search of the name (the first ``limit``,
    the service rule of the source; None: all), resolved, scored, top ``n``; adds ``wiki_images`` and ``wiki_status``."""
    s = (one_response(asked(file_searches, "srsearch", "http_status", "results"), ["srsearch"])
         .filter(F.col("http_status") == 200)
         .select(F.col("srsearch").alias("_sq"), F.transform("results", lambda r: r["title"]).alias("titles")))
    titled = entities.join(s, F.col(name_col) == F.col("_sq"), "left") \
        .withColumn("titles", F.coalesce("titles", F.array().cast("array<string>")))
    scored = _resolve_titles(titled, id_col, name_col, image_info, limit)
    ranked = ranked_lists(rank_media(scored, id_col, "_url", "_score", "_pos", n), id_col, "wiki_images")
    out = titled.join(ranked, id_col, "left")
    imgs = F.coalesce("wiki_images", F.array().cast("array<string>"))
    return out.select(*entities.columns, imgs.alias("wiki_images"),
                      F.when(F.size("titles") == 0, F.lit("no_titles"))
                      .when(F.size(imgs) == 0, F.lit("no_images")).otherwise(F.lit("success")).alias("wiki_status"))


def needs_enrichment(df: DataFrame, images: str, ext_id: str, max_images: int = MAX_IMAGES) -> DataFrame:
    """Rows with fewer than ``max_images`` images and a usable external id."""
    return df.filter((F.size(F.coalesce(F.col(images), F.array())) < max_images)
                     & F.col(ext_id).isNotNull() & (F.col(ext_id) != 0))


def expand_media(rows: DataFrame, observations: DataFrame, images: str, ext_id: str,
                 max_images: int = MAX_IMAGES) -> DataFrame:
    """Append unseen observation photo URLs (thumbnail -> medium) to lists
    shorter than ``max_images``, up to ``max_images``; existing duplicates are
    kept; lists already full, rows without a usable id and failed responses
    are left as they are.

    observations: (taxon_id, http_status, results array<struct<photos
    array<struct<url>>>>)."""
    new = F.filter(F.transform(F.flatten(F.transform(F.col("_res"), lambda r: F.coalesce(r["photos"], F.array()))),
                               lambda p: normalize_media_url(p["url"], drop_query=False)),
                   lambda u: F.coalesce(u != "", F.lit(False)))
    obs = (one_response(asked(observations, "taxon_id", "http_status", "results"), ["taxon_id"])
           .filter(F.col("http_status") == 200).select(F.col("taxon_id").alias("_tid"), F.col("results").alias("_res")))
    eligible = ((F.size(F.coalesce(F.col(images), F.array())) < max_images) & F.col(ext_id).isNotNull()
                & (F.col(ext_id) != 0))
    j = rows.join(obs, F.col(ext_id) == F.col("_tid"), "left")
    old = F.coalesce(F.col(images), F.array().cast("array<string>"))
    grown = F.slice(F.concat(old, F.array_except(F.coalesce(new, F.array().cast("array<string>")), old)),
                    1, max_images)
    return j.select(*[F.when(eligible & F.col("_tid").isNotNull(), grown).otherwise(F.col(images)).alias(c)
                      if c == images else F.col(c) for c in rows.columns])


def filter_allowed_license(media: DataFrame, license_col: str,
                           allowed: Sequence[str] = tuple(ALLOWED_LICENSES)) -> DataFrame:
    """P14 (documented, opt-in): keep media whose licence is allowed."""
    return media.filter(F.lower(F.col(license_col)).isin(list(allowed)))
