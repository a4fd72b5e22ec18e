"""Bindings for media operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from florapipe.functions.expr import normalize_media_url
from florapipe.operators import media
from florapipe.operators.responses import first_page
from florapipe.plans.landing import with_repeats
from florapipe.plans.registry import query
from florapipe.session import materialize
from florapipe.sources.tables import table


def _r(c, n=9):
    return F.round(F.col(c), n).alias(c)


# ---- M1/M2: documents as observations (quality 1 research, 0 needs_id,
# unlabelled casual), grouped 20 to a landed response; texts under 20
# characters carry an empty photo URL, toxic ones a second photo; every tenth
# response timed out; every third entity has one curated photo.
def landed_observations(spark, d):
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    # of a text only whether it is short is moved; labels are merged: small in a file, by which a broadcast is chosen, and
    # large as rows
    dl = docs.select("doc_id", (F.length("text") < 20).alias("short")).join(labels.hint("merge"), "doc_id", "left")
    did = F.col("doc_id").cast("string")
    grade = (F.when(F.col("quality") == 1, F.lit("research")).when(F.col("quality") == 0, F.lit("needs_id"))
             .otherwise(F.lit("casual")))
    photos = F.concat(
        F.array(F.struct(F.when(F.col("short"), F.lit("")).otherwise(F.concat(F.lit("img/square/"), did))
                         .alias("url"))),
        F.when(F.col("toxic") == 1, F.array(F.struct(F.concat(F.lit("img/square/t"), did).alias("url"))))
        .otherwise(F.array().cast("array<struct<url:string>>")))
    entity = F.floor(F.col("doc_id") / 20).cast("bigint")
    obs = (dl.groupBy(entity.alias("entity"))
           .agg(F.array_sort(F.collect_list(F.struct("doc_id", grade.alias("quality_grade"),
                                                     photos.alias("photos")))).alias("_l"))
           .select("entity",
                   F.transform("_l", lambda x: F.struct(x["quality_grade"].alias("quality_grade"),
                                                        x["photos"].alias("photos"))).alias("results"),
                   F.when(F.col("entity") % 10 == 9, F.lit(None).cast("int")).otherwise(F.lit(200))
                   .alias("http_status"),
                   F.when(F.col("entity") % 3 == 0, F.array(F.concat(F.lit("cur/"), F.col("entity").cast("string"))))
                   .otherwise(F.array().cast("array<string>")).alias("curated")))
    return obs


TIERS_SQL = """
WITH ph AS (
  SELECT CAST(floor(d.doc_id / 20) AS BIGINT) AS entity, d.doc_id, 0 AS pidx,
         CASE WHEN length(d.text) < 20 THEN '' ELSE 'img/square/' || CAST(d.doc_id AS VARCHAR) END AS url,
         CASE l.quality WHEN 1 THEN 'research' WHEN 0 THEN 'needs_id' ELSE 'casual' END AS q
  FROM documents d LEFT JOIN labels l USING (doc_id)
  UNION ALL
  SELECT CAST(floor(d.doc_id / 20) AS BIGINT), d.doc_id, 1, 'img/square/t' || CAST(d.doc_id AS VARCHAR),
         CASE l.quality WHEN 1 THEN 'research' WHEN 0 THEN 'needs_id' ELSE 'casual' END
  FROM documents d JOIN labels l USING (doc_id) WHERE l.toxic = 1),
ents AS (SELECT DISTINCT CAST(floor(doc_id / 20) AS BIGINT) AS entity FROM documents),
ok AS (SELECT * FROM ph WHERE entity % 10 <> 9 AND url <> ''),
tiers AS (
  SELECT e.entity,
         coalesce(list(replace(url, 'square', 'medium') ORDER BY doc_id, pidx) FILTER (WHERE q = 'research'), [])
           AS research,
         coalesce(list(replace(url, 'square', 'medium') ORDER BY doc_id, pidx) FILTER (WHERE q = 'needs_id'), [])
           AS needs_id,
         coalesce(list(replace(url, 'square', 'medium') ORDER BY doc_id, pidx)
                  FILTER (WHERE q NOT IN ('research', 'needs_id')), []) AS fallback
  FROM ents e LEFT JOIN ok USING (entity) GROUP BY e.entity)
"""


@query("tier_media", TIERS_SQL + """
SELECT entity, array_to_string(research, '|') AS research, array_to_string(needs_id, '|') AS needs_id,
       array_to_string(fallback, '|') AS fallback,
       CASE WHEN entity % 10 = 9 THEN NULL ELSE 200 END AS http_status
FROM tiers
""")
def q_tier_media(spark, d):
    t = media.tier_media(landed_observations(spark, d))
    return t.select("entity", *[F.array_join(c, "|").alias(c) for c in ("research", "needs_id", "fallback")],
                    "http_status")


@query("select_media", TIERS_SQL + """
SELECT entity,
       array_to_string(chosen[1:3], '|') AS research_images, array_to_string(needs_id[1:3], '|') AS needs_id_images,
       tier AS media_tier, CASE WHEN len(chosen) > 0 THEN 'success' ELSE 'no_images' END AS inat_status
FROM (SELECT entity, needs_id,
             CASE WHEN len(research) > 0 THEN research WHEN len(needs_id) > 0 THEN needs_id
                  WHEN len(fallback) > 0 THEN fallback
                  WHEN entity % 3 = 0 THEN ['cur/' || CAST(entity AS VARCHAR)] ELSE [] END AS chosen,
             CASE WHEN len(research) > 0 THEN 'research' WHEN len(needs_id) > 0 THEN 'needs_id'
                  WHEN len(fallback) > 0 THEN 'fallback' WHEN entity % 3 = 0 THEN 'curated' ELSE 'none' END AS tier
      FROM tiers)
""")
def q_select_media(spark, d):
    s = media.select_media(media.tier_media(landed_observations(spark, d)))
    return s.select("entity", F.array_join("research_images", "|").alias("research_images"),
                    F.array_join("needs_id_images", "|").alias("needs_id_images"), "media_tier", "inat_status")


# ---- M3/M4: documents as reference images, ranked per language; width =
# n_chars, height = 100 x length(source); extension by language, a query
# string on even ids (so the extension bonus is lost, as in the source).
RANK_NAME = "Ment le"


def _doc_media(spark, d):
    docs = table(spark, d, "documents")
    ext = (F.when(F.col("lang") == "en", F.lit(".jpg")).when(F.col("lang") == "fr", F.lit(".JPEG"))
           .when(F.col("lang") == "de", F.lit(".png")).otherwise(F.lit(".gif")))
    url = F.concat(F.lit("https://upload.wikimedia.org/"), F.col("source"), F.lit("/"),
                   (F.col("n_chars") % 7).cast("string"), ext,
                   F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("?v="), F.col("doc_id").cast("string")))
                   .otherwise(F.lit("")))
    cats = F.when(F.col("lang") == "fr", F.lit("Ment le icon")).otherwise(F.col("source"))
    return docs.select("doc_id", "lang", url.alias("url"),
                       media.score_media(url, F.col("n_chars"), F.length("source") * 100, F.col("text"), cats,
                                         F.lit(RANK_NAME)).alias("score"))


def _score_sql():
    parts = ["0.0",
             "CASE WHEN n_chars <> 0 AND length(source) * 100 <> 0 THEN "
             "least(CAST(n_chars AS DOUBLE) * CAST(length(source) * 100 AS DOUBLE) / 1000000 / 2.0, 2.5) "
             "ELSE -0.5 END",
             "CASE WHEN contains(url, 'upload.wikimedia.org') THEN 0.8 ELSE 0.0 END",
             "CASE WHEN lower(url) LIKE '%.jpg' OR lower(url) LIKE '%.jpeg' THEN 0.6 "
             "WHEN lower(url) LIKE '%.png' THEN 0.3 ELSE 0.0 END",
             "CASE WHEN contains(lower(text), 'ment le') THEN 1.8 ELSE 0.0 END",
             "CASE WHEN contains(lower(cats), 'ment le') THEN 1.2 ELSE 0.0 END"]
    for k in media.JUNK_TERMS:
        parts.append(f"CASE WHEN contains(lower(text), '{k}') THEN -1.0 ELSE 0.0 END")
        parts.append(f"CASE WHEN contains(lower(cats), '{k}') THEN -0.6 ELSE 0.0 END")
    expr = parts[0]
    for p in parts[1:]:
        expr = f"({expr} + {p})"
    return expr


RANK_SQL = f"""
WITH m AS (
  SELECT doc_id, lang, url, {_score_sql()} AS score FROM (
    SELECT doc_id, lang, text, source, n_chars,
           'https://upload.wikimedia.org/' || source || '/' || CAST(n_chars % 7 AS VARCHAR) ||
           CASE lang WHEN 'en' THEN '.jpg' WHEN 'fr' THEN '.JPEG' WHEN 'de' THEN '.png' ELSE '.gif' END ||
           CASE WHEN doc_id % 2 = 0 THEN '?v=' || CAST(doc_id AS VARCHAR) ELSE '' END AS url,
           CASE WHEN lang = 'fr' THEN 'Ment le icon' ELSE source END AS cats
    FROM documents)),
firsts AS (
  SELECT * FROM (
    SELECT lang, split_part(url, '?', 1) AS url, score, doc_id,
           row_number() OVER (PARTITION BY lang, split_part(url, '?', 1) ORDER BY score DESC, doc_id) AS k
    FROM m WHERE url IS NOT NULL AND url <> '') WHERE k = 1)
SELECT lang, rank, url, round(score, 9) AS score, doc_id FROM (
  SELECT lang, url, score, doc_id,
         CAST(row_number() OVER (PARTITION BY lang ORDER BY score DESC, doc_id) AS INTEGER) AS rank
  FROM firsts) WHERE rank <= 5
"""


@query("rank_media", RANK_SQL)
def q_rank_media(spark, d):
    ranked = media.rank_media(_doc_media(spark, d), "lang", "url", "score", "doc_id", n=5)
    return ranked.select("lang", "rank", "url", _r("score"), "doc_id")


# ---- J6/J6b: pages as encyclopedia pages.  Entity "Page <id>"; its page
# lists its <a href> targets as image titles ("File:<href>"); ids divisible
# by 13 fail in transport, by 7 answer 404 and fall back to a search whose top
# hit is the next page (ids divisible by 35 fail that search); image info per
# distinct href: lengths divisible by 11 fail, by 9 have no entry, length 3
# mod 10 has an empty URL.
HREF = r'<a href="([^"]*)"'
IMAGEINFO_TYPE = ("array<struct<url:string,width:int,height:int,extmetadata:struct<"
                  "ImageDescription:struct<value:string>,Categories:struct<value:string>>>>")


def landed_links(spark, d):
    """Each page's link targets, taken from the html once and written."""
    return materialize(table(spark, d, "pages").select("page_id", F.regexp_extract_all("html", F.lit(HREF), 1).alias("hrefs")),
                       "landed_links")


def _page_landing(spark, d, pages=None):
    pages = landed_links(spark, d) if pages is None else pages
    pid = F.col("page_id")
    hrefs = F.col("hrefs")
    ents = pages.select("page_id", F.concat(F.lit("Page "), pid.cast("string")).alias("name"))
    page_images = pages.select(
        F.concat(F.lit("Page_"), pid.cast("string")).alias("title"),
        F.when(pid % 13 == 0, F.lit(None).cast("int")).when(pid % 7 == 0, F.lit(404)).otherwise(F.lit(200))
        .alias("http_status"),
        F.transform(hrefs, lambda h: F.struct(F.concat(F.lit("File:"), h).alias("title"))).alias("images"))
    searches = pages.filter(pid % 7 == 0).select(
        F.concat(F.lit("Page "), pid.cast("string")).alias("srsearch"),
        F.when(pid % 5 == 0, F.lit(None).cast("int")).otherwise(F.lit(200)).alias("http_status"),
        F.array(F.struct(F.concat(F.lit("Page "), (pid + 1).cast("string")).alias("title"))).alias("results"))
    h = F.col("h")
    n = F.length(h)
    ext = F.when(n % 3 == 0, F.lit(".jpg")).when(n % 3 == 1, F.lit(".png")).otherwise(F.lit(".svg"))
    url = F.when(n % 10 == 3, F.lit("")).otherwise(
        F.concat(F.lit("https://upload.wikimedia.org/w"), h, ext,
                 F.when(n % 4 == 0, F.lit("?u=1")).otherwise(F.lit(""))))
    info = F.struct(url.alias("url"), (n * 350).alias("width"), F.lit(480).alias("height"),
                    F.struct(F.struct(F.when(n % 5 == 0, F.concat(F.lit("Drawing of "), h)).otherwise(h)
                                      .alias("value")).alias("ImageDescription"),
                             F.struct(F.lit("Pages").alias("value")).alias("Categories")).alias("extmetadata"))
    image_info = (pages.select(F.explode(hrefs).alias("h")).distinct()
                  .select(F.concat(F.lit("File:"), h).alias("title"),
                          F.when(n % 11 == 0, F.lit(None).cast("int")).otherwise(F.lit(200)).alias("http_status"),
                          F.when(n % 9 == 0, F.array().cast(IMAGEINFO_TYPE))
                          .otherwise(F.array(info)).alias("imageinfo")))
    return (ents, with_repeats(page_images, ["title"]), with_repeats(searches, ["srsearch"]),
            with_repeats(image_info, ["title"]))


PAGE_SQL = r"""
WITH pi AS (
  SELECT 'Page_' || CAST(page_id AS VARCHAR) AS title,
         CASE WHEN page_id % 13 = 0 THEN NULL WHEN page_id % 7 = 0 THEN 404 ELSE 200 END AS http_status,
         regexp_extract_all(html, '<a href="([^"]*)"', 1) AS hrefs
  FROM pages),
ii AS (
  SELECT 'File:' || h AS title, CASE WHEN length(h) % 11 = 0 THEN NULL ELSE 200 END AS http_status,
         length(h) % 9 <> 0 AS has_info,
         CASE WHEN length(h) % 10 = 3 THEN ''
              ELSE 'https://upload.wikimedia.org/w' || h ||
                   CASE length(h) % 3 WHEN 0 THEN '.jpg' WHEN 1 THEN '.png' ELSE '.svg' END ||
                   CASE WHEN length(h) % 4 = 0 THEN '?u=1' ELSE '' END END AS url,
         length(h) * 350 AS width, 480 AS height,
         CASE WHEN length(h) % 5 = 0 THEN 'Drawing of ' || h ELSE h END AS descr, 'Pages' AS cats
  FROM (SELECT DISTINCT unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS h FROM pages)),
ents AS (SELECT page_id, 'Page ' || CAST(page_id AS VARCHAR) AS name FROM pages)
"""


def _ii_score_sql():
    parts = ["0.0",
             "CASE WHEN width <> 0 AND height <> 0 THEN "
             "least(CAST(width AS DOUBLE) * CAST(height AS DOUBLE) / 1000000 / 2.0, 2.5) ELSE -0.5 END",
             "CASE WHEN contains(url, 'upload.wikimedia.org') THEN 0.8 ELSE 0.0 END",
             "CASE WHEN lower(url) LIKE '%.jpg' OR lower(url) LIKE '%.jpeg' THEN 0.6 "
             "WHEN lower(url) LIKE '%.png' THEN 0.3 ELSE 0.0 END"]
    for k in media.JUNK_TERMS:
        parts.append(f"CASE WHEN contains(lower(descr), '{k}') THEN -1.0 ELSE 0.0 END")
        parts.append(f"CASE WHEN contains(lower(cats), '{k}') THEN -0.6 ELSE 0.0 END")
    expr = parts[0]
    for p in parts[1:]:
        expr = f"({expr} + {p})"
    return expr


RANK_TAIL_SQL = f"""
scored AS (
  SELECT t.page_id, t.pos, ii.url, {_ii_score_sql()} AS score
  FROM titled_x t JOIN ii ON ii.title = 'File:' || t.h
  WHERE ii.http_status = 200 AND ii.has_info),
resolved AS (SELECT page_id, count(*) AS n_resolved FROM scored GROUP BY page_id),
firsts AS (
  SELECT * FROM (
    SELECT page_id, split_part(url, '?', 1) AS url, score, pos,
           row_number() OVER (PARTITION BY page_id, split_part(url, '?', 1) ORDER BY score DESC, pos) AS k
    FROM scored WHERE url IS NOT NULL AND url <> '') WHERE k = 1),
ranked AS (
  SELECT page_id, string_agg(url, '|' ORDER BY r) AS imgs FROM (
    SELECT page_id, url, row_number() OVER (PARTITION BY page_id ORDER BY score DESC, pos) AS r FROM firsts)
  WHERE r <= TOPN GROUP BY page_id)
"""


@query("page_media", PAGE_SQL + """,
own AS (
  SELECT e.page_id, e.name, CASE WHEN p.http_status = 200 THEN p.hrefs ELSE [] END AS own_h,
         (p.title IS NOT NULL AND p.http_status IS NULL) AS own_fail
  FROM ents e LEFT JOIN pi p ON replace(e.name, ' ', '_') = p.title),
srch AS (
  SELECT 'Page ' || CAST(page_id AS VARCHAR) AS srsearch,
         CASE WHEN page_id % 5 = 0 THEN NULL ELSE 200 END AS http_status,
         'Page ' || CAST(page_id + 1 AS VARCHAR) AS top
  FROM pages WHERE page_id % 7 = 0),
need AS (SELECT * FROM own WHERE len(own_h) = 0 AND NOT own_fail),
alt AS (
  SELECT n.page_id, CASE WHEN p.http_status = 200 THEN p.hrefs ELSE [] END AS alt_h,
         (p.title IS NOT NULL AND p.http_status IS NULL) AS alt_fail
  FROM need n JOIN srch s ON s.srsearch = n.name AND s.http_status = 200
  LEFT JOIN pi p ON replace(s.top, ' ', '_') = p.title),
sfail AS (SELECT n.page_id FROM need n JOIN srch s ON s.srsearch = n.name WHERE s.http_status IS NULL),
titled AS (
  SELECT o.page_id, CASE WHEN len(o.own_h) > 0 THEN o.own_h ELSE coalesce(a.alt_h, []) END AS hs,
         o.own_fail OR coalesce(a.alt_fail, false) OR (sf.page_id IS NOT NULL) AS exc
  FROM own o LEFT JOIN alt a USING (page_id) LEFT JOIN sfail sf USING (page_id)),
titled_x AS (
  SELECT page_id, unnest(hs[1:50]) AS h, generate_subscripts(hs[1:50], 1) - 1 AS pos
  FROM titled WHERE NOT exc),
""" + RANK_TAIL_SQL.replace("TOPN", "5") + """
SELECT t.page_id,
       CASE WHEN t.exc THEN 'exception' WHEN len(t.hs) = 0 THEN 'no_titles'
            WHEN coalesce(r.n_resolved, 0) = 0 THEN 'no_images' ELSE 'success' END AS wiki_status,
       CASE WHEN NOT t.exc AND len(t.hs) > 0 AND coalesce(r.n_resolved, 0) > 0 THEN coalesce(k.imgs, '')
            ELSE '' END AS wiki_images
FROM titled t LEFT JOIN resolved r USING (page_id) LEFT JOIN ranked k USING (page_id)
""")
def q_page_media(spark, d):
    ents, page_images, searches, image_info = _page_landing(spark, d)
    out = media.page_media(ents, "page_id", "name", page_images, searches, image_info)
    return out.select("page_id", "wiki_status", F.array_join("wiki_images", "|").alias("wiki_images"))


# A file-namespace search per page lists its hrefs; ids divisible by 7 answer 404.
@query("search_media", PAGE_SQL + """,
titled AS (
  SELECT e.page_id, CASE WHEN p.page_id % 7 = 0 THEN [] ELSE regexp_extract_all(p.html, '<a href="([^"]*)"', 1) END
           AS hs
  FROM ents e JOIN pages p USING (page_id)),
titled_x AS (SELECT page_id, unnest(hs[1:30]) AS h, generate_subscripts(hs[1:30], 1) - 1 AS pos FROM titled),
""" + RANK_TAIL_SQL.replace("TOPN", "3") + """
SELECT t.page_id,
       CASE WHEN len(t.hs) = 0 THEN 'no_titles' WHEN k.imgs IS NULL THEN 'no_images' ELSE 'success' END
         AS wiki_status,
       coalesce(k.imgs, '') AS wiki_images
FROM titled t LEFT JOIN ranked k USING (page_id)
""")
def q_search_media(spark, d):
    pages = landed_links(spark, d)
    ents, _, _, image_info = _page_landing(spark, d, pages)
    pid = F.col("page_id")
    file_search = pages.select(
        F.concat(F.lit("Page "), pid.cast("string")).alias("srsearch"), F.lit(6).alias("namespace"),
        F.when(pid % 7 == 0, F.lit(404)).otherwise(F.lit(200)).alias("http_status"),
        F.transform("hrefs", lambda h: F.struct(F.concat(F.lit("File:"), h).alias("title"))).alias("results"))
    file_search = with_repeats(file_search, ["srsearch"])
    out = media.search_media(ents, "page_id", "name", file_search, image_info)
    return out.select("page_id", "wiki_status", F.array_join("wiki_images", "|").alias("wiki_images"))


@query("clean_urls", "SELECT page_id, split_part(replace(url, 'square', 'medium'), '?', 1) AS clean_url FROM pages")
def q_clean_urls(spark, d):
    return table(spark, d, "pages").select("page_id", normalize_media_url("url").alias("clean_url"))


# ---- J11/P7: orders carry an image list by status (F none, O a duplicated
# pair, P three); the customer is the external id; a customer's landed
# observations are the part photos of its order lines, ten to a page of the
# service; customers divisible by 17 answer 500.
def _order_rows(spark, d):
    o = table(spark, d, "orders")
    k = F.col("o_orderkey")
    dup = F.concat(F.lit("img/medium/"), (k % 2000).cast("string"))
    imgs = (F.when(F.col("o_orderstatus") == "F", F.array().cast("array<string>"))
            .when(F.col("o_orderstatus") == "O", F.array(dup, dup))
            .otherwise(F.array(*[F.concat(F.lit(p), k.cast("string")) for p in ("a/", "b/", "c/")])))
    return o.select("o_orderkey", F.col("o_custkey").alias("inat_id"), imgs.alias("images"))


def _customer_observations(spark, d, per_page=10):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    lines = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    photo = F.struct(F.array(F.struct(F.concat(F.lit("img/square/"), F.col("l_partkey").cast("string")).alias("url")))
                     .alias("photos"))
    answers = first_page(lines.withColumn("item", photo), "o_custkey", ["l_orderkey", "l_linenumber", "l_partkey"],
                         per_page, "item")
    return with_repeats(answers.select(
        F.col("o_custkey").alias("taxon_id"),
        F.when(F.col("o_custkey") % 17 == 0, F.lit(500)).otherwise(F.lit(200)).alias("http_status"), "results"), ["taxon_id"])


ROWS_SQL = """
WITH rows_ AS (
  SELECT o_orderkey, o_custkey AS inat_id,
         CASE o_orderstatus WHEN 'F' THEN []
              WHEN 'O' THEN ['img/medium/' || CAST(o_orderkey % 2000 AS VARCHAR),
                             'img/medium/' || CAST(o_orderkey % 2000 AS VARCHAR)]
              ELSE ['a/' || CAST(o_orderkey AS VARCHAR), 'b/' || CAST(o_orderkey AS VARCHAR),
                    'c/' || CAST(o_orderkey AS VARCHAR)] END AS images
  FROM orders)
"""


@query("needs_enrichment", ROWS_SQL + """
SELECT o_orderkey, CAST(len(images) AS INTEGER) AS n_images FROM rows_
WHERE len(images) < 3 AND inat_id IS NOT NULL AND inat_id <> 0
""")
def q_needs_enrichment(spark, d):
    return media.needs_enrichment(_order_rows(spark, d), "images", "inat_id").select(
        "o_orderkey", F.size("images").alias("n_images"))


@query("expand_media", ROWS_SQL + """,
top10 AS (
  SELECT * FROM (
    SELECT o.o_custkey, l.l_partkey,
           row_number() OVER (PARTITION BY o.o_custkey ORDER BY l.l_orderkey, l.l_linenumber, l.l_partkey) AS rn
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey) WHERE rn <= 10),
newrows AS (
  SELECT o_custkey AS taxon_id, 'img/medium/' || CAST(l_partkey AS VARCHAR) AS url, min(rn) AS i
  FROM top10 WHERE o_custkey % 17 <> 0 GROUP BY 1, 2),
obs AS (SELECT DISTINCT taxon_id FROM newrows),
added AS (
  SELECT r.o_orderkey, list(n.url ORDER BY n.i) AS added
  FROM rows_ r JOIN newrows n ON n.taxon_id = r.inat_id
  WHERE NOT list_contains(r.images, n.url) GROUP BY r.o_orderkey)
SELECT r.o_orderkey,
       array_to_string(CASE WHEN len(r.images) < 3 AND r.inat_id IS NOT NULL AND r.inat_id <> 0
                                 AND obs.taxon_id IS NOT NULL
                            THEN (r.images || coalesce(a.added, []))[1:3] ELSE r.images END, '|') AS images
FROM rows_ r LEFT JOIN obs ON obs.taxon_id = r.inat_id LEFT JOIN added a USING (o_orderkey)
""")
def q_expand_media(spark, d):
    out = media.expand_media(_order_rows(spark, d), _customer_observations(spark, d), "images", "inat_id")
    return out.select("o_orderkey", F.array_join("images", "|").alias("images"))


@query("filter_allowed_license", """
SELECT doc_id, license FROM (
  SELECT doc_id, CASE CAST(regexp_extract(source, '[0-9]+') AS INTEGER) % 4
                   WHEN 0 THEN 'CC0' WHEN 1 THEN 'cc-by' WHEN 2 THEN 'cc-by-nc' ELSE 'CC-BY-SA' END AS license
  FROM documents)
WHERE lower(license) IN ('cc0', 'cc-by', 'cc-by-sa')
""")
def q_filter_allowed_license(spark, d):
    docs = table(spark, d, "documents")
    n = F.regexp_extract("source", "[0-9]+", 0).cast("int") % 4
    lic = (F.when(n == 0, F.lit("CC0")).when(n == 1, F.lit("cc-by")).when(n == 2, F.lit("cc-by-nc"))
           .otherwise(F.lit("CC-BY-SA")))
    return media.filter_allowed_license(docs.select("doc_id", lic.alias("license")), "license")
