"""Bindings for name resolution and retried lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from florapipe.operators.attempts import first_acceptable
from florapipe.operators.resolve import (best_match, first_result, preferred_label, resolve_accepted_name,
                                         top_taxon)
from florapipe.operators.responses import first_page, one_response
from florapipe.plans.landing import capitalized as cap
from florapipe.plans.landing import with_repeats
from florapipe.plans.registry import query
from florapipe.sources.tables import table


# ---- landed taxon-search responses derived from part: for every genus
# (first word) and every full name whose length is not a multiple of 3, the
# parts (by key) under that query, of which the service's page holds the first
# five; queries whose length is a multiple of 7 answered 500, a multiple of 13 not at all.
PER_PAGE = 5


def landed_taxa_search(spark, d, capitalized: bool = False, per_page: int = PER_PAGE):
    part = table(spark, d, "part")
    if capitalized:   # names written as scientific names ("Small ring")
        part = part.withColumn("p_name", cap("p_name"))

    def result(p):
        pk = p["p_partkey"].cast("string")
        return F.struct(
            p["p_partkey"].alias("id"), p["p_name"].alias("name"),
            p["p_size"].cast("bigint").alias("observations_count"),
            F.when(p["p_brand"].endswith("1"), F.lit(None).cast("string")).otherwise(p["p_brand"])
            .alias("preferred_common_name"),
            p["p_type"].alias("english_common_name"),
            F.array(
                F.struct(F.struct(F.when(p["p_size"] % 2 == 0, F.concat(F.lit("l/"), pk)).alias("large_url"),
                                  F.concat(F.lit("m/"), pk).alias("medium_url"),
                                  F.concat(F.lit("s/"), pk).alias("square_url")).alias("photo")),
                F.struct(F.struct(F.lit(None).cast("string").alias("large_url"), F.lit("").alias("medium_url"),
                                  F.concat(F.lit("sq/"), pk).alias("square_url")).alias("photo")))
            .alias("taxon_photos"))

    # the part's own columns are sorted; results are made of those on a page
    item = F.struct("p_partkey", "p_name", "p_brand", "p_type", "p_size").alias("item")
    by_genus = part.select(F.substring_index("p_name", " ", 1).alias("q"), "p_partkey", item)
    by_name = part.filter(F.length("p_name") % 3 != 0).select(F.col("p_name").alias("q"), "p_partkey", item)
    return (first_page(by_genus.unionByName(by_name), "q", ["p_partkey"], per_page, "item")
            .withColumn("results", F.transform("results", result))
            .withColumn("http_status", F.when(F.length("q") % 7 == 0, F.lit(500))
                        .when(F.length("q") % 13 != 0, F.lit(200))).transform(lambda r: with_repeats(r, ["q"])))


SEARCH_SQL = """
WITH res AS (
  SELECT q, CASE WHEN length(q) % 7 = 0 THEN 500 WHEN length(q) % 13 <> 0 THEN 200 END AS http_status, rn, id, rname, obs, pref, eng,
         url1, url2, med1
  FROM (
    SELECT q, p_partkey AS id, p_name AS rname, CAST(p_size AS BIGINT) AS obs,
           CASE WHEN p_brand LIKE '%1' THEN NULL ELSE p_brand END AS pref, p_type AS eng,
           CASE WHEN p_size % 2 = 0 THEN 'l/' ELSE 'm/' END || CAST(p_partkey AS VARCHAR) AS url1,
           'sq/' || CAST(p_partkey AS VARCHAR) AS url2,
           'm/' || CAST(p_partkey AS VARCHAR) AS med1,
           row_number() OVER (PARTITION BY q ORDER BY p_partkey) AS rn
    FROM (SELECT *, split_part(p_name, ' ', 1) AS q FROM part
          UNION ALL
          SELECT *, p_name AS q FROM part WHERE length(p_name) % 3 <> 0))
  WHERE rn <= 5)
"""


@query("best_match", SEARCH_SQL + """,
cands AS (
  SELECT p_partkey, p_name, 0 AS prio, p_name AS q FROM part
  UNION ALL SELECT p_partkey, p_name, 1, replace(p_name, '-', ' ') FROM part
  UNION ALL SELECT p_partkey, p_name, 2, split_part(p_name, ' ', 1) FROM part),
j AS (
  SELECT c.p_partkey, c.prio, c.q, r.http_status, r.rn, r.id, r.rname,
         coalesce(contains(lower(r.rname), lower(c.p_name)), false) AS hit
  FROM cands c JOIN res r ON c.q = r.q WHERE r.http_status = 200 OR r.http_status IS NULL),
bp AS (SELECT p_partkey, min(prio) AS prio FROM j GROUP BY p_partkey),
pick AS (
  SELECT * FROM (
    SELECT j.*, row_number() OVER (PARTITION BY j.p_partkey ORDER BY (NOT j.hit), j.rn) AS k
    FROM j JOIN bp USING (p_partkey, prio)) WHERE k = 1)
SELECT p.p_partkey, p.p_name, CASE WHEN pick.http_status = 200 THEN pick.q END AS q_used,
       CASE WHEN pick.http_status = 200 THEN pick.id END AS taxon_id,
       CASE WHEN pick.http_status = 200 THEN pick.rname END AS taxon_name,
       CASE WHEN p.p_name IS NULL THEN 'invalid_name' WHEN pick.id IS NULL THEN 'taxon_not_found'
            WHEN pick.http_status IS NULL THEN 'timeout' ELSE 'success' END AS inat_status
FROM part p LEFT JOIN pick USING (p_partkey)
""")
def q_best_match(spark, d):
    ents = table(spark, d, "part").select("p_partkey", "p_name")
    out = best_match(ents, landed_taxa_search(spark, d), "p_partkey", "p_name")
    return out.select("p_partkey", "p_name", "q_used", F.col("taxon.id").alias("taxon_id"),
                      F.col("taxon.name").alias("taxon_name"), "inat_status")


@query("top_taxon", SEARCH_SQL + """,
cands AS (
  SELECT p_partkey, 0 AS prio, p_name AS q FROM part
  UNION ALL SELECT p_partkey, 1, split_part(p_name, ' ', 1) FROM part),
j AS (SELECT c.p_partkey, c.prio, r.* EXCLUDE (q) FROM cands c JOIN res r ON c.q = r.q WHERE r.http_status = 200),
top_in AS (
  SELECT * FROM (SELECT j.*, row_number() OVER (PARTITION BY p_partkey, prio
                                                ORDER BY coalesce(obs, -1) DESC, rn) AS k FROM j)
  WHERE k = 1),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY prio) AS kk FROM top_in)
         WHERE kk = 1)
SELECT p.p_partkey, b.id AS inat_id, coalesce(b.pref, '') AS common_name,
       CAST(coalesce(b.obs, 0) AS BIGINT) AS observations_count,
       coalesce(b.url1, '') AS image_primary,
       CASE WHEN b.id IS NULL THEN '' ELSE b.url1 || '|' || b.url2 END AS image_gallery
FROM part p LEFT JOIN best b USING (p_partkey)
""")
def q_top_taxon(spark, d):
    ents = table(spark, d, "part").select("p_partkey", "p_name")
    out = top_taxon(ents, landed_taxa_search(spark, d), "p_partkey", "p_name")
    return out.select("p_partkey", "inat_id", "common_name", "observations_count", "image_primary",
                      F.array_join("image_gallery", "|").alias("image_gallery"))


@query("first_result", SEARCH_SQL + """
SELECT q, http_status, id AS inat_id, obs AS observations, med1 AS images,
       coalesce(nullif(pref, ''), nullif(eng, ''), '') AS common_name, CAST(NULL AS VARCHAR) AS inat_status
FROM res WHERE rn = 1
UNION ALL
SELECT 'empty ' || r_name, 200, NULL, NULL, '', '', 'unknown' FROM region
""")
def q_first_result(spark, d):
    landed = landed_taxa_search(spark, d)
    empty = table(spark, d, "region").select(
        F.concat(F.lit("empty "), F.col("r_name")).alias("q"), F.array().cast(landed.schema["results"].dataType).alias("results"),
        F.lit(200).alias("http_status"))
    out = first_result(one_response(landed.unionByName(empty, allowMissingColumns=True), ["q"]))
    return out.select("q", "http_status", "inat_id", "observations", F.array_join("images", "|").alias("images"),
                      "common_name", "inat_status")


# ---- J2: part names resolved through landed name matches built from part
# itself: the lowest key k of a name decides the match (k % 11 = 0 failed,
# k % 3 = 0 accepted, 1 synonym of the name of part k + 1, 2 doubtful with an
# upper-case canonical name).
def landed_name_matches(spark, d, capitalized: bool = False):
    part = table(spark, d, "part")
    if capitalized:
        part = part.withColumn("p_name", cap("p_name"))
    base = part.groupBy("p_name").agg(F.min("p_partkey").alias("k"))
    # merged: keys and repeated names are small in a file, by which a broadcast is chosen, and large as rows
    nxt = part.select(F.col("p_partkey").alias("_k1"), F.col("p_name").alias("_acc")).hint("merge")
    k = F.col("k")
    return with_repeats(base.join(nxt, k + 1 == F.col("_k1"), "left")
            .select(F.col("p_name").alias("name"),
                    F.when(k % 11 == 0, F.lit(404)).otherwise(F.lit(200)).alias("http_status"),
                    k.alias("usageKey"),
                    F.when(k % 3 == 0, F.lit("ACCEPTED")).when(k % 3 == 1, F.lit("SYNONYM"))
                    .otherwise(F.lit("DOUBTFUL")).alias("status"),
                    (k % 3 == 1).alias("synonym"),
                    F.when(k % 3 == 2, F.upper("p_name")).otherwise(F.col("p_name")).alias("canonicalName"),
                    F.when((k % 3 == 1) & F.col("_acc").isNotNull(),
                           F.struct(F.col("_acc").alias("canonicalName"))).alias("acceptedUsage")), ["name"])


@query("resolve_accepted_name", """
WITH base AS (SELECT p_name, min(p_partkey) AS k FROM part GROUP BY p_name),
m AS (
  SELECT b.p_name AS name, CASE WHEN b.k % 11 = 0 THEN 404 ELSE 200 END AS http_status, b.k AS usageKey,
         CASE b.k % 3 WHEN 0 THEN 'ACCEPTED' WHEN 1 THEN 'SYNONYM' ELSE 'DOUBTFUL' END AS status,
         (b.k % 3 = 1) AS synonym,
         CASE WHEN b.k % 3 = 2 THEN upper(b.p_name) ELSE b.p_name END AS canonicalName,
         CASE WHEN b.k % 3 = 1 THEN n.p_name END AS accepted_name
  FROM base b LEFT JOIN part n ON n.p_partkey = b.k + 1),
ans AS (
  SELECT name, CASE WHEN http_status <> 200 THEN NULL
                    WHEN coalesce(usageKey <> 0, false) AND status = 'ACCEPTED' THEN canonicalName
                    WHEN synonym AND accepted_name IS NOT NULL THEN accepted_name
                    ELSE canonicalName END AS a
  FROM m)
SELECT p.p_partkey, p.p_name, coalesce(nullif(ans.a, ''), p.p_name) AS resolved_name
FROM part p LEFT JOIN ans ON p.p_name = ans.name
""")
def q_resolve_accepted_name(spark, d):
    part = table(spark, d, "part")
    return resolve_accepted_name(part.select("p_partkey", "p_name"), landed_name_matches(spark, d), "p_name")


@query("preferred_label", """
SELECT source, doc_id, coalesce(text, '') AS label FROM (
  SELECT source, doc_id, text,
         row_number() OVER (PARTITION BY source ORDER BY (lang IS DISTINCT FROM 'en'), doc_id) AS rn
  FROM documents) WHERE rn = 1
""")
def q_preferred_label(spark, d):
    docs = table(spark, d, "documents")
    return preferred_label(docs, ["source"], "lang", "text", "doc_id", preferred="en")


@query("first_acceptable", """
WITH a AS (
  SELECT user_id, event_id, event_type,
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INTEGER) AS attempt
  FROM events),
ok AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY attempt) AS k
                 FROM a WHERE attempt <= 5 AND event_type = 'purchase') WHERE k = 1)
SELECT u.user_id, ok.attempt, ok.event_id, coalesce(ok.event_type, 'max_retries_exhausted') AS event_type
FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN ok USING (user_id)
""")
def q_first_acceptable(spark, d):
    ev = table(spark, d, "events")
    return first_acceptable(ev, "user_id", ["ts", "event_id"], F.col("event_type") == "purchase",
                            ["event_id", "event_type"], max_attempts=5, status_col="event_type")
