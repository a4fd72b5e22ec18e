"""Bindings for the description chain (J5, J5b, S12) and text flags."""

from __future__ import annotations

from pyspark.sql import functions as F

from florapipe.functions.expr import BINOMIAL_PATTERN, extract_binomial, page_title
from florapipe.operators.audit import yes_count
from florapipe.operators.text import cache_new_hits, flag_text_quality, text_fallback
from florapipe.plans.landing import capitalized, with_repeats
from florapipe.plans.registry import query
from florapipe.sources.tables import table


# Entities: part as species "<P>_name <brand>" (e.g. "Small ring Brand#13",
# binomial "Small ring", genus "Small").  Landed summary pages: documents --
# the binomial page of a name is the document numbered by its lowest part key,
# the full-name page the next one, the genus page the one after; German pages
# answered 500, Spanish ones failed in transport.  Search: a genus finds the
# full name of its lowest part.  Cache: names of parts whose label is toxic.
def text_landing(spark, d, canonical: bool = False):
    """``canonical``: the same landing for the names without their brand."""
    part, docs, labels = table(spark, d, "part"), table(spark, d, "documents"), table(spark, d, "labels")
    cap = capitalized("p_name")
    ents = part.select("p_partkey", (cap if canonical else F.concat_ws(" ", cap, F.col("p_brand"))).alias("name"),
                       F.substring_index(cap, " ", 1).alias("genus"))
    e = ents.withColumn("binomial", extract_binomial("name"))
    titles = (e.filter(F.col("binomial").isNotNull()).groupBy("binomial")
              .agg(F.min("p_partkey").alias("doc")).select(page_title("binomial").alias("title"), "doc")
              .unionByName(e.groupBy("name").agg((F.min("p_partkey") + 1).alias("doc"))
                           .select(page_title("name").alias("title"), "doc"))
              .unionByName(e.groupBy("genus").agg((F.min("p_partkey") + 2).alias("doc"))
                           .select(page_title("genus").alias("title"), "doc"))
              .groupBy("title").agg(F.min("doc").alias("doc")))
    status = (F.when(F.col("lang") == "de", F.lit(500)).when(F.col("lang") == "es", F.lit(None).cast("int"))
              .otherwise(F.lit(200)))
    summaries = titles.join(docs, F.col("doc") == F.col("doc_id")).select(
        "title", status.alias("http_status"), F.col("text").alias("extract"))
    searches = (e.groupBy("genus").agg(F.min_by("name", "p_partkey").alias("top"))
                .select(F.col("genus").alias("srsearch"), F.lit(200).alias("http_status"),
                        F.array(F.struct(F.col("top").alias("title"))).alias("results")))
    # merged: labels and texts that repeat are small in a file, by which a broadcast is chosen, and large as rows
    cache = (labels.filter(F.col("toxic") == 1).hint("merge").join(e, F.col("doc_id") == F.col("p_partkey"))
             .join(docs.select("doc_id", "text").hint("merge"), "doc_id")
             .groupBy("name").agg(F.min_by("text", "doc_id").alias("description"))
             .withColumn("source", F.lit("cache")))
    return ents, with_repeats(summaries, ["title"]), with_repeats(searches, ["srsearch"]), cache


TEXT_SQL = rf"""
WITH e AS (
  SELECT p_partkey, name, genus,
         CASE WHEN regexp_matches(name, '{BINOMIAL_PATTERN}')
              THEN regexp_extract(name, '{BINOMIAL_PATTERN}', 1) || ' ' ||
                   regexp_extract(name, '{BINOMIAL_PATTERN}', 2) END AS binomial
  FROM (SELECT p_partkey, concat_ws(' ', upper(substr(p_name, 1, 1)) || substr(p_name, 2), p_brand) AS name,
               split_part(upper(substr(p_name, 1, 1)) || substr(p_name, 2), ' ', 1) AS genus FROM part)),
titles AS (
  SELECT title, min(doc) AS doc FROM (
    SELECT replace(binomial, ' ', '_') AS title, min(p_partkey) AS doc FROM e WHERE binomial IS NOT NULL
    GROUP BY binomial
    UNION ALL SELECT replace(name, ' ', '_'), min(p_partkey) + 1 FROM e GROUP BY name
    UNION ALL SELECT replace(genus, ' ', '_'), min(p_partkey) + 2 FROM e GROUP BY genus)
  GROUP BY title),
summ AS (
  SELECT t.title, CASE d.lang WHEN 'de' THEN 500 WHEN 'es' THEN NULL ELSE 200 END AS http_status,
         d.text AS extract
  FROM titles t JOIN documents d ON d.doc_id = t.doc),
srch AS (SELECT genus AS srsearch, arg_min(name, p_partkey) AS top FROM e GROUP BY genus),
cache AS (
  SELECT e.name, arg_min(d.text, d.doc_id) AS description, 'cache' AS source
  FROM labels l JOIN e ON e.p_partkey = l.doc_id JOIN documents d ON d.doc_id = l.doc_id
  WHERE l.toxic = 1 GROUP BY e.name)
"""


TEXT_CHAIN_SQL = TEXT_SQL + r""",
cands AS (
  SELECT p_partkey, 0 AS prio, binomial AS q FROM e WHERE binomial IS NOT NULL AND binomial <> name
  UNION ALL SELECT p_partkey, 1, name FROM e WHERE name IS NOT NULL
  UNION ALL SELECT p_partkey, 2, genus FROM e WHERE genus IS NOT NULL AND genus <> ''),
keys AS (SELECT DISTINCT q FROM cands),
s1 AS (
  SELECT k.q, CASE WHEN s.http_status = 200 AND length(s.extract) > 50 THEN s.extract END AS text1,
         (s.title IS NOT NULL AND s.http_status IS NULL) AS fail1
  FROM keys k LEFT JOIN summ s ON replace(k.q, ' ', '_') = s.title),
s2 AS (
  SELECT k.q, s.extract AS text2 FROM keys k JOIN srch r ON r.srsearch = k.q
  JOIN summ s ON replace(r.top, ' ', '_') = s.title
  WHERE s.http_status = 200 AND length(s.extract) > 50),
res AS (
  SELECT s1.q,
         CASE WHEN text1 IS NOT NULL THEN 1 WHEN NOT fail1 AND text2 IS NOT NULL THEN 2 END AS stage,
         CASE WHEN text1 IS NOT NULL THEN text1 WHEN NOT fail1 THEN text2 END AS text
  FROM s1 LEFT JOIN s2 USING (q)),
best AS (
  SELECT * FROM (
    SELECT c.p_partkey, c.prio, r.text,
           row_number() OVER (PARTITION BY c.p_partkey ORDER BY c.prio, r.stage) AS rn
    FROM cands c JOIN res r USING (q) WHERE r.text IS NOT NULL) WHERE rn = 1),
lk AS (
SELECT e.p_partkey, e.name,
       CASE WHEN ca.description IS NOT NULL AND ca.description <> '' THEN ca.description
            ELSE coalesce(b.text, 'Description not found.') END AS description,
       CASE WHEN ca.description IS NOT NULL AND ca.description <> '' THEN ca.source
            ELSE coalesce(['binomial', 'species', 'genus'][b.prio + 1], 'none') END AS description_source
FROM e LEFT JOIN best b USING (p_partkey) LEFT JOIN cache ca ON e.name = ca.name)
"""


def looked_up(spark, d):
    ents, summaries, searches, cache = text_landing(spark, d)
    return text_fallback(ents, "p_partkey", "name", summaries, searches, cache, genus_col="genus")


@query("text_fallback", TEXT_CHAIN_SQL + "SELECT * FROM lk")
def q_text_fallback(spark, d):
    return looked_up(spark, d).drop("genus")


@query("lookup_cache", TEXT_CHAIN_SQL + """,
hits AS (
  SELECT name, description, description_source AS source FROM (
    SELECT *, row_number() OVER (PARTITION BY name ORDER BY description DESC, description_source DESC) AS rn
    FROM lk WHERE description_source <> 'none') WHERE rn = 1)
SELECT name, description, source FROM cache WHERE name NOT IN (SELECT name FROM hits)
UNION ALL SELECT name, description, source FROM hits
""")
def q_lookup_cache(spark, d):
    _, _, _, cache = text_landing(spark, d)
    return cache_new_hits(cache, looked_up(spark, d), "name")


@query("text_fallback_short", TEXT_SQL + r""",
cands AS (
  SELECT p_partkey, 0 AS prio, name AS q FROM e WHERE name IS NOT NULL
  UNION ALL
  SELECT p_partkey, 1, t FROM (
    SELECT p_partkey, name, array_to_string(string_split_regex(trim(name), '\s+')[1:2], ' ') AS t FROM e)
  WHERE t <> name
  UNION ALL SELECT p_partkey, 2, split_part(name, ' ', 1) FROM e WHERE split_part(name, ' ', 1) <> ''),
res AS (
  SELECT q, regexp_replace(s.extract, '^\s+|\s+$', '', 'g') AS text
  FROM (SELECT DISTINCT q FROM cands) k JOIN summ s ON replace(k.q, ' ', '_') = s.title
  WHERE s.http_status = 200 AND length(regexp_replace(s.extract, '^\s+|\s+$', '', 'g')) > 0),
best AS (
  SELECT * FROM (
    SELECT c.p_partkey, c.prio, r.text, row_number() OVER (PARTITION BY c.p_partkey ORDER BY c.prio) AS rn
    FROM cands c JOIN res r USING (q)) WHERE rn = 1)
SELECT e.p_partkey, e.name, coalesce(b.text, '') AS description,
       coalesce(['species', 'cleaned', 'genus'][b.prio + 1], 'none') AS description_source
FROM e LEFT JOIN best b USING (p_partkey)
""")
def q_text_fallback_short(spark, d):
    ents, summaries, _, _ = text_landing(spark, d)
    return text_fallback(ents.select("p_partkey", "name"), "p_partkey", "name", summaries,
                         candidates=(("species", "species"), ("two_tokens", "cleaned"), ("genus", "genus")),
                         min_len=0, strip=True, not_found=("", "none"))


@query("flag_text_quality", """
SELECT doc_id, CAST(coalesce(length(text), 0) AS INTEGER) AS description_length,
       CASE WHEN coalesce(length(text), 0) > 50 THEN 'Yes' ELSE 'No' END AS has_wiki
FROM documents
""")
def q_flag_text_quality(spark, d):
    return flag_text_quality(table(spark, d, "documents"), "text").select("doc_id", "description_length",
                                                                            "has_wiki")


@query("yes_count", "SELECT count(*) FILTER (WHERE coalesce(length(text), 0) > 50) AS n_yes FROM documents")
def q_yes_count(spark, d):
    return yes_count(flag_text_quality(table(spark, d, "documents"), "text"))
