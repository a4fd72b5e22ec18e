"""Bindings for the merge-and-load slice: A1, J10, M5, P11, P12."""

from __future__ import annotations

from pyspark.sql import functions as F

from florapipe.operators.merge import explode_media, explode_media_rows, longest_text, merge_entities, pick_primary
from florapipe.plans.registry import query
from florapipe.sources.tables import table

# part plays the species CSV: p_name = scientific name, p_partkey = row
# position, p_brand = common name, p_type = description; each row lists two
# "observation" images (brand, type) and one "reference" image (size).
MERGE_SQL = """
WITH base AS (
  SELECT p_name, p_partkey, p_brand, p_type, p_size, p_retailprice
  FROM part WHERE p_name IS NOT NULL),
firsts AS (
  SELECT p_name, p_partkey, p_brand, p_size, p_retailprice FROM (
    SELECT *, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS rn FROM base)
  WHERE rn = 1),
names AS (
  SELECT p_name,
         coalesce(string_agg(DISTINCT trim(p_brand), '|' ORDER BY trim(p_brand))
                  FILTER (WHERE trim(p_brand) <> ''), '') AS common_names
  FROM base GROUP BY p_name),
descr AS (
  SELECT p_name, p_type FROM (
    SELECT p_name, p_type,
           row_number() OVER (PARTITION BY p_name ORDER BY length(p_type) DESC, p_partkey) AS rn
    FROM base WHERE trim(p_type) <> '')
  WHERE rn = 1),
inat AS (
  SELECT p_name, string_agg(u, '|' ORDER BY p_partkey, i) AS inat_images FROM (
    SELECT *, row_number() OVER (PARTITION BY p_name, u ORDER BY p_partkey, i) AS rn FROM (
      SELECT p_name, p_partkey, 0 AS i, p_brand AS u FROM base WHERE p_brand IS NOT NULL
      UNION ALL
      SELECT p_name, p_partkey, 1 AS i, p_type AS u FROM base WHERE p_type IS NOT NULL))
  WHERE rn = 1 GROUP BY p_name),
wiki AS (
  SELECT p_name, string_agg(u, '|' ORDER BY p_partkey) AS wiki_images FROM (
    SELECT p_name, p_partkey, u,
           row_number() OVER (PARTITION BY p_name, u ORDER BY p_partkey) AS rn FROM (
      SELECT p_name, p_partkey, 'size/' || CAST(p_size AS VARCHAR) AS u FROM base))
  WHERE rn = 1 GROUP BY p_name)
SELECT f.p_name, f.p_partkey, f.p_brand, d.p_type, f.p_size, f.p_retailprice,
       n.common_names,
       coalesce(i.inat_images, '') AS inat_images,
       coalesce(w.wiki_images, '') AS wiki_images,
       coalesce(nullif(split_part(coalesce(i.inat_images, ''), '|', 1), ''),
                nullif(split_part(coalesce(w.wiki_images, ''), '|', 1), '')) AS primary_image_url
FROM firsts f
JOIN names n USING (p_name)
LEFT JOIN descr d USING (p_name)
LEFT JOIN inat i USING (p_name)
LEFT JOIN wiki w USING (p_name)
"""


def merged_parts(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    src = part.select(
        "p_name", "p_partkey", "p_brand", "p_type", "p_size", "p_retailprice",
        F.array_compact(F.array("p_brand", "p_type")).alias("inat_images"),
        F.array(F.concat(F.lit("size/"), F.col("p_size").cast("string"))).alias("wiki_images"))
    return merge_entities(src, key="p_name", pos="p_partkey", name_col="p_brand",
                          text_col="p_type", list_cols=["inat_images", "wiki_images"])


@query("merge_entities", MERGE_SQL)
def q_merge_entities(spark, sf_dir):
    m = pick_primary(merged_parts(spark, sf_dir), "inat_images", "wiki_images")
    return m.select(
        "p_name", "p_partkey", "p_brand", "p_type", "p_size", "p_retailprice",
        F.array_join("common_names", "|").alias("common_names"),
        F.array_join("inat_images", "|").alias("inat_images"),
        F.array_join("wiki_images", "|").alias("wiki_images"),
        F.col("primary_image_url"))


@query("longest_text", """
SELECT source, lang, doc_id, n_text FROM (
  SELECT source, lang, doc_id, CAST(length(text) AS INTEGER) AS n_text,
         row_number() OVER (PARTITION BY source, lang ORDER BY length(text) DESC, doc_id) AS rn
  FROM documents WHERE trim(text) <> '' AND source IS NOT NULL)
WHERE rn = 1
""")
def q_longest_text(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").filter(F.col("source").isNotNull())
    best = longest_text(docs, ["source", "lang"], "text", "doc_id")
    return best.select("source", "lang", "doc_id", F.length("text").alias("n_text"))


# J10 over orders x lineitem: each line lists its part image (observation
# list) and its supplier image (reference list), in line-number order.
EXPLODE_SQL = """
WITH items AS (
  SELECT l_orderkey AS species_id, 'img/' || CAST(l_partkey AS VARCHAR) AS image_url,
         'inat' AS source, 1 AS r, l_linenumber AS ln, l_partkey AS k FROM lineitem
  UNION ALL
  SELECT l_orderkey, 'img/' || CAST(l_suppkey AS VARCHAR), 'wiki', 2, l_linenumber, l_suppkey
  FROM lineitem),
firsts AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY species_id, image_url ORDER BY r, source, ln, k) AS rn
    FROM items) WHERE rn = 1),
numbered AS (
  SELECT species_id, image_url, source,
         CAST(row_number() OVER (PARTITION BY species_id ORDER BY r, source, ln, k) - 1 AS INTEGER)
           AS image_order
  FROM firsts)
SELECT species_id, image_url, source, (image_order = 0 AND source = 'inat') AS is_primary, image_order
FROM numbered
WHERE species_id IN (SELECT o_orderkey FROM orders)
"""


@query("explode_media", EXPLODE_SQL)
def q_explode_media(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("species_id"))
    listed = [F.struct(F.lit(s).alias("source"), F.col(c).alias("k")) for s, c in (("inat", "l_partkey"), ("wiki", "l_suppkey"))]
    rows = li.select(F.col("l_orderkey").alias("species_id"), F.col("l_linenumber").alias("ln"), F.inline(F.array(*listed)))
    rows = rows.withColumn("image_url", F.concat(F.lit("img/"), F.col("k").cast("string")))
    # only parents that exist get child rows (S9 lookup, inner semantics)
    rows = rows.join(orders, "species_id", "left_semi")
    return explode_media_rows(rows, "species_id", "image_url", "source", ["ln", "k"])


# J10's array form on the merged parts: the observation list, then the
# reference images not yet listed.
@query("explode_media_lists", MERGE_SQL.replace("SELECT f.p_name, f.p_partkey", "SELECT * FROM (SELECT f.p_name, f.p_partkey", 1)
       .replace("WITH base AS", "WITH merged AS (WITH base AS", 1) + """)),
imgs AS (
  SELECT p_partkey, u, source, r, i FROM (
    SELECT p_partkey, unnest(string_split(inat_images, '|')) AS u, 'inat' AS source, 1 AS r,
           generate_subscripts(string_split(inat_images, '|'), 1) AS i FROM merged WHERE inat_images <> ''
    UNION ALL
    SELECT p_partkey, unnest(string_split(wiki_images, '|')), 'wiki', 2,
           generate_subscripts(string_split(wiki_images, '|'), 1) FROM merged WHERE wiki_images <> '')),
firsts AS (SELECT *, row_number() OVER (PARTITION BY p_partkey, u ORDER BY r, i) AS k FROM imgs),
numbered AS (SELECT *, CAST(row_number() OVER (PARTITION BY p_partkey ORDER BY r, i) - 1 AS INTEGER) AS image_order
             FROM firsts WHERE k = 1)
SELECT p_partkey, u AS image_url, source, (image_order = 0 AND source = 'inat') AS is_primary, image_order FROM numbered
""")
def q_explode_media_lists(spark, sf_dir):
    return explode_media(merged_parts(spark, sf_dir), "p_partkey", "inat_images", "wiki_images")
