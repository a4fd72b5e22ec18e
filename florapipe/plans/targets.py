"""Bindings for target selection, paging and probes (P6, J1, P9, S2-S4, J7,
J8, O1, S11, A11, A12)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from florapipe.operators import enumeration as en
from florapipe.operators.probe import order_probe_report, probe_summary
from florapipe.plans.landing import with_repeats
from florapipe.plans.registry import query
from florapipe.sources.tables import table


# ---- S2: part listed as paged taxonomy responses, pages of <= 100 keys by
# key range, one "order" per p_type.
def landed_species_pages(spark, d):
    part = table(spark, d, "part")
    return (part.withColumn("offset", (F.floor(F.col("p_partkey") / 100) * 100).cast("bigint"))
            .groupBy(F.col("p_type").alias("order_name"), "offset")
            .agg(F.count(F.lit(1)).alias("count"),
                 F.array_sort(F.collect_list(F.struct(
                     F.col("p_partkey").alias("key"), F.col("p_name").alias("scientificName"),
                     F.col("p_brand").alias("family")))).alias("results"))
            .withColumn("http_status", F.lit(200)))


@query("explode_pages", """
SELECT p_type AS order_name, CAST(floor(p_partkey / 100) * 100 AS BIGINT) AS "offset",
       CAST(row_number() OVER (PARTITION BY p_type, floor(p_partkey / 100) ORDER BY p_partkey) - 1 AS INTEGER)
         AS "index",
       p_partkey AS "key", p_name AS scientificName, p_brand AS family
FROM part WHERE p_partkey IS NOT NULL
""")
def q_explode_pages(spark, d):
    return en.explode_pages(landed_species_pages(spark, d), ["order_name"], "offset", "results")


# ---- S3: lineitem as pages: group = order key, offset = line number;
# flag R = the service answered 500 (stop), A = the request failed (skip),
# N = a page with l_quantity results.
@query("page_prefix", """
WITH p AS (
  SELECT *, CASE l_returnflag WHEN 'R' THEN 500 WHEN 'A' THEN NULL ELSE 200 END AS st,
         CAST(l_quantity AS BIGINT) AS nr
  FROM lineitem),
stops AS (
  SELECT l_orderkey, min(l_linenumber) AS first_stop FROM p
  WHERE st IS NOT NULL AND (st <> 200 OR coalesce(nr, 0) = 0) GROUP BY l_orderkey)
SELECT p.l_orderkey, p.l_linenumber, p.l_partkey, p.l_suppkey, p.l_returnflag
FROM p LEFT JOIN stops s USING (l_orderkey)
WHERE p.st = 200 AND (s.first_stop IS NULL OR p.l_linenumber < s.first_stop)
""")
def q_page_prefix(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                            "l_returnflag", "l_quantity")
    status = (F.when(F.col("l_returnflag") == "R", F.lit(500))
              .when(F.col("l_returnflag") == "A", F.lit(None).cast("int")).otherwise(F.lit(200)))
    kept = en.page_prefix(li, "l_orderkey", "l_linenumber", status, F.col("l_quantity").cast("bigint"))
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")


# ---- S4: part as the taxon table; size > 40 is a genus, PROMO a synonym.
@query("accepted_species", """
SELECT p_partkey, p_name, p_type AS order_key FROM part
WHERE (CASE WHEN p_size <= 40 THEN 'SPECIES' ELSE 'GENUS' END) = 'SPECIES'
  AND (CASE WHEN p_type = 'PROMO' THEN 'SYNONYM' ELSE 'ACCEPTED' END) = 'ACCEPTED'
  AND p_type IN ('ECONOMY', 'STANDARD', 'PROMO', 'LARGE')
""")
def q_accepted_species(spark, d):
    taxa = table(spark, d, "part").select(
        "p_partkey", "p_name", F.col("p_type").alias("order_key"),
        F.when(F.col("p_size") <= 40, F.lit("SPECIES")).otherwise(F.lit("GENUS")).alias("rank"),
        F.when(F.col("p_type") == "PROMO", F.lit("SYNONYM")).otherwise(F.lit("ACCEPTED")).alias("status"))
    out = en.accepted_species(taxa, ["ECONOMY", "STANDARD", "PROMO", "LARGE"])
    return out.select("p_partkey", "p_name", "order_key")


# ---- O1: first 1,000 orders per priority by (date, key).
@query("limit_per_group", """
SELECT o_orderkey, o_orderpriority, rank_in_group FROM (
  SELECT o_orderkey, o_orderpriority,
         row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey) AS rank_in_group
  FROM orders) WHERE rank_in_group <= 1000
""")
def q_limit_per_group(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate")
    out = en.limit_per_group(o, "o_orderpriority", ["o_orderdate", "o_orderkey"], n=1000)
    return out.select("o_orderkey", "o_orderpriority", "rank_in_group")


# ---- P6: nation as the (batch, order) dimension (batch = region); the
# customers of the selected batch.
def _order_dim(spark, d):
    return table(spark, d, "nation").select(F.col("n_regionkey").alias("batch"),
                                            F.col("n_name").alias("order_name"),
                                            F.col("n_nationkey").alias("order_key"))


@query("select_targets", """
SELECT c_custkey, c_name, c_nationkey FROM customer
WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)
""")
def q_select_targets(spark, d):
    picked = en.select_targets(_order_dim(spark, d), batch=1)
    cust = table(spark, d, "customer")
    # the picked dimension is a subset of the 25-row nation table
    return (cust.join(picked.select(F.col("order_key").alias("c_nationkey")), "c_nationkey",
                      "left_semi").select("c_custkey", "c_name", "c_nationkey"))


# ---- J1: order names used by customers, resolved against landed matches
# derived from nation.
MATCHES_SQL = """
WITH matches AS (
  SELECT n_name AS name,
         CASE WHEN n_nationkey % 10 = 7 THEN NULL WHEN n_nationkey % 10 = 9 THEN 503 ELSE 200 END
           AS http_status,
         CASE n_nationkey % 4 WHEN 0 THEN 'NONE' WHEN 1 THEN NULL ELSE 'EXACT' END AS matchType,
         CASE WHEN n_regionkey = 4 THEN 'Animalia' ELSE 'Plantae' END AS kingdom,
         CASE WHEN n_nationkey % 5 = 3 THEN 'FAMILY' ELSE 'ORDER' END AS rank,
         CAST(n_nationkey + 1000 AS BIGINT) AS orderKey
  FROM nation),
names AS (
  SELECT DISTINCT n.n_name AS order_name FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey)
"""


def _matches(spark, d):
    n = table(spark, d, "nation")
    k = F.col("n_nationkey")
    return with_repeats(n.select(
        F.col("n_name").alias("name"),
        F.when(k % 10 == 7, F.lit(None).cast("int")).when(k % 10 == 9, F.lit(503)).otherwise(F.lit(200))
        .alias("http_status"),
        F.when(k % 4 == 0, F.lit("NONE")).when(k % 4 == 1, F.lit(None).cast("string"))
        .otherwise(F.lit("EXACT")).alias("matchType"),
        F.when(F.col("n_regionkey") == 4, F.lit("Animalia")).otherwise(F.lit("Plantae")).alias("kingdom"),
        F.when(k % 5 == 3, F.lit("FAMILY")).otherwise(F.lit("ORDER")).alias("rank"),
        (k + 1000).cast("bigint").alias("orderKey")), ["name"])


@query("resolve_orders", MATCHES_SQL + """
SELECT order_name,
       CASE WHEN st = 'resolved' THEN orderKey END AS order_key, st AS status
FROM (SELECT names.order_name, m.orderKey,
             CASE WHEN m.name IS NULL OR m.http_status IS NULL THEN 'error'
                  WHEN m.http_status <> 200 THEN 'http_error'
                  WHEN m.matchType IS DISTINCT FROM 'NONE' AND m.kingdom = 'Plantae' AND m.rank = 'ORDER'
                    THEN 'resolved'
                  ELSE 'unresolved' END AS st
      FROM names LEFT JOIN matches m ON names.order_name = m.name)
""")
def q_resolve_orders(spark, d):
    cust = table(spark, d, "customer").select(F.col("c_nationkey").alias("n_nationkey")).distinct()
    names = (cust.join(table(spark, d, "nation"), "n_nationkey")
             .select(F.col("n_name").alias("order_name")).distinct())
    return en.resolve_orders(names, _matches(spark, d))


# ---- P9: each customer's order verified: region EUROPE is not a plant
# kingdom, nation keys ending in 5 failed; class from market segment.
CLADE_SQL = """
WITH details AS (
  SELECT c.c_custkey,
         CASE WHEN c.c_nationkey % 10 = 5 THEN 404 ELSE 200 END AS http_status,
         CASE WHEN r.r_name = 'EUROPE' THEN 'Animalia' ELSE 'Plantae' END AS kingdom,
         CASE c.c_mktsegment WHEN 'BUILDING' THEN 'Magnoliopsida' WHEN 'FURNITURE' THEN 'Liliopsida'
              ELSE 'Pinopsida' END AS class
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey)
"""


def _clade_details(spark, d):
    nation, region = table(spark, d, "nation"), table(spark, d, "region")
    dim = nation.join(region, nation.n_regionkey == region.r_regionkey)  # 25 rows
    c = table(spark, d, "customer").join(dim, F.col("c_nationkey") == F.col("n_nationkey"))
    seg = F.col("c_mktsegment")
    return c.select(
        "c_custkey", "c_nationkey", "c_name", "c_mktsegment",
        F.when(F.col("c_nationkey") % 10 == 5, F.lit(404)).otherwise(F.lit(200)).alias("http_status"),
        F.when(F.col("r_name") == "EUROPE", F.lit("Animalia")).otherwise(F.lit("Plantae")).alias("kingdom"),
        F.when(seg == "BUILDING", F.lit("Magnoliopsida")).when(seg == "FURNITURE", F.lit("Liliopsida"))
        .otherwise(F.lit("Pinopsida")).alias("class"))


@query("classify_clade", CLADE_SQL + """
SELECT c_custkey,
       CASE WHEN http_status = 200 AND kingdom = 'Plantae' THEN class IN ('Magnoliopsida', 'Liliopsida') END
         AS is_angiosperm,
       coalesce(http_status = 200 AND kingdom = 'Plantae', false) AS verified
FROM details
""")
def q_classify_clade(spark, d):
    return en.classify_clade(_clade_details(spark, d)).select("c_custkey", "is_angiosperm", "verified")


@query("exclude_processed", """
SELECT c_custkey FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P' AND o_custkey IS NOT NULL)
""")
def q_exclude_processed(spark, d):
    # the sink: customers recorded through a pending order
    cust = table(spark, d, "customer").select("c_custkey")
    sink = table(spark, d, "orders").filter(F.col("o_orderstatus") == "P")
    return en.exclude_processed(cust, sink, "c_custkey", "o_custkey")


@query("retry_candidates", """
SELECT DISTINCT o_custkey FROM orders
WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_custkey IS NOT NULL)
""")
def q_retry_candidates(spark, d):
    o = table(spark, d, "orders")
    return en.retry_candidates(o, o.filter(F.col("o_orderstatus") == "F"), "o_custkey")


@query("progress_state", """
SELECT o_orderpriority, count(*) AS n_processed, count(DISTINCT o_custkey) AS n_ids,
       max(o_orderkey) AS last_offset, CAST(max(o_orderdate) AS VARCHAR) AS last_update
FROM orders GROUP BY o_orderpriority
""")
def q_progress_state(spark, d):
    out = en.progress_state(table(spark, d, "orders"), "o_custkey", "o_orderpriority", "o_orderkey",
                            "o_orderdate")
    return out.withColumn("last_update", F.col("last_update").cast("string"))


# ---- A11/A12: nations are the probed orders, their customers the species
# listing (family = market segment), clade from P9's rule on the nation.
PROBE_SQL = """
WITH orders_ AS (SELECT n_name AS order_name, n_nationkey AS order_key FROM nation),
clades AS (
  SELECT n.n_nationkey AS order_key,
         CASE WHEN n.n_nationkey % 10 <> 5 AND r.r_name <> 'EUROPE'
              THEN (CASE n.n_nationkey % 3 WHEN 0 THEN 'Magnoliopsida' WHEN 1 THEN 'Liliopsida'
                    ELSE 'Pinopsida' END) IN ('Magnoliopsida', 'Liliopsida') END AS is_angiosperm
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey),
ans AS (SELECT n_nationkey AS order_key, CASE n_nationkey % 8 WHEN 6 THEN NULL WHEN 7 THEN 503 ELSE 200 END AS st FROM nation),
sp AS (SELECT c_nationkey AS order_key, c_custkey AS pos, c_name AS name,
              CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE c_mktsegment END AS family,
              row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS rn FROM customer
       WHERE c_nationkey % 8 < 6),
tx AS (SELECT c_name AS name, min(o_orderkey) AS inat_id FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1),
counts AS (SELECT order_key, count(*) AS total_available FROM sp GROUP BY order_key),
firsts AS (SELECT order_key, string_agg(coalesce(name, 'Unknown'), '|' ORDER BY rn) AS sample_names,
                  string_agg(coalesce(family, 'Unknown'), '|' ORDER BY rn) AS sample_families,
                  string_agg(coalesce(CAST(inat_id AS VARCHAR), ''), '|' ORDER BY rn) AS sample_taxa
           FROM sp LEFT JOIN tx USING (name) WHERE rn <= 3 GROUP BY order_key),
report AS (
  SELECT o.order_name, o.order_key, c.is_angiosperm,
         CAST(coalesce(n.total_available, 0) AS BIGINT) AS total_available,
         CAST(least(coalesce(n.total_available, 0), 5) AS BIGINT) AS retrieved,
         coalesce(f.sample_names, '') AS sample_names, coalesce(f.sample_families, '') AS sample_families,
         coalesce(f.sample_taxa, '') AS sample_taxa,
         CASE WHEN ans.st IS NULL THEN 'Network failure' WHEN ans.st <> 200 THEN 'error:' || CAST(ans.st AS VARCHAR)
              WHEN coalesce(n.total_available, 0) > 0 THEN 'success' ELSE 'No results' END AS status
  FROM orders_ o JOIN ans USING (order_key) LEFT JOIN counts n USING (order_key) LEFT JOIN firsts f USING (order_key)
  LEFT JOIN clades c USING (order_key))
"""


def _probe(spark, d):
    nation, region = table(spark, d, "nation"), table(spark, d, "region")
    k = F.col("n_nationkey")
    cls = F.when(k % 3 == 0, F.lit("Magnoliopsida")).when(k % 3 == 1, F.lit("Liliopsida")) \
        .otherwise(F.lit("Pinopsida"))
    details = (nation.join(region, nation.n_regionkey == region.r_regionkey)
               .select(k.alias("order_key"),
                       F.when(k % 10 == 5, F.lit(404)).otherwise(F.lit(200)).alias("http_status"),
                       F.when(F.col("r_name") == "EUROPE", F.lit("Animalia")).otherwise(F.lit("Plantae"))
                       .alias("kingdom"), cls.alias("class")))
    clades = en.classify_clade(details)
    orders = nation.select(F.col("n_name").alias("order_name"), k.alias("order_key"))
    cust = table(spark, d, "customer")
    species = cust.select(
        F.col("c_nationkey").alias("order_key"), F.col("c_custkey").alias("pos"), F.col("c_name").alias("name"),
        F.when(F.col("c_custkey") % 6 != 0, F.col("c_mktsegment")).alias("family"))
    status = F.when(k % 8 == 6, F.lit(None).cast("int")).when(k % 8 == 7, F.lit(503)).otherwise(F.lit(200))
    answers = nation.select(k.alias("order_key"), status.alias("http_status"))
    taxa = (cust.join(table(spark, d, "orders"), F.col("c_custkey") == F.col("o_custkey"))
            .groupBy(F.col("c_name").alias("name")).agg(F.min("o_orderkey").alias("inat_id")))
    return orders, species, clades, answers, taxa


@query("order_probe_report", PROBE_SQL + "SELECT * FROM report")
def q_order_probe_report(spark, d):
    orders, species, clades, answers, taxa = _probe(spark, d)
    return order_probe_report(orders, species, clades, answers=answers, taxa=taxa)


@query("probe_summary", PROBE_SQL + """,
samples AS (SELECT order_key AS order_pos, rn AS sample_pos, family FROM sp WHERE rn <= 3),
fam AS (SELECT family, count(*) AS n, min(order_pos * 1000 + sample_pos) AS first FROM samples
        WHERE family IS NOT NULL AND family <> '' GROUP BY family),
ranked AS (SELECT family, row_number() OVER (ORDER BY n DESC, first) AS r FROM fam)
SELECT (SELECT count(*) FROM report WHERE status = 'success') AS n_success,
       (SELECT count(*) FROM report WHERE status <> 'success') AS n_failed,
       (SELECT CAST(coalesce(sum(total_available), 0) AS BIGINT) FROM report WHERE status = 'success')
         AS total_available,
       (SELECT count(*) FROM report WHERE status = 'success' AND coalesce(is_angiosperm, false)) AS n_angiosperm,
       (SELECT count(*) FROM fam) AS n_families,
       (SELECT coalesce(string_agg(family, '|' ORDER BY r), '') FROM ranked WHERE r <= 5) AS top_families
""")
def q_probe_summary(spark, d):
    orders, species, clades, answers, taxa = _probe(spark, d)
    report = order_probe_report(orders, species, clades, answers=answers, taxa=taxa)
    species = species.filter(F.col("order_key") % 8 < 6)         # the listings that came
    w = F.row_number().over(Window.partitionBy("order_key").orderBy("pos"))
    samples = (species.withColumn("sample_pos", w).filter(F.col("sample_pos") <= 3)
               .select(F.col("order_key").alias("order_pos"), "sample_pos", "family"))
    return probe_summary(report, samples)
