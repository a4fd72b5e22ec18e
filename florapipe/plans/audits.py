"""Bindings for the audit reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from florapipe.operators import audit
from florapipe.operators.sketches import audit_sketches, load_sketches
from florapipe.plans.registry import query
from florapipe.session import scratch_path
from florapipe.sources import store
from florapipe.sources.tables import table


def _r(c, n=6):
    return F.round(F.col(c), n).alias(c)


@query("value_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def q_value_counts(spark, d):
    return audit.value_counts(table(spark, d, "events"), "event_type")


@query("failure_reasons", """
SELECT event_type, count(*) AS n FROM events
WHERE event_type <> 'purchase' GROUP BY event_type
""")
def q_failure_reasons(spark, d):
    return audit.failure_reasons(table(spark, d, "events"), "event_type", success="purchase")


def _docs_labels(spark, d):
    docs = table(spark, d, "documents")
    labels = table(spark, d, "labels")
    return (docs.join(labels, "doc_id", "left")
            .withColumn("image_url", F.when(F.col("quality") == 1,
                                            F.concat(F.lit("img/"), F.col("doc_id").cast("string"))))
            .withColumn("has_images", F.col("quality") == 1)
            .withColumn("media_source", F.when(F.col("lang") == "en", F.lit("wiki"))
                        .otherwise(F.concat(F.lit("inat_"), F.col("lang")))))


DOCS_LABELS_SQL = """
WITH dl AS (
  SELECT d.*, l.quality, l.toxic,
         CASE WHEN l.quality = 1 THEN 'img/' || CAST(d.doc_id AS VARCHAR) END AS image_url,
         (l.quality = 1) AS has_images,
         CASE WHEN d.lang = 'en' THEN 'wiki' ELSE 'inat_' || d.lang END AS media_source
  FROM documents d LEFT JOIN labels l USING (doc_id))
"""


@query("coverage", DOCS_LABELS_SQL + """
SELECT round(avg(CAST(has_images AS DOUBLE)) * 100.0, 6) AS coverage_pct,
       count(*) FILTER (WHERE has_images = false) AS n_false,
       count(*) AS n_rows
FROM dl
""")
def q_coverage(spark, d):
    return audit.coverage(_docs_labels(spark, d), "has_images").select(
        _r("coverage_pct"), "n_false", "n_rows")


@query("missing_counts", DOCS_LABELS_SQL + """
SELECT column_name, n_missing, round(n_missing * 100.0 / n, 6) AS pct_missing FROM (
  SELECT 'quality' AS column_name, count(*) FILTER (WHERE quality IS NULL) AS n_missing,
         count(*) AS n FROM dl
  UNION ALL SELECT 'toxic', count(*) FILTER (WHERE toxic IS NULL), count(*) FROM dl
  UNION ALL SELECT 'image_url', count(*) FILTER (WHERE image_url IS NULL), count(*) FROM dl
  UNION ALL SELECT 'common_name', count(*), count(*) FROM dl)
""")
def q_missing_counts(spark, d):
    out = audit.missing_counts(_docs_labels(spark, d), ["quality", "toxic", "image_url", "common_name"])
    return out.select("column_name", "n_missing", _r("pct_missing"))


@query("fill_rate", DOCS_LABELS_SQL + """
SELECT 'image_url' AS image_column, count(image_url) AS n_filled,
       round(count(image_url) * 100.0 / count(*), 6) AS fill_pct
FROM dl
""")
def q_fill_rate(spark, d):
    return audit.fill_rate(_docs_labels(spark, d)).select("image_column", "n_filled", _r("fill_pct"))


@query("source_share", DOCS_LABELS_SQL + """
SELECT media_source, n, round(share_pct, 6) AS share_pct,
       (contains(lower(media_source), 'wiki') AND share_pct > 50.0) AS licence_risk
FROM (SELECT media_source, count(*) AS n, count(*) * 100.0 / sum(count(*)) OVER () AS share_pct
      FROM dl WHERE image_url IS NOT NULL AND media_source IS NOT NULL GROUP BY media_source)
""")
def q_source_share(spark, d):
    out = audit.source_share(_docs_labels(spark, d), source="media_source", image="image_url")
    return out.select("media_source", "n", _r("share_pct"), "licence_risk")


CNR_SQL = """
WITH cnr AS (
  SELECT c.*, n.n_name, r.r_name FROM customer c
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey)
"""


def _cnr(spark, d):
    nation = table(spark, d, "nation")
    region = table(spark, d, "region")
    # nation and region are fixed-size dimensions (25 and 5 rows by definition)
    dim = nation.join(region, nation.n_regionkey == region.r_regionkey)
    return (table(spark, d, "customer")
            .join(dim, F.col("c_nationkey") == F.col("n_nationkey")))


@query("distinct_counts", CNR_SQL + """
SELECT count(DISTINCT c_name) AS n_species, count(DISTINCT r_name) AS n_orders,
       count(DISTINCT n_name) AS n_families, count(DISTINCT c_mktsegment) AS n_genera
FROM cnr
""")
def q_distinct_counts(spark, d):
    df = _cnr(spark, d).select(F.col("c_name").alias("scientific_name"), F.col("r_name").alias("order"),
                               F.col("n_name").alias("family"), F.col("c_mktsegment").alias("genus"))
    return audit.distinct_counts(df)


@query("grid_symmetry", CNR_SQL + """
SELECT CASE WHEN count(*) = 0 THEN 'Symmetric'
            WHEN count(DISTINCT n) = 1 THEN printf('Perfect Grid (%d species per order)', min(n))
            ELSE printf('Asymmetric (Ranges from %d to %d species per order)', min(n), max(n)) END AS grid,
       min(n) AS min_n, max(n) AS max_n, count(*) AS n_orders
FROM (SELECT r_name, count(DISTINCT c_name) AS n FROM cnr WHERE r_name IS NOT NULL GROUP BY r_name)
""")
def q_grid_symmetry(spark, d):
    df = _cnr(spark, d).select(F.col("c_name").alias("scientific_name"), F.col("r_name").alias("order"))
    return audit.grid_symmetry(df)


@query("describe", """
SELECT count(o_totalprice) AS count, round(avg(o_totalprice), 6) AS mean,
       round(stddev_samp(o_totalprice), 6) AS std, min(o_totalprice) AS min,
       round(quantile_cont(CAST(o_totalprice AS DOUBLE), 0.25), 6) AS p25,
       round(quantile_cont(CAST(o_totalprice AS DOUBLE), 0.5), 6) AS p50,
       round(quantile_cont(CAST(o_totalprice AS DOUBLE), 0.75), 6) AS p75,
       max(o_totalprice) AS max
FROM orders
""")
def q_describe(spark, d):
    out = audit.describe(table(spark, d, "orders"), "o_totalprice")
    return out.select("count", _r("mean"), _r("std"), "min", _r("p25"), _r("p50"), _r("p75"), "max")


# ---- A13: line items loaded in chunks of 1,000 order keys; the loaded key is
# the part, which comes back in later chunks; the line number is its images.
@query("load_metrics", """
WITH l AS (SELECT CAST(floor(l_orderkey / 1000) AS BIGINT) AS chunk, l_partkey, l_linenumber FROM lineitem
           WHERE l_partkey IS NOT NULL),
firsts AS (SELECT chunk, count(*) AS k FROM (SELECT l_partkey, min(chunk) AS chunk FROM l GROUP BY 1) GROUP BY 1),
per AS (SELECT chunk, count(*) AS rows_in, coalesce(any_value(k), 0) AS unique_keys, sum(l_linenumber) AS images_in
        FROM l LEFT JOIN firsts USING (chunk) GROUP BY chunk)
SELECT chunk, rows_in, unique_keys,
       CAST(sum(rows_in) OVER (ORDER BY chunk) AS BIGINT) AS rows_loaded,
       CAST(sum(unique_keys) OVER (ORDER BY chunk) AS BIGINT) AS keys_loaded,
       CAST(sum(images_in) OVER (ORDER BY chunk) AS BIGINT) AS images_loaded,
       round(sum(rows_in) OVER (ORDER BY chunk) * 100.0 / sum(rows_in) OVER (), 6) AS progress_pct
FROM per
""")
def q_load_metrics(spark, d):
    rows = table(spark, d, "lineitem").select("l_partkey", F.floor(F.col("l_orderkey") / 1000).alias("c"), "l_linenumber")
    out = audit.load_metrics(rows, "l_partkey", chunk_col="c", images_col="l_linenumber")
    return out.select("chunk", "rows_in", "unique_keys", "rows_loaded", "keys_loaded", "images_loaded", _r("progress_pct"))


@query("extraction_counts", """
SELECT o_orderstatus, count(*) AS n_processed FROM orders GROUP BY o_orderstatus
""")
def q_extraction_counts(spark, d):
    return audit.extraction_counts(table(spark, d, "orders"), "o_orderstatus")


# ---- A2/A5/A6/A8 from sketches: the orders as five loads (by priority), each
# leaving its sketches; counts, mean, deviation and ends are exact, the
# quantile's rank and the distinct count are within the sketches' bounds.
@query("audit_sketches", """
SELECT 'o_totalprice' AS column_name, count(o_totalprice) AS n, count(*) - count(o_totalprice) AS n_missing,
       round(avg(o_totalprice), 4) AS mean, round(stddev_samp(o_totalprice), 4) AS std, CAST(min(o_totalprice) AS DOUBLE) AS min,
       CAST(max(o_totalprice) AS DOUBLE) AS max, true AS within FROM orders
UNION ALL
SELECT 'o_custkey', count(o_custkey), count(*) - count(o_custkey), NULL, NULL, NULL, NULL, true FROM orders
""")
def q_audit_sketches(spark, d):
    orders, path = table(spark, d, "orders"), scratch_path(spark, "order_sketches")
    loads = [r[0] for r in orders.select("o_orderpriority").distinct().collect()]         # a fixed set of five
    for i, load in enumerate(loads):
        one = load_sketches(orders.filter(F.col("o_orderpriority").eqNullSafe(load)), ["o_totalprice"], ["o_custkey"])
        store.append_batch(one, path, fmt="parquet", batch=str(i))
    found = audit_sketches(spark.read.parquet(path))
    median = found.filter(F.col("column_name") == "o_totalprice").select("p50").scalar()
    exact = orders.agg((F.count_if(F.col("o_totalprice") <= median) / F.count("o_totalprice")).alias("rank"),
                       F.count_distinct("o_custkey").alias("keys")).select(F.struct("rank", "keys")).scalar()
    within = F.when(F.col("column_name") == "o_totalprice", F.abs(exact["rank"] - 0.5) < 0.02).otherwise(
        F.abs(F.col("n_distinct") / exact["keys"] - 1) < 0.04)
    return found.select("column_name", "n", "n_missing", _r("mean", 4), _r("std", 4), "min", "max", within.alias("within"))
