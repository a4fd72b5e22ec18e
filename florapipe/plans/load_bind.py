"""Bindings for cleaning, typed rows, the CSV edge, keyed tables and record
assembly (P1-P4, P8, P10-P12, S1, S5-S10, J9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from florapipe.functions.expr import BINOMIAL_PATTERN
from florapipe.operators import records as rec
from florapipe.operators.merge import merge_entities
from florapipe.plans.landing import capitalized
from florapipe.plans.registry import query
from florapipe.session import scratch_path
from florapipe.sources import store
from florapipe.sources.species_csv import read_species_csv, to_csv_record
from florapipe.sources.tables import DRIVER_TABLES, table

BINOMIAL_SQL = f"'{BINOMIAL_PATTERN}'"


# ---- P1: part names as scientific names "<P>_name L.", every fifth size a
# hybrid written with " x ".
@query("standardize_names", f"""
WITH n AS (
  SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN replace(cap, ' ', ' x ') ELSE cap END || ' L.' AS name
  FROM (SELECT p_partkey, p_size, upper(substr(p_name, 1, 1)) || substr(p_name, 2) AS cap FROM part)),
b AS (
  SELECT *, trim(replace(name, '×', ' ')) AS c1, trim(replace(replace(name, '×', ' '), ' x ', ' ')) AS c2 FROM n)
SELECT p_partkey, name,
       CASE WHEN regexp_matches(c1, {BINOMIAL_SQL})
            THEN regexp_extract(c1, {BINOMIAL_SQL}, 1) || ' ' || regexp_extract(c1, {BINOMIAL_SQL}, 2) END
         AS binomial,
       CASE WHEN regexp_matches(c2, {BINOMIAL_SQL})
            THEN regexp_extract(c2, {BINOMIAL_SQL}, 1) || ' ' || regexp_extract(c2, {BINOMIAL_SQL}, 2) END
         AS query_name,
       coalesce(lower(trim(name)) <> '' AND lower(trim(name)) <> 'x' AND NOT contains(lower(trim(name)), ' x '),
                false) AS is_valid,
       CASE WHEN NOT coalesce(lower(trim(name)) <> '' AND lower(trim(name)) <> 'x'
                              AND NOT contains(lower(trim(name)), ' x '), false)
            THEN 'invalid_name' END AS reject_reason
FROM b
""")
def q_standardize_names(spark, d):
    part = table(spark, d, "part")
    cap = capitalized("p_name")
    name = F.concat(F.when(F.col("p_size") % 5 == 0, F.replace(cap, F.lit(" "), F.lit(" x "))).otherwise(cap),
                    F.lit(" L."))
    return rec.standardize_names(part.select("p_partkey", name.alias("name")), "name")


# ---- P2: documents.source and lang with injected blanks, "NaN", padding.
@query("clean_columns", """
SELECT doc_id,
       CASE WHEN trim(s) = '' OR lower(trim(s)) = 'nan' THEN NULL ELSE trim(s) END AS source,
       CASE WHEN trim(l) = '' OR lower(trim(l)) = 'nan' THEN NULL ELSE trim(l) END AS lang
FROM (SELECT doc_id,
             CASE doc_id % 7 WHEN 0 THEN '  ' WHEN 1 THEN ' NaN ' WHEN 2 THEN ' ' || source || ' '
                             WHEN 3 THEN NULL ELSE source END AS s,
             CASE doc_id % 5 WHEN 0 THEN 'nan' ELSE lang END AS l
      FROM documents)
""")
def q_clean_columns(spark, d):
    docs = table(spark, d, "documents")
    k = F.col("doc_id")
    s = (F.when(k % 7 == 0, F.lit("  ")).when(k % 7 == 1, F.lit(" NaN "))
         .when(k % 7 == 2, F.concat(F.lit(" "), F.col("source"), F.lit(" ")))
         .when(k % 7 == 3, F.lit(None).cast("string")).otherwise(F.col("source")))
    lang = F.when(k % 5 == 0, F.lit("nan")).otherwise(F.col("lang"))
    return rec.clean_columns(docs.select("doc_id", s.alias("source"), lang.alias("lang")), ["source", "lang"])


@query("normalize_headers", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
""")
def q_normalize_headers(spark, d):
    cust = table(spark, d, "customer").toDF(" C_CustKey ", "C_NAME", "c_NationKey  ", " c_acctbal", "C_MktSegment")
    return rec.normalize_headers(cust)


# ---- P4: events.props rewritten as a JSON list ["<k>", "<event_type>"];
# ids ending in 0 truncated (malformed), ending in 1 NULL.
@query("parse_json", """
WITH t AS (
  SELECT event_id, CASE event_id % 10 WHEN 0 THEN substr(props, 1, 5) WHEN 1 THEN NULL
         ELSE '["' || regexp_extract(props, '[0-9]+') || '", "' || event_type || '"]' END AS items
  FROM events)
SELECT event_id,
       array_to_string(CASE WHEN items IS NOT NULL AND json_valid(items) THEN from_json(items, '["VARCHAR"]')
                            ELSE [] END, '|') AS items,
       CAST(len(CASE WHEN items IS NOT NULL AND json_valid(items) THEN from_json(items, '["VARCHAR"]')
                     ELSE [] END) AS INTEGER) AS n_items,
       (items IS NOT NULL AND NOT json_valid(items)) AS items_malformed
FROM t
""")
def q_parse_json(spark, d):
    ev = table(spark, d, "events")
    k = F.col("event_id")
    items = (F.when(k % 10 == 0, F.substring("props", 1, 5)).when(k % 10 == 1, F.lit(None).cast("string"))
             .otherwise(F.concat(F.lit('["'), F.regexp_extract("props", "[0-9]+", 0), F.lit('", "'),
                                 F.col("event_type"), F.lit('"]'))))
    out = rec.parse_json_arrays(ev.select("event_id", items.alias("items")), ["items"])
    return out.select("event_id", F.array_join("items", "|").alias("items"), F.size("items").alias("n_items"),
                      "items_malformed")


# ---- P3: events.props enforced to {k: bigint (required, doubled), note:
# string}; ids ending in 0 truncated, ending in 1 carry k as a string, in 2
# note as a number, in 3 note alone.
@query("enforce_schema", """
WITH t AS (
  SELECT event_id, CASE event_id % 10 WHEN 0 THEN substr(props, 1, 5)
         WHEN 1 THEN '{"k": "' || regexp_extract(props, '[0-9]+') || '"}'
         WHEN 2 THEN '{"k": 2, "note": 5}' WHEN 3 THEN '{"note": "n' || event_id || '"}' ELSE props END AS doc
  FROM events)
SELECT event_id,
       coalesce(coalesce(CASE WHEN json_valid(doc) AND json_type(doc, '$.k') IN ('BIGINT', 'UBIGINT')
                              THEN CAST(json_extract(doc, '$.k') AS BIGINT) END, -1) * 2, -1) AS k,
       coalesce(CASE WHEN json_valid(doc) AND json_type(doc, '$.note') = 'VARCHAR'
                     THEN json_extract_string(doc, '$.note') END, 'none') AS note
FROM t
""")
def q_enforce_schema(spark, d):
    ev = table(spark, d, "events")
    k = F.col("event_id")
    doc = (F.when(k % 10 == 0, F.substring("props", 1, 5))
           .when(k % 10 == 1, F.concat(F.lit('{"k": "'), F.regexp_extract("props", "[0-9]+", 0), F.lit('"}')))
           .when(k % 10 == 2, F.lit('{"k": 2, "note": 5}'))
           .when(k % 10 == 3, F.concat(F.lit('{"note": "n'), k.cast("string"), F.lit('"}')))
           .otherwise(F.col("props")))
    spec = [rec.Field("k", "bigint", -1, required=True, transform=lambda c: F.try_multiply(c, F.lit(2))),
            rec.Field("note", "string", "none")]
    return rec.enforce_schema(ev.select("event_id", doc.alias("doc")), spec, json_col="doc", keep=["event_id"])


# ---- P11/P12: merged part rows in the species shape (text numbers such as
# "12.0", padded statuses, "True"/"False").
def _species_shaped(spark, d):
    part = table(spark, d, "part")
    src = part.select(
        F.col("p_name").alias("scientific_name"), "p_partkey",
        F.col("p_brand").alias("common_name"), F.col("p_type").alias("wikipedia_description"),
        F.when(F.col("p_size") % 4 == 0, F.lit(None).cast("string")).otherwise(F.col("p_brand")).alias("family"),
        F.substring_index("p_name", " ", -1).alias("species"),
        F.substring_index("p_name", " ", 1).alias("genus"), F.lit("Order_one").alias("order"),
        F.col("p_partkey").cast("double").cast("string").alias("gbif_id"),
        F.col("p_size").cast("string").alias("inat_id"),
        F.col("p_retailprice").cast("string").alias("observation_count"),
        F.lit(" Success ").alias("inat_status"),
        F.when(F.col("p_size") % 2 == 0, F.lit("True")).otherwise(F.lit("false")).alias("has_images"),
        F.lit(" Species ").alias("description_source"),
        F.array(F.concat(F.lit("i/"), F.col("p_size").cast("string"))).alias("inat_research_images"),
        F.array(F.concat(F.lit("w/"), F.col("p_partkey").cast("string"))).alias("wiki_images"))
    return merge_entities(src, key="scientific_name", pos="p_partkey", name_col="common_name",
                          text_col="wikipedia_description", list_cols=["inat_research_images", "wiki_images"])


SPECIES_SQL = """
WITH firsts AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS rn FROM part) WHERE rn = 1),
descr AS (
  SELECT p_name, p_type FROM (
    SELECT p_name, p_type, row_number() OVER (PARTITION BY p_name ORDER BY length(p_type) DESC, p_partkey) AS rn
    FROM part WHERE trim(p_type) <> '') WHERE rn = 1),
names AS (
  SELECT p_name, string_agg(DISTINCT trim(p_brand), '|' ORDER BY trim(p_brand)) AS common_names
  FROM part WHERE trim(p_brand) <> '' GROUP BY p_name)
"""


@query("to_species_rows", SPECIES_SQL + """
SELECT f.p_name AS scientific_name, coalesce(n.common_names, '') AS common_names,
       CASE WHEN f.p_size % 4 = 0 THEN NULL ELSE f.p_brand END AS family, d.p_type AS description,
       'i/' || CAST(f.p_size AS VARCHAR) AS primary_image_url, 'Order_one' AS order_name,
       split_part(f.p_name, ' ', 1) AS genus, regexp_extract(f.p_name, '[^ ]*$') AS species,
       f.p_partkey AS gbif_id, CAST(f.p_size AS BIGINT) AS inat_id,
       CAST(trunc(TRY_CAST(f.p_retailprice AS DOUBLE)) AS BIGINT) AS observation_count,
       'Success' AS inat_status, (f.p_size % 2 = 0) AS has_images, 'species' AS description_source
FROM firsts f JOIN names n USING (p_name) LEFT JOIN descr d USING (p_name)
WHERE NOT contains(lower(trim(f.p_name)), ' x ') AND lower(trim(f.p_name)) NOT IN ('', 'x')
""")
def q_to_species_rows(spark, d):
    out = rec.to_species_rows(_species_shaped(spark, d))
    return out.withColumn("common_names", F.array_join("common_names", "|"))


@query("missing_field_rejects", """
SELECT p_name AS scientific_name, true AS missing_family, false AS missing_species FROM (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS rn FROM part) WHERE rn = 1)
WHERE p_size % 4 = 0
""")
def q_missing_field_rejects(spark, d):
    return rec.missing_field_rejects(_species_shaped(spark, d))


# ---- S1/S5/F17: part rows with their document text (multi-line, quotes)
# written as species CSV in two appended batches, read back typed.
@query("species_csv_roundtrip", """
SELECT p.p_name AS scientific_name, p.p_partkey AS gbif_id,
       CASE WHEN p.p_size % 9 = 0 THEN NULL WHEN p.p_size % 9 = 1 THEN 'none' ELSE p.p_brand END AS common_name,
       (p.p_size % 2 = 0) AS has_images, d.text AS wikipedia_description,
       'i/' || CAST(p.p_size AS VARCHAR) || '|w/"' || CAST(p.p_partkey AS VARCHAR) AS inat_research_images
FROM part p LEFT JOIN documents d ON d.doc_id = p.p_partkey
""")
def q_species_csv_roundtrip(spark, d):
    part, docs = table(spark, d, "part"), table(spark, d, "documents")
    rows = (part.join(docs.select(F.col("doc_id").alias("p_partkey"), "text"), "p_partkey", "left")
            .select(F.col("p_name").alias("scientific_name"),
                    F.col("p_partkey").cast("double").cast("string").alias("gbif_id"),
                    F.when(F.col("p_size") % 9 == 0, F.lit("NA")).when(F.col("p_size") % 9 == 1, F.lit("none"))
                    .otherwise(F.col("p_brand")).alias("common_name"),
                    (F.col("p_size") % 2 == 0).alias("has_images"),
                    F.col("text").alias("wikipedia_description"),
                    F.array(F.concat(F.lit("i/"), F.col("p_size").cast("string")),
                            F.concat(F.lit('w/"'), F.col("p_partkey").cast("string"))).alias("inat_research_images"),
                    F.col("p_partkey").alias("_k")))
    path = scratch_path(spark, "species_csv")
    store.append_batch(to_csv_record(rows.filter(F.col("_k") % 2 == 0)), path)
    store.append_batch(to_csv_record(rows.filter(F.col("_k") % 2 == 1)), path)
    back = read_species_csv(spark, path)
    return back.select("scientific_name", "gbif_id", "common_name", "has_images", "wikipedia_description",
                       F.array_join("inat_research_images", "|").alias("inat_research_images"))


# ---- S7/S6/S9: supplier as a keyed parent table.  Target = keys not
# divisible by 3 (id = key + 1,000,000); batch = even keys, each sent twice,
# the second time with an upper-case name and, for keys divisible by 4, a
# NULL balance.  New keys get id = key + 2,000,000.
def _supplier_tables(spark, d):
    s = table(spark, d, "supplier").select("s_suppkey", "s_name", "s_acctbal", "s_nationkey")
    k = F.col("s_suppkey")
    target = s.filter(k % 3 != 0).withColumn("id", k + 1_000_000)
    first = s.filter(k % 2 == 0).withColumn("seq", F.lit(1))
    second = (s.filter(k % 2 == 0)
              .select("s_suppkey", F.upper("s_name").alias("s_name"),
                      F.when(k % 4 == 0, F.lit(None).cast("double")).otherwise(F.col("s_acctbal") + 1)
                      .alias("s_acctbal"), "s_nationkey")
              .withColumn("seq", F.lit(2)))
    return target, first.unionByName(second)


UPSERT_SQL = """
WITH target AS (SELECT s_suppkey, s_name, s_acctbal, s_nationkey, s_suppkey + 1000000 AS id
                FROM supplier WHERE s_suppkey % 3 <> 0),
batch AS (SELECT s_suppkey, upper(s_name) AS s_name,
                 CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE s_acctbal + 1 END AS s_acctbal, s_nationkey
          FROM supplier WHERE s_suppkey % 2 = 0),
upserted AS (
  SELECT * FROM target WHERE s_suppkey NOT IN (SELECT s_suppkey FROM batch)
  UNION ALL
  SELECT b.s_suppkey, b.s_name, b.s_acctbal, b.s_nationkey, coalesce(t.id, b.s_suppkey + 2000000) AS id
  FROM batch b LEFT JOIN target t USING (s_suppkey))
"""


def upserted_suppliers(spark, d):
    target, batch = _supplier_tables(spark, d)
    out = store.upsert(target, batch, ["s_suppkey"], "seq", id_fn=lambda keys: F.col(keys[0]) + 2_000_000)
    path = scratch_path(spark, "supplier_table")
    store.write_snapshot(target, path)            # version 1: the target as loaded
    store.write_snapshot(out, path)               # version 2: after the batch
    return store.read_snapshot(spark, path)


@query("upsert", UPSERT_SQL + "SELECT * FROM upserted")
def q_upsert(spark, d):
    return upserted_suppliers(spark, d).select("s_suppkey", "s_name", "s_acctbal", "s_nationkey", "id")


@query("lookup_ids", UPSERT_SQL + """
SELECT c.c_custkey, u.s_suppkey, u.id FROM customer c JOIN upserted u ON u.s_suppkey = c.c_custkey % 150
""")
def q_lookup_ids(spark, d):
    batch = table(spark, d, "customer").select("c_custkey", (F.col("c_custkey") % 150).alias("s_suppkey"))
    return store.lookup_ids(batch, upserted_suppliers(spark, d), ["s_suppkey"]).select("c_custkey", "s_suppkey",
                                                                                      "id")


# ---- S8: (nation, supplier) pairs as a child table with a unique key;
# target = keys not divisible by 3; batch = every supplier, twice.
@query("insert_ignore", """
SELECT s_nationkey, s_suppkey, s_name FROM supplier WHERE s_suppkey % 3 <> 0
UNION ALL
SELECT s_nationkey, s_suppkey, s_name FROM supplier WHERE s_suppkey % 3 = 0
""")
def q_insert_ignore(spark, d):
    s = table(spark, d, "supplier").select("s_nationkey", "s_suppkey", "s_name")
    target = s.filter(F.col("s_suppkey") % 3 != 0)
    batch = (s.withColumn("_o", F.lit(1))
             .unionByName(s.withColumn("s_name", F.lower("s_name")).withColumn("_o", F.lit(2))))
    out = store.insert_ignore(target, batch, ["s_nationkey", "s_suppkey"], ["_o"])
    return out.select("s_nationkey", "s_suppkey", "s_name")


@query("table_counts", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in DRIVER_TABLES))
def q_table_counts(spark, d):
    return store.table_counts({t: table(spark, d, t) for t in DRIVER_TABLES})


# ---- J9/P8: customers as taxa (order = nation, family = segment, genus =
# name prefix), latest order as the observation lookup, event summary as the
# description, orders with status F carrying one image.
def assembled(spark, d):
    cust, nation = table(spark, d, "customer"), table(spark, d, "nation")
    taxa = (cust.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")  # 25 rows
            .select(F.col("c_custkey").alias("key"), F.col("n_name").alias("order"),
                    F.col("c_mktsegment").alias("family"), F.substring_index("c_name", "#", 1).alias("genus"),
                    F.col("c_name").alias("scientific_name"),
                    F.replace(F.col("c_name"), F.lit("#"), F.lit(" ")).alias("canonical_name"),
                    F.when(F.col("c_acctbal") > 5000, F.lit(" rICH client ")).alias("vernacular")))
    orders = table(spark, d, "orders")
    latest = orders.groupBy("o_custkey").agg(
        F.max_by(F.struct("o_orderkey", "o_orderstatus", "o_orderpriority"),
                 F.struct("o_orderdate", "o_orderkey")).alias("_l"),
        F.count(F.lit(1)).alias("observation_count"))
    obs = latest.select(
        F.col("o_custkey").alias("key"), F.col("_l.o_orderkey").alias("inat_id"), "observation_count",
        F.when(F.col("_l.o_orderpriority").startswith("1"), F.col("_l.o_orderpriority")).alias("common_name"),
        F.when(F.col("_l.o_orderstatus") == "F",
               F.array(F.concat(F.lit("o/"), F.col("_l.o_orderkey").cast("string"))))
        .otherwise(F.array().cast("array<string>")).alias("research_images"),
        F.lit("success").alias("inat_status"))
    ev = table(spark, d, "events")
    text = (ev.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.max("event_type").alias("t"))
            .select(F.col("user_id").alias("key"),
                    F.concat(F.lit("events "), F.col("n").cast("string"), F.lit(" last "), F.col("t"))
                    .alias("description"), F.lit("species").alias("description_source")))
    return rec.assemble_records(taxa, "key", {"obs": obs, "text": text})


ASSEMBLE_SQL = """
WITH latest AS (
  SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS ok,
         arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS st,
         arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS pr, count(*) AS observation_count
  FROM orders GROUP BY o_custkey),
ev AS (SELECT user_id, 'events ' || CAST(count(*) AS VARCHAR) || ' last ' || max(event_type) AS description
       FROM events GROUP BY user_id),
rec AS (
  SELECT coalesce(n.n_name, '') AS "order", coalesce(c.c_mktsegment, '') AS family,
         coalesce(split_part(c.c_name, '#', 1), '') AS genus,
         coalesce(string_split_regex(trim(replace(c.c_name, '#', ' ')), '\\s+')[2], '') AS species,
         coalesce(c.c_name, '') AS scientific_name,
         CASE WHEN coalesce(nullif(CASE WHEN l.pr LIKE '1%' THEN l.pr END, ''),
                            nullif(CASE WHEN c.c_acctbal > 5000 THEN ' rICH client ' END, '')) IS NULL THEN ''
              ELSE upper(substr(lower(trim(coalesce(nullif(CASE WHEN l.pr LIKE '1%' THEN l.pr END, ''),
                                                    nullif(CASE WHEN c.c_acctbal > 5000 THEN ' rICH client ' END, '')))), 1, 1))
                   || substr(lower(trim(coalesce(nullif(CASE WHEN l.pr LIKE '1%' THEN l.pr END, ''),
                                                 nullif(CASE WHEN c.c_acctbal > 5000 THEN ' rICH client ' END, '')))), 2)
         END AS common_name,
         c.c_custkey AS gbif_id, l.ok AS inat_id, coalesce(CASE WHEN l.ok IS NOT NULL THEN 'success' END, 'unknown')
           AS inat_status,
         (l.st = 'F') IS TRUE AS has_images, l.observation_count,
         coalesce(e.description, 'Description not found.') AS wikipedia_description,
         CASE WHEN e.description IS NULL THEN 'none' ELSE 'species' END AS description_source,
         CASE WHEN l.st = 'F' THEN 'o/' || CAST(l.ok AS VARCHAR) ELSE '' END AS inat_research_images,
         '' AS inat_needs_id_images, '' AS wiki_images
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN latest l ON l.o_custkey = c.c_custkey LEFT JOIN ev e ON e.user_id = c.c_custkey)
"""


@query("assemble_records", ASSEMBLE_SQL + "SELECT * FROM rec")
def q_assemble_records(spark, d):
    out = assembled(spark, d).drop("extraction_timestamp")
    return out.select(*[F.array_join(c, "|").alias(c) if c in ("inat_research_images", "inat_needs_id_images",
                                                                "wiki_images") else F.col(c) for c in out.columns])


@query("is_complete", ASSEMBLE_SQL + """
SELECT gbif_id, (inat_research_images <> '' OR wiki_images <> ''
                 OR (wikipedia_description <> '' AND wikipedia_description <> 'Description not found.')
                 OR common_name <> '') AS is_complete
FROM rec
""")
def q_is_complete(spark, d):
    return rec.is_complete(assembled(spark, d)).select("gbif_id", "is_complete")

