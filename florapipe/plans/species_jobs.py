"""End-to-end jobs over landed tables, one per entry point of the source
pipeline (SURVEY section 3): the extraction run, the load run, the audit
report and the sample dataset.  Each is one logical plan composed of the
operators; the only boundaries are shuffles and, for the load, table writes.

Landed roles (all derived from the driver tables): ``part`` is the taxonomy
listing (order = p_type, scientific name "<P>_name <brand>", canonical name
without the brand, pages of 100 keys), the name-match and taxon-search
responses, and the summary/media page keys; ``documents`` are summaries and
observations; ``pages`` are the encyclopedia pages (page_id = part key) and
their image titles.  Texts and page images are looked up by canonical name,
observations by its binomial.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from florapipe.functions.expr import (NOT_FOUND_TEXT, blank_placeholder, clean_text, extract_binomial, fallback_observation,
                                      is_valid_species_name, normalize_query_name, page_title)
from florapipe.operators import audit, media
from florapipe.operators import enumeration as en
from florapipe.operators.attempts import accept_status, lookup_outcome
from florapipe.operators.merge import explode_media_rows, gallery_text, merge_entities
from florapipe.operators.numbering import number_rows
from florapipe.operators.records import (assemble_records, is_complete, missing_field_rejects, normalize_headers,
                                         to_species_rows)
from florapipe.operators.resolve import best_match, resolve_accepted_name, top_taxon
from florapipe.operators.responses import LANDED_AT, one_response
from florapipe.operators.text import MIN_TEXT_LEN, cache_new_hits, flag_text_quality, text_fallback
from florapipe.plans.landing import capitalized, with_repeats
from florapipe.plans.media_bind import PAGE_SQL, RANK_TAIL_SQL, TIERS_SQL, _page_landing, landed_links, landed_observations
from florapipe.plans.registry import query
from florapipe.plans.resolution import landed_name_matches, landed_taxa_search
from florapipe.plans.text_bind import TEXT_CHAIN_SQL, TEXT_SQL, text_landing
from florapipe.session import materialize, materialize_seen, scratch_path
from florapipe.sources import bucketed, keyed, store
from florapipe.sources.species_csv import LIST_COLUMNS, SPECIES_COLUMNS, to_csv_record
from florapipe.sources.tables import table


def listed_species(part: DataFrame) -> DataFrame:
    """The listing's results, one row each, with their order and place."""
    cap = capitalized("p_name")
    return part.select(
        F.col("p_type").alias("order_name"), F.struct(F.col("p_type"), F.col("p_partkey")).alias("pos"),
        F.col("p_partkey").alias("key"), F.concat_ws(" ", cap, F.col("p_brand")).alias("scientificName"),
        cap.alias("canonicalName"), F.col("p_brand").alias("family"), F.substring_index(cap, " ", 1).alias("genus"),
        F.when(F.col("p_size") % 3 == 0, F.lower("p_type")).alias("vernacularName"),
        F.when(F.col("p_size") <= 45, F.lit("SPECIES")).otherwise(F.lit("VARIETY")).alias("rank"),
        F.when(F.col("p_type") == "PROMO", F.lit("DOUBTFUL")).otherwise(F.lit("ACCEPTED")).alias("status"))


def landed_listing(spark, d) -> DataFrame:
    """Taxonomy listing pages (order, offset) with up to 100 results each."""
    rows = listed_species(table(spark, d, "part"))
    res = F.struct(*[c for c in rows.columns if c not in ("order_name", "pos")])
    return (rows.withColumn("offset", (F.floor(F.col("key") / 100) * 100).cast("bigint"))
            .groupBy("order_name", "offset")
            .agg(F.count(F.lit(1)).alias("count"), F.array_sort(F.collect_list(F.struct("key", res.alias("r")))).alias("_l"))
            .select("order_name", "offset", "count", F.lit(200).alias("http_status"),
                    F.transform("_l", lambda x: x["r"]).alias("results")))


def _order_matches(spark, d) -> DataFrame:
    part = table(spark, d, "part")
    return with_repeats(part.groupBy(F.col("p_type").alias("name")).agg(F.min("p_partkey").alias("orderKey"))
                        .select("name", F.lit(200).alias("http_status"), F.lit("EXACT").alias("matchType"),
                                F.lit("Plantae").alias("kingdom"), F.lit("ORDER").alias("rank"), "orderKey"), ["name"])


def landed_page_images(spark, d) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pages, searches and image info by canonical name: a name's page is the
    one of its lowest part key that has a page (ids divisible by 13 failed, by
    7 answered 404); its search finds the name of the part after its lowest
    one (keys divisible by 5 failed)."""
    # parts and pages are merged: keys and repeated names or links are small in a file, by which a broadcast is chosen,
    # and large as rows
    part = table(spark, d, "part").select("p_partkey", capitalized("p_name").alias("name"))
    links = landed_links(spark, d)
    pages = links.select("page_id", F.transform(
        "hrefs", lambda h: F.struct(F.concat(F.lit("File:"), h).alias("title"))).alias("images"))
    first = (pages.select("page_id").join(part.hint("merge"), F.col("page_id") == F.col("p_partkey"))
             .groupBy("name").agg(F.min("page_id").alias("page_id")))
    k = F.col("page_id")
    status = F.when(k % 13 == 0, F.lit(None).cast("int")).when(k % 7 == 0, F.lit(404)).otherwise(F.lit(200))
    page_images = first.join(pages.hint("merge"), "page_id").select(page_title("name").alias("title"), status.alias("http_status"), "images")
    lowest = part.groupBy("name").agg(F.min("p_partkey").alias("k"))
    after = part.select((F.col("p_partkey") - 1).alias("k"), F.col("name").alias("top"))
    searches = lowest.join(after.hint("merge"), "k").select(
        F.col("name").alias("srsearch"),
        F.when(F.col("k") % 5 != 0, F.lit(200)).alias("http_status"),
        F.array(F.struct(F.col("top").alias("title"))).alias("results"))
    return with_repeats(page_images, ["title"]), with_repeats(searches, ["srsearch"]), _page_landing(spark, d, links)[3]


class Landed(NamedTuple):
    """The landing logs that the extraction looks up, each a written table."""
    name_matches: DataFrame
    taxa_search: DataFrame
    summaries: DataFrame
    searches: DataFrame
    cache: DataFrame
    page_images: DataFrame
    page_searches: DataFrame
    image_info: DataFrame


def landed_logs(spark, d) -> Landed:
    """The logs, made once: a lookup reads its log several times, and a plan that made them each time would be the driver's
    largest load, whatever the data."""
    _, summaries, searches, cache = text_landing(spark, d, canonical=True)
    logs = Landed(landed_name_matches(spark, d, True), landed_taxa_search(spark, d, True), summaries, searches, cache,
                  *landed_page_images(spark, d))
    return Landed(*[materialize(log, name) for name, log in logs._asdict().items()])


def extract_species(spark, d, limit: int | None = None, cache_path: str | None = None) -> DataFrame:
    """The extraction run: :func:`species_to_extract` -> :func:`enrich`."""
    return enrich(spark, d, species_to_extract(spark, d, limit), cache_path)


def species_to_extract(spark, d, limit: int | None = None) -> DataFrame:
    """Targets -> resolved orders -> listing pages (stop rule, explode) ->
    accepted species -> not yet processed -> the first ``limit`` per order, if
    one is asked for; with their place ``pos`` in the listing."""
    dim = table(spark, d, "part").select(F.lit(1).alias("batch"), F.col("p_type").alias("order_name")).distinct()
    targets = en.select_targets(dim, all_targets=True)
    orders = en.resolve_orders(targets, _order_matches(spark, d)).filter(F.col("status") == "resolved")
    pages = en.page_prefix(landed_listing(spark, d), "order_name", "offset", "http_status", "count")
    pages = pages.join(orders.select("order_name"), "order_name", "left_semi")
    taxa = en.accepted_species(en.explode_pages(pages, ["order_name"], "offset", "results"))
    processed = table(spark, d, "labels").filter(F.col("quality") == 0).select(F.col("doc_id").alias("key"))
    taxa = en.exclude_processed(taxa, processed, "key")
    if limit is not None:
        taxa = en.limit_per_group(taxa, "order_name", ["offset", "index"], n=limit).drop("rank_in_group")
    return taxa.withColumn("pos", F.struct("order_name", "offset", "index"))


def retry_extraction(spark, d, taxa: DataFrame, recorded: DataFrame, cache_path: str | None = None,
                     landed: Landed | None = None) -> DataFrame:
    """J8 as a job: the extraction of those of ``taxa`` that have no record yet."""
    taxa = materialize(taxa, "retry_taxa")
    return enrich(spark, d, taxa.join(en.retry_candidates(taxa, recorded, "key").hint("merge"), "key", "left_semi"), cache_path,
                  landed)


def enrich(spark, d, taxa: DataFrame, cache_path: str | None = None, landed: Landed | None = None) -> DataFrame:
    """Listed species -> accepted names -> taxon match -> observation media ->
    description chain -> page media -> one record per species (arrays kept)
    with its place ``pos`` in the listing.  With ``cache_path`` descriptions
    are looked up in the cache stored there first, and found ones are entered
    (S12): a later run asks for none of them.  ``landed``: the logs, where a
    caller that enriches more than once has them."""
    landed = landed or landed_logs(spark, d)
    # lineage cut: every enrichment branch starts from these rows (a table in
    # the shared spark.checkpoint.dir, so it survives executor loss)
    taxa = materialize(taxa, "taxa")
    canonical = F.coalesce("canonicalName", F.lit(""))

    # observation lookup: binomial -> accepted name -> taxon -> observation photos
    binomial = F.coalesce(extract_binomial(canonical), canonical)
    ents = taxa.select("key", normalize_query_name(binomial).alias("query_name"))
    ents = resolve_accepted_name(ents, landed.name_matches, "query_name")
    ents = ents.withColumn("resolved_name", F.when(F.col("query_name").isNotNull(), F.col("resolved_name")))
    matched = (best_match(ents, landed.taxa_search, "key", "resolved_name")
               .withColumnRenamed("inat_status", "_match_status"))
    obs_landed = one_response(landed_observations(spark, d).withColumnRenamed("entity", "taxon_id").drop("curated"), ["taxon_id"])
    curated = F.filter(F.transform("taxon.taxon_photos", lambda p: p["photo"]["medium_url"]),
                       lambda u: F.coalesce(u != "", F.lit(False)))
    # merged: lists of photos are small as shuffled blocks, by which a broadcast is chosen, and large as rows
    obs = (matched.join(obs_landed.hint("merge"), F.col("taxon.id") == F.col("taxon_id"), "left")
           .select("key", "taxon", "_match_status", "results", "http_status",
                   F.coalesce(curated, F.array().cast("array<string>")).alias("curated")))
    obs = _obs_columns(media.select_media(media.tier_media(obs)))

    # description chain
    cache = landed.cache
    if cache_path:
        stored = store.read_snapshot(spark, cache_path)
        cache = stored if stored is not None else cache.withColumn(LANDED_AT, F.lit(0))
    names = taxa.select("key", canonical.alias("name"), "genus")
    text = (text_fallback(names, "key", "name", landed.summaries, landed.searches, cache, genus_col="genus", final_min_len=MIN_TEXT_LEN)
            .select("key", "name", "description", "description_source"))
    if cache_path:
        text = materialize(text, "texts")
        store.write_snapshot(cache_new_hits(cache, text, "name"), cache_path)
        store.expire_versions(spark, cache_path)
    text = text.drop("name")
    # reference images from the species page
    wiki = media.page_media(names.drop("genus"), "key", "name", landed.page_images, landed.page_searches, landed.image_info)
    wiki = wiki.select("key", "wiki_images")

    base = taxa.select("key", F.col("order_name").alias("order"), "family", "genus",
                       F.col("scientificName").alias("scientific_name"),
                       F.col("canonicalName").alias("canonical_name"), F.col("vernacularName").alias("vernacular"), "pos")
    return assemble_records(base, "key", {"obs": obs, "text": text, "media": wiki}, keep=["pos"])


def _obs_columns(obs: DataFrame) -> DataFrame:
    """Observation lookup result per species: ids and counts of the matched
    taxon, common name (preferred, else English), the selected images, and the
    outcome: a status that the retried lookup accepts, else the fallback (no
    taxon, no images) labelled as exhausted retries."""
    found = F.col("taxon").isNotNull()
    status = F.when(found, F.col("inat_status")).otherwise(F.col("_match_status"))
    obs = obs.withColumn("_status", status)
    empty = F.array().cast("array<string>")
    hit = F.struct(
        F.col("taxon.id").alias("inat_id"), F.col("taxon.observations_count").alias("observations"),
        F.col("research_images").alias("images"),
        F.coalesce(F.when(F.col("taxon.preferred_common_name") != "", F.col("taxon.preferred_common_name")),
                   F.when(F.col("taxon.english_common_name") != "", F.col("taxon.english_common_name")),
                   F.lit("")).alias("common_name"), F.col("_status").alias("inat_status"))
    ok = accept_status("_status")
    r = F.when(ok, hit).otherwise(fallback_observation(lookup_outcome("_status")))
    return obs.withColumn("_r", r).select(
        "key", F.col("_r.inat_id").alias("inat_id"), F.col("_r.observations").alias("observation_count"),
        F.col("_r.common_name").alias("common_name"), F.col("_r.images").alias("research_images"),
        F.when(ok, F.col("needs_id_images")).otherwise(empty).alias("needs_id_images"),
        F.col("_r.inat_status").alias("inat_status"))


def records_text(records: DataFrame) -> DataFrame:
    """Records in their CSV shape (lists as JSON text), without the run clock."""
    return to_csv_record(records).drop("extraction_timestamp")


# ---- the same run in SQL: ``rec`` is one row per record, lists as lists
RUN_SQL = TEXT_CHAIN_SQL.replace("concat_ws(' ', upper(substr(p_name, 1, 1)) || substr(p_name, 2), p_brand) AS name",
                                 "upper(substr(p_name, 1, 1)) || substr(p_name, 2) AS name") + r""",
cpart AS (
  SELECT p_partkey, upper(substr(p_name, 1, 1)) || substr(p_name, 2) AS cname, p_brand, p_type, p_size FROM part),
taxa AS (
  SELECT p_partkey AS key, p_type AS order_name, concat_ws(' ', cname, p_brand) AS sname, cname, p_brand,
         split_part(cname, ' ', 1) AS genus, CASE WHEN p_size % 3 = 0 THEN lower(p_type) END AS vern
  FROM cpart WHERE p_size <= 45 AND p_type <> 'PROMO' AND p_partkey NOT IN (SELECT doc_id FROM labels WHERE quality = 0)),
nbase AS (SELECT cname, min(p_partkey) AS k FROM cpart GROUP BY cname),
ans AS (
  SELECT b.cname, CASE WHEN b.k % 11 = 0 THEN NULL WHEN b.k % 3 = 0 THEN b.cname
                       WHEN b.k % 3 = 1 AND n.cname IS NOT NULL THEN n.cname
                       WHEN b.k % 3 = 2 THEN upper(b.cname) ELSE b.cname END AS a
  FROM nbase b LEFT JOIN cpart n ON n.p_partkey = b.k + 1),
ents0 AS (SELECT t.key, coalesce(nullif(ans.a, ''), t.cname) AS rname FROM taxa t LEFT JOIN ans USING (cname)),
tres AS (
  SELECT q, CASE WHEN length(q) % 7 = 0 THEN 500 WHEN length(q) % 13 <> 0 THEN 200 END AS st, rn, id, tname, obs, pref, eng FROM (
    SELECT q, p_partkey AS id, cname AS tname, CAST(p_size AS BIGINT) AS obs,
           CASE WHEN p_brand LIKE '%1' THEN NULL ELSE p_brand END AS pref, p_type AS eng,
           row_number() OVER (PARTITION BY q ORDER BY p_partkey) AS rn
    FROM (SELECT *, split_part(cname, ' ', 1) AS q FROM cpart
          UNION ALL SELECT *, cname AS q FROM cpart WHERE length(cname) % 3 <> 0))
  WHERE rn <= 5),
tcands AS (
  SELECT key, rname, 0 AS prio, rname AS q FROM ents0
  UNION ALL SELECT key, rname, 1, replace(rname, '-', ' ') FROM ents0
  UNION ALL SELECT key, rname, 2, split_part(rname, ' ', 1) FROM ents0),
tj AS (
  SELECT c.key, c.prio, r.*, coalesce(contains(lower(r.tname), lower(c.rname)), false) AS hit
  FROM tcands c JOIN tres r ON c.q = r.q WHERE r.st = 200 OR r.st IS NULL),
tpick AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY prio, (NOT hit), rn) AS pk FROM tj)
  WHERE pk = 1 AND st = 200),
tiers AS (""" + TIERS_SQL + r""" SELECT * FROM tiers),
obs AS (
  SELECT t.key, p.id, p.obs, coalesce(nullif(p.pref, ''), nullif(p.eng, ''), '') AS cn,
         CASE WHEN len(coalesce(ti.research, [])) > 0 THEN ti.research WHEN len(coalesce(ti.needs_id, [])) > 0 THEN ti.needs_id
              WHEN len(coalesce(ti.fallback, [])) > 0 THEN ti.fallback
              ELSE ['m/' || CAST(p.id AS VARCHAR)] END[1:3] AS research, coalesce(ti.needs_id, [])[1:3] AS needs_id
  FROM taxa t JOIN tpick p USING (key) LEFT JOIN tiers ti ON ti.entity = p.id),
wiki AS (""" + PAGE_SQL + r""",
  first AS (SELECT c.cname, min(p.page_id) AS page_id FROM pages p JOIN cpart c ON c.p_partkey = p.page_id GROUP BY 1),
  ipage AS (SELECT f.cname, CASE WHEN f.page_id % 13 = 0 THEN NULL WHEN f.page_id % 7 = 0 THEN 404 ELSE 200 END AS st,
                   regexp_extract_all(p.html, '<a href="([^"]*)"', 1) AS hrefs
            FROM first f JOIN pages p USING (page_id)),
  isrch AS (SELECT b.cname, CASE WHEN b.k % 5 <> 0 THEN 200 END AS st, n.cname AS top
            FROM nbase b JOIN cpart n ON n.p_partkey = b.k + 1),
  own AS (SELECT b.cname, CASE WHEN p.st = 200 THEN p.hrefs ELSE [] END AS own_h, (p.cname IS NOT NULL AND p.st IS NULL) AS own_fail
          FROM nbase b LEFT JOIN ipage p USING (cname)),
  need AS (SELECT * FROM own WHERE len(own_h) = 0 AND NOT own_fail),
  alt AS (SELECT n.cname, CASE WHEN s.st = 200 AND p.st = 200 THEN p.hrefs ELSE [] END AS alt_h,
                 (s.st IS NULL) OR (s.st = 200 AND p.cname IS NOT NULL AND p.st IS NULL) AS alt_fail
          FROM need n JOIN isrch s USING (cname) LEFT JOIN ipage p ON p.cname = s.top),
  titled AS (SELECT o.cname AS page_id, CASE WHEN len(o.own_h) > 0 THEN o.own_h ELSE coalesce(a.alt_h, []) END AS hs,
                    o.own_fail OR coalesce(a.alt_fail, false) AS exc
             FROM own o LEFT JOIN alt a USING (cname)),
  titled_x AS (SELECT page_id, unnest(hs[1:50]) AS h, generate_subscripts(hs[1:50], 1) - 1 AS pos FROM titled WHERE NOT exc),
""" + RANK_TAIL_SQL.replace("string_agg(url, '|' ORDER BY r) AS imgs", "list(url ORDER BY r) AS imgs").replace("TOPN", "5") + r"""
  SELECT page_id AS cname, imgs FROM ranked),
rec AS (
  SELECT t.key, t.order_name, t.p_brand AS family, t.genus, coalesce(string_split_regex(trim(t.cname), '\s+')[2], '') AS species,
         t.sname, coalesce(nullif(o.cn, ''), nullif(t.vern, ''), '') AS cn0, o.id AS inat_id,
         CASE WHEN o.key IS NULL THEN 'max_retries_exhausted' ELSE 'success' END AS inat_status,
         (len(coalesce(o.research, [])) > 0 OR len(coalesce(w.imgs, [])) > 0) AS has_images, o.obs AS observation_count,
         CASE WHEN length(lk.description) > 50 THEN lk.description ELSE 'Description not found.' END AS description,
         CASE WHEN length(lk.description) > 50 THEN lk.description_source ELSE 'none' END AS description_source,
         coalesce(o.research, []) AS research, coalesce(o.needs_id, []) AS needs_id, coalesce(w.imgs, []) AS wiki
  FROM taxa t LEFT JOIN obs o USING (key) LEFT JOIN wiki w USING (cname) LEFT JOIN lk ON lk.p_partkey = t.key),
records AS (
  SELECT order_name AS "order", family, genus, species, sname AS scientific_name,
         upper(substr(lower(trim(cn0)), 1, 1)) || substr(lower(trim(cn0)), 2) AS common_name, key AS gbif_id, inat_id,
         inat_status, has_images, observation_count, description AS wikipedia_description, description_source, research, needs_id, wiki
  FROM rec)
"""


EXTRACT_SQL = RUN_SQL + """
SELECT "order", family, genus, species, scientific_name, common_name, CAST(gbif_id AS VARCHAR) AS gbif_id,
       CAST(inat_id AS VARCHAR) AS inat_id, inat_status, CAST(has_images AS VARCHAR) AS has_images,
       CAST(observation_count AS VARCHAR) AS observation_count, wikipedia_description, description_source,
       CAST(to_json(research) AS VARCHAR) AS inat_research_images, CAST(to_json(needs_id) AS VARCHAR) AS inat_needs_id_images,
       CAST(to_json(wiki) AS VARCHAR) AS wiki_images
FROM records
"""


@query("extract_species", EXTRACT_SQL)
def q_extract_species(spark, d):
    return records_text(extract_species(spark, d))


@query("retry_extraction", EXTRACT_SQL)
def q_retry_extraction(spark, d):
    """A run that lost every third record, and the rerun of what it lost: together the whole, descriptions from one cache."""
    sink, cache = scratch_path(spark, "records_sink"), scratch_path(spark, "text_cache")
    taxa, landed = materialize(species_to_extract(spark, d), "species_to_extract"), landed_logs(spark, d)
    first = enrich(spark, d, taxa, cache, landed)
    bucketed.write_batch(first.filter(F.col("gbif_id") % 3 != 0), sink, ["gbif_id"], "run")
    recorded = bucketed.read(spark, sink).select(F.col("gbif_id").alias("key"))
    bucketed.write_batch(retry_extraction(spark, d, taxa, recorded, cache, landed), sink, ["gbif_id"], "retry")
    return records_text(bucketed.read(spark, sink).drop(bucketed.BATCH))


def load_species(spark: SparkSession, records: DataFrame, parent_path: str, child_path: str,
                 chunk_rows: int = 10_000, report: Callable[[str, dict], None] = lambda step, figures: None) -> dict[str, DataFrame]:
    """The load run into the (possibly existing) keyed tables at the two paths:
    records, in their order ``pos`` -> global duplicate merge on the cleaned
    name (A1) -> parent rows (P11) -> upsert (S7) -> ids (S9) -> child image
    rows (J10, from one row per listed image) -> insert-ignore (S8).  Loading
    the same records again changes nothing.

    Returns the tables and reports: parent, child, metrics per chunk of input
    rows (A13), rejects (P12) and table counts (S10).  While it runs, ``report``
    is told each step's figures as its write ends, counted by that write (S10):
    rows and images read, keys merged and rejected, images listed."""
    name = clean_text("scientific_name")
    at = number_rows(records, ["pos"], "row_id", "load_rows")
    n_rows = F.count(F.lit(1)).alias("n_rows")
    n_images = F.sum(F.coalesce(F.size("inat_research_images"), F.lit(0)) + F.coalesce(F.size("wiki_images"), F.lit(0)))
    rows = materialize_seen(at.withColumn("scientific_name", name).filter(F.col("scientific_name").isNotNull())
                            .select(*[c for c in SPECIES_COLUMNS if c != "inat_needs_id_images"], "row_id"), "load_rows", report,
                            n_rows, F.coalesce(n_images, F.lit(0)).alias("n_images"))
    first = lambda c: F.try_element_at(F.col(c), F.lit(1))
    slim = rows.select(*[c for c in rows.columns if c not in LIST_COLUMNS], first("inat_research_images").alias("_inat"),
                       first("wiki_images").alias("_wiki"))
    merged = merge_entities(slim, key="scientific_name", pos="row_id", name_col="common_name", text_col="wikipedia_description",
                            first_present=["_inat", "_wiki"])
    merged = merged.withColumn("primary_image_url", F.coalesce("_inat", "_wiki"))
    valid = is_valid_species_name("scientific_name")
    keys = materialize_seen(merged, "load_merged", report, n_rows, F.count_if(~F.coalesce(valid, F.lit(False))).alias("n_invalid"))
    merged = keys.filter(valid)
    species = to_species_rows(merged)
    keyed.upsert_into(spark, parent_path, species.withColumn("_seq", F.lit(0)), ["scientific_name"], "_seq")
    like = species.withColumn("id", F.lit(0).cast("bigint"))
    parent = _stored(keyed.read_table(spark, parent_path), like)
    loaded_keys = _stored(keyed.rows_of_keys(spark, parent_path, species, ["scientific_name"]), like)

    listed = F.concat(_listed("inat_research_images", "inat"), _listed("wiki_images", "wiki"))
    images = rows.select("scientific_name", "row_id", F.inline(listed)).filter(F.col("image_url").isNotNull())
    images = store.lookup_ids(images, loaded_keys, ["scientific_name"]).withColumnRenamed("id", "species_id")
    child = materialize_seen(explode_media_rows(images, "species_id", "image_url", "source", ["row_id", "i"]), "load_images",
                             report, n_rows)
    keyed.insert_into(spark, child_path, child, ["species_id", "image_url"], ["image_order"])
    child = _stored(keyed.read_table(spark, child_path), child)
    chunk = F.floor(F.col("row_id") / chunk_rows)
    loaded = rows.select(chunk.alias("_c"), (F.size("inat_research_images") + F.size("wiki_images")).alias("_n"))
    return {"parent": parent.drop(keyed.BUCKET), "child": child.drop(keyed.BUCKET),
            "metrics": audit.load_metrics(loaded, None, chunk_col="_c", images_col="_n", firsts=keys.select(chunk.alias("chunk"))),
            "rejects": missing_field_rejects(merged),
            "counts": store.table_counts({"species": parent, "species_images": child})}


def _stored(rows: DataFrame | None, like: DataFrame) -> DataFrame:
    """A stored table, or an empty one of the same columns before its first row."""
    return like.limit(0).withColumn(keyed.BUCKET, F.lit("")) if rows is None else rows


def _listed(c: str, source: str):
    return F.transform(F.coalesce(F.col(c), F.array().cast("array<string>")),
                       lambda u, i: F.struct(u.alias("image_url"), F.lit(source).alias("source"), i.alias("i")))


def _loaded(spark, d) -> dict[str, DataFrame]:
    """Two loads into the same tables: first an earlier state (every other
    record, with another family and its first observation image only), then
    the whole run."""
    records = materialize(extract_species(spark, d), "records")
    early = (records.filter(F.col("gbif_id") % 2 == 0).withColumn("family", F.lit("Earlier"))
             .withColumn("inat_research_images", F.slice("inat_research_images", 1, 1))
             .withColumn("wiki_images", F.array().cast("array<string>")))
    paths = scratch_path(spark, "species"), scratch_path(spark, "species_images")
    load_species(spark, early, *paths)
    return load_species(spark, records, *paths, chunk_rows=500)


LOAD_SQL = RUN_SQL + r""",
inrows AS (SELECT *, row_number() OVER (ORDER BY "order", gbif_id) - 1 AS row_id FROM records),
lfirst AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY scientific_name ORDER BY row_id) AS rn FROM inrows) WHERE rn = 1),
lnames AS (SELECT scientific_name, list(DISTINCT trim(common_name) ORDER BY trim(common_name)) AS names FROM inrows
           WHERE trim(common_name) <> '' GROUP BY 1),
ltext AS (SELECT scientific_name, wikipedia_description FROM (
            SELECT *, row_number() OVER (PARTITION BY scientific_name ORDER BY length(wikipedia_description) DESC, row_id) AS rn
            FROM inrows) WHERE rn = 1),
limg AS (
  SELECT scientific_name, row_id, 1 AS r, 'inat' AS source, unnest(research) AS u, generate_subscripts(research, 1) AS i, gbif_id FROM inrows
  UNION ALL
  SELECT scientific_name, row_id, 2, 'wiki', unnest(wiki), generate_subscripts(wiki, 1), gbif_id FROM inrows),
numbered AS (
  SELECT scientific_name, u, source, CAST(row_number() OVER (PARTITION BY scientific_name ORDER BY r, row_id, i) - 1 AS INTEGER) AS image_order
  FROM (SELECT *, row_number() OVER (PARTITION BY scientific_name, u ORDER BY r, row_id, i) AS k FROM limg) WHERE k = 1),
early AS (
  SELECT scientific_name, u, CAST(row_number() OVER (PARTITION BY scientific_name ORDER BY row_id) - 1 AS INTEGER) AS image_order
  FROM (SELECT *, row_number() OVER (PARTITION BY scientific_name, u ORDER BY row_id) AS k FROM limg
        WHERE source = 'inat' AND i = 1 AND gbif_id % 2 = 0) WHERE k = 1),
primary_ AS (SELECT scientific_name, u FROM numbered WHERE image_order = 0),
parent AS (
  SELECT f.scientific_name, coalesce(n.names, []) AS common_names, f.family, t.wikipedia_description AS description,
         p.u AS primary_image_url, f."order" AS order_name, f.genus, f.species, f.gbif_id, f.inat_id, f.observation_count,
         f.inat_status, f.has_images, f.description_source
  FROM lfirst f LEFT JOIN lnames n USING (scientific_name) LEFT JOIN ltext t USING (scientific_name)
  LEFT JOIN primary_ p USING (scientific_name)),
child AS (
  SELECT scientific_name, u AS image_url, 'inat' AS source, (image_order = 0) AS is_primary, image_order FROM early
  UNION ALL
  SELECT scientific_name, u, source, (image_order = 0 AND source = 'inat'), image_order FROM numbered
  WHERE (scientific_name, u) NOT IN (SELECT (scientific_name, u) FROM early))
"""


@query("load_species", LOAD_SQL + """
SELECT scientific_name, array_to_string(common_names, '|') AS common_names, family, description, primary_image_url, order_name,
       genus, species, gbif_id, inat_id, observation_count, inat_status, has_images, description_source FROM parent
""")
def q_load_species(spark, d):
    return _loaded(spark, d)["parent"].drop("id").withColumn("common_names", F.array_join("common_names", "|"))


@query("load_images", LOAD_SQL + "SELECT * FROM child")
def q_load_images(spark, d):
    out = _loaded(spark, d)
    names = out["parent"].select(F.col("id").alias("species_id"), "scientific_name")
    return out["child"].join(names, "species_id").select("scientific_name", "image_url", "source", "is_primary", "image_order")


@query("load_report", LOAD_SQL + """,
per AS (SELECT CAST(floor(row_id / 500) AS BIGINT) AS chunk, count(*) AS rows_in, sum(len(research) + len(wiki)) AS imgs
        FROM inrows GROUP BY 1),
firsts_ AS (SELECT chunk, count(*) AS k FROM (
              SELECT scientific_name, CAST(floor(min(row_id) / 500) AS BIGINT) AS chunk FROM inrows GROUP BY 1) GROUP BY 1)
SELECT chunk, rows_in, coalesce(k, 0) AS unique_keys,
       CAST(sum(rows_in) OVER (ORDER BY chunk) AS BIGINT) AS rows_loaded,
       CAST(sum(coalesce(k, 0)) OVER (ORDER BY chunk) AS BIGINT) AS keys_loaded,
       CAST(sum(imgs) OVER (ORDER BY chunk) AS BIGINT) AS images_loaded,
       round(sum(rows_in) OVER (ORDER BY chunk) * 100.0 / sum(rows_in) OVER (), 6) AS progress_pct,
       (SELECT count(*) FROM parent) AS n_species, (SELECT count(*) FROM child) AS n_images,
       (SELECT count(*) FROM parent WHERE family IS NULL OR species IS NULL) AS n_rejects
FROM per LEFT JOIN firsts_ USING (chunk)
""")
def q_load_report(spark, d):
    out = _loaded(spark, d)
    rows = lambda t: out["counts"].filter(F.col("table_name") == t).select("n_rows").scalar()
    return out["metrics"].withColumn("progress_pct", F.round("progress_pct", 6)).select(
        "*", rows("species").alias("n_species"), rows("species_images").alias("n_images"),
        out["rejects"].agg(F.count(F.lit(1))).scalar().alias("n_rejects"))


def audit_species(records: DataFrame) -> DataFrame:
    """The audit report on extracted records, one row: rows, distinct
    species/orders/families/genera, grid label, missing common names and
    observation counts, image coverage and gaps, complete records.

    The records are reduced once to one row per (order, species, family,
    genus) with its counts; every figure is a second aggregate over those."""
    df = is_complete(normalize_headers(records))
    blank_common = F.col("common_name").isNull() | (F.col("common_name") == "")
    per = materialize(df.groupBy("order", "scientific_name", "family", "genus").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(blank_common).alias("no_name"),
        F.count_if(F.col("observation_count").isNull()).alias("no_count"), F.count_if("has_images").alias("images"),
        F.count_if("is_complete").alias("complete")), "audit_groups")
    grid = audit.grid_symmetry(per).select("grid").scalar()
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return per.agg(
        total("n").alias("n_rows"), F.count_distinct("scientific_name").alias("n_species"),
        F.count_distinct("order").alias("n_orders"), F.count_distinct("family").alias("n_families"),
        F.count_distinct("genus").alias("n_genera"), total("no_name").alias("missing_common_name"),
        total("no_count").alias("missing_observation_count"),
        F.coalesce(F.try_divide(F.sum("images") * 100.0, F.sum("n")), F.lit(0.0)).alias("image_coverage_pct"),
        (total("n") - total("images")).alias("n_without_images"),
        total("complete").alias("n_complete")).select("*", grid.alias("grid"))


@query("audit_species", RUN_SQL + f"""
SELECT count(*) AS n_rows, count(DISTINCT scientific_name) AS n_species, count(DISTINCT "order") AS n_orders,
       count(DISTINCT family) AS n_families, count(DISTINCT genus) AS n_genera,
       count(*) FILTER (WHERE common_name IS NULL OR common_name = '') AS missing_common_name,
       count(*) FILTER (WHERE observation_count IS NULL) AS missing_observation_count,
       round(count(*) FILTER (WHERE has_images) * 100.0 / count(*), 6) AS image_coverage_pct,
       count(*) FILTER (WHERE NOT has_images) AS n_without_images,
       count(*) FILTER (WHERE has_images OR common_name <> ''
                              OR (wikipedia_description <> '' AND wikipedia_description <> '{NOT_FOUND_TEXT}')) AS n_complete,
       (SELECT CASE WHEN count(*) = 0 THEN 'Symmetric' WHEN count(DISTINCT n) = 1
                    THEN printf('Perfect Grid (%d species per order)', min(n))
                    ELSE printf('Asymmetric (Ranges from %d to %d species per order)', min(n), max(n)) END
        FROM (SELECT "order", count(DISTINCT scientific_name) AS n FROM records GROUP BY 1)) AS grid
FROM records
""")
def q_audit_species(spark, d):
    return audit_species(extract_species(spark, d)).withColumn("image_coverage_pct", F.round("image_coverage_pct", 6))


def sample_dataset(spark, d, per_order: int = 10) -> DataFrame:
    """The sample build: accepted species of each order (first ``per_order``)
    -> short description chain -> most-observed taxon -> text flags -> the
    16-column sample record."""
    taxa = en.explode_pages(landed_listing(spark, d), ["order_name"], "offset", "results")
    taxa = en.accepted_species(taxa, rank_col="rank", status_col="status")
    taxa = en.limit_per_group(taxa, "order_name", ["offset", "index"], n=per_order)
    _, summaries, _, _ = text_landing(spark, d)
    text = text_fallback(taxa.select("key", F.col("canonicalName").alias("name")), "key", "name", summaries,
                         candidates=(("species", "species"), ("two_tokens", "cleaned"), ("genus", "genus")),
                         min_len=0, strip=True, not_found=("", "none"))
    inat = top_taxon(taxa.select("key", F.col("canonicalName").alias("name")),
                     landed_taxa_search(spark, d, True), "key", "name")
    out = (taxa.join(text.select("key", "description"), "key").join(inat.drop("name"), "key"))
    out = flag_text_quality(out, "description")
    return out.select(F.col("order_name").alias("order"), "scientificName", "canonicalName", "family", "genus",
                      F.col("key").alias("gbif_id"), "description", "description_length", "has_wiki", "inat_id",
                      "common_name", "observations_count", "image_primary",
                      gallery_text("image_gallery").alias("image_gallery"),
                      blank_placeholder().alias("color_primary"), blank_placeholder().alias("native_region"))


SAMPLE_SQL = TEXT_SQL + r""",
cpart AS (
  SELECT p_partkey, upper(substr(p_name, 1, 1)) || substr(p_name, 2) AS cname, p_brand, p_type, p_size FROM part),
taxa AS (
  SELECT * FROM (
    SELECT p_partkey AS key, p_type AS order_name, concat_ws(' ', cname, p_brand) AS scientificName,
           cname AS canonicalName, p_brand AS family, split_part(cname, ' ', 1) AS genus,
           row_number() OVER (PARTITION BY p_type ORDER BY p_partkey) AS rn
    FROM cpart WHERE p_size <= 45 AND p_type <> 'PROMO')
  WHERE rn <= 10),
cands AS (
  SELECT key, 0 AS prio, canonicalName AS q FROM taxa
  UNION ALL
  SELECT key, 1, t FROM (
    SELECT key, canonicalName, array_to_string(string_split_regex(trim(canonicalName), '\s+')[1:2], ' ') AS t
    FROM taxa) WHERE t <> canonicalName
  UNION ALL SELECT key, 2, split_part(canonicalName, ' ', 1) FROM taxa WHERE split_part(canonicalName, ' ', 1) <> ''),
tres AS (
  SELECT q, regexp_replace(s.extract, '^\s+|\s+$', '', 'g') AS text
  FROM (SELECT DISTINCT q FROM cands) k JOIN summ s ON replace(k.q, ' ', '_') = s.title
  WHERE s.http_status = 200 AND length(regexp_replace(s.extract, '^\s+|\s+$', '', 'g')) > 0),
tbest AS (
  SELECT * FROM (SELECT c.key, c.prio, r.text, row_number() OVER (PARTITION BY c.key ORDER BY c.prio) AS rn
                 FROM cands c JOIN tres r USING (q)) WHERE rn = 1),
res AS (
  SELECT q, CASE WHEN length(q) % 7 = 0 THEN 500 WHEN length(q) % 13 <> 0 THEN 200 END AS http_status, rn, id, obs, pref, url1, url2 FROM (
    SELECT q, p_partkey AS id, CAST(p_size AS BIGINT) AS obs,
           CASE WHEN p_brand LIKE '%1' THEN NULL ELSE p_brand END AS pref,
           CASE WHEN p_size % 2 = 0 THEN 'l/' ELSE 'm/' END || CAST(p_partkey AS VARCHAR) AS url1,
           'sq/' || CAST(p_partkey AS VARCHAR) AS url2,
           row_number() OVER (PARTITION BY q ORDER BY p_partkey) AS rn
    FROM (SELECT *, split_part(cname, ' ', 1) AS q FROM cpart
          UNION ALL SELECT *, cname AS q FROM cpart WHERE length(cname) % 3 <> 0))
  WHERE rn <= 5),
icands AS (SELECT key, 0 AS prio, canonicalName AS q FROM taxa
           UNION ALL SELECT key, 1, split_part(canonicalName, ' ', 1) FROM taxa),
ij AS (SELECT c.key, c.prio, r.* EXCLUDE (q) FROM icands c JOIN res r ON c.q = r.q WHERE r.http_status = 200),
itop AS (SELECT * FROM (SELECT ij.*, row_number() OVER (PARTITION BY key, prio ORDER BY coalesce(obs, -1) DESC, rn)
                          AS k FROM ij) WHERE k = 1),
ibest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY prio) AS kk FROM itop) WHERE kk = 1)
SELECT t.order_name AS "order", t.scientificName, t.canonicalName, t.family, t.genus, t.key AS gbif_id,
       coalesce(tb.text, '') AS description,
       CAST(length(coalesce(tb.text, '')) AS INTEGER) AS description_length,
       CASE WHEN length(coalesce(tb.text, '')) > 50 THEN 'Yes' ELSE 'No' END AS has_wiki,
       b.id AS inat_id, coalesce(b.pref, '') AS common_name, CAST(coalesce(b.obs, 0) AS BIGINT) AS observations_count,
       coalesce(b.url1, '') AS image_primary,
       CASE WHEN b.id IS NULL THEN '' ELSE b.url1 || '|' || b.url2 END AS image_gallery,
       '' AS color_primary, '' AS native_region
FROM taxa t LEFT JOIN tbest tb USING (key) LEFT JOIN ibest b USING (key)
"""


@query("sample_dataset", SAMPLE_SQL)
def q_sample_dataset(spark, d):
    return sample_dataset(spark, d)

