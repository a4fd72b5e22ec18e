"""The corpus operators bound to the driver tables, each with its DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from florapipe.llm.embedding_dedup import embedding_groups
from florapipe.llm.exact_dedup import exact_duplicates
from florapipe.llm.html_text import extract_main_text
from florapipe.llm.language_id import identify_language, train
from florapipe.llm.lexical_search import search
from florapipe.llm.license_scan import scan_licenses
from florapipe.llm.mixing import mix_counts
from florapipe.llm.packing import pack
from florapipe.llm.sharding import LAW, shard
from florapipe.llm.simhash import simhash_groups
from florapipe.llm.topk import top_k
from florapipe.llm.url_filter import ALLOW, BLOCK, Rule, filter_urls
from florapipe.llm.whitening import whiten
from florapipe.sources.tables import table

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        LLM_QUERIES[name] = fn
        if sql is not None:
            LLM_ORACLE[name] = sql.strip()
        return fn
    return deco


TOKENIZER = "word_bpe_49k.json"


@query("op2_mix_sources", r"""
WITH d AS MATERIALIZED (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
     s AS (SELECT source, sum(size)::BIGINT AS z, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w
           FROM d GROUP BY source),
     o AS (SELECT *, row_number() OVER (ORDER BY 3.0::DOUBLE * z / w, source NULLS LAST) AS k FROM s),
     l AS (SELECT o.*, (sum(z) OVER () - 3 * coalesce(sum(z) OVER before, 0))::DOUBLE
                       / (sum(w) OVER () - coalesce(sum(w) OVER before, 0)) AS level
           FROM o WINDOW before AS (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
     f AS (SELECT arg_min(level, k) AS level FROM l WHERE level * w <= 3.0::DOUBLE * z),
     t AS (SELECT source, z AS source_size, least(3.0::DOUBLE * z, f.level * w) AS target FROM s, f),
     r AS (SELECT *, CASE WHEN source_size = 0 THEN 0.0::DOUBLE ELSE least(target / source_size, 3.0::DOUBLE) END AS rate FROM t),
     h AS (SELECT d.*, i, md5(coalesce(doc_id::VARCHAR, 'null') || ':' || i) AS hash FROM d, range(16) g(i)),
     c AS (SELECT doc_id, source, size, i * 4 + k AS j, ('0x' || substr(hash, k * 8 + 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u FROM h, range(4) f(k)),
     p AS (SELECT c.source, j, abs(sum(CASE WHEN u < rate - floor(rate) THEN size ELSE 0 END)::DOUBLE
                                   - (any_value(rate) - floor(any_value(rate))) * any_value(source_size)) AS miss
           FROM c JOIN r ON c.source IS NOT DISTINCT FROM r.source GROUP BY c.source, j),
     b AS (SELECT source, min(miss) AS best FROM p GROUP BY source),
     e AS (SELECT p.source, min(j) AS seed FROM p JOIN b ON p.source IS NOT DISTINCT FROM b.source AND p.miss = b.best GROUP BY p.source)
SELECT c.doc_id, c.size, r.source_size, r.target,
       ((floor(rate)::BIGINT + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) * c.size)::BIGINT AS taken
FROM c JOIN e ON c.source IS NOT DISTINCT FROM e.source AND c.j = e.seed JOIN r ON c.source IS NOT DISTINCT FROM r.source
""")
def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = mix_counts(table(spark, sf_dir, "documents"))
    return counts.withColumn("taken", F.col("copies") * F.col("size")).drop("copies")


@query("op4_exact_dedup", r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n,
                  sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents),
     r AS (SELECT *, row_number() OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS LAST) AS place,
                  first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS LAST) AS keep_id,
                  count(*) OVER (PARTITION BY text_sha256) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM r
""")
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents")).drop("text_hash")


@query("op5_simhash_near_dedup")
def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"), shingle=3, bits=2).drop("text_hash")


@query("op7_best_fit_packing")
def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), capacity=2048)


@query("op8_language_id")
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    dictionaries = train(docs.filter(~held_out), F.col("text"), F.col("lang"))
    found = identify_language(docs.select("doc_id", "text"), dictionaries)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", (~F.col("accepted")).alias("rejected"))


@query("op1_sharding")
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"), shards=24).withColumns(
        {"law": F.lit(LAW), "grown_shard": F.lit(None).cast("int")})


#: The rules of the contract.
URL_RULES = [Rule(ALLOW, "org/"), Rule(BLOCK, "example.org/es/"), Rule(BLOCK, "example.org/en/1"),
             Rule(ALLOW, "com/fr/"), Rule(BLOCK, "com/de/")]


@query("op9_url_filter")
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), URL_RULES).drop("url")


@query("op3_html_extraction")
def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract_main_text(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.char_length("text").cast("bigint"))


@query("op10_embedding_near_dedup")
def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_groups(table(spark, sf_dir, "embeddings"), threshold=0.95)


@query("op6_license_scan")
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


@query("op11_lexical_search", r"""
WITH d AS (SELECT row_number() OVER () AS uid, doc_id,
                  regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS terms
           FROM documents WHERE text IS NOT NULL),
     z AS (SELECT uid, doc_id, len(terms)::BIGINT AS n FROM d WHERE len(terms) > 0),
     a AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS total FROM z),
     i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                              '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term FROM benchmark),
     p AS (SELECT uid, unnest(terms) AS term FROM d),
     f AS (SELECT uid, term, count(*)::BIGINT AS tf FROM p WHERE term IN (SELECT term FROM i) GROUP BY uid, term),
     w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM f, a GROUP BY term, docs),
     s AS (SELECT i.item_id, z.uid, z.doc_id,
                  sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * docs) // total)))))::BIGINT AS score
           FROM f JOIN w USING (term) JOIN i USING (term) JOIN z USING (uid), a GROUP BY i.item_id, z.uid, z.doc_id),
     r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r WHERE rank <= 10
""")
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


@query("op12_exact_top_k", r"""
WITH v AS (SELECT row_number() OVER () AS uid, vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE embedding IS NOT NULL),
     x AS (SELECT uid, vec_id, list_transform(e, lambda c: floor(256 * c)::BIGINT) AS x FROM v
           WHERE len(list_filter(e, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
     s AS (SELECT q.uid, q.vec_id AS query_id, c.vec_id,
                  coalesce(list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2])), 0)::BIGINT AS score
           FROM x q JOIN x c ON q.uid <> c.uid AND len(q.x) = len(c.x) WHERE q.vec_id % 50 = 0),
     r AS (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
""")
def op12_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 50 == 0, k=5, scale=256.0)


@query("op13_whitening")
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"), components=16, scale=64.0)
