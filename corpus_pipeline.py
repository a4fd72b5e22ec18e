"""Corpus pipeline: stages over ``documents``, each one of the corpus operators.

A stage takes ``(spark, docs, sf_dir)``; what it returns is written as Parquet
and reread as the next stage's ``docs``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from florapipe.llm.exact_dedup import drop_exact_duplicates
from florapipe.llm.language_id import keep_identified, train
from florapipe.llm.mixing import mix
from florapipe.llm.packing import pack
from florapipe.llm.queries import TOKENIZER
from florapipe.llm.simhash import drop_near_duplicates
from florapipe.session import materialize
from florapipe.sources.tables import table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_identified(docs, train(docs, F.col("text"), F.col("lang")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_exact_duplicates(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs, shingle=3, bits=2)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, public_tokenizers.path(TOKENIZER), capacity=2048)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("mix_sources", mix_sources),
    ("best_fit_packing", best_fit_packing),
]

#: No SQL: fingerprints, language models and token ids are beyond it; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
