import os

import pytest
from pyspark.sql import types as T

SMALL = os.environ.get("LLM_TEST_DIR", "/root/testdata/sf0.001")

DOCUMENT = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                         T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                         # names that the operators use themselves
                         *[T.StructField(n, T.StringType()) for n in ("shard", "fp", "digest", "size", "target", "row", "length")]])

LONG = " ".join(f"word{i % 977}" for i in range(60_000))


def rows_of(*docs):
    """Rows of ``DOCUMENT`` from (doc_id, text[, lang[, source]])."""
    return [(*d, *(None,) * (4 - len(d)), *"abcdefg") for d in docs]


ODD = rows_of((1, "The cat sat on the mat today", "en", "a"), (1, "The cat sat on the mat today", "en", "a"),
              (2, "Thecat sat on\tthe mat today\n", "en", "a"), (3, None, None, None), (4, "", "en", "b"),
              (5, " \t\n", "fr", None), (6, LONG, "en", "b"), (7, LONG + " end", "en", "b"), (None, "A row without id", "en", None),
              (8, "12 34 !!", "en", "c"), (9, "été ÉTÉ 中文 \U0001f44d", "fr", "c"))


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, DOCUMENT)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCUMENT)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")
