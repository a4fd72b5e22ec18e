"""URL filter: host and path rules, and boosted trees for what no rule decides (operator 9).

In DataFrame functions only: addresses are taken apart and measured with
built-in functions, the trees are Spark's gradient-boosted trees.  They learn
from the labelled URLs, which are those that a rule decides, by lexical
features: lengths, depth, digit ratio, entropy, parameters, and statistics of
the host's suffix, the first folder and the file suffix among the labelled URLs.
"""

from __future__ import annotations

import string
from typing import NamedTuple

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from florapipe.session import materialize

ALLOW, BLOCK = "allow", "block"

#: Bounded sample of distinct labelled URLs that the trees are fitted on.
TRAIN_ROWS = 20_000
TREES, DEPTH, SEED = 12, 4, 7
#: A suffix's block rate counts as if so many more URLs had the overall rate.
SMOOTHING = 10.0


class Rule(NamedTuple):
    """``host + path``, like ``example.org/es/``: for the host and its subdomains, paths that start so."""
    verdict: str
    pattern: str

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.pattern.partition("/")[2]


def split_url(url: Column) -> tuple[Column, Column, Column]:
    """Host, path and what follows; all empty for a null url or one without ``://``."""
    part = [F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)(.*)$", i), F.lit("")) for i in (1, 2, 3)]
    return F.translate(part[0], string.ascii_uppercase, string.ascii_lowercase), part[1], part[2]


def match_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Pattern and verdict of the longest rule that fits, else null (of equal length: by code point)."""
    pattern = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.pattern), r.pattern)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        pattern = F.when(fits, F.lit(rule.pattern)).otherwise(pattern)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return pattern, verdict


def _entropy(text: Column) -> Column:
    """Bits per character, from the counts of its distinct characters."""
    chars = F.split(text, "")
    share = F.transform(F.array_distinct(chars), lambda c: F.size(F.filter(chars, lambda x: x == c)) / F.size(chars))
    return F.aggregate(share, F.lit(0.0), lambda a, p: a - p * F.log2(p))


FEATURES = ["f_length", "f_host", "f_path", "f_depth", "f_digits", "f_entropy", "f_parameters", "f_query", "f_labels",
            "f_hyphens", "f_https", "f_lead", "f_suffix_rate", "f_suffix_rows", "f_file_rate", "f_file_rows",
            "f_folder_rate", "f_folder_rows"]


def lexical(pages: DataFrame) -> DataFrame:
    """``pages`` with ``url, host, path, rest`` plus the features that need no statistics, and what these are kept by."""
    url, host, path, rest = (F.coalesce(F.col(c), F.lit("")) for c in ("url", "host", "path", "rest"))
    length = F.char_length(url)
    number = {
        "f_length": length, "f_host": F.char_length(host), "f_path": F.char_length(path),
        "f_depth": F.regexp_count(path, F.lit("/[^/]+")),
        "f_digits": F.regexp_count(url, F.lit("[0-9]")) / F.greatest(length, F.lit(1)),
        "f_entropy": F.when(length > 0, _entropy(url)).otherwise(0.0),
        "f_parameters": F.regexp_count(rest, F.lit("[?&][^?&#=]+")), "f_query": F.char_length(rest),
        "f_labels": F.regexp_count(host, F.lit(r"[^.]+")), "f_hyphens": F.regexp_count(host, F.lit("-")),
        "f_https": url.startswith("https:").cast("int"),
        "f_lead": F.coalesce(F.regexp_extract(path, r"/([0-9])[^/]*/?$", 1).try_cast("int"), F.lit(-1)),
    }
    return pages.withColumns({k: v.cast("double") for k, v in number.items()} | {
        "suffix": F.substring_index(host, ".", -2), "folder": F.regexp_extract(path, "^/([^/]*)/", 1), "file": F.regexp_extract(path, r"\.([A-Za-z0-9]{1,8})$", 1)})


def _statistics(labelled: DataFrame, key: str) -> DataFrame:
    """Per suffix the smoothed block rate and the number of labelled URLs."""
    overall = labelled.agg(F.avg("label")).first()[0] or 0.0
    n, blocked = F.count("*"), F.sum("label")
    return labelled.groupBy(key).agg(((blocked + SMOOTHING * overall) / (n + SMOOTHING)).alias(f"f_{key}_rate"),
                                     F.log1p(n).alias(f"f_{key}_rows"))


def filter_urls(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url",
                train_rows: int = TRAIN_ROWS, learn_from: Column | None = None) -> DataFrame:
    """One row per page: ``id_col, url, host, path, rule, verdict`` and ``score``, the trees' chance of a block.

    Rule rows take the rule's verdict, the others the trees'.  A null url is an
    empty one for the trees.  Without a labelled URL all is allowed; with
    labels of one kind only, that is the trees' verdict.  Repeated rows give
    repeated rows; an empty table gives an empty result; extra columns are
    ignored.  ``learn_from`` (a condition on the columns of ``pages``) keeps the
    labelled URLs of other rows from the trees and their statistics."""
    host, path, rest = split_url(F.col(url_col))
    teaches = F.lit(True) if learn_from is None else F.coalesce(learn_from, F.lit(False))
    parts = pages.select(F.col(id_col), F.col(url_col).alias("url"), host.alias("host"), path.alias("path"), rest.alias("rest"), teaches.alias("teaches"))
    pattern, verdict = match_rule(F.col("host"), F.col("path"), rules)
    parts = parts.withColumns({"rule": pattern, "by_rule": verdict})
    labelled = materialize(
        lexical(parts.filter("by_rule is not null and teaches").dropDuplicates(["url"]))
        .withColumn("label", (F.col("by_rule") == BLOCK).cast("double")), "url_labelled")
    kinds = labelled.agg(F.count("*").alias("n"), F.min("label").alias("low"), F.max("label").alias("high")).first()
    if not kinds["n"] or kinds["low"] == kinds["high"]:
        score = F.lit(float(kinds["high"] or 0.0))
        return _verdicts(parts.withColumn("score", score), id_col)
    stats = {key: materialize(_statistics(labelled, key), f"url_{key}") for key in ("suffix", "file", "folder")}
    share = min(1.0, train_rows / kinds["n"])
    sample = labelled.filter(F.pmod(F.xxhash64("url"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    fit_on = materialize(assembler.transform(_with(sample, stats)).select("label", "features").coalesce(4), "url_sample")
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED, maxMemoryInMB=64).fit(fit_on)
    scored = model.transform(assembler.transform(_with(lexical(parts), stats)))
    return _verdicts(scored.withColumn("score", F.get(vector_to_array("probability"), F.lit(1))), id_col)


def _with(rows: DataFrame, stats: dict[str, DataFrame]) -> DataFrame:
    for key, table in stats.items():
        rows = rows.join(table, key, "left").fillna(0.0, [f"f_{key}_rate", f"f_{key}_rows"])
    return rows


def _verdicts(scored: DataFrame, id_col: str) -> DataFrame:
    by_trees = F.when(F.col("score") > 0.5, F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    return scored.select(id_col, "url", "host", "path", "rule", F.coalesce("by_rule", by_trees).alias("verdict"), "score")
