"""Mixing sources to target weights (operator 2).

Words are summed per source, the targets are shares of all words by the
sources' weights, and target over size is a source's repetition rate.  A
document is emitted ``floor(rate)`` times and once more if its hash, seeded,
falls under the fraction: a Bernoulli copy that any rerun repeats.  Of a few
seeds each source takes the one whose copies come nearest to its target, which
one more sum per seed decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from florapipe.operators.numbering import number_rows
from florapipe.session import materialize

#: Weights by source in code point order, repeating; no target above so many times its source.
WEIGHTS = (1, 2, 3)
MOST = 3
#: Draws to choose from per source; a hash gives as many numbers as it has 32 bits.
SEEDS = 64
PER_HASH = 4


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in the text; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def _hash(key: Column, block: Column) -> Column:
    return F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("null")), F.lit(":"), block.cast("string")).cast("binary"))


def _chance(digest: Column, place: Column) -> Column:
    """A number in [0, 1) from the 32 bits of the digest that begin at ``place`` of ``PER_HASH``."""
    return F.conv(F.substring(digest, place * 8 + 1, F.lit(8)), 16, 10).cast("double") / F.lit(float(1 << 32))


def _targets(sources: DataFrame, most: int) -> DataFrame:
    """``target`` of each source of ``(source, source_size, weight)``: all words shared by weight, none above
    ``most`` times its size; what is over is shared again until none is above."""
    level, last = 0.0, -1
    while True:   # each turn fixes at least one more source at its limit; two sums leave Spark per turn
        limit = F.col("source_size") * float(most)
        over = F.lit(level) * F.col("weight") > limit
        row = sources.agg(F.sum("source_size").alias("total"),
                          F.sum(F.when(over, F.col("source_size"))).alias("fixed"),
                          F.sum(F.when(~over, F.col("weight"))).alias("weights"),
                          F.count(F.when(over, 1)).alias("n")).first()
        if row["n"] == last or not row["weights"]:
            return sources.withColumn("target", F.when(over, limit).otherwise(F.lit(level) * F.col("weight")))
        last = row["n"]
        level = float(row["total"] - most * (row["fixed"] or 0)) / row["weights"]


def plan_mix(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seeds: int = SEEDS) -> DataFrame:
    """One row per source of ``sized (doc_id, source, size)``: ``source, source_size, target, whole, fraction, seed``.

    A null source is a source of its own, the last one.  A source without any
    word has target 0 and rate 0."""
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = [F.col("source").isNull(), F.col("source")]
    by_place = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    sources = materialize(number_rows(sources, order, "place", "mix_sources").withColumn("weight", by_place), "mix_weights")
    rate = F.least(F.try_divide("target", "source_size"), F.lit(float(most)))
    rates = (_targets(sources, most).withColumn("rate", F.coalesce(rate, F.lit(0.0)))
             .withColumn("whole", F.floor("rate")).withColumn("fraction", F.col("rate") - F.col("whole")))
    rates = materialize(rates.select("source", "source_size", "target", "whole", "fraction"), "mix_rates")
    drawn = sized.join(rates.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
    blocks = -(-seeds // PER_HASH)
    drawn = drawn.select("source", "size", "fraction", *[_hash(F.col("doc_id"), F.lit(b)).alias(f"h{b}") for b in range(blocks)])
    sums = drawn.groupBy("source").agg(*[
        F.sum(F.when(_chance(F.col(f"h{j // PER_HASH}"), F.lit(j % PER_HASH)) < F.col("fraction"), F.col("size")).otherwise(0)).alias(f"s{j}")
        for j in range(seeds)]).withColumnRenamed("source", "s")
    misses = F.array(*[F.abs(F.col(f"s{j}") - F.col("fraction") * F.col("source_size")) for j in range(seeds)])
    seed = F.array_position(misses, F.array_min(misses)) - 1
    return materialize(rates.join(sums, F.col("source").eqNullSafe(F.col("s")))
                       .select("source", "source_size", "target", "whole", "fraction", seed.alias("seed")), "mix_plan")


def _copies(doc_id: Column) -> Column:
    drawn = _chance(_hash(doc_id, F.floor(F.col("seed") / PER_HASH)), F.pmod(F.col("seed"), F.lit(PER_HASH)).cast("int"))
    return F.col("whole") + (drawn < F.col("fraction")).cast("bigint")


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    return materialize(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                                   word_count(F.col(text_col)).alias("size")), "mix_sizes")


def mix_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seeds: int = SEEDS) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, copies``; ``copies`` is 0 for one left out.

    Null texts have size 0.  Rows with one id and source are drawn alike, a
    null id like the word null.  An empty table gives an empty result; extra
    columns are ignored."""
    sized = _sized(docs, id_col, text_col, source_col)
    plan = plan_mix(sized, weights, most, seeds).withColumnRenamed("source", "s")
    return sized.join(plan, F.col("source").eqNullSafe(F.col("s"))).select(
        "doc_id", "size", "source_size", "target", _copies(F.col("doc_id")).alias("copies"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seeds: int = SEEDS) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with all their columns (the rules of ``mix_counts``)."""
    plan = plan_mix(_sized(docs, id_col, text_col, source_col), weights, most, seeds)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    taken = rows.join(plan, F.col(f"row.{source_col}").eqNullSafe(F.col("source")))
    copies = _copies(F.col(f"row.{id_col}")).cast("int")
    return taken.select("row", F.explode(F.array_repeat(F.lit(0), copies))).select("row.*")
