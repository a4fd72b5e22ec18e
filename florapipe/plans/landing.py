"""What the landed tables of the bindings have in common."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from florapipe.operators.responses import LANDED_AT


def capitalized(c: str) -> Column:
    return F.concat(F.upper(F.substring(c, 1, 1)), F.substring(c, 2, 1 << 30))


def with_repeats(responses: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A landing log: beside every other key's response a later request that failed (no status), and before every other
    answer an older one without its contents: an operator must read one response per key from it, the latest answer."""
    def emptied(rows: DataFrame, **said) -> DataFrame:
        return rows.select(*[F.col(c) if c in keys else said.get(c, F.lit(None)).cast(responses.schema[c].dataType).alias(c)
                             for c in responses.columns])
    choice = F.xxhash64(*keys)
    failed = emptied(responses.filter(F.pmod(choice, F.lit(2)) == 0))
    older = emptied(responses.filter((F.pmod(choice, F.lit(4)) < 2) & (F.col("http_status") == 200)), http_status=F.lit(200))
    return (responses.withColumn(LANDED_AT, F.lit(2)).unionByName(failed.withColumn(LANDED_AT, F.lit(3)))
            .unionByName(older.withColumn(LANDED_AT, F.lit(1))))
