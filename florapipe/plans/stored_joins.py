"""Joins with tables that many runs share (J7, S9, J9): ``orders`` plays the
listing, its finished and part-finished orders a sink written in two batches,
``customer`` the stored parent with its ids, orders per customer an enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from florapipe.operators.enumeration import exclude_processed
from florapipe.plans.registry import query
from florapipe.session import scratch_path
from florapipe.sources import bucketed, store
from florapipe.sources.tables import table


def stored_tables(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sink (by listed id), parent and enrichment (by entity); the sink's second batch broke off once and was written again."""
    orders = table(spark, d, "orders")
    sink, parent, counts = (scratch_path(spark, n) for n in ("stored_sink", "stored_parent", "stored_counts"))

    def done(status):
        return orders.filter(F.col("o_orderstatus") == status).select("o_orderkey")
    bucketed.write_batch(done("F"), sink, ["o_orderkey"], "first", buckets=16)
    for part in (done("P").filter(F.col("o_orderkey") % 2 == 0), done("P")):
        bucketed.write_batch(part, sink, ["o_orderkey"], "second")
    ids = table(spark, d, "customer").select(F.col("c_custkey").alias("key"), (F.col("c_custkey") + 1_000_000).alias("id"))
    bucketed.write_batch(ids, parent, ["key"], "all", buckets=16)
    placed = orders.groupBy(F.col("o_custkey").alias("key")).agg(F.count(F.lit(1)).alias("n_orders"))
    bucketed.write_batch(placed, counts, ["key"], "all", buckets=16)
    return tuple(bucketed.read(spark, p).drop(bucketed.BATCH) for p in (sink, parent, counts))


def stored_joins(listed: DataFrame, sink: DataFrame, parent: DataFrame, counts: DataFrame) -> DataFrame:
    """Not yet processed (anti-join with the sink), ids of the parent, enrichment: only the listing is exchanged, once per key."""
    left = exclude_processed(listed, sink, "o_orderkey")
    return store.lookup_ids(left, parent, ["key"]).join(counts, "key", "left")


def listed_orders(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("key"), "o_totalprice")


@query("stored_joins", """
SELECT o_orderkey, o_custkey AS key, o_totalprice, c_custkey + 1000000 AS id, n_orders
FROM orders JOIN customer ON o_custkey = c_custkey
LEFT JOIN (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY 1) USING (o_custkey)
WHERE o_orderstatus NOT IN ('F', 'P')
""")
def q_stored_joins(spark, d):
    return stored_joins(listed_orders(spark, d), *stored_tables(spark, d))
