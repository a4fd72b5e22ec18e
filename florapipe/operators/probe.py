"""Per-order probe report and its summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from florapipe.operators.responses import asked, one_response


def order_probe_report(orders: DataFrame, species: DataFrame, clades: DataFrame | None = None,
                       order_key: str = "order_key", pos: str = "pos", name: str = "name",
                       family: str = "family", limit: int = 5, n_samples: int = 3,
                       answers: DataFrame | None = None, taxa: DataFrame | None = None) -> DataFrame:
    """One row per probed order -- total species available, rows a probe
    of ``limit`` retrieves, the first ``n_samples`` names and families
    ("Unknown" where one is missing) and, with ``taxa`` (name, inat_id), the
    taxon id found for each sample ("" where none is), the clade check, and
    ``status``: success, No results, and with ``answers`` (order_key,
    http_status) "Network failure" for an order whose listing did not come
    (no status) or "error:<status>" for one that was refused.

    The per-order sample is a ``row_number() <= n`` filter (a partial
    WindowGroupLimit), the counts a partial aggregate."""
    unknown = F.lit("Unknown")
    failed = F.lit(None).cast("string")
    if answers is not None:
        a = one_response(asked(answers, F.col(order_key).alias("_ak"), "http_status"), ["_ak"])
        orders_in = orders.columns
        orders = orders.join(a, F.col(order_key) == F.col("_ak"), "left")
        species = species.join(a.filter(F.col("http_status") == 200).select(F.col("_ak").alias(order_key)), order_key, "left_semi")
        failed = (F.when(F.col("http_status").isNull(), F.lit("Network failure"))
                  .when(F.col("http_status") != 200, F.concat(F.lit("error:"), F.col("http_status").cast("string"))))
    else:
        orders_in = orders.columns
    counts = species.groupBy(order_key).agg(F.count(F.lit(1)).alias("total_available"))
    w = Window.partitionBy(order_key).orderBy(pos)
    firsts = (species.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n_samples)
              .select(order_key, "_rn", F.col(name).alias("n"), F.col(family).alias("f")))
    if taxa is not None:
        t = taxa.groupBy(F.col("name").alias("n")).agg(F.min("inat_id").alias("t"))
        firsts = firsts.join(t, "n", "left")
    else:
        firsts = firsts.withColumn("t", F.lit(None).cast("bigint"))
    firsts = firsts.groupBy(order_key).agg(F.array_sort(F.collect_list(F.struct("_rn", "n", "f", "t"))).alias("_s"))
    out = (orders.join(counts, order_key, "left").join(firsts, order_key, "left")
           .withColumn("total_available", F.coalesce("total_available", F.lit(0)).cast("bigint")))
    if clades is not None:
        out = out.join(clades.select(order_key, "is_angiosperm"), order_key, "left")
    else:
        out = out.withColumn("is_angiosperm", F.lit(None).cast("boolean"))
    taxon_ids = [] if taxa is None else [F.coalesce(F.array_join(F.transform(
        "_s", lambda s: F.coalesce(s["t"].cast("string"), F.lit(""))), "|"), F.lit("")).alias("sample_taxa")]
    return out.select(
        *orders_in, "is_angiosperm", "total_available",
        F.least(F.col("total_available"), F.lit(limit)).cast("bigint").alias("retrieved"),
        F.coalesce(F.array_join(F.transform("_s", lambda s: F.coalesce(s["n"], unknown)), "|"), F.lit("")).alias("sample_names"),
        F.coalesce(F.array_join(F.transform("_s", lambda s: F.coalesce(s["f"], unknown)), "|"), F.lit("")).alias("sample_families"),
        *taxon_ids,
        F.coalesce(failed, F.when(F.col("total_available") > 0, F.lit("success")).otherwise(F.lit("No results"))).alias("status"))


def probe_summary(report: DataFrame, samples: DataFrame, order_pos: str = "order_pos",
                  sample_pos: str = "sample_pos", family: str = "family", top: int = 5) -> DataFrame:
    """Successful and failed probes, species available over successful
    probes, distinct sample families, the ``top`` families by sample count
    (ties: first seen), verified angiosperm orders -- one row."""
    ok = F.col("status") == "success"
    head = report.agg(
        F.count_if(ok).alias("n_success"), F.count_if(~ok).alias("n_failed"),
        F.coalesce(F.sum(F.when(ok, F.col("total_available"))), F.lit(0)).cast("bigint").alias("total_available"),
        F.count_if(ok & F.coalesce(F.col("is_angiosperm"), F.lit(False))).alias("n_angiosperm"))
    fam = (samples.filter(F.col(family).isNotNull() & (F.col(family) != ""))
           .groupBy(family).agg(F.count(F.lit(1)).alias("n"),
                                F.min(F.struct(order_pos, sample_pos)).alias("first")))
    # the top families alone leave their tasks (TakeOrdered)
    best = fam.orderBy(F.desc("n"), "first").limit(top).select((-F.col("n")).alias("o"), "first", F.col(family).alias("f"))
    names = best.agg(F.coalesce(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o", "first", "f"))),
                                                         lambda s: s["f"]), "|"), F.lit("")).alias("top_families"))
    # two single-row aggregates side by side: the family figures are scalar subqueries
    return head.select("*", fam.agg(F.count(F.lit(1)).alias("n")).scalar().alias("n_families"),
                       names.scalar().alias("top_families"))
