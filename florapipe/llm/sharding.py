"""Sharding by balanced label propagation (operator 1), in DataFrame functions only.

Linked documents are those with equal texts.  Every linked document starts on
a shard by hash.  In each round a group sees how many of its documents every
shard holds, and its documents ask to move to where most of them are; a shard
takes in only what its quota and its own leavers leave room for.  A group
larger than a shard's quota aims at as many shards as it needs.  At the end
each shard keeps its quota exactly: linked documents first, group by group,
and single documents fill the rest.

A group is never joined with itself: its pull on a shard is one count, so a
round moves rows in proportion to the linked documents.  A hot group's rows are
dealt out by a salt, of as many values as its size asks for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from florapipe.llm.common import UID, identified
from florapipe.operators.numbering import number_rows
from florapipe.session import materialize

LAW = "rows"
ROUNDS = 8
#: A shard may hold so much more than its quota between rounds.
SLACK = 0.02
#: Documents of a group that are joined under one salt.
SALT_ROWS = 2_000


def _share(key: Column, turn: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(turn)), F.lit(1 << 20)) / F.lit(float(1 << 20))


def _pulls(state: DataFrame, quota: int, full: list[int]) -> DataFrame:
    """Per group that is not whole yet: the shards its documents should move to, and those whose documents stay.

    A group's shards are at most as many as there are shards, so the arrays are bounded."""
    held = state.groupBy("digest", "shard").agg(F.count("*").alias("w"))
    lists = held.groupBy("digest").agg(
        F.sum("w").alias("n"),
        F.reverse(F.array_sort(F.collect_list(F.struct("w", F.xxhash64("digest", "shard").alias("tie"), "shard")))).alias("held"))
    open_ = F.filter("held", lambda x: ~x["shard"].isin(full)) if full else F.col("held")
    wanted = F.ceil(F.col("n") / F.lit(float(max(quota, 1)))).cast("int")
    lists = lists.filter(F.size("held") > wanted).withColumn("targets", F.slice(open_, F.lit(1), wanted))
    last = F.element_at("targets", -1)
    near = F.filter("held", lambda x: (x["w"] > last["w"]) | ((x["w"] == last["w"]) & (x["tie"] >= last["tie"])))
    lists = lists.filter(F.size("targets") > 0).withColumn("near", near)
    return lists.select("digest", "n", F.col("targets.shard").alias("targets"), F.col("near.shard").alias("stay"))


def _round(state: DataFrame, shards: int, quota: int, turn: int) -> tuple[DataFrame, bool]:
    """One round of moves; whether any document asked to move."""
    loads = {r["shard"]: r["n"] for r in state.groupBy("shard").agg(F.count("*").alias("n")).collect()}  # a row per shard
    room = [quota * (1 + SLACK) - loads.get(s, 0) for s in range(shards)]
    pulls = _pulls(state, quota, [s for s in range(shards) if room[s] <= 0])
    salts = F.ceil(F.col("n") / F.lit(float(SALT_ROWS)))
    pulls = pulls.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), salts - 1))).withColumnRenamed("n", "group_n")
    pick = F.element_at("targets", (F.pmod(F.xxhash64(UID), F.size("targets")) + 1).cast("int"))
    asked = materialize(
        state.join(pulls, ["digest", "salt"], "left")
        .withColumn("to", F.when(~F.array_contains("stay", F.col("shard")), pick))
        .drop("targets", "stay", "group_n"), "shard_asks")
    moves = asked.filter("to is not null").groupBy("shard", "to").agg(F.count("*").alias("n")).collect()  # shards squared
    into, out = [0] * shards, [0] * shards
    for m in moves:
        into[m["to"]] += m["n"]
        out[m["shard"]] += m["n"]
    chance = [min(1.0, max(0.0, (room[s] + out[s]) / into[s])) if into[s] else 0.0 for s in range(shards)]
    # a group moves as one while it is small beside the quota, else document by document
    mover = F.when(F.col("group_size") * 8 <= quota, F.xxhash64("digest")).otherwise(F.col(UID))
    accept = _share(mover, turn) < F.element_at(F.array(*[F.lit(c) for c in chance]), F.col("to") + 1)
    return asked.withColumn("shard", F.when(F.col("to").isNotNull() & accept, F.col("to")).otherwise(F.col("shard"))).drop("to"), bool(moves)


def shard(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text",
          rounds: int = ROUNDS) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, group_size, shard, slot``.

    Shard sizes in documents are at most one apart, slots count from 0 without
    a gap.  ``size`` is the text's UTF-8 bytes plus 8.  A null text counts no
    bytes, has CRC 0 and is linked to nothing; empty texts are equal texts.
    Repeated rows are documents of their own; an empty table gives an empty
    result; extra columns are ignored."""
    text = F.col(text_col)
    base = identified(docs, id_col, text_col, (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("bigint").alias("size"),
                      F.coalesce(F.crc32(text.cast("binary")), F.lit(0).cast("bigint")).alias("text_crc32"),
                      F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"), name="shard_docs").drop("text_hash")
    # a written table, so that both sides of the join below are dealt out anew and a hot digest can be split
    groups = materialize(base.filter("digest is not null").groupBy("digest").agg(F.count("*").alias("group_size"))
                         .filter("group_size > 1"), "shard_groups")
    base = materialize(base.join(groups, "digest", "left")
                       .withColumn("group_size", F.coalesce("group_size", F.lit(1).cast("bigint"))), "shard_grouped")
    rows = base.count()
    quota = rows // shards
    salt = F.pmod(F.xxhash64(UID, F.lit(7)), F.ceil(F.col("group_size") / F.lit(float(SALT_ROWS)))).cast("bigint")
    # a group that no shard can hold starts on as many neighbouring shards as it needs, the others anywhere
    parts = F.when(F.col("group_size") > quota, F.ceil(F.col("group_size") / F.lit(float(max(quota, 1))))).otherwise(F.lit(shards))
    first = F.when(F.col("group_size") > quota, F.pmod(F.xxhash64("digest"), F.lit(shards))).otherwise(F.lit(0))
    state = (base.filter("group_size > 1").withColumn("salt", salt)
             .withColumn("shard", F.pmod(first + F.pmod(F.xxhash64(UID), parts), F.lit(shards)).cast("int")))
    for turn in range(rounds):
        state, moved = _round(state, shards, quota, turn)
        if not moved:
            break
    return _settle(state.drop("salt"), base.filter("group_size = 1"), shards, rows)


def _settle(linked: DataFrame, single: DataFrame, shards: int, rows: int) -> DataFrame:
    """Exact quotas: each shard keeps its first linked documents, the others and the single ones fill what is left."""
    quota = [rows // shards + (s < rows % shards) for s in range(shards)]
    columns = ["doc_id", "size", "text_crc32", "group_size"]
    placed = materialize(number_rows(linked, ["shard", "digest", UID], "at", "shard_linked"), "shard_placed")
    loads = {r["shard"]: r["n"] for r in placed.groupBy("shard").agg(F.count("*").alias("n")).collect()}  # a row per shard
    starts, kept, gaps = [], [], []
    for s in range(shards):
        starts.append(sum(loads.get(t, 0) for t in range(s)))
        kept.append(min(loads.get(s, 0), quota[s]))
        gaps.append(sum(quota[t] - kept[t] for t in range(s)))

    def of(values: list[int], s: Column) -> Column:
        return F.element_at(F.array(*[F.lit(v).cast("bigint") for v in values]), s + 1)

    slot = F.col("at") - of(starts, F.col("shard"))
    stay = placed.withColumn("slot", slot).filter(F.col("slot") < of(kept, F.col("shard")))
    over = placed.filter(slot >= of(kept, F.col("shard"))).select(*columns, "digest", UID)
    over = number_rows(over, ["digest", UID], "i", "shard_over")
    spare = sum(loads.values()) - sum(kept)
    rest = number_rows(single.select(*columns, "digest", UID), None, "i", "shard_single").withColumn("i", F.col("i") + spare)
    # the last shard whose gap begins at or before i; shards without a gap begin where the next one does
    to = F.size(F.filter(F.array(*[F.lit(g).cast("bigint") for g in gaps]), lambda g: g <= F.col("i"))) - 1
    filled = over.unionByName(rest).withColumn("shard", to).withColumn(
        "slot", F.col("i") - of(gaps, F.col("shard")) + of(kept, F.col("shard")))
    return stay.select(*columns, "shard", "slot").unionByName(filled.select(*columns, "shard", "slot"))
