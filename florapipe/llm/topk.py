"""Exact top-k search by inner product with Fagin's threshold algorithm (operator 12).

Distinct vectors are dealt into blocks of bounded size, and each block keeps a
list per dimension, sorted by that component.  A query reads its lists from the
end that its own component favours, deeper round by round.  What it meets for
the first time is looked up and scored whole.  The sum of its components times
the values last read bounds every vector it has not met: once that bound is
below the query's kth score, the block is done, often before its first row if
an earlier block gave good scores.

Queries come in blocks of a bounded size that are broadcast; the candidates'
lists stay where they are written.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from florapipe.llm.common import spread
from florapipe.llm.vectors import KINDS, kind_of, matrix, vector_length, whole_vectors
from florapipe.session import materialize

#: Distinct vectors in a block of candidates: bytes of components, and vectors at least.
BLOCK_BYTES = 1 << 19
BLOCK_ROWS = 1 << 8
#: Blocks that a task searches one after the other, each with the bounds that those before it gave.
TASK_BLOCKS = 8
#: Bytes of components in a block of queries.
QUERY_BYTES = 1 << 23
#: Queries whose scores give each query its first bound.
SEEDS = 1 << 10
#: The first round reads so many rows of the lists; each later one this much deeper.
FIRST_DEPTH, DEEPER = 8, 1.6


def _pack(table: pa.Table) -> pa.Table:
    """A block as one row: its vectors, the lists of its dimensions, and the rows of each vector.

    A list is the order of the vectors by one component, from the least."""
    x = matrix(table["x"].to_pylist())
    kind = kind_of(int(np.abs(x).max(initial=0)))
    lists = np.argsort(x, axis=0, kind="stable").T.astype(_places(len(x)))
    rows = table["rows"].combine_chunks()
    return pa.table({"length": pa.array([x.shape[1]], pa.int32()), "n": pa.array([len(x)], pa.int32()), "kind": [kind],
                     "x": [x.astype(KINDS[kind]).tobytes()], "lists": [lists.tobytes()],
                     "rows": pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows)})


def _places(n: int) -> np.dtype:
    return np.dtype("<u2" if n <= 1 << 16 else "<i4")


PACKED = ("length int, n int, kind binary, x binary, lists binary, "
          "rows array<array<struct<vec_id: bigint, uid: bigint>>>")


def _exact(x: np.ndarray, q: np.ndarray) -> np.dtype:
    """Doubles where every partial sum of a product is exact in them, else whole numbers; never a sum beyond 64 bits."""
    most = int(np.abs(x).max(initial=0)) * int(np.abs(q).max(initial=0)) * max(1, x.shape[1])
    if most >= 2 ** 63:
        raise OverflowError("an inner product does not fit a whole number of 64 bits")
    return np.dtype(np.float64) if most < 2 ** 53 else np.dtype(np.int64)


def threshold_search(x: np.ndarray, lists: np.ndarray, q: np.ndarray, least: int, k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Vectors of a block that score ``least`` or more and are among its ``k`` best (all that tie with the kth), their
    scores, and how many were looked up.  ``lists`` is dimensions by places."""
    n = len(x)
    used = np.flatnonzero(q)                                  # a list of a zero component adds nothing to any score
    weight = q[used]
    up = weight < 0                                           # these lists are read from the least value
    met = np.zeros(n, bool)
    numbers, scores = np.empty(0, np.int64), np.empty(0, x.dtype)
    if not len(used):                                         # all scores are zero
        return (np.arange(n), np.zeros(n, x.dtype), n) if least <= 0 else (numbers, scores, 0)
    depth, step = 0, FIRST_DEPTH
    while depth < n:
        last = np.where(up, lists[used, depth], lists[used, n - 1 - depth])
        if weight @ x[last, used] < least:                    # the best that a vector not met can score
            break
        upto = min(n, depth + int(step))
        seen = np.concatenate([lists[used[up], depth:upto].ravel(), lists[used[~up], n - upto:n - depth].ravel()])
        fresh = np.zeros(n, bool)
        fresh[seen] = True
        fresh &= ~met
        new = np.flatnonzero(fresh)
        met[new] = True
        found = x[new] @ q
        good = found >= least
        numbers, scores = np.concatenate([numbers, new[good]]), np.concatenate([scores, found[good]])
        if len(scores) > k:
            kth = np.partition(scores, len(scores) - k)[len(scores) - k]
            if kth > least:
                least = kth
                good = scores >= least
                numbers, scores = numbers[good], scores[good]
        depth, step = upto, step * DEEPER
        if met.all():
            break
    return numbers, scores, int(met.sum())


class _Best:
    """The ``k`` best rows of each query so far: score from the highest, then vec_id (null last), then row."""

    def __init__(self, least: np.ndarray, k: int):
        self.k, self.least = k, least.copy()
        self.rows: list[list[tuple]] = [[] for _ in least]

    def add(self, query: int, scores: list[int], rows: list) -> None:
        own = self.rows[query]
        own += [(-s, r["vec_id"] is None, r["vec_id"] or 0, r["uid"]) for s, of in zip(scores, rows) for r in of]
        own.sort()
        del own[self.k:]
        if len(own) == self.k:
            self.least[query] = max(self.least[query], -own[-1][0])


def _search(queries, k: int):
    """A task's best rows for each query of the block, and how many vectors were looked up of those that were there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, bounds = queries.value
        best = _Best(bounds, k)
        looked = there = 0
        for batch in batches:
            for i in range(batch.num_rows):
                length, n, kind, x, lists = (c[i].as_py() for c in batch.columns[:5])
                if length != q.shape[1]:
                    continue
                rows = batch.column(5)[i].values
                x = np.frombuffer(x, KINDS[kind]).reshape(n, length)
                exact = _exact(x, q)
                x, lists = x.astype(exact), np.frombuffer(lists, _places(n)).reshape(length, n)
                for j, row in enumerate(q.astype(exact)):
                    numbers, scores, met = threshold_search(x, lists, row, best.least[j], k)
                    looked, there = looked + met, there + n
                    if len(numbers):
                        best.add(j, [int(s) for s in scores], [rows[int(r)].as_py() for r in numbers])
        found = [(j, -s, None if none else v, uid) for j, own in enumerate(best.rows) for s, none, v, uid in own]
        columns = list(zip(*found, (-1, looked, there, None)))
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query", "score", "vec_id", "uid"])
    return run


def _query_blocks(distinct: DataFrame, query_bytes: int) -> Iterator[list[bytes]]:
    held: list[bytes] = []
    size = 0
    for r in distinct.toLocalIterator():
        x = bytes(r["x"])
        if held and (size + len(x) > query_bytes or r["length"] != length):
            yield held
            held, size = [], 0
        held.append(x)
        size, length = size + len(x), r["length"]
    if held:
        yield held


def _bounds(q: np.ndarray, k: int) -> np.ndarray:
    """For each query a score that ``k`` rows reach: among the queries themselves, which are rows too."""
    seeds = q[:SEEDS]
    if len(seeds) < k:
        return np.full(len(q), np.iinfo(np.int64).min)
    exact = _exact(q, q)
    out, seeds = [], seeds.T.astype(exact)
    for i in range(0, len(q), SEEDS):
        scores = q[i:i + SEEDS].astype(exact) @ seeds
        out.append(np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k])
    return np.concatenate(out).astype(np.int64)


def top_k(embeddings: DataFrame, is_query, k: int = 5, scale: float = 256.0, id_col: str = "vec_id",
          vector_col: str = "embedding", block_bytes: int = BLOCK_BYTES, query_bytes: int = QUERY_BYTES,
          on_block=None) -> DataFrame:
    """The ``k`` highest inner products of ``floor(scale * x)`` of each query: ``query_id, rank, vec_id, score``.

    ``is_query`` is a condition on ``vec_id``.  Candidates of a query are all
    rows but its own; a row repeated is another row, as a query and as a
    candidate.  Vectors that are null or hold a null or non-finite component
    take no part; a null id is no query, and comes last among ties, which go by
    ascending id.  Vectors of different length are no candidates of each other;
    empty ones score zero.  A component or product beyond 64 bits is an error.
    Empty tables give an empty result; extra columns are ignored.  ``on_block``
    gets, per block of queries, how many vectors were looked up of how many."""
    spark = embeddings.sparkSession
    rows = whole_vectors(embeddings, id_col, vector_col, scale)
    rows = materialize(rows.withColumn("uid", F.monotonically_increasing_id()), "topk_rows")
    # of equal vectors only the first k + 1 rows can be among a query's best
    first = Window.partitionBy("x").orderBy(F.col("vec_id").asc_nulls_last(), "uid")
    few = rows.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= k + 1)
    distinct = few.groupBy("x").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "uid"))).alias("rows"))
    distinct = materialize(distinct.select("x", vector_length(F.col("x")).alias("length"), F.transform(
        "rows", lambda r: F.struct(r["vec_id"].alias("vec_id"), r["uid"].alias("uid"))).alias("rows")), "topk_distinct")
    size = distinct.groupBy("length").agg(F.count("*").alias("n"), F.sum(F.octet_length("x")).alias("bytes"))
    # every length has blocks of its own, as many as its bytes ask for
    size = size.select(F.col("length").alias("l"), F.greatest(F.lit(1), F.least(
        F.ceil(F.col("bytes") / block_bytes), F.ceil(F.col("n") / BLOCK_ROWS))).cast("bigint").alias("blocks"))
    blocks = materialize(distinct.join(size, F.col("length") == F.col("l")).withColumn(
        "block", F.pmod(F.xxhash64("x"), F.col("blocks"))).groupBy("length", "block").applyInArrow(_pack, PACKED), "topk_lists")
    tasks = spread(spark, blocks.count(), TASK_BLOCKS)
    asked = materialize(rows.filter(is_query(F.col("vec_id"))).select(F.col("vec_id").alias("query_id"), F.col("uid").alias("own"), "x"),
                        "topk_queries")
    each = asked.groupBy("x").agg(F.count("*").alias("n")).select("x", vector_length(F.col("x")).alias("length"))
    results = []
    for held in _query_blocks(each.orderBy("length", F.xxhash64("x"), "x"), query_bytes):
        q = matrix(held)
        sent = spark.sparkContext.broadcast((q, _bounds(q, k + 1)))       # bounded by the block
        found = blocks.repartition(tasks).mapInArrow(_search(sent, k + 1), "query bigint, score bigint, vec_id bigint, uid bigint")
        found = materialize(found, "topk_found")
        if on_block:
            on_block(found.filter("query = -1").agg(F.sum("score"), F.sum("vec_id")).first())
        best = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "uid")
        found = found.filter("query >= 0").withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k + 1)
        found = found.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("place", "score", "vec_id", "uid"))).alias("best"))
        names = spark.createDataFrame([(i, bytearray(x)) for i, x in enumerate(held)], "query bigint, x binary")
        results.append(materialize(found.join(names, "query").select("x", "best"), "topk_best"))
        sent.unpersist()
    if not results:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    best = results[0]
    for r in results[1:]:
        best = best.unionByName(r)
    own = F.filter("best", lambda b: b["uid"] != F.col("own"))
    return asked.join(best, "x").select("query_id", F.posexplode(F.slice(own, 1, k)).alias("rank", "b")).select(
        "query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("b.vec_id").alias("vec_id"), F.col("b.score").alias("score"))
