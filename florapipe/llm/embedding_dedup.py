"""Near-duplicate embeddings by an epsilon grid order join (operator 10).

Vectors become unit vectors, for which a cosine of at least ``t`` is a distance
of at most ``eps = sqrt(2 - 2t)``.  They are sorted by the cells of a grid of
width ``eps`` on their leading principal dimensions and cut into intervals.
Interval is joined with interval recursively, whole intervals first: halves
whose boxes are more than ``eps`` apart are provably without a link and are
skipped.  A box spans the leading dimensions and the norm of the rest, which
bound a cosine too: ``<x,y> <= <Px,Py> + |Rx||Ry|``.  Of two small parts only the
vectors that pass this bound with some vector of the other part are compared
whole, in double precision.

The first levels are joins of small tables of boxes, one row per interval.  The
last ones run within tasks: sequences of intervals, of bounded size, make a
tile, and a task gets two tiles' intervals that are near some of the other's.
An interval moves once per tile it has a near interval in, in the width its
components came in.

Equal vectors are one representative with a weight, and a pair of intervals
gives counts per vector and a spanning forest instead of its links, so a dense
group moves rows in proportion to its members.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from florapipe.llm.common import spread
from florapipe.llm.components import connected_components
from florapipe.operators.numbering import running_sums
from florapipe.session import materialize

#: Bounded sample of distinct vectors, in number and bytes, that the principal dimensions are taken from; links do
#: not depend on it.
FIT_ROWS = 2_000
FIT_BYTES = 1 << 25
#: Leading dimensions of the grid, and those of the boxes and bounds.
GRID_DIMS = 8
BOUND_DIMS = 16
#: Bytes of vectors in an interval and in a tile, and vectors in the smallest part of an interval.
INTERVAL_BYTES = 1 << 19
TILE_BYTES = 1 << 23
LEAF = 512
#: Single pairs are compared where the bound leaves fewer than one in so many.
FEW = 16
#: Bytes of distinct vectors that a task holds to count copies of, before it passes them on.
HELD_BYTES = 1 << 25
#: Groups of intervals that the join of boxes begins with.
TOP = 32
#: Intervals of different vector lengths are this far apart.
APART = 10.0
SLACK = 1e-9


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as bytes, in single precision where that is exact, with a digest; null where there is nothing to compare."""
    for batch in batches:
        column = batch.column(1)
        ends = np.asarray(column.offsets, np.int64)
        v = column.values.slice(ends[0], ends[-1] - ends[0]).to_numpy(zero_copy_only=False).astype(np.float64) + 0.0
        ends = ends - ends[0]
        with np.errstate(over="ignore", invalid="ignore"):
            single = v.astype(np.float32)
            wide = np.concatenate([[0], np.cumsum(single != v)])
        bad = np.concatenate([[0], np.cumsum(~np.isfinite(v))])
        some = np.concatenate([[0], np.cumsum(v != 0.0)])
        digests, raws = [], []
        for null, s, e in zip(np.asarray(column.is_null()).tolist(), ends[:-1].tolist(), ends[1:].tolist()):
            if null or bad[e] > bad[s] or some[e] == some[s]:
                digests.append(None)
                raws.append(None)
                continue
            digests.append(hashlib.blake2b(v[s:e].tobytes(), digest_size=16).digest())
            raws.append(b"f" + single[s:e].tobytes() if wide[e] == wide[s] else b"d" + v[s:e].tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.binary()), pa.array(raws, pa.binary())],
                                         ["vec_id", "digest", "v"])


def _units(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors as rows, filled with zeros to the longest, and their lengths."""
    rows = [np.frombuffer(r, np.float32 if r[:1] == b"f" else np.float64, offset=1) for r in raws]
    lengths = np.array([len(r) for r in rows], np.int64)
    x = np.zeros((len(rows), int(lengths.max(initial=0))))
    for i, r in enumerate(rows):
        x[i, :len(r)] = r
    if len(rows):
        x /= np.abs(x).max(axis=1, keepdims=True)              # no overflow or underflow in the squares
        x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x, lengths


def principal_dimensions(sample: list[bytes], dims: int) -> np.ndarray:
    """Orthonormal columns: the leading principal dimensions of the sample."""
    x, _ = _units(sample)
    _, axes = np.linalg.eigh(x.T @ x)
    return axes[:, ::-1][:, :dims]


def _places(x: np.ndarray, lengths: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Leading dimensions, the norm of the rest, and a place for the length.  Components beyond the axes are part of the rest."""
    width = min(x.shape[1], axes.shape[0])
    lead = x[:, :width] @ axes[:width]
    rest = np.sqrt(np.maximum(0.0, 1.0 - (lead * lead).sum(axis=1)))
    return np.column_stack([lead, rest, APART * lengths])


def _grid(axes: np.ndarray, eps: float, held_bytes: int):
    """A task's distinct vectors with their cells, rows and least id; emitted whenever ``held_bytes`` are held."""
    def emit(held: dict[bytes, list]) -> pa.RecordBatch:
        n, rep, raws = zip(*held.values())
        x, lengths = _units(list(raws))
        cells = np.floor(_places(x, lengths, axes)[:, :GRID_DIMS] / eps).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [pa.array(lengths, pa.int32()), pa.array(list(cells), pa.list_(pa.int32())), pa.array(list(held), pa.binary()),
             pa.array(n, pa.int64()), pa.array(rep, pa.int64()), pa.array(raws, pa.binary())],
            ["length", "cells", "digest", "n", "rep_id", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list] = {}
        size = 0
        for batch in batches:
            for vec_id, digest, v in zip(*(batch.column(i).to_pylist() for i in range(3))):
                old = held.get(digest)
                if old is None:
                    held[digest] = [1, vec_id, v]
                    size += len(v)
                    if size >= held_bytes:
                        yield emit(held)
                        held, size = {}, 0
                else:
                    old[0] += 1
                    old[1] = vec_id if old[1] is None else old[1] if vec_id is None else min(old[1], vec_id)
        if held:
            yield emit(held)
    return run


GRID = "length int, cells array<int>, digest binary, n bigint, rep_id bigint, v binary"


def _pack(axes: np.ndarray, interval_bytes: int):
    """Sorted rows as intervals, one row each: copies of a vector, which are neighbours, become one."""
    def emit(rows: list[list]) -> pa.RecordBatch:
        digest, n, rep, raws = map(list, zip(*rows))
        x, lengths = _units(raws)
        places = _places(x, lengths, axes)
        return pa.RecordBatch.from_arrays(
            [pa.array([len(rows)], pa.int64()), pa.array([sum(map(len, raws))], pa.int64()), pa.array([digest], pa.list_(pa.binary())),
             pa.array([rep], pa.list_(pa.int64())), pa.array([n], pa.list_(pa.int64())), pa.array([raws], pa.list_(pa.binary())),
             pa.array([places.min(axis=0).tolist()]), pa.array([places.max(axis=0).tolist()])],
            ["n_rows", "bytes", "digests", "reps", "weights", "v", "low", "high"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[list] = []
        size = 0
        for batch in batches:
            for digest, n, rep, v in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if rows and rows[-1][0] == digest:
                    last = rows[-1]
                    last[1] += n
                    last[2] = rep if last[2] is None else last[2] if rep is None else min(last[2], rep)
                    continue
                if size + len(v) > interval_bytes and rows:
                    yield emit(rows)
                    rows, size = [], 0
                rows.append([digest, n, rep, v])
                size += len(v)
        if rows:
            yield emit(rows)
    return run


PACKED = ("n_rows bigint, bytes bigint, digests array<binary>, reps array<bigint>, weights array<bigint>, v array<binary>, "
          "low array<double>, high array<double>")


class _Interval:
    def __init__(self, block: int, first: int, raws: list[bytes], weights: list[int], axes: np.ndarray):
        self.block, self.weights = block, np.array(weights, np.float64)
        self.x, self.lengths = _units(raws)
        self.places = _places(self.x, self.lengths, axes)
        self.bound = self.places[:, :-1]
        self.ids = np.arange(first, first + len(raws))
        self.links = np.zeros(len(raws))


def _gap(a: np.ndarray, b: np.ndarray) -> float:
    """Squared distance of the boxes of two sets of places."""
    d = np.maximum(0.0, np.maximum(a.min(axis=0) - b.max(axis=0), b.min(axis=0) - a.max(axis=0)))
    return float(d @ d)


def _compare(a: _Interval, b: _Interval, rows: slice, cols: slice, threshold: float, edges: list) -> int:
    """All pairs of two leaves that the bound leaves, in double precision; how many that were."""
    near = a.bound[rows] @ b.bound[cols].T >= threshold - SLACK
    i, j = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
    if not len(i):
        return 0
    near = near[np.ix_(i, j)]
    i, j = rows.start + i, cols.start + j
    width = min(a.x.shape[1], b.x.shape[1])
    compared = int(near.sum())
    if compared * FEW < near.size:
        k, m = np.nonzero(near)
        linked = np.zeros(near.shape, bool)
        linked[k, m] = np.einsum("ij,ij->i", a.x[i[k], :width], b.x[j[m], :width]) >= threshold
    else:                                                      # whole rows by whole rows is faster than many single pairs
        compared = near.size
        linked = a.x[i, :width] @ b.x[j, :width].T >= threshold
    linked &= a.lengths[i][:, None] == b.lengths[j][None, :]
    itself = a is b and rows == cols
    if itself:                                                 # its bounds are symmetric, so ``i`` and ``j`` are the same rows
        np.fill_diagonal(linked, False)
    if not linked.any():
        return compared
    a.links[i] += linked @ b.weights[j]
    if not itself:
        b.links[j] += a.weights[i] @ linked
    k, m = np.flatnonzero(linked.any(axis=1)), np.flatnonzero(linked.any(axis=0))
    linked = linked[np.ix_(k, m)]
    mine, others = a.ids[i][k], b.ids[j][m]
    one, two = mine, others
    while True:     # least id by links, back and forth, until nothing changes
        down = np.minimum(two, np.where(linked, one[:, None], np.iinfo(np.int64).max).min(axis=0))
        up = np.minimum(one, np.where(linked, down[None, :], np.iinfo(np.int64).max).min(axis=1))
        if (down == two).all() and (up == one).all():
            break
        one, two = up, down
    edges.append(np.column_stack([np.concatenate([one, two]), np.concatenate([mine, others])]))
    return compared


def _halves(s: slice) -> list[slice]:
    n = s.stop - s.start
    return [s] if n <= LEAF else [slice(s.start, s.start + n // 2), slice(s.start + n // 2, s.stop)]


def _join(axes: np.ndarray, eps: float, threshold: float):
    """Join the intervals of two tiles recursively: counts of links ``(vertex, -1, n)``, edges ``(a, b, 0)``, and how many
    pairs of vectors there were and how many were compared ``(-1, all, compared)``."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        one, two = (k.as_py() for k in key)
        intervals = [(r["tile"], _Interval(r["block"], r["first"], r["v"], r["weights"], axes)) for r in table.to_pylist()]
        edges: list[np.ndarray] = []
        compared = pairs = 0
        for a in (i for tile, i in intervals if tile == one):
            for b in (i for tile, i in intervals if tile == two and (one != two or i.block >= a.block)):
                todo = [(slice(0, len(a.ids)), slice(0, len(b.ids)))]
                pairs += len(a.ids) * len(b.ids)
                while todo:
                    rows, cols = todo.pop()
                    if _gap(a.places[rows], b.places[cols]) > eps * eps:
                        continue
                    halves, others = _halves(rows), _halves(cols)
                    if len(halves) == len(others) == 1:
                        compared += _compare(a, b, rows, cols, threshold, edges)
                    else:
                        todo += [(r, c) for r in halves for c in others if a is not b or r.start <= c.start]
        out = [np.array([[-1, pairs, compared]])]
        for _, x in intervals:
            some = np.flatnonzero(x.links)
            out.append(np.column_stack([x.ids[some], np.full(len(some), -1), x.links[some].astype(np.int64)]))
        if edges:
            found = np.unique(np.concatenate(edges), axis=0)
            found = found[found[:, 0] != found[:, 1]]
            out.append(np.column_stack([found, np.zeros(len(found), np.int64)]))
        a, b, n = np.concatenate(out).T
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "n": pa.array(n, pa.int64())})
    return run


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The vectors of intervals, one row each."""
    for batch in batches:
        for first, digests, reps, weights in zip(*(batch.column(i).to_pylist() for i in range(4))):
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(first, first + len(digests)), pa.int64()), pa.array(digests, pa.binary()), pa.array(reps, pa.int64()),
                 pa.array(weights, pa.int64())], ["pos", "digest", "rep_id", "n"])


def _near_boxes(boxes: DataFrame, blocks: int, eps: float) -> DataFrame:
    """Pairs ``(a, b)``, a <= b, of intervals whose boxes are within ``eps``: from a few groups of them down by halves."""
    spark, width = boxes.sparkSession, BOUND_DIMS + 2
    levels = max(0, math.ceil(math.log2(blocks / TOP))) if blocks else 0
    top = -(-blocks // (1 << levels))
    pairs = spark.range(top).select(F.col("id").alias("a"), F.explode(F.sequence("id", F.lit(top - 1).cast("bigint"))).alias("b"))
    for level in range(levels + 1):
        shift = levels - level
        box = boxes.groupBy(F.shiftright("block", shift).alias("at")).agg(
            *[F.min(F.get("low", F.lit(i))).alias(f"l{i}") for i in range(width)],
            *[F.max(F.get("high", F.lit(i))).alias(f"h{i}") for i in range(width)])
        low = F.array(*[f"l{i}" for i in range(width)])
        high = F.array(*[f"h{i}" for i in range(width)])
        one = box.select(F.col("at").alias("a"), low.alias("la"), high.alias("ha"))
        two = box.select(F.col("at").alias("b"), low.alias("lb"), high.alias("hb"))
        if level:
            pairs = pairs.select(F.explode(F.array(F.col("a") * 2, F.col("a") * 2 + 1)).alias("a"), "b").select(
                "a", F.explode(F.array(F.col("b") * 2, F.col("b") * 2 + 1)).alias("b")).filter("a <= b")
        far = F.zip_with(F.zip_with("la", "hb", lambda x, y: x - y), F.zip_with("lb", "ha", lambda x, y: x - y),
                         lambda x, y: F.greatest(x, y, F.lit(0.0)))
        gap = F.aggregate(far, F.lit(0.0), lambda s, x: s + F.coalesce(x * x, F.lit(0.0)))
        pairs = materialize(pairs.join(one, "a").join(two, "b").filter(gap <= eps * eps).select("a", "b"), "ego_pairs")
    return pairs


def embedding_groups(embeddings: DataFrame, threshold: float = 0.95, id_col: str = "vec_id",
                     vector_col: str = "embedding", interval_bytes: int = INTERVAL_BYTES, tile_bytes: int = TILE_BYTES,
                     on_join: Callable[[int, int], None] | None = None) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    Vectors that are null, empty or zero or hold a null or non-finite component
    link with nothing, and vectors of different length do not link.  Rows with
    equal vectors, also rows repeated with one id, are vectors that link with
    each other.  ``component_id`` is the smallest id reachable, null ids last.
    An empty table gives an empty result; extra columns are ignored.  ``on_join``
    gets the pairs of distinct vectors in near intervals and those compared whole."""
    spark, eps = embeddings.sparkSession, math.sqrt(2.0 - 2.0 * threshold) + SLACK
    keyed = materialize(embeddings.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>"))
                        .mapInArrow(_vectors, "vec_id bigint, digest binary, v binary"), "ego_vectors")
    vectors = keyed.filter("digest is not null")
    size = vectors.agg(F.count("*").alias("n"), F.max(F.octet_length("v")).alias("bytes")).first()
    fit_rows = max(BOUND_DIMS, min(FIT_ROWS, FIT_BYTES // max(size["bytes"] or 8, 8)))
    share = min(1.0, fit_rows / max(size["n"], 1))
    sample = vectors.filter(F.pmod(F.xxhash64("digest"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))).select("digest", "v").distinct()
    axes = principal_dimensions([r["v"] for r in sample.select("v").limit(2 * fit_rows).collect()], BOUND_DIMS)
    if axes.shape[1] < BOUND_DIMS:
        axes = np.pad(axes, ((0, 0), (0, BOUND_DIMS - axes.shape[1])))
    order = ["length", "cells", "digest"]
    each = max(LEAF, interval_bytes // max(size["bytes"] or 8, 8))
    in_order = vectors.mapInArrow(_grid(axes, eps, HELD_BYTES), GRID).repartitionByRange(
        spread(spark, size["n"], each), *order).sortWithinPartitions(*order)
    packed = in_order.select("digest", "n", "rep_id", "v").mapInArrow(_pack(axes, interval_bytes), PACKED)
    packed = materialize(packed.withColumn("at", F.monotonically_increasing_id()), "ego_packed")
    # one row per interval: its number, and those of the vectors and bytes before it
    places = running_sums(packed.select("at", "n_rows", "bytes", F.lit(1).alias("one"), "low", "high"), ["at"], ["n_rows", "bytes", "one"])
    places = materialize(places.select("at", (F.col("cum_one") - 1).cast("bigint").alias("block"), (F.col("cum_n_rows") - F.col("n_rows")).alias("first"),
                                       F.floor((F.col("cum_bytes") - F.col("bytes")) / tile_bytes).alias("tile"), "low", "high"), "ego_places")
    pairs = _near_boxes(places.select("block", "low", "high"), places.count(), eps)
    tile = places.select("block", "tile")
    tiles = (pairs.join(tile.withColumnsRenamed({"block": "a", "tile": "one"}), "a").join(tile.withColumnsRenamed({"block": "b", "tile": "two"}), "b"))
    sides = tiles.select("one", "two", F.explode(F.array("a", "b")).alias("block")).distinct().join(places.select("at", "block", "first", "tile"), "block")
    sides = materialize(sides, "ego_sides")
    joined = packed.select("at", "v", "weights").join(sides, "at").select("one", "two", "tile", "block", "first", "v", "weights")
    found = materialize(joined.groupBy("one", "two").applyInArrow(_join(axes, eps, threshold), "a bigint, b bigint, n bigint"), "ego_links")
    if on_join:
        on_join(*found.filter("a < 0").agg(F.sum("b"), F.sum("n")).first())
    counts = found.filter("a >= 0 and b < 0").groupBy(F.col("a").alias("pos")).agg(F.sum("n").alias("others"))
    members = connected_components(found.filter("a >= 0 and b >= 0").select("a", "b"))
    placed = packed.select("at", "digests", "reps", "weights").join(places.select("at", "first"), "at")
    placed = placed.select("first", "digests", "reps", "weights").mapInArrow(_members, "pos bigint, digest binary, rep_id bigint, n bigint")
    reps = (placed.join(counts, "pos", "left").join(members.withColumnRenamed("vertex", "pos"), "pos", "left")
            .withColumn("component", F.coalesce("component", "pos")))
    reps = materialize(reps, "ego_reps")
    least = materialize(reps.groupBy("component").agg(F.min("rep_id").alias("component_id")), "ego_components")
    reps = reps.join(least, "component").select(
        "digest", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id")
    out = keyed.select("vec_id", "digest").join(reps, "digest", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
        F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
