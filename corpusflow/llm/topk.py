"""Exact top-k by inner product: ball trees per block, branch and bound.

Vectors are dealt to the nearest of a bounded set of pivots; a pivot's cell is
a ball (pivot, largest distance) and is cut by hash into blocks of bounded
size. A block is searched through a ball tree: the node with the largest upper
bound <q, centre> + |q| * radius comes first, and a node is dropped, with all
below it, for the queries whose current k-th score its bound does not reach.
The k-th score is shared: a first round searches one block per query, in the
cell of the best bound, and every later block starts with the score found
there. Cells that cannot reach it are never sent the query.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusflow.plans.strategy import materialize

#: Components (rows x dimension) of a block, and of all pivots of a dimension.
BLOCK_CELLS = 1 << 20
PIVOT_CELLS = 1 << 22
MAX_PIVOTS = 4096
#: Rows of a tree's leaf, and queries that walk a tree together.
LEAF = 128
QUERY_BATCH = 256
#: Largest integer that a product of float64 matrices holds exactly.
EXACT = float(1 << 53)
LONG = (1 << 63) - 1


@dataclass
class BallTree:
    """Nodes of a binary tree over the rows ``order[lo:hi]``; a leaf has no
    children (-1)."""

    order: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    left: np.ndarray
    right: np.ndarray
    centre: np.ndarray
    radius: np.ndarray


def ball_tree(v: np.ndarray, leaf: int = LEAF) -> BallTree:
    """Cut by the median along the line between two far rows until a node has
    at most ``leaf`` rows."""
    order = np.arange(len(v))
    lo, hi, left, right, centre, radius = [], [], [], [], [], []

    def node(a: int, b: int) -> int:
        x = v[order[a:b]]
        c = x.mean(axis=0)
        lo.append(a), hi.append(b), left.append(-1), right.append(-1)
        centre.append(c), radius.append(np.linalg.norm(x - c, axis=1).max())
        return len(lo) - 1

    todo = [node(0, len(v))]
    while todo:
        i = todo.pop()
        a, b = lo[i], hi[i]
        if b - a <= leaf or radius[i] == 0:
            continue
        x = v[order[a:b]]
        far = x[np.linalg.norm(x - centre[i], axis=1).argmax()]
        other = x[np.linalg.norm(x - far, axis=1).argmax()]
        mid = (b - a) // 2
        order[a:b] = order[a:b][np.argpartition(x @ _unit(other - far), mid)]
        left[i], right[i] = node(a, a + mid), node(a + mid, b)
        todo += [left[i], right[i]]
    return BallTree(order, *(np.array(x) for x in (lo, hi, left, right)), np.array(centre), np.array(radius))


def _unit(x: np.ndarray) -> np.ndarray:
    return x / max(np.abs(x).max(), 1e-300)


def upper_bounds(q: np.ndarray, centre: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """For each query and ball, a number that no member's product exceeds. The
    margin covers the rounding of the centres, norms and products."""
    qn, cn = np.linalg.norm(q, axis=1), np.linalg.norm(centre, axis=1)
    with np.errstate(over="ignore", invalid="ignore"):
        bound = q @ centre.T + qn[:, None] * (radius + 1e-9 * (cn + radius))[None, :] + 1e-6
    # numbers beyond doubles bound nothing; scores end at the longs
    return np.maximum(np.where(np.isnan(bound), np.inf, bound), -float(1 << 64))


def products(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows: float64 where that is exact, else
    Python integers, cut to the longs."""
    with np.errstate(over="ignore"):
        if q.shape[1] * np.abs(q).max(initial=0) * np.abs(v).max(initial=0) < EXACT:
            return (q @ v.T).astype(np.int64)
    a = np.array([[int(x) for x in r] for r in q], dtype=object).reshape(q.shape)
    b = np.array([[int(x) for x in r] for r in v], dtype=object).reshape(v.shape)
    return np.clip(a @ b.T, -LONG - 1, LONG).astype(np.int64)


def search_block(tree: BallTree, ids, v, qid, q, floor: list, k: int) -> list[list[tuple[int, int]]]:
    """Per query at most ``k`` (score, -id), no score below its ``floor``
    (None: no floor), best first by bound. Rows with the query's own id are
    left out."""
    bound = upper_bounds(q, tree.centre, tree.radius)
    heaps: list[list[tuple[int, int]]] = [[] for _ in qid]
    kth = np.array([-np.inf if f is None else float(f) for f in floor])
    nodes = [(-bound[:, 0].max(), 0, np.arange(len(qid)))]
    while nodes:
        _, i, live = heapq.heappop(nodes)
        # a float k-th score may round up by a part in 2^53
        live = live[bound[live, i] >= kth[live] - np.abs(kth[live]) * 1e-15]
        if not len(live):
            continue
        if tree.left[i] >= 0:
            for j in (tree.left[i], tree.right[i]):
                heapq.heappush(nodes, (-bound[live, j].max(), int(j), live))
            continue
        at = tree.order[tree.lo[i] : tree.hi[i]]
        scores = products(q[live], v[at])
        own = ids[at][None, :] == qid[live][:, None]
        least = kth[live].copy()
        if scores.shape[1] > k:
            top = np.partition(np.where(own, np.iinfo(np.int64).min, scores), -k, axis=1)[:, -k]
            least = np.maximum(least, top.astype(float))
        r, c = np.nonzero((scores >= (least - np.abs(least) * 1e-15)[:, None]) & ~own)
        for x, score, name in zip(live[r].tolist(), scores[r, c].tolist(), ids[at][c].tolist()):
            heap = heaps[x]
            if floor[x] is not None and score < floor[x]:
                continue
            if len(heap) < k:
                heapq.heappush(heap, (score, -name))
            elif (score, -name) > heap[0]:
                heapq.heapreplace(heap, (score, -name))
            if len(heap) == k:
                kth[x] = max(kth[x], float(heap[0][0]))
    return heaps


def quantised(df: DataFrame, id_col: str, vec_col: str, scale: float) -> DataFrame:
    """``id``, ``dim``, ``v``: floor(scale * x) of each component, as doubles,
    of vectors that are not null and hold only finite products."""
    scaled = F.transform(F.col(vec_col).cast("array<double>"), lambda x: x * F.lit(float(scale)))
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    ok = df.select(F.col(id_col).cast("long").alias("id"), scaled.alias("v"))
    return ok.where(F.col("id").isNotNull() & F.col("v").isNotNull() & ~odd).select("id", F.size("v").alias("dim"), "v")


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.floor(column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim))


def _runs(*keys: np.ndarray) -> Iterator[tuple[int, int]]:
    """(start, end) of the runs of equal keys."""
    if len(keys[0]):
        cut = np.flatnonzero(np.any([np.diff(k) != 0 for k in keys], axis=0)) + 1
        yield from zip([0, *cut.tolist()], [*cut.tolist(), len(keys[0])])


def choose_pivots(rows: DataFrame, counts: dict[int, int], block_cells: int) -> dict[int, np.ndarray]:
    """For each dimension the vectors with the smallest hashes, about one for
    each block of its rows, at most ``PIVOT_CELLS`` components and
    ``MAX_PIVOTS`` rows: a documented, bounded sample. Every row is searched,
    whichever pivots are chosen."""
    wanted = {d: max(1, min(MAX_PIVOTS, PIVOT_CELLS // max(d, 1), n * d // block_cells)) for d, n in counts.items()}
    most = _by_dim(wanted)
    first = Window.partitionBy("dim").orderBy(F.xxhash64("id", "v"), "id")
    picked = rows.withColumn("n", F.row_number().over(first)).where(F.col("n") <= MAX_PIVOTS).where(F.col("n") <= most)
    found: dict[int, list] = {}
    for r in picked.select("dim", "v").collect():
        found.setdefault(r["dim"], []).append(r["v"])
    return {d: np.floor(np.unique(np.array(x, dtype=float).reshape(len(x), d), axis=0)) for d, x in found.items()}


def _by_dim(values: dict[int, int]) -> Column:
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])[F.col("dim")]


def exact_topk(
    vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
    scale: float = 256.0, block_cells: int = BLOCK_CELLS, leaf: int = LEAF,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` of the ``k`` rows
    with the largest integer inner product of the vectors floor(scale * x), ties
    to the smaller id.

    Defined cases: vectors that are null or hold null or non-finite components
    (also after scaling) take no part on either side, nor do null ids; zero
    vectors do, and so do empty ones, among themselves with score 0;
    candidates have the query's length; rows with the query's own id are no
    candidates, every other row is one, also where an id or a vector repeats;
    queries that repeat id and vector count once, and different vectors under
    one query id share its ``k`` places; fewer candidates than ``k`` give all
    of them; a score outside of the longs is the nearest long; empty tables
    give no rows; other columns are ignored.

    A task holds one block of about ``block_cells`` components and its tree;
    queries stream past it. What the driver holds is one pivot per cell, of
    bounded number and size.
    """
    spark = vectors.sparkSession
    rows = quantised(vectors, id_col, vec_col, scale)
    asked = materialize(quantised(queries, id_col, vec_col, scale).distinct(), "queries")
    counts = {r["dim"]: r["n"] for r in rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}
    counts = {r["dim"]: counts[r["dim"]] for r in asked.select("dim").distinct().collect() if r["dim"] in counts}
    if not counts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    rows = rows.where(F.col("dim").isin(*counts))
    pivots = spark.sparkContext.broadcast(choose_pivots(rows, counts, block_cells))

    def to_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The nearest pivot of each row, and the distance to it."""
        for batch in batches:
            dims = batch.column("dim").to_numpy(zero_copy_only=False)
            for d in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == d))
                p = pivots.value[d]
                half = (p * p).sum(axis=1) / 2
                for s in range(0, part.num_rows, 4096):
                    some = part.slice(s, 4096)
                    x = _matrix(some.column("v"), d)
                    cell = (x @ p.T - half[None, :]).argmax(axis=1)
                    yield pa.RecordBatch.from_arrays(
                        [some.column("dim"), pa.array(cell.astype(np.int64)), some.column("id"), some.column("v"),
                         pa.array(np.linalg.norm(x - p[cell], axis=1))],
                        ["dim", "cell", "id", "v", "dist"],
                    )

    dealt = materialize(rows.mapInArrow(to_cells, "dim int, cell long, id long, v array<double>, dist double"), "cells")
    per_block = _by_dim({d: max(1, block_cells // max(d, 1)) for d in counts})
    cells = dealt.groupBy("dim", "cell").agg(F.count(F.lit(1)).alias("n"), F.max("dist").alias("radius"))
    # At most one row per pivot.
    cells = materialize(cells.withColumn("blocks", F.ceil(F.col("n") / per_block).cast("long")), "balls")
    table: dict[int, list] = {}
    for r in cells.collect():
        table.setdefault(r["dim"], []).append((r["cell"], r["radius"], r["blocks"]))
    balls = spark.sparkContext.broadcast({d: tuple(np.array(x) for x in zip(*sorted(t))) for d, t in table.items()})
    held = dealt.join(F.broadcast(cells.select("dim", "cell", "blocks")), ["dim", "cell"]).select(
        "dim", "cell", F.pmod(F.xxhash64("id", "v"), "blocks").alias("block"), F.lit(0).alias("side"), "id", "v",
        F.lit(None).cast("long").alias("floor"),
    )

    def to_blocks(first: bool):
        def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                dims = batch.column("dim").to_numpy(zero_copy_only=False)
                for d in np.unique(dims).tolist():
                    cell, radius, n = balls.value[d]
                    part = batch.filter(pa.array(dims == d))
                    for s in range(0, part.num_rows, QUERY_BATCH):
                        some = part.slice(s, QUERY_BATCH)
                        ids, x = some.column("id").to_numpy(zero_copy_only=False), _matrix(some.column("v"), d)
                        bound = upper_bounds(x, pivots.value[d][cell.astype(int)], radius)
                        best = bound.argmax(axis=1)
                        home = np.abs(ids) % n[best].astype(int)
                        if first:
                            r, c, b = np.arange(len(ids)), best, home
                        else:
                            floor = np.array([-np.inf if f is None else f for f in some.column("floor").to_pylist()], dtype=float)
                            r, c = np.nonzero(bound >= (floor - np.abs(floor) * 1e-15)[:, None])
                            times = n[c].astype(int)
                            b = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                            r, c = np.repeat(r, times), np.repeat(c, times)
                            new = (c != best[r]) | (b != home[r])
                            r, c, b = r[new], c[new], b[new]
                        for t in range(0, len(r), 1024):
                            at = pa.array(r[t : t + 1024])
                            yield pa.RecordBatch.from_arrays(
                                [some.column("dim").take(at), pa.array(cell[c[t : t + 1024]].astype(np.int64)), pa.array(b[t : t + 1024].astype(np.int64)),
                                 pa.array(np.ones(len(at), np.int32)), some.column("id").take(at), some.column("v").take(at), some.column("floor").take(at)],
                                ["dim", "cell", "block", "side", "id", "v", "floor"],
                            )

        return route

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted by block, vectors first: they are held with their tree, the
        queries stream past."""
        key, parts, tree = None, [], None
        for batch in batches:
            dim, cell, block, side = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("dim", "cell", "block", "side"))
            for s, e in _runs(dim, cell, block, side):
                if (dim[s], cell[s], block[s]) != key:
                    key, parts, tree = (dim[s], cell[s], block[s]), [], None
                ids = batch.column("id").slice(s, e - s).to_numpy(zero_copy_only=False)
                m = _matrix(batch.column("v").slice(s, e - s), int(dim[s]))
                if side[s] == 0:
                    parts.append((ids, m))
                    continue
                if not parts:
                    continue
                if tree is None:
                    parts = [tuple(np.concatenate(x) for x in zip(*parts))]
                    tree = ball_tree(parts[0][1], leaf)
                floor = batch.column("floor").slice(s, e - s).to_pylist()
                for t in range(0, e - s, QUERY_BATCH):
                    u = slice(t, t + QUERY_BATCH)
                    found = search_block(tree, *parts[0], ids[u], m[u], floor[u], k)
                    out = [(q, -i, x) for q, h in zip(ids[u].tolist(), found) for x, i in h]
                    if out:
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["query_id", "vec_id", "score"])

    def searched(asking: DataFrame, first: bool) -> DataFrame:
        sent = asking.mapInArrow(to_blocks(first), "dim int, cell long, block long, side int, id long, v array<double>, floor long")
        keys = ["dim", "cell", "block"]
        both = held.unionByName(sent).repartition(*keys).sortWithinPartitions(*keys, "side")
        return both.mapInArrow(visit, "query_id long, vec_id long, score long")

    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    one = materialize(searched(asked.withColumn("floor", F.lit(None).cast("long")), True), "first")
    ranked = one.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    # The k-th score of an id with one vector; ids with several have no floor.
    floors = ranked.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("floor"))
    single = asked.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n = 1").select("id")
    again = asked.join(floors.join(single, "id", "left_semi"), "id", "left").select("id", "dim", "v", "floor")
    every = one.unionByName(searched(again, False))
    out = every.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return out.select("query_id", "rank", "vec_id", "score")
