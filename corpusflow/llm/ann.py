"""Nearest neighbours of a query set by a block matrix join.

Vectors are quantised to int8 with a scale of their own. A tile multiplies a
block of queries with a block of candidates in int8 (held in float32, whose
24-bit mantissa keeps the integer products exact) and the residual norms bound
each product from both sides. A pair whose upper bound reaches the k-th best
lower bound known for its query is recomputed in float64, the rest cannot be
among the k nearest. Each tile keeps k per query; heaps merge the tiles.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.plans.strategy import materialize

#: Rows of a query block and of a candidate block, and columns of one int8
#: product (127 * 127 * 1024 < 2^24, so sums stay exact in float32). A task
#: holds about QUERY_DEAL queries and multiplies a query block at a time.
QUERY_BLOCK = 1024
QUERY_DEAL = 16_384
VECTOR_BLOCK = 32_768
STRIP = 4096
EXACT_DIMS = 1024


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scale, norm of the decoded vector, norm of the residual, all
    of the vector times 2^-power, whose largest component lies in [1/2, 1);
    and the power. Scaling by a power of two is exact at any magnitude."""
    power = np.frexp(np.abs(x).max(axis=1))[1]
    x = np.ldexp(x, -power[:, None])
    scale = np.abs(x).max(axis=1) / 127.0
    codes = np.rint(x / scale[:, None]).astype(np.int8)
    decoded = codes * scale[:, None]
    return codes, scale, np.linalg.norm(decoded, axis=1), np.linalg.norm(x - decoded, axis=1), power


def int8_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of all rows of ``a`` and ``b``, as float64."""
    out = np.zeros((len(a), len(b)))
    for i in range(0, a.shape[1], EXACT_DIMS):
        out += a[:, i : i + EXACT_DIMS].astype(np.float32) @ b[:, i : i + EXACT_DIMS].astype(np.float32).T
    return out


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise products in float64, summed from the first component on, so
    that the same pair has the same score wherever it is computed."""
    out = np.zeros(len(a))
    with np.errstate(over="ignore", invalid="ignore"):
        for j in range(a.shape[1]):
            out += a[:, j] * b[:, j]
    return np.where(np.isnan(out), -np.inf, out)  # sums of both infinities rank last


def tile_topk(qid, q, vid, v, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query id, vector id, exact product) of at most k per query, such that
    the k nearest of the tile are among them."""
    qc, qs, qn, qe, qp = quantise(q)
    # Bounds are of the product times 2^-qp. There the largest double, and what
    # an underflow of the summed products can hide:
    with np.errstate(over="ignore"):
        top = np.ldexp(np.finfo(float).max, -qp)
        hidden = np.ldexp(np.full(len(q), np.finfo(float).tiny * 4.0 * q.shape[1]), -qp)
    best = np.full(len(q), -np.inf)
    kept: list[list[tuple[float, int]]] = [[] for _ in range(len(q))]
    for s in range(0, len(v), STRIP):
        vv, ids = v[s : s + STRIP], vid[s : s + STRIP]
        vc, vs, vn, ve, vp = quantise(vv)
        mid = int8_product(qc, vc) * qs[:, None] * vs[None, :]
        # |<x,y> - <x',y'>| <= |x'||y - y'| + |x - x'||y|, and a margin for rounding
        err = qn[:, None] * ve[None, :] + qe[:, None] * (vn + ve)[None, :]
        err += 1e-9 * (qn + qe)[:, None] * (vn + ve)[None, :]
        with np.errstate(over="ignore", invalid="ignore"):
            mid, err = np.ldexp(mid, vp[None, :]), np.ldexp(err, vp[None, :]) + hidden[:, None]
            high, low = mid + err, np.minimum(mid - err, top[:, None])
        high, low = np.where(np.isnan(high), np.inf, high), np.where(np.isnan(low), -np.inf, low)
        own = ids[None, :] == qid[:, None]
        low = np.where(own, -np.inf, low)
        if low.shape[1] >= k:
            best = np.maximum(best, np.partition(low, -k, axis=1)[:, -k])
        r, c = np.nonzero((high >= best[:, None]) & ~own)
        for i in range(0, len(r), 1 << 16):
            ri, ci = r[i : i + (1 << 16)], c[i : i + (1 << 16)]
            exact = exact_products(q[ri], vv[ci])
            for row, score, x in zip(ri.tolist(), exact.tolist(), ids[ci].tolist()):
                heap = kept[row]
                if len(heap) < k:
                    heapq.heappush(heap, (score, -x))
                elif (score, -x) > heap[0]:
                    heapq.heapreplace(heap, (score, -x))
        full = [i for i, h in enumerate(kept) if len(h) == k]
        with np.errstate(over="ignore"):
            found = np.minimum(np.ldexp([kept[i][0][0] for i in full], -qp[full]) - hidden[full], top[full])
        best[full] = np.maximum(best[full], np.where(np.isnan(found), -np.inf, found))
    for i, heap in enumerate(kept):
        if heap:
            yield np.full(len(heap), qid[i]), np.array([-x for _, x in heap]), np.array([s for s, _ in heap])


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, v, n) of vectors that are not null, empty or zero and hold only
    finite numbers, one row per id and vector; ``n`` is how many rows have
    both."""
    v = F.col(vec_col).cast("array<double>")
    ok = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull()
    )
    ok = ok.where(~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0))
    return ok.groupBy("vec_id", "v").agg(F.count(F.lit(1)).alias("n"))


def _stack(column: pa.Array) -> np.ndarray:
    """Rows of equal length as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
    query_block: int = QUERY_BLOCK, vector_block: int = VECTOR_BLOCK, query_deal: int = QUERY_DEAL,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` of the ``k``
    vectors with the largest inner product for each query, ties to the smaller
    id; the query's own id is no candidate, and candidates have the query's
    length. The result is exact, so recall is 1.

    Defined cases: vectors that are null, empty, zero or hold null or
    non-finite components take no part on either side, nor do null ids; every
    other row is a candidate, also where an id or a vector repeats, at any
    magnitude (a product beyond the doubles is infinite, a sum of both
    infinities ranks last as minus infinity); queries
    that repeat id and vector count once, and different vectors under one
    query id share its k places; fewer than k candidates give all of them;
    empty tables give no rows; other columns are ignored.

    Queries and candidates are dealt to groups of one query share and one
    candidate block, of about ``query_deal`` and ``vector_block`` rows; a task
    holds one group at a time and gives its results by ``query_block``.
    """
    base = materialize(usable(vectors, id_col, vec_col), "usable")
    asked = materialize(usable(queries, id_col, vec_col).withColumn("dim", F.size("v")), "asked")
    # More than k equal rows cannot take more than k places.
    copies = F.sequence(F.lit(1).cast("long"), F.least("n", F.lit(k).cast("long")))
    sized = base.select("vec_id", "v", F.explode(copies).alias("copy")).withColumn("dim", F.size("v"))
    counts = {r["dim"]: r["n"] for r in sized.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}
    schema = "query_id long, vec_id long, score double"
    q_counts = {r["dim"]: r["n"] for r in asked.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts or not q_counts:
        return base.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")

    def blocks(rows: int, of: dict[int, int]) -> Column:
        """Number of blocks of about ``rows`` rows, by dimension."""
        return F.create_map(*[F.lit(x) for d in counts for x in (d, max(1, -(-of.get(d, 0) // rows)))])[F.col("dim")].cast("long")

    def every(n: Column) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), n - 1))

    # Hash-dealt within each dimension; each side goes to all blocks of the other.
    n_cand, n_query = blocks(vector_block, counts), blocks(query_deal, q_counts)
    cand = sized.withColumn("cb", F.pmod(F.xxhash64("vec_id", "v", "copy"), n_cand)).withColumn("qb", every(n_query))
    cand = cand.where(F.col("dim").isin(*q_counts)).select("dim", "qb", "cb", F.lit(1).alias("side"), F.col("vec_id").alias("id"), "v")
    q = asked.where(F.col("dim").isin(*counts)).withColumn("qb", F.pmod(F.xxhash64("vec_id", "v"), n_query)).withColumn("cb", every(n_cand))
    q = q.select("dim", "qb", "cb", F.lit(0).alias("side"), F.col("vec_id").alias("id"), "v")

    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted by group, then queries before candidates: the queries of a
        group are held, its candidates stream past them."""
        key, qi, qv = None, [], []
        parts: list[tuple[np.ndarray, np.ndarray]] = []

        def product():
            if not parts or not qi:
                return
            vid, v = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            if len(qi) > 1:
                qi[:], qv[:] = [np.concatenate(qi)], [np.concatenate(qv)]
            for s in range(0, len(qi[0]), query_block):
                rows = list(tile_topk(qi[0][s : s + query_block], qv[0][s : s + query_block], vid, v, k))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*rows)], ["query_id", "vec_id", "score"])

        for batch in batches:
            dim, qb, cb, side = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("dim", "qb", "cb", "side"))
            edge = np.flatnonzero((np.diff(dim) != 0) | (np.diff(qb) != 0) | (np.diff(cb) != 0) | (np.diff(side) != 0)) + 1
            for s, e in zip([0, *edge.tolist()], [*edge.tolist(), len(dim)]):
                if s == e:
                    continue
                if (dim[s], qb[s], cb[s]) != key:
                    yield from product()
                    key, qi, qv, parts = (dim[s], qb[s], cb[s]), [], [], []
                ids = batch.column("id").slice(s, e - s).to_numpy(zero_copy_only=False)
                m = _stack(batch.column("v").slice(s, e - s))
                if side[s] == 0:
                    qi.append(ids)
                    qv.append(m)
                else:
                    parts.append((ids, m))
                    if sum(len(p[0]) for p in parts) >= vector_block:
                        yield from product()
                        parts = []
        yield from product()

    both = cand.unionByName(q).repartition("dim", "qb", "cb").sortWithinPartitions("dim", "qb", "cb", "side")
    found = both.mapInArrow(tiles, schema)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Heap of the k best per query over rows sorted by query."""
        key, heap = None, []

        def done():
            best = sorted(heap, key=lambda x: (-x[0], -x[1]))
            return pa.RecordBatch.from_pydict(
                {
                    "query_id": [key] * len(best), "rank": list(range(1, len(best) + 1)),
                    "vec_id": [-x for _, x in best], "score": [s for s, _ in best],
                },
                pa.schema([("query_id", pa.int64()), ("rank", pa.int32()), ("vec_id", pa.int64()), ("score", pa.float64())]),
            )

        for batch in batches:
            for a, b, s in zip(*(batch.column(c).to_pylist() for c in ("query_id", "vec_id", "score"))):
                if a != key:
                    if heap:
                        yield done()
                    key, heap = a, []
                if len(heap) < k:
                    heapq.heappush(heap, (s, -b))
                elif (s, -b) > heap[0]:
                    heapq.heapreplace(heap, (s, -b))
        if heap:
            yield done()

    ranked = found.repartition("query_id").sortWithinPartitions("query_id")
    return ranked.mapInArrow(merge, "query_id long, rank int, vec_id long, score double")
