"""A metric index for cosine search: written once, asked by any table of queries.

Vectors are scaled to length 1 and dealt to the nearest of a bounded set of
pivots, so a ball is a pivot and the largest angle from it to its vectors. By
the triangle inequality of angles no vector of a ball is nearer to a query than
the angle to the pivot less that of the ball. A query first asks one block of
its nearest ball; the k-th score found there rules out every ball whose bound
stays below it, and the blocks of the others return only what reaches it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from corpusflow.plans.strategy import bounded_broadcast, materialize
from corpusflow.session import shared_path

#: Components of a ball on average and of a block at most (a larger ball is
#: several blocks), components of all pivots, pivots of a dimension.
BALL_CELLS = 500_000
BLOCK_CELLS = 2_000_000
PIVOT_CELLS = 4_000_000
MAX_PIVOTS = 4096
#: Queries that one task holds against a block.
QUERY_GROUP = 4096
#: Rounding moves a score by at most half a unit of its last decimal.
SLACK = 2e-6


def unit_rows(m: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, at every magnitude; zero rows stay zero."""
    top = np.abs(m).max(axis=1, initial=0.0)
    m = np.ldexp(m, -np.frexp(top)[1][:, None])
    norms = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(norms == 0, 1.0, norms)


def finite_vectors(df: DataFrame, cols: Sequence, vec: str) -> DataFrame:
    """``cols``, ``dim`` and ``v`` of the rows whose vector is not null or empty
    and holds numbers only."""
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = df.select(*cols, F.col(vec).cast("array<double>").alias("v")).where("size(v) > 0")
    return rows.where(~bad).withColumn("dim", F.size("v"))


@dataclass(eq=False)
class Balls:
    """The balls of one dimension: pivots by row (the last one is the zero
    vector, for vectors without a direction), widest angle, rows and blocks."""

    centre: np.ndarray
    angle: np.ndarray
    rows: np.ndarray
    blocks: np.ndarray

    def bounds(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cosines to the pivots, and the largest that a vector of each ball
        can reach (no vector: -inf)."""
        near = np.clip(q @ self.centre.T, -1.0, 1.0)
        best = np.cos(np.maximum(0.0, np.arccos(near) - self.angle[None, :]))
        best[:, -1] = 0.0
        best[:, self.rows == 0] = -np.inf
        return near, best

    def home(self, near: np.ndarray, k: int) -> np.ndarray:
        """The ball a query asks first: the nearest whose blocks hold ``k``
        rows with some to spare, else the one with the fullest blocks."""
        held = self.rows // np.maximum(self.blocks, 1)
        full = held >= min(2 * k, int(held.max()))
        return np.where(full[None, :], near, -np.inf).argmax(axis=1)


@dataclass(eq=False)
class VectorIndex:
    spark: SparkSession
    path: str
    ids: list[str]
    block_cells: int = BLOCK_CELLS
    balls: dict[int, Balls] = field(default_factory=dict, repr=False)

    @property
    def _keys(self) -> list[str]:
        return [f"k{i}" for i in range(len(self.ids))]

    def rows(self) -> DataFrame:
        """``dim``, ``ball``, ``block``, the ids as ``k0``..., and ``v``."""
        table = [(d, i, int(n)) for d, b in self.balls.items() for i, n in enumerate(b.blocks)]  # one row per pivot
        blocks = self.spark.createDataFrame(table, "dim int, ball int, blocks long")
        rows = self.spark.read.parquet(f"{self.path}/rows").join(F.broadcast(blocks), ["dim", "ball"])
        return rows.select("dim", "ball", F.pmod(F.xxhash64(*self._keys, "v"), "blocks").cast("int").alias("block"), *self._keys, "v")

    def visits(self, asked: DataFrame, k: int, first: bool) -> DataFrame:
        """The blocks that ``asked(qn, part, dim, v, floor)`` go to: the first
        one of each query, or all others that can reach its floor."""
        schema = T.StructType.fromDDL("qn long, part int, dim int, ball int, block int, floor double, v array<double>")
        arrow, balls = to_arrow_schema(schema), self.spark.sparkContext.broadcast(self.balls)

        def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part, d in (x for b in batches for x in _by_dim(b)):
                if d not in balls.value:
                    continue
                ball = balls.value[d]
                m = unit_rows(_matrix(part.column("v"), d))
                near, best = ball.bounds(m)
                home, qn = ball.home(near, k), part.column("qn").to_numpy(zero_copy_only=False)
                block = qn % ball.blocks[home]
                if first:
                    r, c, b = np.arange(len(qn)), home, block
                else:
                    floor = np.array([-np.inf if f is None else f for f in part.column("floor").to_pylist()])
                    r, c = np.nonzero((best > -np.inf) & ((1.0 + best) / 2.0 >= floor[:, None] - SLACK))
                    times = ball.blocks[c]
                    b = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                    r, c = np.repeat(r, times), np.repeat(c, times)
                    other = (c != home[r]) | (b != block[r])
                    r, c, b = r[other], c[other], b[other]
                for s in range(0, len(r), 1024):
                    at, cells = r[s : s + 1024], c[s : s + 1024]
                    take = pa.array(at)
                    cols = [part.column("qn").take(take), part.column("part").take(take), part.column("dim").take(take), pa.array(cells),
                            pa.array(b[s : s + 1024]), part.column("floor").take(take), _lists(m[at])]
                    yield pa.RecordBatch.from_arrays([x.cast(f.type) for x, f in zip(cols, arrow)], schema=arrow)

        return asked.select("qn", "part", "dim", "v", "floor").mapInArrow(route, schema)

    def _found(self, sent: DataFrame, k: int) -> DataFrame:
        """At most ``k`` rows of each query and block, those at its floor or above."""
        rows, keys, by = self.rows(), self._keys, ["dim", "ball", "block", "part"]
        schema = T.StructType([T.StructField("qn", T.LongType()), *[rows.schema[c] for c in keys], T.StructField("score", T.DoubleType())])
        wanted, _ = bounded_broadcast(sent.select(*by).distinct())
        return sent.groupBy(*by).cogroup(rows.join(wanted, by[:3]).groupBy(*by)).applyInPandas(_tile(keys, k, schema), schema)

    def topk(self, queries: DataFrame, k: int, query_id: str, query_vec: str, query_rows: int = QUERY_GROUP) -> DataFrame:
        """(query, ids, ``score``): a superset of each query's ``k`` best."""
        keys = self._keys
        asked = finite_vectors(queries, [F.col(query_id).alias("query"), F.monotonically_increasing_id().alias("qn")], query_vec)
        asked = materialize(asked.withColumn("zero", F.forall("v", lambda x: x == 0)), "vector-queries")
        size = asked.agg(F.count(F.lit(1)).alias("n"), F.count_if("zero").alias("zero")).first()
        parts = max(1, -(-size["n"] // query_rows))
        ready = asked.where("not zero").withColumn("part", F.pmod(F.xxhash64("qn"), F.lit(parts)).cast("int"))
        sent = self.visits(ready.withColumn("floor", F.lit(None).cast("double")), k, True)
        one = materialize(self._found(materialize(sent, "visits"), k), "first-hits")
        floors = one.groupBy("qn").agg(F.count(F.lit(1)).alias("n"), F.round(F.min("score"), 6).alias("floor")).where(F.col("n") == k).drop("n")
        sent = materialize(self.visits(ready.join(floors, "qn", "left"), k, False), "visits")
        found = one.unionByName(self._found(sent, k)) if sent.head(1) else one
        if size["zero"]:  # a query without a direction scores all of its dimension alike: the smallest ids
            first = Window.partitionBy("dim").orderBy(*keys)
            same = self.spark.read.parquet(f"{self.path}/rows").select("dim", *keys, F.row_number().over(first).alias("n")).where(F.col("n") <= k)
            found = found.unionByName(asked.where("zero").join(same, "dim").select("qn", *keys, F.lit(0.5).alias("score")))
        ids = [F.col(c).alias(i) for c, i in zip(keys, self.ids)]
        return found.join(asked.select("qn", "query"), "qn").select(F.col("query").alias(query_id), *ids, "score")


def _by_dim(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, int]]:
    """Slices of rows of one dimension, of about a million components."""
    dims = batch.column("dim").to_numpy(zero_copy_only=False)
    for d in np.unique(dims).tolist():
        part = batch.filter(pa.array(dims == d))
        step = max(1, 1_000_000 // d)
        for s in range(0, part.num_rows, step):
            yield part.slice(s, step), d


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def _lists(m: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1, dtype=np.int32) * m.shape[1]), pa.array(m.ravel()))


def _tile(keys: list[str], k: int, schema: T.StructType):
    """Some queries against one block."""
    from corpusflow.operators.retrieval import best_rounded, id_ranks

    def run(asked: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if asked.empty or rows.empty:
            return pd.DataFrame({f.name: [] for f in schema.fields})
        q, x = np.stack(asked["v"].to_list()), np.stack(rows["v"].to_list())
        floor = asked["floor"].fillna(-np.inf).to_numpy(dtype=float) - SLACK
        order = id_ranks(rows, keys)
        at, take, scores = [], [], []
        for lo in range(0, len(q), 64):
            score = (1.0 + q[lo : lo + 64] @ x.T) / 2.0
            for j in np.flatnonzero(score.max(axis=1) >= floor[lo : lo + 64]).tolist():
                s = score[j]
                sel = best_rounded(s, order, k)
                sel = sel[s[sel] >= floor[lo + j]]
                at.append(np.full(len(sel), lo + j))
                take.append(sel)
                scores.append(s[sel])
        if not at:
            return pd.DataFrame({f.name: [] for f in schema.fields})
        got = rows[keys].iloc[np.concatenate(take)].reset_index(drop=True)
        got.insert(0, "qn", asked["qn"].to_numpy()[np.concatenate(at)])
        return got.assign(score=np.concatenate(scores))

    return run


def _choose_pivots(rows: DataFrame, counts: dict[int, int], ball_cells: int) -> dict[int, np.ndarray]:
    """For each dimension the directions with the smallest hashes, about one
    for each ``ball_cells`` components: a bounded sample that decides speed
    alone, as every row is indexed and the bounds hold for any pivots."""
    share = PIVOT_CELLS // max(len(counts), 1)
    most = {d: max(1, min(MAX_PIVOTS, share // d, n * d // ball_cells)) for d, n in counts.items()}
    limit = F.create_map(*[F.lit(x) for kv in most.items() for x in kv])[F.col("dim")]
    first = Window.partitionBy("dim").orderBy("h")
    some = rows.where(F.exists("v", lambda x: x != 0)).withColumn("h", F.xxhash64("v")).withColumn("n", F.row_number().over(first))
    found: dict[int, list] = {d: [] for d in counts}
    for r in some.where(F.col("n") <= MAX_PIVOTS).where(F.col("n") <= limit).select("dim", "v").collect():
        found[r["dim"]].append(r["v"])
    return {d: np.vstack([np.unique(unit_rows(np.array(x, dtype=float).reshape(len(x), d)), axis=0), np.zeros((1, d))]) for d, x in found.items()}


def build_vector_index(index: DataFrame, id_col: str | Sequence[str] = "vec_id", vec_col: str = "embedding", path: str | None = None,
                       ball_cells: int = BALL_CELLS, block_cells: int = BLOCK_CELLS) -> VectorIndex:
    """Write the index of ``index`` into ``path`` or the shared folder, without
    a shuffle. Ids of any type are kept; vectors of any dimension, those that
    are null, empty or hold other than finite numbers are left out."""
    ids = [id_col] if isinstance(id_col, str) else list(id_col)
    keys, spark = [f"k{i}" for i in range(len(ids))], index.sparkSession
    path = path or shared_path(spark, f"tables/vectors-{uuid.uuid4().hex[:16]}")
    rows = materialize(finite_vectors(index, [F.col(c).alias(k) for c, k in zip(ids, keys)], vec_col), "vectors")
    counts = {r["dim"]: r["n"] for r in rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}
    pivots = spark.sparkContext.broadcast(_choose_pivots(rows, counts, ball_cells) if counts else {})
    schema = T.StructType([*[rows.schema[c] for c in keys], *T.StructType.fromDDL("dim int, ball int, angle double, v array<double>").fields])
    arrow = to_arrow_schema(schema)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, d in (x for b in batches for x in _by_dim(b)):
            m, p = unit_rows(_matrix(part.column("v"), d)), pivots.value[d]
            near = m @ p.T
            near[:, -1] = np.where(m.any(axis=1), -np.inf, np.inf)
            ball = near.argmax(axis=1)
            angle = np.arccos(np.clip(near[np.arange(len(m)), ball], -1.0, 1.0))
            cols = [*[part.column(c) for c in keys], part.column("dim"), pa.array(ball), pa.array(angle), _lists(m)]
            yield pa.RecordBatch.from_arrays([x.cast(f.type) for x, f in zip(cols, arrow)], schema=arrow)

    rows.select(*keys, "dim", "v").mapInArrow(deal, schema).write.parquet(f"{path}/rows")
    size = spark.read.parquet(f"{path}/rows").groupBy("dim", "ball").agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("angle"))
    held = {(r["dim"], r["ball"]): (r["n"], r["angle"]) for r in size.collect()}  # at most one row per pivot
    table = [(d, i, c.tolist(), *held.get((d, i), (0, 0.0))) for d, p in pivots.value.items() for i, c in enumerate(p)]
    spark.createDataFrame(table, "dim int, ball int, centre array<double>, n long, angle double").write.parquet(f"{path}/balls")
    meta = {"ids": ids, "block_cells": block_cells}
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.json(f"{path}/meta")
    return open_vector_index(spark, path)


def open_vector_index(spark: SparkSession, path: str) -> VectorIndex:
    """An index that was written before; its balls are read, its rows are not."""
    found = VectorIndex(spark, path, **json.loads(spark.read.schema("meta string").json(f"{path}/meta").first()["meta"]))
    table: dict[int, list] = {}
    for r in spark.read.parquet(f"{path}/balls").orderBy("dim", "ball").collect():
        table.setdefault(r["dim"], []).append(r)
    for d, rs in table.items():
        n = np.array([r["n"] for r in rs])
        blocks = -(-n // max(1, found.block_cells // d))
        found.balls[d] = Balls(np.array([r["centre"] for r in rs]), np.array([r["angle"] for r in rs]), n, blocks)
    return found
