"""An inverted index for BM25: written once, asked by any table of queries.

The documents are cut into blocks. A row of the index holds one term's postings
in one block (places, counts and document lengths as arrays) with the largest
count and the smallest length among them, which bound what the term can add to
any document of the block. A query first scores the one block of its best
bound; a block whose bound does not reach the k-th score found there is neither
joined nor read for that query. Rows of the index are kept in folders by a hash
of the term, so a query reads those of its terms alone.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from corpusflow.functions.text import search_terms
from corpusflow.plans.strategy import bounded_broadcast, materialize
from corpusflow.session import shared_path

#: Terms of a block (a longer document is a block of its own), folders of the
#: postings, and queries that one task scores against a block.
BLOCK_TERMS = 1_000_000
FOLDERS = 8
QUERY_GROUP = 2048
#: Rounding moves a score by at most half a unit of its last decimal.
SLACK = 2e-6


@dataclass
class InvertedIndex:
    spark: SparkSession
    path: str
    keys: list[str]
    n_docs: int
    avg_len: float

    def _rows(self) -> DataFrame:
        return self.spark.read.option("basePath", self.path).parquet(f"{self.path}/rows")

    def docs(self) -> DataFrame:
        """``block``, ``place`` and the keys of every document."""
        return self._rows().where("folder = -1").select("block", "place", *[F.col(f"k{i}").alias(c) for i, c in enumerate(self.keys)])

    def postings(self, terms: DataFrame) -> DataFrame:
        """The index rows of ``terms(term)``, from their folders alone."""
        folders = [r[0] for r in terms.select(_folder(F.col("term"))).distinct().collect()]  # at most FOLDERS
        rows = self._rows().where(F.col("folder").isin(folders)) if folders else self._rows().where("false")
        return rows.select("term", "block", "places", "tfs", "lens", "max_tf", "min_len").join(terms.select("term").distinct(), "term", "left_semi")

    def topk(self, pairs: DataFrame, k: int, k1: float, b: float, query_id: str = "query_id") -> DataFrame:
        """(query, keys, ``score``): a superset of each query's ``k`` best, at
        most ``k`` per query and block; ``pairs`` are distinct (query, term)."""
        n, avg = self.n_docs, self.avg_len
        post = materialize(self.postings(pairs), "postings")  # the asked terms alone, read four times
        freq = post.groupBy("term").agg(F.sum(F.size("places")).alias("df"))
        weight = F.log(F.lit(1.0) + (F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5))
        asked = materialize(pairs.select(F.col(query_id).alias("query"), "term").join(freq, "term").select("query", "term", weight.alias("w")), "asked")
        share = F.col("max_tf") * (k1 + 1.0) / (F.col("max_tf") + k1 * ((1.0 - b) + b * F.col("min_len") / avg))
        bounds = post.select("term", "block", share.alias("share")).join(asked, "term").groupBy("query", "block")
        bounds = materialize(bounds.agg((F.sum(F.col("w") * F.col("share")) * (1 + 1e-9)).alias("bound")), "bounds")
        queries = asked.groupBy("query").agg(F.collect_list(F.struct("term", "w")).alias("terms"))
        groups = max(1, -(-queries.count() // QUERY_GROUP))
        queries = materialize(queries.withColumn("part", F.pmod(F.xxhash64("query"), F.lit(groups))), "queries")

        def scored(some: DataFrame) -> DataFrame:
            left = some.select("query", "block").join(queries, "query")
            wanted = left.select("block", "part").distinct()
            right = post.join(wanted, "block").select(F.col("block").alias("at"), F.col("part").alias("group"), "term", "places", "tfs", "lens")
            schema = T.StructType([asked.schema["query"], T.StructField("block", T.LongType()), T.StructField("place", T.IntegerType()), T.StructField("score", T.DoubleType())])
            return left.groupBy("block", "part").cogroup(right.groupBy("at", "group")).applyInArrow(_score_block(avg, k, k1, b, to_arrow_schema(schema)), schema)

        first = Window.partitionBy("query").orderBy(F.col("bound").desc(), "block")
        bounds = bounds.withColumn("nth", F.row_number().over(first))
        one = materialize(scored(bounds.where("nth = 1")), "first")
        floors = one.groupBy("query").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("floor")).where(F.col("n") == k)
        rest = bounds.where("nth > 1").join(floors, "query", "left").where(F.col("floor").isNull() | (F.col("bound") >= F.col("floor") - SLACK))
        found = one.unionByName(scored(materialize(rest.select("query", "block"), "rest")))
        return found.join(self.docs(), ["block", "place"]).select(F.col("query").alias(query_id), *self.keys, "score")


def _folder(term: Column) -> Column:
    return (F.crc32(term.cast("binary")) % FOLDERS).cast("int")


def build_inverted(docs: DataFrame, doc_keys: Sequence[str], doc_text: str, path: str | None = None, block_terms: int = BLOCK_TERMS, only: DataFrame | None = None) -> InvertedIndex:
    """Write the index of ``docs`` (every row is a document of its own, a null
    text is an empty one) in one pass, without a shuffle, into ``path`` or the
    shared folder. Keys of any type are kept. With ``only(term)`` an index that
    serves these terms alone may leave out the others; it does if they can be
    broadcast."""
    keys = list(doc_keys)
    spark = docs.sparkSession
    path = path or shared_path(spark, f"tables/inverted-{uuid.uuid4().hex[:16]}")
    src = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keys)], search_terms(F.coalesce(F.col(doc_text), F.lit(""))).alias("t"))
    names = [f"k{i}" for i in range(len(keys))]
    ints = T.ArrayType(T.IntegerType())
    schema = T.StructType(
        [T.StructField("block", T.LongType()), T.StructField("place", T.IntegerType()), *[T.StructField(c, src.schema[c].dataType) for c in names], T.StructField("term", T.StringType()),
         T.StructField("places", ints), T.StructField("tfs", ints), T.StructField("lens", ints), T.StructField("max_tf", T.IntegerType()),
         T.StructField("min_len", T.IntegerType()), T.StructField("len", T.IntegerType()), T.StructField("folder", T.IntegerType())]
    )
    arrow = to_arrow_schema(schema)
    known = None
    if only is not None:
        terms, small = bounded_broadcast(only.select("term"))
        known = spark.sparkContext.broadcast([r["term"] for r in terms.collect()]) if small else None

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 33
        wanted = None if known is None else pa.array(known.value, pa.string())
        for batch in batches:
            at = batch.column("t").offsets.to_numpy()
            s = 0
            while s < batch.num_rows:
                e = max(s + 1, int(np.searchsorted(at, at[s] + block_terms, "right")) - 1)
                yield from _block(batch.slice(s, e - s), block, names, arrow, wanted)
                block, s = block + 1, e

    src.mapInArrow(build, schema).write.partitionBy("folder").parquet(f"{path}/rows")
    size = spark.read.parquet(f"{path}/rows").where("folder = -1").agg(F.count(F.lit(1)).alias("n"), F.avg("len").alias("a")).first()
    meta = {"keys": keys, "n_docs": int(size["n"]), "avg_len": float(size["a"] or 0.0) or 1.0}
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.json(f"{path}/meta")
    return InvertedIndex(spark, path, **meta)


def open_inverted(spark: SparkSession, path: str) -> InvertedIndex:
    return InvertedIndex(spark, path, **json.loads(spark.read.schema("meta string").json(f"{path}/meta").first()["meta"]))


def _block(part: pa.RecordBatch, block: int, names: list[str], schema: pa.Schema, wanted: pa.Array | None) -> Iterator[pa.RecordBatch]:
    """The head rows of a block, in the order of the keys, and its postings
    (of the ``wanted`` terms)."""
    n = part.num_rows
    ranks = [pd.factorize(part.column(c).to_pandas(), sort=True)[0] for c in names]
    part = part.take(pa.array(np.lexsort(ranks[::-1])))
    t = part.column("t")
    lens = np.diff(t.offsets.to_numpy())
    coded = t.flatten().dictionary_encode()
    term, place = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.repeat(np.arange(n), lens)
    if wanted is not None:
        kept = pc.is_in(coded.dictionary, wanted).to_numpy(zero_copy_only=False)[term]
        term, place = term[kept], place[kept]
    key, tf = np.unique(term * n + place, return_counts=True)
    term, place = key // n, key % n
    cut = np.concatenate([[0], np.flatnonzero(np.diff(term)) + 1]) if len(term) else np.zeros(0, np.int64)
    words = coded.dictionary.take(pa.array(term[cut])) if len(term) else pa.array([], pa.string())
    at = pa.array(np.concatenate([cut, [len(term)]]).astype(np.int32))

    def row_batch(rows: int, given: dict[str, pa.Array]) -> pa.RecordBatch:
        cols = [given[f.name].cast(f.type) if f.name in given else pa.nulls(rows, f.type) for f in schema]
        return pa.RecordBatch.from_arrays(cols, schema=schema)

    def full(rows: int, value: int) -> pa.Array:
        return pa.array(np.full(rows, value))

    yield row_batch(n, {"block": full(n, block), "place": pa.array(np.arange(n)), "len": pa.array(lens), "folder": full(n, -1)} | {c: part.column(c) for c in names})
    if len(cut):
        m = len(cut)
        folders = [zlib.crc32(w.encode()) % FOLDERS for w in words.to_pylist()]
        yield row_batch(m, {
            "block": full(m, block), "term": words, "folder": pa.array(folders, pa.int32()),
            "max_tf": pa.array(np.maximum.reduceat(tf, cut)), "min_len": pa.array(np.minimum.reduceat(lens[place], cut)),
            **{c: pa.ListArray.from_arrays(at, pa.array(x.astype(np.int32))) for c, x in (("places", place), ("tfs", tf), ("lens", lens[place]))},
        })


def _score_block(avg: float, k: int, k1: float, b: float, schema: pa.Schema):
    """Scores of some queries over one block, the k best of each."""
    from corpusflow.operators.retrieval import best_rounded

    def run(queries: pa.Table, post: pa.Table) -> pa.Table:
        index: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        size = 0
        cols = [post.column(c).combine_chunks() for c in ("places", "tfs", "lens")]
        values = [c.values.to_numpy(zero_copy_only=False) for c in cols]
        offsets = cols[0].offsets.to_numpy() if post.num_rows else np.zeros(1, np.int64)
        for i, term in enumerate(post.column("term").to_pylist()):
            place, tf, length = (v[offsets[i] : offsets[i + 1]] for v in values)
            index.setdefault(term, []).append((place, tf * (k1 + 1.0) / (tf + k1 * ((1.0 - b) + b * length / avg))))
            size = max(size, int(place[-1]) + 1)
        rows, places, scores = [], [], []
        for i, terms in enumerate(queries.column("terms").to_pylist()):
            acc = np.zeros(size)
            for t in sorted(terms, key=lambda t: t["term"]):
                for place, share in index.get(t["term"], ()):
                    acc[place] += t["w"] * share
            hit = np.flatnonzero(acc > 0)
            sel = hit[best_rounded(acc[hit], [hit], k)]
            rows.append(np.full(len(sel), i))
            places.append(sel)
            scores.append(acc[sel])
        at = pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int64))
        return pa.table(
            [queries.column("query").take(at), queries.column("block").take(at), pa.array(np.concatenate(places).astype(np.int32)), pa.array(np.concatenate(scores))]
            if rows else [pa.array([], f.type) for f in schema],
            schema=schema,
        )

    return run
