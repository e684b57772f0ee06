"""Ranked lexical search by pipelined term partitioning.

Documents are cut into blocks; a posting row holds one term of one block. The
terms of the queries are dealt to owners by weight, the rarest to the first.
Queries travel in bundles: for every block a bundle carries sparse integer
accumulators (document -> score) through the owners one after the other, and
meets an owner's postings by a cogroup on (block, bundle). After each owner an
accumulator is dropped when even the largest contributions of the owners to
come cannot lift it to the block's current k-th score; the best k of each block
are ranked at the end.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusflow.llm.common import BLOCK_CHARS
from corpusflow.plans.strategy import fits_broadcast, materialize
from corpusflow.session import shared_path

#: Owners (stages of the pipeline) and queries of a bundle.
OWNERS = 4
BUNDLE = 256
#: A query vocabulary up to this size goes to the tasks that read documents.
VOCABULARY_ROWS = 1_000_000
VOCABULARY_BYTES = 64_000_000

_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)
_POSTING = "block long, term string, docs array<int>, tfs array<long>, lens array<long>, ids array<long>"
_STATE = "block long, bundle long, item long, docs array<int>, scores array<long>"


def terms_of(text: bytes | None) -> list[bytes]:
    """Maximal runs of letters, digits and non-ASCII characters, A-Z lowered."""
    return text.translate(_WORD_BYTES).split() if text else []


def _lists(column: pa.ChunkedArray) -> list[np.ndarray]:
    a = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    at, values = a.offsets.to_numpy(), a.values.to_numpy(zero_copy_only=False)
    return [values[s:e] for s, e in zip(at[:-1], at[1:])]


def _list_array(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    at = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    values = np.concatenate(parts) if parts else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(values, kind))


def _block_rows(block: int, ids: list, texts: list, vocabulary: dict[bytes, int] | None, words: list[bytes]) -> pa.RecordBatch:
    """The head row (ids and lengths, by ascending id) and one row per term."""
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))
    lens, term_at, doc_at = [], [], []
    own: dict[bytes, int] = {}
    for pos, i in enumerate(order):
        terms = terms_of(texts[i])
        lens.append(len(terms))
        if vocabulary is None:
            found = np.fromiter((own.setdefault(t, len(own)) for t in terms), np.int64, len(terms))
        else:
            found = np.fromiter(map(vocabulary.get, terms, repeat(-1)), np.int64, len(terms))
            found = found[found >= 0]
        if len(found):
            term_at.append(found)
            doc_at.append(np.full(len(found), pos))
    lens = np.array(lens, np.int64)
    rows = len(ids)
    key = np.concatenate(term_at) * rows + np.concatenate(doc_at) if term_at else np.zeros(0, np.int64)
    key, tf = np.unique(key, return_counts=True)
    term, doc = key // max(rows, 1), key % max(rows, 1)
    cut = np.flatnonzero(np.diff(term)) + 1
    names = list(own) if vocabulary is None else words
    parts = [x for x in np.split(np.arange(len(key)), cut) if len(x)]
    empty = np.zeros(0, np.int64)
    n = len(parts)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([block] * (n + 1), pa.int64()),
            pa.array([None, *(names[term[p[0]]].decode("utf-8", "replace") for p in parts)], pa.string()),
            _list_array([empty, *(doc[p] for p in parts)], pa.int32()),
            _list_array([empty, *(tf[p] for p in parts)], pa.int64()),
            _list_array([lens, *(lens[doc[p]] for p in parts)], pa.int64()),
            pa.array([[ids[i] for i in order], *[None] * n], pa.list_(pa.int64())),
        ],
        ["block", "term", "docs", "tfs", "lens", "ids"],
    )


def postings(docs: DataFrame, vocabulary: list[bytes] | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per block of documents a head row (null term: ``ids`` and ``lens`` of all
    its documents) and a row per term (``docs`` are places in the head, with
    ``tfs`` and ``lens``), for the terms of ``vocabulary`` or for all (None).
    A block is what one task reads at once, at most ``BLOCK_CHARS`` bytes of
    text unless a single text is longer. The rows are written once, so the
    numbering of the blocks is the same for every reader."""
    words = vocabulary or []
    known = None if vocabulary is None else docs.sparkSession.sparkContext.broadcast({w: i for i, w in enumerate(words)})
    listed = docs.sparkSession.sparkContext.broadcast(words)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 33
        lookup = None if known is None else known.value
        ids, texts, size = [], [], 0
        for batch in batches:
            for i, t in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                if ids and size + len(t or b"") > BLOCK_CHARS:
                    yield _block_rows(block, ids, texts, lookup, listed.value)
                    block, ids, texts, size = block + 1, [], [], 0
                ids.append(i), texts.append(t)
                size += len(t or b"")
            if ids:  # a block ends with its batch, so empty texts cannot pile up
                yield _block_rows(block, ids, texts, lookup, listed.value)
                block, ids, texts, size = block + 1, [], [], 0

    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    return materialize(src.mapInArrow(read, _POSTING), "postings")


def query_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct (``item``, ``term``); rows that share an id are one item."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, t in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist()):
                terms = sorted(set(terms_of(t)))
                if terms:
                    text = pa.array([w.decode("utf-8", "replace") for w in terms], pa.string())
                    yield pa.RecordBatch.from_arrays([pa.array([i] * len(terms), pa.int64()), text], ["item", "term"])

    src = items.select(F.col(id_col).cast("long").alias("item"), F.col(text_col).cast("string").cast("binary").alias("text"))
    return src.where("item is not null").mapInArrow(read, "item long, term string").distinct()


def stage(n_docs: int, n_words: int, k: int):
    """The work of one owner on one bundle and block."""

    def run(state: pa.Table, met: pa.Table) -> pa.Table:
        sums: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for item, d, s in zip(state.column("item").to_pylist(), _lists(state.column("docs")), _lists(state.column("scores"))):
            sums[item] = [(d, s)]
        rest: dict[int, int] = {}
        arrays = (_lists(met.column(c)) for c in ("docs", "tfs", "lens"))
        for weight, users, doc, tf, n in zip(met.column("weight").to_pylist(), met.column("users").to_pylist(), *arrays):
            m = 10 + (90 * n * n_docs) // n_words
            score = weight * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
            for u in users:
                sums.setdefault(u["item"], []).append((doc, score))
                rest[u["item"]] = u["rest"]
        items, docs, scores = [], [], []
        for item, parts in sums.items():
            doc, score = parts[0]
            if item in rest:
                acc = np.zeros(max(int(d[-1]) if len(d) else 0 for d, _ in parts) + 1, np.int64)
                for d, s in parts:  # places are ascending and distinct within a part
                    acc[d] += s
                doc = np.flatnonzero(acc)
                score = acc[doc]
                if len(doc) > k:
                    kth = np.partition(score, -k)[-k]
                    stay = np.flatnonzero(score + rest[item] >= kth)
                    if rest[item] == 0 and len(stay) > k:  # ties go by place, which is by id
                        stay = np.sort(stay[np.argsort(-score[stay], kind="stable")[:k]])
                    doc, score = doc[stay], score[stay]
            if len(doc):
                items.append(item), docs.append(doc), scores.append(score)
        source = met if met.num_rows else state
        key = [source.column(c)[0].as_py() for c in ("block", "bundle")] if source.num_rows else [0, 0]
        return pa.table(
            [
                pa.array([key[0]] * len(items), pa.int64()), pa.array([key[1]] * len(items), pa.int64()), pa.array(items, pa.int64()),
                _list_array(docs, pa.int32()), _list_array(scores, pa.int64()),
            ],
            ["block", "bundle", "item", "docs", "scores"],
        )

    return run


def ranked_search(
    docs: DataFrame, items: DataFrame, k: int = 10, owners: int = OWNERS, bundle: int = BUNDLE,
    vocabulary_rows: int = VOCABULARY_ROWS, doc_id: str = "doc_id", item_id: str = "item_id", text_col: str = "text",
) -> DataFrame:
    """``item_id``, ``rank`` (from 1), ``doc_id``, ``score`` of the ``k``
    documents with the highest score above 0 for every item, equal scores by
    ascending id. Weights and scores are those of the contract, in integers.

    Defined cases: a null or empty text has no terms; every row of ``docs`` is a
    document of its own, also where an id repeats; a document without an id
    counts and ranks behind equal scores with one; items without an id take no
    part, rows of ``items`` that share an id are one item; items without terms,
    or whose terms no document holds, and empty tables give no rows; other
    columns are ignored.

    The query vocabulary goes to the tasks up to ``vocabulary_rows`` and 64 MB
    (measured); beyond that all terms are posted and a join keeps those asked.
    """
    spark = docs.sparkSession
    none = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    asked = materialize(query_terms(items, item_id, text_col), "asked")
    vocabulary = materialize(asked.select("term").distinct(), "vocabulary")
    small = fits_broadcast(vocabulary, vocabulary_rows, VOCABULARY_BYTES)
    listed = sorted(r["term"].encode() for r in vocabulary.collect()) if small else None
    posted = postings(docs, listed, doc_id, text_col)
    heads = posted.where("term is null")
    total = heads.agg(
        F.sum(F.size(F.filter("lens", lambda x: x > 0))).alias("n"), F.sum(F.aggregate("lens", F.lit(0).cast("long"), lambda a, x: a + x)).alias("l")
    ).first()
    n_docs, n_words = total["n"] or 0, total["l"] or 0
    if not n_words:
        return none
    posted = posted.where("term is not null")
    if not small:
        posted = posted.join(vocabulary, "term", "left_semi")
    share = F.expr(
        "array_max(zip_with(tfs, lens, (t, n) -> (1000000000L * t) div "
        f"(1000L * t + 8L * (10L + (90L * n * {n_docs}L) div {n_words}L))))"
    )
    weight = F.floor(1000 * F.log((2.0 * n_docs + 2) / (2.0 * F.col("df") + 1))).cast("long")
    terms = posted.groupBy("term").agg(F.sum(F.size("docs")).alias("df"), F.max(share).alias("share"))
    terms = terms.select("term", weight.alias("weight"), (weight * F.col("share")).alias("most"))
    most = int(1000 * np.log((2 * n_docs + 2) / 3)) + 1
    owner = F.least(F.lit(owners - 1), F.floor(F.lit(owners) * (F.lit(most) - F.col("weight")) / F.lit(most + 1)).cast("int"))
    # What the owners after this one can add to an item at most.
    later = Window.partitionBy("item").orderBy(-F.col("owner")).rangeBetween(Window.unboundedPreceding, -1)
    n_items = asked.select("item").distinct().count()
    group = F.pmod(F.xxhash64("item"), F.lit(-(-n_items // bundle)))
    users = asked.join(terms.withColumn("owner", owner), "term").withColumn("rest", F.coalesce(F.sum("most").over(later), F.lit(0)))
    users = users.withColumn("bundle", group).groupBy("term", "bundle").agg(
        F.first("weight").alias("weight"), F.first("owner").alias("owner"), F.collect_list(F.struct("item", "rest")).alias("users")
    )
    users = materialize(users, "users")
    if fits_broadcast(users, vocabulary_rows):
        users = F.broadcast(users)
    path = shared_path(spark, f"tables/owners-{uuid.uuid4().hex[:16]}")
    met = posted.join(users, "term").select("owner", "block", "bundle", "weight", "users", "docs", "tfs", "lens")
    met.write.partitionBy("owner").parquet(path)
    state = spark.createDataFrame([], _STATE)
    for p in range(owners):
        here = spark.read.schema(met.schema).parquet(path).where(F.col("owner") == p).drop("owner")
        keys = ["block", "bundle"]
        state = state.groupBy(*keys).cogroup(here.groupBy(*keys)).applyInArrow(stage(n_docs, n_words, k), _STATE)
    found = state.select("block", "item", F.explode(F.arrays_zip("docs", "scores")).alias("x")).select("block", "item", "x.*")
    found = found.join(heads.select("block", "ids"), "block").select(
        "item", F.col("ids")[F.col("docs")].alias("doc_id"), F.col("scores").alias("score")
    )
    best = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select(F.col("item").alias("item_id"), "rank", "doc_id", "score")
