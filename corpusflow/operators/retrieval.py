"""Retrieval over a table of queries.

Fixed definitions (SURVEY §2.0):
* score = (1 + cosine) / 2, rounded to 6 decimals; ties by id ascending.
* BM25 (Robertson): k1 = 1.2, b = 0.75, idf = ln(1 + (N - df + 0.5) / (df + 0.5)),
  terms = lower-cased letter/digit runs, each distinct query term counted once.
* RRF (Cormack 2009): sum of 1 / (60 + rank), 1-based ranks, 50 candidates per list.

Physical plan:
* BM25 asks an inverted index (``operators.inverted``): postings in blocks with
  bounds, a query scores the block of its best bound first and skips blocks
  that cannot reach the k-th score; k rows per query and block are shuffled.
* Vector top-k asks a metric index (``operators.vector_index``): balls around
  pivots, a query asks its nearest ball first and skips balls that cannot reach
  the k-th score; a task multiplies a block of a ball with a group of queries.
* Both select by the rounded score with ties by id, and give ids of any type.
* Top-k per query uses ``row_number() <= k``, which Spark plans as a partial
  WindowGroupLimit before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusflow.functions.text import is_blank, search_terms
from corpusflow.operators.inverted import BLOCK_TERMS, InvertedIndex, build_inverted
from corpusflow.operators.vector_index import BALL_CELLS, BLOCK_CELLS, QUERY_GROUP, VectorIndex, build_vector_index
from corpusflow.plans.strategy import MAX_BROADCAST_ROWS, bounded_broadcast, dense_position, materialize

# Fixed values.
BM25_K1, BM25_B = 1.2, 0.75
RRF_K = 60
RRF_CANDIDATES = 50
DEFAULT_TOP_K = 5
NO_CONTEXT = "No relevant context found."
SCORE_DECIMALS = 6


def _ids(cols: str | Sequence[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def top_k(df: DataFrame, part: Sequence[str], score: str, ids: Sequence[str], k: int) -> DataFrame:
    """Rows ranked per ``part`` by score desc, ids asc; ``rank`` 1..k."""
    w = Window.partitionBy(*part).orderBy(F.col(score).desc(), *[F.col(c).asc() for c in ids])
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


# --------------------------------------------------------------------------- BM25


def query_terms(queries: DataFrame, query_id: str = "query_id", text: str = "text") -> DataFrame:
    """(query_id, term): distinct search terms of each query."""
    return queries.where(~is_blank(text)).select(
        query_id, F.explode(F.array_distinct(search_terms(text))).alias("term")
    )


def _doc_terms(docs: DataFrame, keys: list[str], doc_text: str, qt: DataFrame, max_terms: int) -> DataFrame:
    """(keys, dl, _t): length and terms of every document, written once. A null
    text is an empty document. Up to ``max_terms`` distinct query terms, the
    others are left out of ``_t``; that saves space and changes no score."""
    d = docs.select(*keys, search_terms(F.coalesce(F.col(doc_text), F.lit(""))).alias("_t"))
    terms = qt.select("term").distinct().limit(max_terms + 1).collect()
    kept = F.col("_t")
    if len(terms) <= max_terms:
        wanted = [r["term"] for r in terms]
        kept = F.filter("_t", lambda t: t.isin(wanted)) if wanted else F.array().cast("array<string>")
    return materialize(d.select(*keys, F.size("_t").alias("dl"), kept.alias("_t")), "bm25-terms")


def _corpus_stats(compact: DataFrame) -> tuple[int, float]:
    st = compact.agg(F.count(F.lit(1)).alias("n"), F.avg("dl").alias("avgdl")).first()
    return int(st["n"]), float(st["avgdl"] or 0.0) or 1.0


def _doc_freq(compact: DataFrame) -> DataFrame:
    return compact.select(F.explode(F.array_distinct("_t")).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def bm25_scores(
    queries: DataFrame,
    docs: DataFrame,
    query_id: str = "query_id",
    query_text: str = "text",
    doc_keys: str | Sequence[str] = ("doc_id", "chunk_index"),
    doc_text: str = "content",
    k1: float = BM25_K1,
    b: float = BM25_B,
    max_terms: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Every (query, document) pair that shares a term, with its score: the
    whole relation, as large as it is. For the best k use ``bm25_topk``.

    The joins on ``term`` are plain equi-joins, so a hot term is split by
    adaptive execution."""
    keys = _ids(doc_keys)
    qt = query_terms(queries, query_id, query_text)
    compact = _doc_terms(docs, keys, doc_text, qt, max_terms)
    n_docs, avgdl = _corpus_stats(compact)
    row = compact.withColumn("_row", F.monotonically_increasing_id())
    post = row.select("_row", *keys, "dl", F.explode("_t").alias("term")).groupBy("_row", *keys, "dl", "term").agg(F.count(F.lit(1)).alias("tf"))
    idf = F.log(F.lit(1.0) + (F.lit(n_docs) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    norm = F.lit(k1) * (F.lit(1.0 - b) + F.lit(b) * F.col("dl") / F.lit(avgdl))
    contrib = idf * F.col("tf") * F.lit(k1 + 1.0) / (F.col("tf") + norm)
    scored = post.join(_doc_freq(compact), "term").join(qt, "term").select(query_id, "_row", *keys, contrib.alias("_c"))
    return scored.groupBy(query_id, "_row", *keys).agg(F.round(F.sum("_c"), SCORE_DECIMALS).alias("score")).drop("_row")


def _round(x: np.ndarray) -> np.ndarray:
    """Half-up rounding of the shortest decimal form, as ``F.round`` does."""
    uniq, inv = np.unique(x, return_inverse=True)
    step = Decimal(1).scaleb(-SCORE_DECIMALS)
    return np.array([float(Decimal(repr(float(v))).quantize(step, ROUND_HALF_UP)) for v in uniq])[inv]


def best_rounded(score: np.ndarray, order: list[np.ndarray], k: int) -> np.ndarray:
    """Indices of the k best by rounded score descending, then by ``order``."""
    cand = np.arange(len(score))
    if len(score) > k:
        # Rounding moves a score by at most half a unit of the last decimal.
        kth = np.partition(score, len(score) - k)[len(score) - k]
        cand = np.flatnonzero(score >= kth - 2.0 * 10.0**-SCORE_DECIMALS)
    rounded = _round(score[cand])
    return cand[np.lexsort((*[o[cand] for o in reversed(order)], -rounded))[:k]]


def id_ranks(pdf: pd.DataFrame, cols: Sequence[str]) -> list[np.ndarray]:
    """Sort positions of id columns of any type (nulls first)."""
    return [pd.factorize(pdf[c], sort=True)[0] for c in cols]


def bm25_topk(
    queries: DataFrame,
    docs: DataFrame | InvertedIndex,
    k: int = DEFAULT_TOP_K,
    query_id: str = "query_id",
    query_text: str = "text",
    doc_keys: str | Sequence[str] = ("doc_id", "chunk_index"),
    doc_text: str = "content",
    k1: float = BM25_K1,
    b: float = BM25_B,
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """k best documents per query by BM25; ids of any type, null texts are
    empty documents, a document without a common term is no hit.

    ``docs`` is a table, which is indexed first, or an index that
    ``build_inverted`` wrote. Exact: a block of documents is left out for a
    query only if its bound stays below the k-th score already found. Queries
    stay in Spark; a task holds one block's postings and a group of queries.
    """
    keys = docs.keys if isinstance(docs, InvertedIndex) else _ids(doc_keys)
    pairs = materialize(query_terms(queries, query_id, query_text), "query-terms")
    if isinstance(docs, InvertedIndex):
        index = docs
    else:
        index = build_inverted(docs, keys, doc_text, block_terms=block_terms, only=pairs.select("term").distinct())
    found = index.topk(pairs, k, k1, b, query_id)
    return top_k(found.withColumn("score", F.round("score", SCORE_DECIMALS)), [query_id], "score", keys, k)


def match_text(
    queries: DataFrame,
    docs: DataFrame,
    query_id: str = "query_id",
    query_text: str = "text",
    doc_keys: str | Sequence[str] = "doc_id",
    doc_text: str = "text",
) -> DataFrame:
    """documents holding every term of the query (relational division).

    Without (query, document) pairs for common words: a document can only
    match if it holds the query's rarest term, so candidates come from that
    one term (at most its document frequency per query); each candidate is
    then checked against the query's other terms with an equi-join on
    (document, term). A query with a term no document holds matches nothing.
    """
    keys = _ids(doc_keys)
    qt = query_terms(queries, query_id, query_text)
    need = qt.groupBy(query_id).agg(F.count(F.lit(1)).alias("_need"))
    term_set, _ = bounded_broadcast(qt.select("term").distinct())
    dt = docs.select(*keys, F.explode(F.array_distinct(search_terms(doc_text))).alias("term")).join(term_set, "term", "left_semi")
    dt = materialize(dt, "match-terms")
    dfreq = dt.groupBy("term").agg(F.count(F.lit(1)).alias("_df"))
    q = qt.join(dfreq, "term")
    rare = q.groupBy(query_id).agg(F.min_by("term", F.struct("_df", "term")).alias("term"), F.count(F.lit(1)).alias("_known"))
    rare = rare.join(need, query_id).where(F.col("_known") == F.col("_need")).select(query_id, "term", "_need")
    rare, _ = bounded_broadcast(rare)
    cand = dt.join(rare, "term").select(query_id, *keys, "_need")
    check = cand.join(qt, query_id).select(query_id, *keys, "_need", "term").join(dt, [*keys, "term"], "left_semi")
    hits = check.groupBy(query_id, *keys, "_need").agg(F.count(F.lit(1)).alias("_have"))
    return hits.where(F.col("_have") == F.col("_need")).select(query_id, *keys)


# --------------------------------------------------------------------------- vectors


def vector_topk(
    queries: DataFrame,
    index: DataFrame | VectorIndex,
    k: int = DEFAULT_TOP_K,
    query_id: str = "query_id",
    query_vec: str = "embedding",
    id_col: str | Sequence[str] = "vec_id",
    vec_col: str = "embedding",
    ball_cells: int = BALL_CELLS,
    block_cells: int = BLOCK_CELLS,
    query_rows: int = QUERY_GROUP,
) -> DataFrame:
    """F1: exact k nearest vectors per query by cosine; score = (1+cos)/2.

    Output: query_id, id columns, score, rank. Ids keep their type; vectors of
    another dimension than the query's never match; null, empty and non-finite
    vectors take no part; a zero vector scores 0.5.

    ``index`` is a table, which is indexed first, or an index that
    ``build_vector_index`` wrote. Exact: a ball is left out for a query only if
    its bound stays below the k-th score that the query's nearest ball gave.
    """
    if k < 1:
        raise ValueError("k must be >= 1")
    if not isinstance(index, VectorIndex):
        index = build_vector_index(index, _ids(id_col), vec_col, ball_cells=ball_cells, block_cells=block_cells)
    found = index.topk(queries, k, query_id, query_vec, query_rows)
    return top_k(found.withColumn("score", F.round("score", SCORE_DECIMALS)), [query_id], "score", index.ids, k)


# --------------------------------------------------------------------------- fusion


def rrf_fuse(
    ranked: DataFrame,
    k: int = DEFAULT_TOP_K,
    query_id: str = "query_id",
    id_cols: str | Sequence[str] = "id",
    list_col: str = "list",
    rank_col: str = "rank",
    list_order: Sequence[str] = ("vector", "keyword"),
    keep: Sequence[str] = (),
) -> DataFrame:
    """fuse ranked lists by RRF; ``hybrid_sources`` keeps which lists found
    each hit, in ``list_order``; of the ``keep`` columns the largest value."""
    ids = _ids(id_cols)
    order = F.create_map(*[x for i, name in enumerate(list_order) for x in (F.lit(name), F.lit(i))])
    fused = ranked.groupBy(query_id, *ids).agg(
        F.round(F.sum(F.lit(1.0) / (F.lit(RRF_K) + F.col(rank_col))), SCORE_DECIMALS).alias("rrf_score"),
        F.sort_array(F.collect_set(F.struct(F.coalesce(order[F.col(list_col)], F.lit(len(list_order))).alias("o"), F.col(list_col).alias("n")))).alias("_src"),
        *[F.max(c).alias(c) for c in keep],
    )
    fused = fused.select(query_id, *ids, "rrf_score", F.col("_src.n").alias("hybrid_sources"), *keep)
    return top_k(fused, [query_id], "rrf_score", ids, k)


def hybrid_search(
    queries: DataFrame,
    chunks: DataFrame,
    k: int = DEFAULT_TOP_K,
    query_id: str = "query_id",
    query_text: str = "text",
    query_vec: str = "embedding",
    doc_keys: Sequence[str] = ("doc_id", "chunk_index"),
    doc_text: str = "content",
    doc_vec: str = "embedding",
    candidates: int = RRF_CANDIDATES,
) -> DataFrame:
    """the best ``max(candidates, k)`` by vectors and by BM25, fused by RRF;
    the cosine score of a hit is kept when the vector list found it. The key
    columns keep their types. The short lists are united and grouped once."""
    keys = list(doc_keys)
    n = max(candidates, k)
    vec = vector_topk(queries, chunks, n, query_id, query_vec, keys, doc_vec)
    kw = bm25_topk(queries, chunks, n, query_id, query_text, keys, doc_text)
    ranked = vec.select(query_id, *keys, F.lit("vector").alias("list"), "rank", "score").unionByName(
        kw.select(query_id, *keys, F.lit("keyword").alias("list"), "rank", F.lit(None).cast("double").alias("score"))
    )
    return rrf_fuse(ranked, k, query_id, keys, keep=["score"]).select(
        query_id, "rank", *keys, "rrf_score", "score", "hybrid_sources", F.lit(True).alias("hybrid_search")
    )


# --------------------------------------------------------------------------- context


def expand_parents(hits: DataFrame, query_id: str = "query_id", source: str = "doc_id") -> DataFrame:
    """a hierarchical hit stands for its parent; one row per distinct
    parent (or plain chunk), keeping the best rank."""
    is_h = F.coalesce(F.col("is_hierarchical"), F.lit(False))
    unit = F.when(is_h, F.col("parent_index")).otherwise(F.col("chunk_index"))
    h = hits.select(
        query_id,
        source,
        F.when(is_h, F.lit("parent")).otherwise(F.lit("chunk")).alias("unit_kind"),
        unit.alias("unit_index"),
        F.when(is_h, F.col("parent_text")).otherwise(F.col("content")).alias("context"),
        "rank",
    )
    w = Window.partitionBy(query_id, source, "unit_kind", "unit_index").orderBy("rank")
    return h.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def assemble_context(
    hits: DataFrame,
    queries: DataFrame,
    query_id: str = "query_id",
    text_col: str = "context",
    max_chars: int | None = None,
) -> DataFrame:
    """hits in rank order as one grounding text per query; queries with no
    hit get a fixed message. With ``max_chars``, hits are kept while the
    running length stays within the budget. A group is at most k hits."""
    h = hits.select(query_id, "rank", F.concat(F.lit("["), F.col("rank").cast("string"), F.lit("] "), F.col(text_col)).alias("_t"))
    if max_chars is not None:
        w = Window.partitionBy(query_id).orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
        h = h.withColumn("_run", F.sum(F.length("_t") + F.lit(2)).over(w)).where(F.col("_run") - F.lit(2) <= max_chars)
    g = h.groupBy(query_id).agg(
        F.array_join(F.sort_array(F.collect_list(F.struct("rank", "_t"))).getField("_t"), "\n\n").alias("context"),
        F.count(F.lit(1)).alias("chunks_retrieved"),
    )
    q = queries.select(query_id).distinct()
    return q.join(g, query_id, "left").select(
        query_id,
        F.coalesce("context", F.lit(NO_CONTEXT)).alias("context"),
        F.coalesce("chunks_retrieved", F.lit(0)).cast("long").alias("chunks_retrieved"),
    )


def history_window(conversations: DataFrame, exchanges: int = 3, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """F8: for every user turn, the last ``exchanges`` exchanges (2 messages
    each, system messages left out) before it, as ``role: text`` lines.

    Skew-safe: messages get their position in the conversation from
    ``dense_position`` (no conversation is gathered in one task); each
    message is offered to the next 2 x exchanges positions, and user turns
    pick them up with an equi-join on (conversation, position), a key no
    larger than 2 x exchanges rows.
    """
    n = 2 * exchanges
    msgs = conversations.where(F.col("role") != "system").select(conv, turn, "role", "text")
    pos = dense_position(msgs, [conv], [turn], "_p")
    back = pos.select(
        F.col(conv).alias("_c"), F.col("_p").alias("_src"),
        F.concat(F.col("role"), F.lit(": "), F.col("text")).alias("_line"),
        F.explode(F.sequence(F.lit(1), F.lit(n))).alias("_j"),
    ).select("_c", (F.col("_src") + F.col("_j")).alias("_target"), "_j", "_line")
    users = pos.where(F.col("role") == "user").select(conv, turn, F.col("text").alias("query"), "_p")
    j = users.join(back, (F.col(conv) == F.col("_c")) & (F.col("_p") == F.col("_target")), "left")
    g = j.groupBy(conv, turn, "query").agg(
        F.sort_array(F.collect_list(F.when(F.col("_j").isNotNull(), F.struct((-F.col("_j")).alias("o"), F.col("_line").alias("l"))))).alias("_h")
    )
    return g.select(
        conv, turn, "query",
        F.array_join(F.col("_h.l"), "\n").alias("history"),
        F.size("_h").cast("long").alias("history_messages"),
    )


def present_hits(hits: DataFrame, chars: int = 500) -> DataFrame:
    """the shown score (rrf_score, else score), a preview and a source."""
    cols = hits.columns
    shown = F.coalesce(F.col("rrf_score"), F.col("score")) if "rrf_score" in cols else F.col("score")
    if "metadata" in cols:
        src = F.coalesce(F.nullif(F.col("metadata")["url"], F.lit("")), F.col("metadata")["source"], F.lit(""))
    elif "url" in cols:
        src = F.coalesce(F.col("url"), F.lit(""))
    else:
        src = F.coalesce(F.col("source"), F.lit("")) if "source" in cols else F.lit("")
    return hits.withColumn("shown_score", F.round(shown, 4)).withColumn(
        "preview", F.substring(F.col("text") if "text" in cols else F.col("content"), 1, chars)
    ).withColumn("source_label", src)
