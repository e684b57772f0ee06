"""Chunking and retrieval against plain Python / numpy on small data."""

import math
import re
import tempfile
from collections import Counter


import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusflow.operators import chunking as ch
from corpusflow.operators import index as ix
from corpusflow.operators import inverted
from corpusflow.operators import retrieval as rt
from corpusflow.operators import vector_index as vi
from corpusflow.operators.inverted import build_inverted, open_inverted
from tests.conftest import SF_SMALL


def py_windows(text, size, overlap):
    toks = re.sub(r"[ \t\n\r\f]+", " ", text).strip(" ").split(" ")
    if toks == [""]:
        return []
    step, last = size - overlap, max(len(toks) - overlap - 1, 0)
    return [" ".join(toks[s:s + size]) for s in range(0, last + 1, step)]


@pytest.mark.parametrize("size,overlap", [(512, 50), (64, 0), (100, 99)])
def test_chunk_windows(spark, size, overlap):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(-1, "   \n\t "), (-2, "one"), (-3, "a  b\tc\n" * 40)], "doc_id long, text string")
    docs = docs.unionByName(extra)
    got = {}
    for r in ch.chunk_text(docs, "doc_id", "text", size, overlap).collect():
        got.setdefault(r.doc_id, []).append((r.chunk_index, r.content, r.token_estimate))
    for d in docs.collect():
        want = py_windows(d.text, size, overlap)
        mine = sorted(got.get(d.doc_id, []))
        assert [c for _, c, _ in mine] == want, d.doc_id
        assert [i for i, _, _ in mine] == list(range(len(want)))
        assert all(t == len(c) // 4 for _, c, t in mine)


def test_chunk_validation():
    with pytest.raises(ValueError):
        ch._check(32, 0)
    with pytest.raises(ValueError):
        ch._check(512, 512)


def test_hierarchical_children_cover_parents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    kids = ch.chunk_hierarchical(docs, "doc_id", "text", 512, 128, 50).collect()
    by_parent = {}
    for k in kids:
        by_parent.setdefault((k.doc_id, k.parent_index), []).append(k)
    for (_, _), ks in by_parent.items():
        ks.sort(key=lambda k: k.chunk_index)
        assert " ".join(k.content for k in ks) == ks[0].parent_text
        assert all(k.is_hierarchical for k in ks)


def test_reassemble_and_cap(spark):
    df = spark.createDataFrame([(1, 0, " a "), (1, 1, "b"), (2, 0, "c")], "doc_id long, chunk_index int, content string")
    assert sorted((r.doc_id, r.text) for r in ch.reassemble(df).collect()) == [(1, "a \n\nb"), (2, "c")]
    capped = ch.cap_chunks(spark.range(25).select(F.lit(1).alias("doc_id"), F.col("id").cast("int").alias("chunk_index")), 10)
    assert Counter(r.request_index for r in capped.collect()) == {0: 10, 1: 10, 2: 5}


def test_contextualize(spark):
    chunks = spark.createDataFrame([(1, 0, "x"), (1, 1, "y"), (2, 0, "z")], "doc_id long, chunk_index int, content string")
    ctx = spark.createDataFrame([(1, 0, "C"), (1, 1, "  ")], "doc_id long, chunk_index int, context string")
    got = {(r.doc_id, r.chunk_index): (r.content, r.context, r.original_text) for r in ch.contextualize(chunks, ctx).collect()}
    assert got == {(1, 0): ("Context: C\n\nx", "C", "x"), (1, 1): ("y", None, None), (2, 0): ("z", None, None)}


def terms(t):
    return [x for x in re.split(r"[^\w]+|_+", t.lower()) if x]


def test_bm25_brute_force(spark):
    docs = ch.chunk_text(spark.read.parquet(f"{SF_SMALL}/documents.parquet"), "doc_id", "text", 128, 0).cache()
    qs = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select(F.col("item_id").alias("query_id"), "text").limit(8)
    got = rt.bm25_topk(qs, docs, k=5).collect()
    D = [(r.doc_id, r.chunk_index, terms(r.content)) for r in docs.collect()]
    N, avgdl = len(D), sum(len(t) for *_, t in D) / len(D)
    df = Counter(t for *_, ts in D for t in set(ts))
    for q in qs.collect():
        qt = set(terms(q.text))
        scores = []
        for d, c, ts in D:
            tf = Counter(ts)
            s = sum(math.log(1 + (N - df[t] + 0.5) / (df[t] + 0.5)) * tf[t] * 2.2 / (tf[t] + 1.2 * (0.25 + 0.75 * len(ts) / avgdl))
                    for t in qt if tf[t])
            if any(tf[t] for t in qt):
                scores.append((-round(s, 6), d, c))
        want = [(d, c) for _, d, c in sorted(scores)[:5]]
        mine = [(r.doc_id, r.chunk_index) for r in sorted((r for r in got if r.query_id == q.query_id), key=lambda r: r.rank)]
        assert mine == want


def test_vector_topk_paths_agree_with_numpy(spark):
    emb = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    qs = ix.embed_hashed(spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select(F.col("item_id").alias("query_id"), "text"),
                         "query_id", "text", 64)
    a = rt.vector_topk(qs, emb, k=7).collect()
    b = rt.vector_topk(qs, emb, k=7, ball_cells=640, block_cells=1024, query_rows=8).collect()
    key = lambda rows: sorted((r.query_id, r.rank, r.vec_id, r.score) for r in rows)
    assert key(a) == key(b)
    V = {r.vec_id: np.asarray(r.embedding, dtype=float) for r in emb.collect()}
    for q in qs.collect():
        qv = np.asarray(q.embedding) / np.linalg.norm(q.embedding)
        s = sorted((-round((1 + float(v @ qv / np.linalg.norm(v))) / 2, 6), i) for i, v in V.items())[:7]
        mine = sorted(((r.rank, r.vec_id) for r in a if r.query_id == q.query_id))
        assert [i for _, i in mine] == [i for _, i in s]
        assert all(r.rank <= 7 for r in a)


def test_rrf(spark):
    lists = spark.createDataFrame(
        [(1, "vector", "a", 1), (1, "vector", "b", 2), (1, "keyword", "b", 1), (1, "keyword", "a", 2), (1, "keyword", "c", 3)],
        "query_id long, list string, id string, rank int",
    )
    got = rt.rrf_fuse(lists, k=3).orderBy("rank").collect()
    assert [(r.id, r.rank) for r in got] == [("a", 1), ("b", 2), ("c", 3)]  # a and b tie: id order
    assert got[0].hybrid_sources == ["vector", "keyword"] and got[2].hybrid_sources == ["keyword"]
    assert all(r.rrf_score <= 2 / 61 + 1e-9 for r in got)


def test_history_window(spark):
    conv = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    got = {(r.conv_id, r.turn): r.history for r in rt.history_window(conv).collect()}
    rows = sorted(conv.collect(), key=lambda r: (r.conv_id, r.turn))
    for r in rows:
        if r.role != "user":
            continue
        prev = [x for x in rows if x.conv_id == r.conv_id and x.turn < r.turn and x.role != "system"][-6:]
        assert got[(r.conv_id, r.turn)] == "\n".join(f"{x.role}: {x.text}" for x in prev)


def test_upsert_idempotent(spark):
    ex = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "id long, v string, version int")
    inc = spark.createDataFrame([(2, "B", 1), (3, "C", 1)], "id long, v string, version int")
    once = sorted(ix.upsert_index(ex, inc, "id").collect())
    twice = sorted(ix.upsert_index(ix.upsert_index(ex, inc, "id"), inc, "id").collect())
    assert once == twice == [(1, "a", 0), (2, "B", 1), (3, "C", 1)]


def test_inspect_and_suggest(spark):
    idx = spark.createDataFrame([("a", [0.1] * 1024), ("a", [0.2] * 1024), ("b", [0.1] * 384), ("c", [0.0] * 5)],
                                "ns string, embedding array<double>")
    ins = ix.inspect_index(idx, namespace="ns")
    rows = {r.ns: (r.dimension, r.dimension_known, r.total_vectors) for r in ins.collect()}
    assert rows == {"a": (1024, True, 2), "b": (384, True, 1), "c": (5, True, 1), None: (0, False, 4)}
    models = {(r.ns, r.model) for r in ix.suggest_models(ins).collect()}
    assert ("b", "embed-english-light-v3.0") in models and ("a", "voyage-3") in models
    assert not any(ns == "c" for ns, _ in models)


def test_bm25_paths_agree(spark):
    docs = ch.chunk_text(spark.read.parquet(f"{SF_SMALL}/documents.parquet"), "doc_id", "text", 256, 20)
    qs = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select(F.col("item_id").alias("query_id"), "text")
    key = lambda rows: sorted((r.query_id, r.rank, r.doc_id, r.chunk_index, r.score) for r in rows)
    one = key(rt.bm25_topk(qs, docs, k=7).collect())
    assert one == key(rt.bm25_topk(qs, docs, k=7, block_terms=600).collect())  # many blocks
    path = tempfile.mkdtemp(prefix="cf-inverted-") + "/index"
    build_inverted(docs, ["doc_id", "chunk_index"], "content", path, block_terms=2000)
    index = open_inverted(spark, path)
    assert one == key(rt.bm25_topk(qs, index, k=7).collect())  # written once, opened again
    assert key(rt.bm25_topk(qs.where("query_id = 3"), index, k=7).collect()) == [r for r in one if r[0] == 3]
    pairs = rt.top_k(rt.bm25_scores(qs, docs), ["query_id"], "score", ["doc_id", "chunk_index"], 7)
    assert one == key(pairs.collect())


def test_bm25_odd_rows_same_for_all_blocks(spark):
    """Null texts, string ids, scores that round to 0 and ties."""
    rows = [(f"d{i:04d}", "w common" if i % 2 else "common " * 40) for i in range(300)] + [("null", None), ("empty", "")]
    docs = spark.createDataFrame(rows, "doc_id string, content string")
    qs = spark.createDataFrame([("b", "common"), ("a", "w"), ("c", "absent"), ("d", None), ("e", "W, common!")], "query_id string, text string")
    key = lambda rows: sorted((r.query_id, r.rank, r.doc_id, r.score) for r in rows)
    one = key(rt.bm25_topk(qs, docs, k=400, doc_keys="doc_id").collect())
    assert {q for q, *_ in one} == {"a", "b", "e"} and sum(q == "b" for q, *_ in one) == 300
    for kw in ({"block_terms": 1}, {"block_terms": 90}):
        assert one == key(rt.bm25_topk(qs, docs, k=400, doc_keys="doc_id", **kw).collect())
    assert one == key(rt.top_k(rt.bm25_scores(qs, docs, doc_keys="doc_id"), ["query_id"], "score", ["doc_id"], 400).collect())
    assert [d for q, r, d, _ in one if q == "a"][:2] == ["d0001", "d0003"]


def test_blocks_below_the_kth_score_are_not_read(spark):
    """One block holds the best documents of a term; the others are skipped."""
    rows = [(i, "rare word " * (9 if i < 8 else 1) + "filler " * (0 if i < 8 else 200)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, content string").coalesce(1)
    qs = spark.createDataFrame([(1, "rare word")], "query_id long, text string")
    index = build_inverted(docs, ["doc_id"], "content", tempfile.mkdtemp(prefix="cf-inverted-") + "/i", block_terms=2000)
    assert index.docs().select("block").distinct().count() > 20
    written, real = {}, inverted.materialize
    inverted.materialize = lambda df, name: written.setdefault(name, real(df, name))
    try:
        got = rt.bm25_topk(qs, index, k=5)
        assert [r.doc_id for r in got.collect()] == [0, 1, 2, 3, 4]
    finally:
        inverted.materialize = real
    assert written["bounds"].count() > 20 and written["rest"].count() == 0


def test_rounding_is_that_of_spark(spark):
    x = [0.0000005, 0.1234565, 2.5e-7, 1.0000004999, 3.3333335, 7.0, 0.4999995]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in x], "x double").select(F.round("x", 6)).collect()]
    assert rt._round(np.array(x)).tolist() == got


def test_search_over_stored_ids_and_wide_keys(spark):
    """Ids keep their type: sha256 ids of index_rows, and 64-bit keys in the hybrid."""
    chunks = spark.createDataFrame(
        [(1 << 60, 0, "alpha beta"), ((1 << 60) + 1, 1 << 21, "alpha gamma"), (-5, 3, "delta")], "doc_id long, chunk_index int, content string"
    ).withColumn("embedding", ix.embed_column("content"))
    rows = ix.index_rows(chunks)
    qs = spark.createDataFrame([("q", "alpha gamma"), ("z", "!!")], "query_id string, text string").withColumn("embedding", ix.embed_column("text"))
    got = rt.vector_topk(qs, rows, k=2, id_col="id").collect()
    best = [r for r in got if r["rank"] == 1]
    assert len(got) == 2 and len(best[0]["id"]) == 64 and best[0]["score"] == 1.0
    hits = rt.hybrid_search(qs, chunks, k=60).collect()
    assert {(r.doc_id, r.chunk_index) for r in hits} == {(1 << 60, 0), ((1 << 60) + 1, 1 << 21), (-5, 3)}
    assert hits[0].query_id == "q" and [r.doc_id for r in hits if r["rank"] == 1] == [(1 << 60) + 1]


def test_row_local_plans_have_no_exchange(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for df in (ch.chunk_text(docs, "doc_id", "text"), ix.embed_hashed(docs, "doc_id", "text")):
        assert "Exchange" not in df._jdf.queryExecution().toString()


def test_match_text_brute_force(spark):
    docs = spark.createDataFrame(
        [(1, "The cat sat on the mat"), (2, "the dog and the cat"), (3, "a mat, a cat, the end"), (4, "nothing here")],
        "doc_id long, text string",
    )
    qs = spark.createDataFrame([(10, "the cat"), (11, "cat mat"), (12, "cat unicorn"), (13, "THE"), (14, "   ")],
                               "query_id long, text string")
    got = sorted((r.query_id, r.doc_id) for r in rt.match_text(qs, docs).collect())
    D = {r.doc_id: set(terms(r.text)) for r in docs.collect()}
    want = sorted((q.query_id, d) for q in qs.collect() if terms(q.text) for d, ts in D.items() if set(terms(q.text)) <= ts)
    assert got == want


def test_vector_topk_mixed_dimensions(spark):
    idx = spark.createDataFrame(
        [(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 0.0, 0.0]), (4, [0.6, 0.8]), (5, None)],
        "vec_id long, embedding array<double>",
    )
    q = spark.createDataFrame([(7, [1.0, 0.0])], "query_id long, embedding array<double>")
    for rows in (rt.vector_topk(q, idx, k=5).collect(), rt.vector_topk(q, idx, k=5, ball_cells=2, block_cells=4, query_rows=1).collect()):
        got = sorted((r.rank, r.vec_id, r.score) for r in rows)
        # vectors of another size (or none) never match
        assert got == [(1, 1, 1.0), (2, 4, 0.8), (3, 2, 0.5)]


def _nearest(queries, rows, k):
    """(query, rank, id, score) by plain arithmetic; ``rows`` are (id, vector)."""
    def cos(a, b):
        a, b = (np.asarray(x) / max(np.abs(x).max(), 1e-320) for x in (a, b))
        n = np.linalg.norm(a) * np.linalg.norm(b)
        return float(a @ b / n) if n else 0.0

    out = []
    for q, v in queries:
        best = sorted((-round((1 + cos(v, x)) / 2, 6), i) for i, x in rows if len(x) == len(v))[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


def test_vector_index_equals_brute_force(spark):
    """Clusters, exact copies, zero vectors and magnitudes from 1e-160 to 1e160."""
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(12, 8))
    near = [centres[i % 12] + 0.05 * rng.normal(size=8) for i in range(400)]
    rows = [(i, (v * 10.0 ** rng.integers(-160, 160)).tolist()) for i, v in enumerate(near)]
    rows += [(1000 + i, [1.0] + [0.0] * 7) for i in range(60)] + [(2000, [0.0] * 8), (2001, [0.0] * 8), (3000, [1.0, 2.0, 3.0])]
    queries = [(i, (centres[i] * 10.0 ** (40 * i - 160)).tolist()) for i in range(8)] + [(90, [1.0] + [0.0] * 7), (91, [0.0] * 8), (92, [1.0, 0.0, 0.0]), (93, [1.0, 2.0])]
    other = [(5000, None), (5001, []), (5002, [1.0] * 7 + [None]), (5003, [float("nan")] * 8), (5004, [float("inf")] * 8)]
    idx = spark.createDataFrame(rows + other, "vec_id long, embedding array<double>").repartition(3)
    q = spark.createDataFrame(queries + [(99, None)], "query_id long, embedding array<double>")
    for k in (1, 6, 100):
        want = _nearest(queries, rows, k)
        for sizes in ({}, {"ball_cells": 160, "block_cells": 240, "query_rows": 2}):
            got = rt.vector_topk(q, idx, k=k, **sizes).collect()
            assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == want, (k, sizes)


def test_vector_index_skips_balls(spark):
    """On clustered vectors a query leaves most blocks out, and an index that
    is opened again gives the same rows."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, 16))
    rows = [(i, (centres[i % 20] + 0.02 * rng.normal(size=16)).tolist()) for i in range(2000)]
    idx = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    queries = [(i, centres[i].tolist()) for i in range(20)]
    q = spark.createDataFrame(queries, "query_id long, embedding array<double>")
    made = vi.build_vector_index(idx, ball_cells=400, block_cells=1600)
    again = vi.open_vector_index(spark, made.path)
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in rt.vector_topk(q, again, k=5).collect()) == _nearest(queries, rows, 5)
    asked = q.select(F.col("query_id").alias("qn"), F.lit(0).alias("part"), F.lit(16).alias("dim"), F.col("embedding").alias("v"), F.lit(0.9995).cast("double").alias("floor"))
    blocks = int(made.balls[16].blocks.sum())
    assert again.visits(asked, 5, True).count() == 20
    assert again.visits(asked, 5, False).count() < 20 * blocks / 4


def test_vector_index_of_nothing(spark):
    q = spark.createDataFrame([(1, [1.0, 0.0])], "query_id long, embedding array<double>")
    none = spark.createDataFrame([], "vec_id string, embedding array<double>")
    assert rt.vector_topk(q, none).collect() == []
    assert rt.vector_topk(q.limit(0), spark.createDataFrame([("a", [1.0, 0.0])], "vec_id string, embedding array<double>")).collect() == []
