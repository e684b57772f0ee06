import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from corpusflow.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(low)


def brute(docs, items, k=10):
    d = [(i, words(t)) for i, t in docs]
    n_docs, n_words = sum(1 for _, w in d if w), sum(len(w) for _, w in d)
    df = {}
    for _, w in d:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    asked = {}
    for i, t in items:
        if i is not None:
            asked.setdefault(i, set()).update(words(t))
    out = []
    for i, terms in asked.items():
        s = []
        for name, w in d:
            m = 10 + (90 * len(w) * n_docs) // n_words if n_words else 0
            x = 0
            for t in terms:
                if tf := w.count(t):
                    x += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * tf // (1000 * tf + 8 * m))
            if x > 0:
                s.append((-x, name is None, name))
        out += [(i, r + 1, name, -x) for r, (x, _, name) in enumerate(sorted(s, key=lambda z: (z[0], z[1], z[2] or 0))[:k])]
    return sorted(out, key=str)


def run(spark, docs, items, parts=7, **kw):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(parts, "doc_id")
    q = spark.createDataFrame(items, "item_id long, text string")
    return sorted((tuple(r) for r in lexical.ranked_search(d, q, **kw).collect()), key=str)


@pytest.mark.parametrize("kw", [{}, {"owners": 1, "bundle": 3}, {"owners": 6, "bundle": 1}, {"vocabulary_rows": 0, "bundle": 5}, {"k": 3, "owners": 9}])
def test_equals_brute_force(spark, kw):
    """Zipf words, copies of one document, and a word in every document."""
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    docs = [(i, " the ".join(rng.choices(vocabulary, weights, k=rng.randint(1, 60)))) for i in range(400)]
    docs += [(1000 + i, docs[7][1]) for i in range(150)]
    items = [(i, " ".join(rng.choices(vocabulary, weights, k=rng.randint(1, 25)))) for i in range(11)]
    items += [(50, docs[7][1]), (51, "the"), (52, "unheard of")]
    assert run(spark, docs, items, **kw) == brute(docs, items, kw.get("k", 10))


def test_odd_rows(spark):
    docs = [
        (1, "Alpha beta-beta Ärger İ 9x"), (1, "alpha"), (2, None), (3, ""), (4, " \x00 -- "), (None, "alpha"), (None, None), (5, "ärger alpha"),
        (6, "long " * 200_000 + "alpha"), (7, "ALPHA"), (8, "alpha"),
    ]
    items = [(1, "alpha Alpha"), (2, None), (3, ""), (None, "alpha"), (4, "Ärger"), (5, "beta"), (5, "9X"), (6, "none of these"), (7, "i̇ İ")]
    assert run(spark, docs, items, parts=3) == brute(docs, items)


def test_empty_tables_and_clashing_names(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "b", 2, 3, "x")], "item_id long, text string, block int, item long, term string")
    assert [r["doc_id"] for r in lexical.ranked_search(odd_docs, items).collect()] == [1, 1]
    assert lexical.ranked_search(no_docs, items).count() == 0
    assert lexical.ranked_search(odd_docs, items.where("false")).count() == 0
    assert lexical.ranked_search(odd_docs.where("text is null"), items).count() == 0


def test_accumulators_are_dropped_only_by_the_bound():
    """A document that cannot reach the k-th score goes, one that can stays."""
    def users(rest):
        return pa.array([[{"item": 1, "rest": rest}]] * 2)

    met = pa.table({
        "block": pa.array([0, 0], pa.int64()), "bundle": pa.array([0, 0], pa.int64()), "weight": pa.array([10, 1], pa.int64()), "users": users(5),
        "docs": pa.array([[0, 2], [0, 1, 2, 3]], pa.list_(pa.int32())), "tfs": pa.array([[1, 1], [1, 1, 1, 1]], pa.list_(pa.int64())),
        "lens": pa.array([[10, 10], [10] * 4], pa.list_(pa.int64())),
    })
    state = pa.table({c: pa.array([], t) for c, t in (("block", pa.int64()), ("bundle", pa.int64()), ("item", pa.int64()),
                      ("docs", pa.list_(pa.int32())), ("scores", pa.list_(pa.int64())))})
    out = lexical.stage(10, 100, 2)(state, met)
    assert out.column("docs").to_pylist() == [[0, 2]]
    out = lexical.stage(10, 100, 2)(state, met.set_column(3, "users", users(10**9)))
    assert out.column("docs").to_pylist() == [[0, 1, 2, 3]]
    assert np.all(np.diff(out.column("docs").to_pylist()[0]) > 0)
