import math

import numpy as np
import pytest

from corpusflow.llm import topk


def brute(rows, queries, k, scale=256.0):
    def ints(v):
        if v is None or any(x is None or not math.isfinite(x * scale) for x in v):
            return None
        return [math.floor(x * scale) for x in v]

    cand = [(i, q) for i, v in rows if i is not None and (q := ints(v)) is not None]
    asked = {(i, tuple(q)) for i, v in queries if i is not None and (q := ints(v)) is not None}
    out = []
    for i in {i for i, _ in asked}:
        s = []
        for j, x in asked:
            if j == i:
                for name, y in cand:
                    if name != i and len(x) == len(y):
                        s.append((-max(-(1 << 63), min((1 << 63) - 1, sum(a * b for a, b in zip(x, y)))), name))
        out += [(i, n + 1, name, -x) for n, (x, name) in enumerate(sorted(s)[:k])]
    return sorted(out)


def run(spark, rows, pick, k=5, **kw):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return sorted(tuple(r) for r in topk.exact_topk(df, df.where(pick), k, **kw).collect())


@pytest.mark.parametrize("cells, leaf", [(1 << 20, 128), (64, 4), (8 * 40, 7)])
def test_equals_brute_force_for_every_block_size(spark, cells, leaf):
    """Clusters, a crowd of equal vectors and ties, from one block to many."""
    rng = np.random.default_rng(cells)
    centres = rng.normal(size=(6, 8))
    v = centres[rng.integers(0, 6, 700)] + rng.normal(scale=0.2, size=(700, 8))
    v[200:430] = v[200]
    v[500:560] = np.rint(v[500:560])
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    got = run(spark, rows, "vec_id % 10 = 0", block_cells=cells, leaf=leaf)
    assert got == brute(rows, [r for r in rows if r[0] % 10 == 0], 5)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, None), (2, [0.0, 0.0]), (3, [1.0, None]), (4, [nan, 1.0]), (5, [inf, 1.0]),
        (6, [0.5, 0.5]), (7, [0.5, 0.5]), (7, [0.5, 0.5]), (8, [1.0, 2.0, 3.0]), (9, []), (10, []), (None, [1.0, 1.0]), (50, [-3.0, -0.001]),
        (100, []), (150, [1e300, 1e300]), (200, [1e306, 0.0]), (250, [-1e12, 2e12]), (11, [3e11, 7e11]),
    ]
    got = run(spark, rows, "vec_id % 50 = 0")
    assert got == brute(rows, [r for r in rows if r[0] is not None and r[0] % 50 == 0], 5)
    assert (100, 1, 9, 0) in got and (100, 2, 10, 0) in got
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert topk.exact_topk(df.where("false"), df.where("false")).count() == 0
    assert topk.exact_topk(df, df.where("false")).count() == 0
    assert topk.exact_topk(df.where("vec_id = 0"), df.where("vec_id = 0")).count() == 0


def test_clashing_columns(spark):
    df = spark.createDataFrame([(i, [float(i), 1.0], i, 0.5, "x", 1) for i in range(9)], "vec_id long, embedding array<double>, dim int, floor double, cell string, side int")
    assert [r["vec_id"] for r in topk.exact_topk(df, df.where("vec_id = 0"), 3).collect()] == [1, 2, 3]


def test_bounds_hold_over_magnitudes():
    rng = np.random.default_rng(2)
    for power in (-3, 0, 4, 9):
        v = np.floor(rng.normal(size=(300, 12)) * 10.0**power * 256)
        tree = topk.ball_tree(v, 16)
        q = np.floor(rng.normal(size=(20, 12)) * 256)
        bound = topk.upper_bounds(q, tree.centre, tree.radius)
        for i in range(len(tree.lo)):
            members = v[tree.order[tree.lo[i] : tree.hi[i]]]
            assert (q @ members.T <= bound[:, i : i + 1]).all()


def test_tree_drops_nodes(monkeypatch):
    """With separated clusters most leaves are never multiplied."""
    rng = np.random.default_rng(4)
    v = np.floor(256 * (np.repeat(rng.normal(size=(32, 8)) * 5, 128, axis=0) + rng.normal(scale=0.01, size=(4096, 8))))
    tree, seen, real = topk.ball_tree(v, 64), [], topk.products
    monkeypatch.setattr(topk, "products", lambda q, x: seen.append(len(q) * len(x)) or real(q, x))
    ids = np.arange(len(v))
    topk.search_block(tree, ids, v, ids[:64], v[:64], [None] * 64, 5)
    assert sum(seen) < 0.2 * 64 * len(v)
