import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from corpusflow.llm import ann, simhash
from corpusflow.llm.components import connected_components


def test_nearest_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(600, 24))
    base[300:420] = base[7] + rng.normal(scale=1e-3, size=(120, 24))  # a tight crowd
    base[500:520] = base[500]  # ties
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(base)], "vec_id long, embedding array<double>")
    got = ann.nearest(df, df.where("vec_id % 20 = 0"), 20, query_block=8, vector_block=128).collect()
    assert len(got) == 30 * 20
    by = {(r["query_id"], r["rank"]): r for r in got}
    for q in range(0, 600, 20):
        s = ann.exact_products(np.repeat(base[q : q + 1], 600, 0), base)
        want = sorted((-x, i) for i, x in enumerate(s) if i != q)[:20]
        assert [(by[q, k + 1]["vec_id"], by[q, k + 1]["score"]) for k in range(20)] == [(i, -x) for x, i in want]


def test_int8_bounds_hold():
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(40, 1500)), rng.normal(size=(50, 1500))
    xc, xs, xn, xe, xp = ann.quantise(x)
    yc, ys, yn, ye, yp = ann.quantise(y)
    prod = ann.int8_product(xc, yc)
    assert (prod == xc.astype(int) @ yc.astype(int).T).all()
    x, y = np.ldexp(x, -xp[:, None]), np.ldexp(y, -yp[:, None])
    assert (np.abs(x).max(axis=1) < 1).all() and (np.abs(x).max(axis=1) >= 0.5).all()
    err = np.abs(x @ y.T - prod * xs[:, None] * ys[None, :])
    assert (err <= xn[:, None] * ye[None, :] + xe[:, None] * (yn + ye)[None, :] + 1e-9).all()


def test_nearest_odd_vectors(spark):
    rows = [
        (0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (1, None, 2), (2, [0.0, 0.0], 3), (3, [1.0, None], 4), (4, [float("nan"), 1.0], 5),
        (5, [float("inf"), 1.0], 6), (6, [0.5, 0.5], 7), (7, [0.5, 0.5], 8), (8, [1.0, 2.0, 3.0], 9), (9, [], 10), (None, [1.0, 1.0], 11),
        (20, [3.0, 3.0, 3.0], None), (40, [-1.0, 0.0], 1),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int")
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in ann.nearest(df, df.where("vec_id % 20 = 0"), 3).collect()]
    assert sorted(got) == [
        (0, 1, 6, 0.5), (0, 2, 7, 0.5), (0, 3, 40, -1.0), (20, 1, 8, 18.0), (40, 1, 6, -0.5), (40, 2, 7, -0.5), (40, 3, 0, -1.0),
    ]
    none = df.where("false")
    assert ann.nearest(none, none, 3).count() == 0
    assert ann.nearest(df, none, 3).count() == 0


def test_nearest_at_every_magnitude(spark):
    """From 1e-160 to 1e160, exactly quantised vectors among them; products
    that underflow or overflow tie and go by id."""
    rng = np.random.default_rng(11)
    rows = []
    for i in range(500):
        v = rng.integers(-127, 128, 6).astype(float) if i % 3 else rng.normal(size=6)
        rows.append((i, (v * 10.0 ** int(rng.integers(-160, 161))).tolist()))
    rows += [(1000 + i, [1e155 * (i + 1)] * 6) for i in range(12)] + [(2000 + 20 * i, [10.0**p] * 6) for i, p in enumerate((-308, -160, 0, 150, 155, 160, 307))]
    rows = [(i, v if any(v) else [1.0] * 6) for i, v in rows]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in ann.nearest(df, df.where("vec_id % 20 = 0"), 9, query_block=5, vector_block=97).collect()}
    m, ids = np.array([v for _, v in rows]), [i for i, _ in rows]
    for q, v in rows:
        if q % 20 == 0:
            s = ann.exact_products(np.repeat(np.array([v]), len(m), 0), m)
            want = sorted((-x, i) for x, i in zip(s.tolist(), ids) if i != q)[:9]
            assert [got[q, k + 1] for k in range(9)] == [(i, -x) for x, i in want], q


def test_every_row_is_a_candidate(spark):
    """Two vectors under one id are two candidates; many equal rows too."""
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [5.0, 9.0]), (1, [7.0, 1.0]), *[(2, [6.0, 0.0])] * 5, (3, [4.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    q = df.where("vec_id = 0")
    for k, want in ((3, [(1, 7.0), (2, 6.0), (2, 6.0)]), (9, [(1, 7.0), *[(2, 6.0)] * 5, (1, 5.0), (3, 4.0)])):
        got = sorted((r["rank"], r["vec_id"], r["score"]) for r in ann.nearest(df, q, k).collect())
        assert got == [(i + 1, *w) for i, w in enumerate(want)]


def test_nearest_is_the_same_for_every_deal(spark):
    """Also with query ids that hold several vectors, of several lengths."""
    rng = np.random.default_rng(5)
    rows = [(int(rng.integers(0, 150)), rng.integers(-3, 4, 4 + i % 2).astype(float).tolist()) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    q = {(i, tuple(v)) for i, v in rows if i % 5 == 0 and any(v)}
    want = []
    for i in {i for i, _ in q}:
        s = sorted((-float(np.dot(v, w)), j) for x, v in q if x == i for j, w in rows if j != i and len(w) == len(v) and any(w))
        want += [(i, n + 1, j, -x) for n, (x, j) in enumerate(s[:7])]
    for deal, block in ((3, 11), (16, 1000), (10_000, 50)):
        got = ann.nearest(df, df.where("vec_id % 5 = 0"), 7, query_block=2, vector_block=block, query_deal=deal).collect()
        assert sorted(tuple(r) for r in got) == sorted(want), (deal, block)


def slow_fingerprint(text, k):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    for sep in "\t\n\x0b\x0c\r":
        low = low.replace(sep, " ")
    words = [w for w in low.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(spark):
    texts = ["", " \t", "One", "one two THREE", "a b c d", "a b c d e\x0bf\x0cg", "Ä ä\u00a0x y z ẞ \u2003q", "r " * 9, "\x1c one \x85 two three four five"]
    assert [simhash.fingerprint(t, 4) for t in texts] == [slow_fingerprint(t, 4) for t in texts]
    assert simhash.fingerprint("one two three", 4) == int(
        spark.range(1).select(F.hex(F.xxhash64(F.lit("one two three")))).first()[0], 16
    )


def brute_groups(fps, d):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in fps:
        for b in fps:
            if bin(a ^ b).count("1") <= d:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {f: find(f) for f in fps}


def near_fingerprints(seed=5):
    """A dense crowd, chains of far ends, and loose values."""
    rng = random.Random(seed)
    out = {0, (1 << 64) - 1}
    centre = rng.getrandbits(64)
    for _ in range(250):
        out.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))))
    x = rng.getrandbits(64)
    for _ in range(60):
        x ^= sum(1 << b for b in rng.sample(range(64), 4))
        out.add(x)
    return sorted(out | {rng.getrandbits(64) for _ in range(200)})


def test_multi_index_finds_every_link(spark):
    fps = near_fingerprints()
    want = brute_groups(fps, 4)
    df = spark.createDataFrame([(simhash._signed(f),) for f in fps], "fp long")
    for segments, split in ((None, 4096), (2, 4096), (3, 8), (4, 4096), (5, 20)):
        links = simhash.near_links(df, 4, segments, split)
        got = {}
        for r in connected_components(links).collect():
            got.setdefault(r["root"], set()).add(r["node"] % (1 << 64))
        groups = {}
        for f, g in want.items():
            groups.setdefault(g, set()).add(f)
        assert sorted(map(sorted, got.values())) == sorted(sorted(g) for g in groups.values() if len(g) > 1), (segments, split)


def test_segments_cannot_miss():
    for d in (2, 4, 5):
        for m in range(1, d + 2):
            parts = simhash._segments(list(range(64)), m, d)
            assert sum(r + 1 for _, r in parts) == d + 1 and sorted(b for p, _ in parts for b in p) == list(range(64))


def test_components(spark):
    e = spark.createDataFrame([(5, 4), (4, 5), (3, 4), (9, 9), (7, 8), (8, 7), (None, 1), (10, 3), (2, 11)], "a long, b long")
    got = {r["node"]: r["root"] for r in connected_components(e).collect()}
    assert got == {3: 3, 4: 3, 5: 3, 10: 3, 7: 7, 8: 7, 2: 2, 11: 2}
    assert connected_components(e.where("false")).count() == 0
    chain = spark.createDataFrame([(i, i + 1) for i in range(100)], "a long, b long")
    assert {r["root"] for r in connected_components(chain).collect()} == {0}


def test_simhash_groups_odd_rows(spark, odd_docs, no_docs):
    rows = simhash.simhash_groups(odd_docs).collect()
    assert len(rows) == 8
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows}
    assert got[2] == got[3] == got[5] == ("0" * 16, 2)
    assert got[1] == (format(slow_fingerprint("a b c d e f", 4), "016x"), 1)
    assert got[None][1] is None
    assert simhash.simhash_groups(no_docs).count() == 0


def test_dense_region_leaves_no_hot_bucket(spark, monkeypatch):
    """128 fingerprints that differ in seven bits alone and some far from them:
    buckets are dealt until none is hot, and no link is lost."""
    fps = [(n << 2) ^ 0x0F0F00FF for n in range(128)]
    far = [f ^ (((1 << 20) - 1) << 41) for f in fps[:10]]
    signed = [(simhash._signed(f),) for f in fps + far]
    sizes, plain = [], simhash._links

    def measured(rows, d):
        sizes.append(rows.where("is_table").groupBy("bucket").count().agg(F.max("count")).first()[0] or 0)
        return plain(rows, d)

    monkeypatch.setattr(simhash, "_links", measured)
    links = simhash.near_links(spark.createDataFrame(signed, "fp long"), 4, 4, 8).distinct().collect()
    assert len(sizes) > 3 and max(sizes) <= 8
    parent = {f: f for (f,) in signed}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        assert bin((a ^ b) & (2**64 - 1)).count("1") <= 4
        parent[root(a)] = root(b)
    assert len({root(f) for (f,) in signed}) == 2
