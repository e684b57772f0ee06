import hashlib
import random
import zlib

import numpy as np
import pytest

from corpusflow.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    """The contract, over nested tuples."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            sha = hashlib.sha256((str(len(role.encode())) + ":" + role + text).encode()).hexdigest()
            own.setdefault(c, []).append(((turn is not None, turn or 0, role, sha), (role, text)))
    own = {c: [x for _, x in sorted(v)] for c, v in own.items()}
    seq = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        seq[c] = tuple(own.get(c - int(np.fmod(c, 5)), [])[:h] + v[h:])
    members = {}
    for c, s in seq.items():
        for d in range(len(s) + 1):
            members.setdefault(s[:d], []).append(c)
    kids = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids.get(p, [])) or 1
        saved[p] = sum(saved[k] for k in kids.get(p, [])) + ((len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0)
    return sorted(
        (
            min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids.get(p, [])), leaves[p], saved[p],
            hashlib.sha256(",".join(str(c) for c in sorted(m) if len(seq[c]) == len(p)).encode()).hexdigest(),
        )
        for p, m in members.items()
    )


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    out = pt.prefix_nodes(*pt.graft(pt.turn_rows(df)), **kw)
    assert out.columns == ["conv_id", "parent_conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((r["conv_id"], r["depth"], r["parent_conv_id"], *r[3:]) for r in out.collect())


def crowd():
    """Copies, branches at every depth, one conversation with a third of all
    turns, and a family in which each goes one turn further."""
    rng = random.Random(8)
    rows = []
    for c in range(60):
        start = rng.randint(0, 3)
        rows += [(c, t, "user" if t % 2 == 0 else None, f"{start if t < 3 else rng.randint(0, 2)} é{t}") for t in range(rng.randint(1, 9))]
    rows += [(200, t, "user", f"long {t}") for t in range(300)]
    rows += [(c, t, "user", f"long {t}") for c in (205, 210) for t in range(40 if c == 205 else 120)]
    rows += [(300 + 5 * c, t, "user", f"step {t}") for c in range(20) for t in range(c + 1)]
    rows += [(500 + 5 * c, t, "x", "same") for c in range(40) for t in range(3)]
    return rows


@pytest.mark.parametrize("cut", [1, 7, 60, 32_768])
def test_equals_brute_force_for_every_cut(spark, cut):
    rows = crowd()
    assert run(spark, rows, cut=cut) == brute(rows)


def test_odd_rows(spark):
    rows = [
        (0, None, "user", "first"), (0, 1, None, None), (0, 1, None, None), (0, 2, "", ""), (3, 0, "user", None), (3, None, None, "x" * 200_000),
        (None, 1, "user", "nobody"), (-7, 0, "user", "minus"), (-5, 0, "user", "base"), (11, 0, "user", "left without a turn"), (16, 5, "u", "a"),
        (7, 0, "us", "er"), (8, 0, "u", "ser"), (2**62, 0, "user", "far"),
    ]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, cut=1) == brute(rows)
    empty = spark.createDataFrame([], SCHEMA)
    assert pt.prefix_nodes(*pt.graft(pt.turn_rows(empty))).count() == 0
    alone = spark.createDataFrame([(11, 0, "u", "x", 1, 2, 3)], SCHEMA + ", position long, hi long, n long")
    got = pt.prefix_nodes(*pt.graft(pt.turn_rows(alone))).collect()
    assert len(got) == len(brute([(11, 0, "u", "x")]))


def test_a_collision_changes_the_seed(spark, monkeypatch):
    """Digests that collide are found by the check column and keyed anew."""
    real, seeds = pt.prefix_rows, []

    def weak(rows, convs, seed):
        from pyspark.sql import functions as F

        seeds.append(seed)
        out = real(rows, convs, seed)
        return out.withColumn("hi", F.lit(7).cast("long")).withColumn("lo", F.col("lo") % 3) if seed == 0 else out

    monkeypatch.setattr(pt, "prefix_rows", weak)
    rows = crowd()[:200]
    assert run(spark, rows) == brute(rows)
    assert seeds == [0, 1]


def test_perfect_table():
    rng = np.random.default_rng(1)
    hi, lo = rng.integers(-(2**63), 2**63 - 1, 5000), rng.integers(0, 3, 5000)
    table = pt.PerfectTable(hi, lo)
    assert sorted(table.slot) == list(range(5000))
    assert (table.find(hi, lo) == table.slot).all()
    assert (table.find(hi, lo + 5) == -1).all()
    with pytest.raises(ValueError):
        pt.PerfectTable(np.array([1, 1]), np.array([2, 2]))
    assert len(pt.PerfectTable(np.zeros(0, np.int64), np.zeros(0, np.int64)).find(hi, lo)) == 5000


def test_pieces_of_one_id_list(spark):
    """A node where thousands of conversations end, over many tasks."""
    df = spark.range(0, 300_000, 1, 16).selectExpr("1L as hi", "id % 2 as lo", "id as conv_id")
    got = {r["lo"]: r["ends_sha256"] for r in pt.ends(df).collect()}
    for lo in (0, 1):
        assert got[lo] == hashlib.sha256(",".join(str(i) for i in range(lo, 300_000, 2)).encode()).hexdigest()
