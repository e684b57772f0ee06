import hashlib
import random
import re

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from corpusflow.llm import bpe, licenses
from corpusflow.llm.token_rollups import RollupStore, count_rows, quarter_count, word_count
from corpusflow.session import read_table, shared_path
from pyspark.sql import functions as F

PATH = public_tokenizers.path("word_bpe_49k.json")


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


@pytest.fixture(scope="module")
def pair():
    with open(PATH, encoding="utf-8") as f:
        return bpe.WordBPE(f.read()), Tokenizer.from_file(PATH)


def test_bpe_equals_the_library(pair):
    mine, lib = pair
    rng = random.Random(1)
    parts = ["Hello", " ", "'s", "'LL", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "é", "é", "ΣΑΣ", "İ", "ß", " ", " ", "\x1c", "\x85", "12", "½", "①", "日本", "!!", "😀", "\n", "a" * 70, "​", "don't", "\x00"]
    texts = ["", *["".join(rng.choice(parts) for _ in range(rng.randint(1, 14))) for _ in range(500)]]
    for t in texts:
        ids = lib.encode(t, add_special_tokens=False).ids
        assert mine.encode(t) == ids, t
        back = lib.decode(ids, skip_special_tokens=False)
        assert mine.decode(ids) == back
        assert mine.digest(t) == (len(ids), sha(" ".join(map(str, ids))), sha(back))


def test_bpe_columns(spark, odd_docs, no_docs, pair):
    _, lib = pair
    got = {}
    for r in bpe.bpe_digest(odd_docs, PATH).collect():
        got.setdefault(r["doc_id"], []).append(r)
    for r in odd_docs.collect():
        ids = lib.encode(r["text"] or "", add_special_tokens=False).ids
        for g in got[r["doc_id"]]:
            assert (g["n_tokens"], g["ids_sha256"]) == (len(ids), sha(" ".join(map(str, ids))))
    assert len(got[1]) == 2 and got[2][0]["decoded_sha256"] == sha("")
    assert bpe.bpe_digest(no_docs, PATH).count() == 0
    ids = bpe.bpe_encode(odd_docs, PATH)
    model = bpe.load_model(spark, PATH)
    text = ids.select("doc_id", bpe.decode_column(F.col("ids"), model).alias("t")).where("doc_id = 1").first()["t"]
    assert text == "a</w> b</w> c</w> d</w> e</w> f</w>"


def test_bpe_cache_does_not_change_results(pair, monkeypatch):
    mine, _ = pair
    texts = ["alpha beta gamma delta " * 5, "epsilon zeta alpha"] * 3
    want = [mine.digest(t) for t in texts]
    monkeypatch.setattr(bpe, "MAX_CACHED_WORDS", 2)
    mine.cache.clear()
    assert [mine.digest(t) for t in texts] == want


# ---- licenses


def slow_base(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words, cur = [], ""
    for c in low + " ":
        if c.isascii() and not (c.isdigit() or "a" <= c <= "z"):
            if cur:
                words.append(cur)
            cur = ""
        else:
            cur += c
    at, labels = [], set()
    for phrase, label in (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")):
        p = phrase.split()
        for i in range(len(words)):
            if words[i : i + len(p)] == p:
                at.append(i)
                labels.add(label)
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def test_base_phrases_equal_brute_force():
    rng = random.Random(3)
    scanner = licenses.Scanner()
    parts = ["Under", "the", "MIT", "License", "Apache", "version", "2", "CC", "BY-NC", "nc", "é", "x", ",", "\n", "2.0", "mité"]
    for _ in range(1500):
        t = " ".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        r = scanner.scan(t)
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == slow_base(t), t
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1


def test_gates_lose_no_match():
    """Every rule finds the same with and without its gate."""
    scanner = licenses.Scanner()
    assert len(scanner.rules) > 300
    texts = [
        "SPDX-License-Identifier: GPL-3.0-or-later", "SPDX-License-Identifier: CC-BY-NC-SA-4.0", "Released under the MIT License.",
        "is licensed under the terms of the GNU General Public License, version 3.", "under the New BSD licence", "the zlib/libpng license",
        "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 license", "gplv2 license", "governed by the Mozilla Public License, v. 2.0",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "Neither the name of the University nor the names of its contributors may be used to endorse or promote products",
    ]
    for t in texts:
        words = t.encode().translate(licenses._TABLE).split()
        joined = b" " + b" ".join(words) + b" "
        hits = [i for i, r in enumerate(scanner.rules) if r.pattern.search(joined)]
        assert hits, t
        for i in hits:
            assert scanner.rules[i].keywords <= set(words) and scanner.rules[i].phrase in joined, (t, scanner.rules[i])


def test_suppression_and_labels():
    scan = licenses.Scanner().scan
    assert scan("Licensed under the Apache License, Version 2.0.")["labels"] == "apache-2"
    assert scan("Licensed under CC BY-NC-SA 4.0")["labels"] == "cc-by-nc,cc-by-nc-sa"  # the base phrase stays
    d = scan("Released under the MIT License and the ISC license")["detections"]
    assert [(x["label"], x["first"], x["last"]) for x in d] == [("mit", 0, 4), ("isc", 6, 8)]
    for plain in ("he went out with the dog", "mit der version 2", "the public version under the bridge", ""):
        assert scan(plain)["labels"] == "" and scan(plain)["score"] == 0


def test_every_signature_fires():
    """Each sentence as a license writes it, with words around it."""
    scanner = licenses.Scanner()
    fill = ((".{1,60}", "the University"), ("[1-4]", "4"), ("(?:unauthorized|no part)", "no part"), ("(?:dedicated|released|placed) (?:in)?to", "released into"))
    for label, text in licenses.SIGNATURES:
        for spelt in ("acknowledgement", "acknowledgment"):
            real = re.sub(r"acknowledg\S*", spelt, text)
            for a, b in fill:
                real = real.replace(a, b)
            found = scanner.scan(f"x1 {real}: x2")
            assert label in found["labels"].split(","), (label, real)

def test_license_rows(spark, odd_docs, no_docs):
    rows = licenses.license_scan(odd_docs).collect()
    assert len(rows) == 8 and {r["first_word"] for r in rows} == {None}
    assert {r["n_words"] for r in rows if r["doc_id"] in (2, 3, 5)} == {0}
    assert licenses.license_scan(no_docs).count() == 0


# ---- rollups


def table(store):
    return {(r["source"], r["lang"], r["tokenizer"]): (r["docs"], r["tokens"]) for r in store.totals().collect()}


def test_rollups_follow_signed_batches(spark, odd_docs):
    base = shared_path(spark, f"rollup-test-{random.random()}")
    store = RollupStore(spark, base)
    docs = lambda *rows: count_rows(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), {"w": word_count})
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "doc_id long")
    assert store.totals().count() == 0 and store.committed() == []
    assert store.apply(1, docs((1, "a b", "en", "s"), (2, "c", "en", "s"), (2, "c", "en", "s"), (3, None, None, None), (None, "x", "en", "s")))
    assert table(store) == {("s", "en", "w"): (2, 3), ("", "", "w"): (1, 0)}
    assert not store.apply(1, docs((9, "z", "en", "s")))
    assert store.apply(2, docs((1, "a b c d", "en", "s"), (2, "c c", "fr", "t")), ids(3, 77))
    assert table(store) == {("s", "en", "w"): (1, 4), ("t", "fr", "w"): (1, 2)}
    # An interrupted batch: rows without a commit are not read, and a retry replaces them.
    docs((5, "q", "en", "s")).withColumn("docs", F.lit(1).cast("long")).write.parquet(store._at("rows", 3))
    assert table(store) == {("s", "en", "w"): (1, 4), ("t", "fr", "w"): (1, 2)}
    assert store.apply(3, docs((6, "q q q", "en", "s"), (1, "gone", "en", "s")), ids(1, 2))
    assert table(store) == {("s", "en", "w"): (1, 3)}
    assert store.apply(4) and store.apply(5, None, ids(6)) and store.totals().count() == 0
    assert store.apply(6, count_rows(odd_docs)) and store.committed() == [1, 2, 3, 4, 5, 6]


def test_counts(spark):
    rows = [(None,), ("",), (" a  b\t\n",), ("x y z",)]
    got = spark.createDataFrame(rows, "text string").select(word_count(F.col("text")), quarter_count(F.col("text"))).collect()
    assert [tuple(r) for r in got] == [(0, 0), (0, 0), (2, 2), (2, 2)]


def test_license_scan_is_linear_in_the_text():
    """Twice the phrases take about twice the time, and word numbers are right."""
    import time

    from corpusflow.llm.licenses import Scanner

    scanner = Scanner()
    scanner.scan("warm up")
    times = []
    for n in (20_000, 80_000):
        t0 = time.perf_counter()
        got = scanner.scan("cc by nc " * n)
        times.append(time.perf_counter() - t0)
        assert got["n_words"] == 3 * n and got["n_base"] == n and got["first_word"] == 0 and got["last_word"] == 3 * n - 3
    assert times[1] < 10 * times[0] + 0.2, times
