import subprocess
import sys

import corpus_pipeline as P
from corpusflow.llm import pii
from corpusflow.llm.queries import QUERIES
from corpusflow.session import read_table

SF = "/root/testdata/sf0.001"


def test_stage_order_and_columns(spark):
    assert [n for n, _ in P.STAGES] == ["toxicity", "simhash_dedup", "decontaminate", "pii", "bpe"]
    docs = read_table(spark, SF, "documents")
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name


def test_stages_take_odd_rows(spark, odd_docs, no_docs):
    for name, stage in P.STAGES:
        assert stage(spark, no_docs, SF).count() == 0, name
        out = stage(spark, odd_docs, SF).collect()
        if name == "simhash_dedup":
            assert sorted((r["doc_id"] for r in out), key=str) == [1, 2, 4, 6, None]
        elif name != "bpe":
            assert len(out) == 8, name


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def _rows(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)


def test_a_shared_id_does_not_drop_another_text(spark):
    """Copies leave, a text of its own under a copy's id stays; copies without
    an id leave beside a named one, and one of them stays without."""
    a, b, c = ("one two three four five six " * 9, "quite another text of other words altogether " * 9, "nobody named this long text of many words " * 9)
    got = P.drop_near_copies(spark, _rows(spark, [(1, a), (2, a), (2, b), (None, a), (None, c), (None, c), (3, b), (4, None), (5, ""), (4, None)]), SF).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=str) == sorted([(1, a), (2, b), (None, c), (4, None)], key=str)


def test_a_shared_id_does_not_drop_a_clean_text(spark):
    item = read_table(spark, SF, "benchmark").orderBy("item_id").first()["text"]
    rows = [(5, "before " + item + " after"), (5, "clean words only"), (6, "clean words only"), (None, item), (None, "clean"), (7, None)]
    got = P.drop_contaminated(spark, _rows(spark, rows), SF).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=str) == sorted([rows[1], rows[2], rows[4], rows[5]], key=str)


def test_last_stages_equal_the_library(spark):
    """Token digests of the redacted texts, by the tokenizer library."""
    import hashlib

    from tokenizers import Tokenizer

    from corpusflow.llm.queries import tokenizer_path

    docs = P.redact_pii(spark, read_table(spark, SF, "documents"), SF)
    want = {}
    tok = Tokenizer.from_file(tokenizer_path())
    tok.no_truncation()
    tok.no_padding()
    for r in docs.collect():
        ids = tok.encode(r["text"] or "", add_special_tokens=False).ids
        back = tok.decode(ids, skip_special_tokens=False)
        want[r["doc_id"]] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest())
    got = {r["doc_id"]: tuple(r)[1:] for r in P.tokenize(spark, docs, SF).collect()}
    assert got == want


def test_redaction_takes_effect(spark):
    docs = spark.createDataFrame([(1, "write a@b.com é", "en", "s", 3), (2, None, "en", "s", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: r for r in P.redact_pii(spark, docs, SF).collect()}
    assert got[1]["text"] == "write [EMAIL] é" and got[1]["n_chars"] == 15
    assert got[2]["text"] is None and pii.KINDS


def test_run_keeps_what_brute_force_keeps(spark):
    """Each stage's decisions, made one document at a time."""
    from pyspark.sql import functions as F

    from corpusflow.llm import decontaminate, simhash, toxicity
    from corpusflow.llm.queries import toxicity_model

    docs = read_table(spark, SF, "documents")
    model = toxicity_model(spark, docs, SF)
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    kept = {i: t for i, t in rows.items() if model.score(model.marginals([toxicity.words_of(t or "")])[0]) < toxicity.THRESHOLD}
    fps = {i: simhash.fingerprint(t or "", 4) for i, t in kept.items()}
    root = {i: i for i in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sorted(fps):
        for b in sorted(fps):
            if a < b and bin(fps[a] ^ fps[b]).count("1") <= 4:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    kept = {i: t for i, t in kept.items() if find(i) == i}
    some = spark.createDataFrame(list(kept.items()), "doc_id long, text string")
    bad = {r["doc_id"] for r in decontaminate.contamination(some, read_table(spark, SF, "benchmark")).where("contaminated").collect()}
    got = P.run(spark, SF)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert {r["doc_id"] for r in got.collect()} == set(kept) - bad and F


def test_queries_are_registered():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)] + ["pipeline"]


def test_entry_works_without_the_subpackage():
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name in ('corpus_pipeline', 'corpusflow.llm'):\n"
        "            raise ModuleNotFoundError(f'No module named {name!r}', name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert 'bm25_topk' in e.queries() and not any(n.startswith('op') for n in e.queries())\n"
    )
    subprocess.run([sys.executable, "-c", code], check=True, cwd=P.__file__.rsplit("/", 1)[0])
