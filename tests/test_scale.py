"""Steps that have to grow no faster than their input."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusflow.functions import elements as el
from corpusflow.functions.text import row_blocks


def test_row_blocks():
    assert list(row_blocks(np.array([3, 3, 9, 1, 1]), 6)) == [(0, 2), (2, 3), (3, 5)]
    assert list(row_blocks(np.array([0, 0, 0]), 5)) == [(0, 3)]
    assert list(row_blocks(np.array([], np.int64), 5)) == []


def test_elements_are_built_in_blocks(spark, monkeypatch):
    """a batch of pages is never held as Python objects at once."""
    monkeypatch.setattr(el, "BLOCK_BYTES", 64)
    pages = [f"<div id=d{i} class='a b'><p>{'é' * i}<p>x</div>" for i in range(40)] + ["", None, "no tag", "<p>" * 60]
    df = spark.createDataFrame(list(enumerate(pages)), "i int, html string").repartition(1)
    got = {r["i"]: [e.asDict() for e in r["t"]] for r in df.select("i", el.elements("html").alias("t")).collect()}
    assert got == {i: el.element_list(p) if p else [] for i, p in enumerate(pages)}


from corpusflow.operators import index as ix


def _hashed(text: str, dim: int):
    v = [0.0] * dim
    for t in text.lower().split():
        h = hashlib.md5(t.encode()).hexdigest()
        v[int(h[:8], 16) % dim] += 1.0 if int(h[8], 16) < 8 else -1.0
    n = math.sqrt(sum(x * x for x in v))
    return [x / n for x in v] if n else None


@pytest.mark.parametrize("cells", [40, 1 << 19])
def test_embedding_in_blocks(spark, monkeypatch, cells):
    """what a worker holds does not depend on the rows of a batch."""
    monkeypatch.setattr(ix, "BLOCK_CELLS", cells)
    monkeypatch.setattr(ix, "MAX_KNOWN_TERMS", 20)
    texts = ["", None, " - ", "One two TWO", *(" ".join(f"w{i * j % 37}" for j in range(i)) for i in range(50))]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").repartition(1)
    got = {r["i"]: r["v"] for r in df.select("i", ix.embed_column("text", 16).alias("v")).collect()}
    for i, t in enumerate(texts):
        want = _hashed(t or "", 16) if t != " - " else None
        assert got[i] == want if want is None else got[i] == pytest.approx(want)


def test_a_filter_on_vectors_does_not_embed_twice(spark):
    df = ix.embed_hashed(spark.createDataFrame([(1, "a b")], "doc_id int, text string"))
    assert df._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_python_units_spread_a_narrow_table(spark, tmp_path):
    """one file of parts is read by one task; the units are not made there."""
    from corpusflow.plans import registry as reg

    part = spark.range(400).selectExpr("id as p_partkey", "cast(id % 50 as int) as p_size", "'n' as p_name", "'b' as p_brand")
    part.coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    units = reg._py_units(spark, str(tmp_path))
    assert units.select(F.spark_partition_id()).distinct().count() > 1
    assert units.select("file").distinct().count() == 400


def test_the_kind_of_a_sitemap_is_found_once(spark):
    """Nothing above the explode looks into the document again."""
    from corpusflow.operators.links import sitemap_locs

    docs = [(1, "<urlset><url><loc> a&amp;b </loc></url><url><loc></loc></url><url><loc>c</loc></url></urlset>"), (2, "<sitemapindex><sitemap><loc>d</loc></sitemap></sitemapindex>"),
            (3, "<urlset><loc>e&amp;f</loc>"), (4, None), (5, "")]
    out = sitemap_locs(spark.createDataFrame(docs, "i int, xml string"))
    got = sorted((r["i"], r["kind"], r["pos"], r["loc"]) for r in out.collect())
    assert got == [(1, "page", 0, "a&b"), (1, "page", 2, "c"), (2, "sitemap", 0, "d"), (3, "page", 0, "e&amp;f")]
    above = out._jdf.queryExecution().optimizedPlan().toString().split("Generate")[0]
    assert "sitemapindex" not in above


def test_a_computed_text_is_computed_once_by_the_chunker(spark):
    """no filter repeats the text, blank and null texts give no chunk."""
    from corpusflow.operators.chunking import chunk_text

    rows = [(1, " a  b\n"), (2, "  "), (3, None), (4, " ".join(map(str, range(130))))]
    df = spark.createDataFrame(rows, "doc_id int, text string").withColumn("text", F.regexp_replace("text", "QQQ", ""))
    out = chunk_text(df, size=64, overlap=10)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("QQQ") == 1
    got = [(r["doc_id"], r["chunk_index"], r["n_tokens"], r["content"][:4]) for r in out.orderBy("doc_id", "chunk_index").collect()]
    assert got == [(1, 0, 2, "a b"), (4, 0, 64, "0 1 "), (4, 1, 64, "54 5"), (4, 2, 22, "108 ")]


def test_small_files_share_a_partition():
    """5,000 small files are a few tasks, large ones are still dealt out."""
    from corpusflow.sources import corpus_files as cf

    small = cf.packed([(f"f{i}", 3000) for i in range(5000)], cf.PARTITION_BYTES)
    assert len(small) <= 8 and sum(map(len, small)) == 5000
    assert len(cf.packed([(f"f{i}", 100 << 20) for i in range(6)], cf.PARTITION_BYTES)) == 6


def test_a_resumed_crawl_derives_its_links_once(spark, tmp_path, monkeypatch):
    """both crawls read the links as a written table."""
    from corpusflow.plans import registry as reg

    pages = [(i, f"https://h{i % 2}.com/p{i}", "<a href='/x'>x</a>") for i in range(8)]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    plans, crawl = [], reg.oc.crawl_frontier

    def spy(seeds, pages, links, **options):
        plans.append(links._jdf.queryExecution().optimizedPlan().toString())
        return crawl(seeds, pages, links, **options)

    monkeypatch.setattr(reg.oc, "crawl_frontier", spy)
    assert reg.q_crawl_resumed(spark, str(tmp_path)).count() > 8
    assert len(plans) == 2 and all("Generate" not in p and "Join" not in p for p in plans)


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_route_of_short_texts_is_read_in_parts(spark, monkeypatch):
    """scans are cut by bytes, and millions of short texts take few."""
    from corpusflow.plans import ingest as ing

    monkeypatch.setattr(ing, "ROUTE_FILE_ROWS", 50)
    files = spark.range(400).selectExpr("concat('o/', id, '.csv') as file", "concat('k,v\\n', id, ',x\\n') as text").coalesce(1)
    units = ing.file_units(files)
    assert units.select(F.spark_partition_id()).distinct().count() > 1
    assert sorted(r["text"] for r in units.collect()) == sorted(f"Row 1: k: {i} | v: x" for i in range(400))


def test_ingest_files_writes_its_texts_once(spark, monkeypatch):
    """the routes are what is written; the query does not write them before."""
    from corpusflow.plans import registry as reg

    plans, job = [], reg.ing.ingest_files

    def spy(files, **options):
        plans.append(files._jdf.queryExecution().optimizedPlan().toString())
        return job(files, **options)

    monkeypatch.setattr(reg.ing, "ingest_files", spy)
    assert reg.q_ingest_files(spark, "/root/testdata/sf0.001").columns[:2] == ["file", "source_type"]
    assert len(plans) == 1 and "Union" in plans[0]


def test_a_text_is_looked_at_once(spark):
    """branches, lambdas and generators share no parts by themselves."""
    from corpusflow.functions.html import html_text
    from corpusflow.operators.code_units import python_units, sql_units
    from corpusflow.sources.formats import json_records

    df = spark.createDataFrame([("a.x", "b")], "file string, text string")
    assert _plan(json_records(df)).count("from_json(") == 1
    assert _plan(sql_units(df)).count("TRUNCATE\\b") == 1
    assert _plan(python_units(df)).count("regexp_extract_all(") == 1
    assert _plan(df.select(html_text("text").alias("x"))).count("<!--") == 1


def test_csv_in_blocks(spark, monkeypatch):
    """a worker reads CSV texts with the standard library, block by block;
    bytes that are no text stay as they are."""
    from corpusflow.sources import formats as fm

    monkeypatch.setattr(fm, "CSV_BLOCK_BYTES", 16)
    rows = [(i, f"k,v\n{i},\n,{i}".encode()) for i in range(60)] + [(60, b"\xff\xfe,a\n"), (61, b""), (62, None), (63, "k\n﷐".encode()), (64, b"k\n\xff")]
    df = spark.createDataFrame(rows, "i int, b binary").repartition(1).select("i", F.expr("cast(b as string)").alias("t"))
    out = df.select("i", fm.csv_text("t").alias("x"))
    assert "ArrowEvalPython" in out._jdf.queryExecution().executedPlan().toString()
    got = {r["i"]: bytes(r["x"]) for r in out.select("i", F.col("x").cast("binary").alias("x")).collect()}
    assert {i: got[i] for i in range(60)} == {i: f"Row 1: k: {i}\nRow 2: v: {i}".encode() for i in range(60)}
    assert [got[i] for i in range(60, 65)] == [b"\xff\xfe,a\n", b"", b"", "k\n﷐".encode(), "Row 1: k: �".encode()]


def test_terms_are_cut_from_bytes(spark, monkeypatch):
    """the vector of a text is that of its ``search_terms``, in any script."""
    from corpusflow.functions.text import search_terms, term_text

    monkeypatch.setattr(ix, "BLOCK_CELLS", 60)
    texts = ["Foo-BAR_9 x", "É é ß ẞ İ I ΑΣ ς", "ñ ٣ Ⅷ ½ ² 漢字 😀𝔸 a b", "\x00a\x01B\x7f", "", None, " . ", "ends", " starts ", "ﬁ ǅ٠‍x", "one two " * 40]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(1)
    got = {r["i"]: (r["w"], r["v"]) for r in df.select("i", search_terms(F.coalesce("t", F.lit(""))).alias("w"), ix.embed_column("t", 16).alias("v")).collect()}
    for i, t in enumerate(texts):
        want = _hashed(" ".join(got[i][0]), 16)
        assert got[i][1] == (want if want is None else pytest.approx(want)), t
    same = df.where("i = 0").select(term_text("t").alias("x")).first()
    assert same["x"] == texts[0]  # ASCII is not rewritten
