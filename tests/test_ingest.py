"""Folder ingest and crawl to chunks as whole jobs, on hand-made inputs."""

import os
import tempfile

from corpusflow.plans.ingest import crawl_to_chunks, file_units, ingest_folder


def test_file_units_by_type(spark):
    files = [
        ("d/a.md", "# T\nbody"), ("d/b.JSON", '[{"text": "one", "url": "u"}, "two"]'), ("d/c.csv", "k,v\n1,2\n"), ("d/e.html", "<p>1 < 2</p>"),
        ("d/f.xml", "<r><a>x</a></r>"), ("d/g.ipynb", '{"cells": [{"cell_type": "markdown", "source": "m"}]}'), ("d/h.py", "import os\n\ndef f():\n    return os\n"),
        ("d/i.sql", "SELECT 1;\nDELETE FROM t;"), ("d/j.rs", "fn main() {}"), ("d/noext", "plain"), ("d/k.pdf", "bytes"), ("d/l.txt", None),
    ]
    got = file_units(spark.createDataFrame(files, "file string, text string")).collect()
    assert sorted((r.file[2:], r.source_type, r.url, r.text) for r in got if r.text is not None) == sorted([
        ("a.md", "markdown", "file://a.md", "# T\nbody"), ("b.JSON", "json", "u", "one"), ("b.JSON", "json", "file://b.JSON", "two"),
        ("c.csv", "csv", "file://c.csv", "Row 1: k: 1 | v: 2"), ("e.html", "html", "file://e.html", "1 < 2"), ("f.xml", "xml", "file://f.xml", "x"),
        ("g.ipynb", "notebook", "file://g.ipynb", "m"), ("h.py", "code", "file://h.py#f", "import os\n\ndef f():\n    return os"),
        ("i.sql", "code", "file://i.sql#select_0", "SELECT 1;"), ("i.sql", "code", "file://i.sql#delete_from_1", "DELETE FROM t;"),
        ("j.rs", "code", "file://j.rs", "fn main() {}"), ("noext", "text", "file://noext", "plain"),
    ])


def test_ingest_folder(spark):
    base = tempfile.mkdtemp(prefix="cf-ingest-")
    os.makedirs(os.path.join(base, "deep"))
    for name, text in (("a.md", "alpha " * 600), ("deep/B.TXT", "beta"), ("c.docx", "x"), ("skip.bin", "x"), ("empty.txt", ""), ("_notes.md", "gamma"), ("bad.csv", 'a\n"' + "x " * 100_000)):
        with open(os.path.join(base, name), "w") as f:
            f.write(text)
    rows, report = ingest_folder(spark, base, "j")
    got = {}
    for r in rows.collect():
        got.setdefault(os.path.basename(r.file), []).append(r.chunk_index)
        assert len(r.embedding) == 64
    assert {k: sorted(v) for k, v in got.items()} == {"a.md": [0, 1], "B.TXT": [0], "_notes.md": [0], "bad.csv": list(range(len(got["bad.csv"])))}
    r = report.collect()[0]
    assert (r.job, r.files_processed, r.files_failed, r.total_chunks, r.status) == ("j", 5, 1, 4 + len(got["bad.csv"]), "partial")


def test_unreadable_files_are_reported(spark):
    from corpusflow.plans.ingest import folder_errors

    files = [("a.md", "markdown", None), ("b.pdf", "pdf", None), ("c.md", "markdown", "PermissionError: no")]
    got = folder_errors(spark.createDataFrame(files, "file string, source_type string, error string")).collect()
    assert [(r.file, r.error) for r in got] == [("a.md", None), ("b.pdf", "unsupported file type"), ("c.md", "PermissionError: no")]


def test_every_route_reads_its_own_files(spark):
    df = spark.createDataFrame([("a.md", "x"), ("b.csv", "k\n1"), ("c.html", "<p>y</p>")], "file string, text string")
    plan = file_units(df)._jdf.queryExecution().optimizedPlan().toString()
    for route in ("whole", "csv", "html", "json", "xml", "notebook", "py", "sql"):
        assert f"= {route})" in plan
    assert "Filter" in plan and plan.count("_route#") >= 8


def test_crawl_to_chunks(spark):
    h = "https://s.example.com"
    pages = spark.createDataFrame([(0, h + "/a", "<p>root page</p>"), (1, h + "/b", "<p>next</p>"), (2, h + "/c", "<p>never linked</p>")], "page_id long, url string, html string")
    links = spark.createDataFrame([(0, 0, h + "/b"), (0, 1, h + "/missing")], "page_id long, pos long, target string")
    chunks, report = crawl_to_chunks(spark.createDataFrame([(h + "/a",)], "root string"), pages, links, max_pages=None)
    assert sorted(r.content for r in chunks.collect()) == ["next", "root page"]
    r = report.collect()[0]
    assert (r.pages_discovered, r.pages_crawled, r.pages_failed, r.total_chunks) == (3, 2, 1, 2)
