"""A1-A7, A9, A11, A12 on hand-made files and rows."""

import json
import os
import tempfile
import xml.etree.ElementTree as ET

import pytest
from pyspark.sql import functions as F

from corpusflow.sources import corpus_files
from corpusflow.sources.files import classify_source_type, scan_corpus, write_chunks, write_files
from corpusflow.sources.formats import csv_text, flatten_tables, gfm_table, json_records, notebook_text, row_text, sheet_text, xml_text


# (file text, records as (text, url)): written by hand.
JSON_CASES = [
    ('[{"b": 1, "text": "  ", "content": "hello", "url": "u1"}, {"link": "l2", "x": 3}, "str item", "   ", 5, null, [1], {"body": "b", "url": ""}]',
     [("hello", "u1"), ('{"link": "l2", "x": 3}', "l2"), ("str item", "file://f0.json"), ("b", "file://f0.json")]),
    ("[]", [("[]", "file://f1.json")]),
    ("[1, 2, null]", [("[1, 2, null]", "file://f2.json")]),
    ('{"title": "t", "markdown": "m", "link": "L"}', [("m", "L")]),
    ('{"a": 1, "url": "U", "é": [1, {"b": null}]}', [('{\n  "a": 1,\n  "url": "U",\n  "é": [\n    1,\n    {\n      "b": null\n    }\n  ]\n}', "file://f4.json")]),
    ('"just a string"', [("just a string", "file://f5.json")]),
    ('{"broken": ', [('{"broken": ', "file://f6.json")]),
    ("42", [("42", "file://f7.json")]),
]


def test_json_records(spark):
    rows = [(f"d/f{i}.json", t) for i, (t, _) in enumerate(JSON_CASES)]
    got = json_records(spark.createDataFrame(rows, "file string, text string")).collect()
    for i, (raw, want) in enumerate(JSON_CASES):
        mine = [(r.text, r.url) for r in sorted((r for r in got if r.file == f"d/f{i}.json"), key=lambda r: r.item_index)]
        assert mine == want, raw


def test_xml_by_hand(spark):
    cases = [
        ("<r><!-- <a>gone --><b>x</b></r>", "x"),
        ("<r><![CDATA[1 < 2 & <b>]]></r>", "1 < 2 & <b>"),
        ("<r>a<!-- c -->b<i/>tail</r>", "ab"),
        ("<r><b>x</r>", "<r><b>x</r>"),
        ("<r><b>x</c></r>", "<r><b>x</c></r>"),
        ('<?xml version="1.0"?>\n<r t="1>0"><a k=\'<\'>no</a></r>', '<?xml version="1.0"?>\n<r t="1>0"><a k=\'<\'>no</a></r>'),
        ('<r t="1&gt;0"><a>y</a><?pi <z>?></r>', "y"),
        ("plain", "plain"), ("", ""),
    ]
    df = spark.createDataFrame([(str(i), x) for i, (x, _) in enumerate(cases)], "file string, text string")
    got = {r.file: r.text for r in xml_text(df).collect()}
    for i, (x, want) in enumerate(cases):
        assert got[str(i)] == want, x


def test_notebook(spark):
    nb = {"cells": [
        {"cell_type": "markdown", "source": ["# T\n", "x"]},
        {"cell_type": "code", "source": "print(1)"},
        {"cell_type": "code", "source": ["  \n"]},
        {"cell_type": "raw", "source": "raw"},
        {"cell_type": "markdown", "source": "end"},
    ]}
    df = spark.createDataFrame([("a.ipynb", json.dumps(nb)), ("b.ipynb", "{bad")], "file string, text string")
    got = {r.file: r.text for r in notebook_text(df).collect()}
    assert got["a.ipynb"] == "# T\nx\n\n```python\nprint(1)\n```\n\nend"
    assert got["b.ipynb"] == "{bad"


def test_xml_matches_elementtree(spark):
    docs = [
        '<?xml version="1.0"?><urlset xmlns="x"><url><loc> a &amp; b </loc><lastmod>2024</lastmod></url><url><loc>c</loc></url></urlset>',
        "<root>top<child>one</child>tail<child/><child>two</child></root>",
        "<root><unclosed></root",
    ]
    got = [r.text for r in xml_text(spark.createDataFrame([(str(i), d) for i, d in enumerate(docs)], "file string, text string")).orderBy("file").collect()]
    for d, g in zip(docs, got):
        try:
            root = ET.fromstring(d)
            want = "\n".join(e.text.strip() for e in root.iter() if e.text and e.text.strip())
        except ET.ParseError:
            want = d
        assert g == want


def test_row_sheet_gfm(spark):
    rows = spark.createDataFrame(
        [("f", 1, "a", "1"), ("f", 2, "", ""), ("f", 3, "ccc", None), ("g", 1, None, "x")],
        "file string, i int, k string, v string",
    )
    rt = {r.file: r.text for r in row_text(rows, "file", "i", ["k", "v"]).collect()}
    assert rt == {"f": "Row 1: k: a | v: 1\nRow 3: k: ccc", "g": "Row 1: v: x"}
    sh = sheet_text(rows.withColumn("sheet", F.lit("S1")), "file", "sheet", "sheet", "i", ["k", "v"]).collect()
    # empty strings are cells (only nulls are skipped), as in the reference
    assert {r.file: r.text for r in sh}["f"] == "## Sheet: S1\na | 1\n | \nccc"
    g = {r.file: r.text for r in gfm_table(rows, "file", "i", ["k", "v"]).collect()}
    assert g["f"] == "| k   | v   |\n| --- | --- |\n| a   | 1   |\n|     |     |\n| ccc |     |"


def test_flatten_tables(spark):
    df = spark.createDataFrame(
        [(1, [(1, 0, [{"a": "1", "b": "2"}, {"a": "3"}]), (2, 1, [])])],
        "doc_id long, tables array<struct<page int, table_index int, rows array<map<string,string>>>>",
    )
    got = sorted((r.page, r.table_index, r.row_index, r.column, r.value) for r in flatten_tables(df).collect())
    assert got == [(1, 0, 0, "a", "1"), (1, 0, 0, "b", "2"), (1, 0, 1, "a", "3")]


def test_notebooks_that_are_none(spark):
    cases = [
        ("[1]", "[1]"), ("3", "3"), ("{}", ""), ('{"cells": null}', '{"cells": null}'), ('{"cells": 5}', '{"cells": 5}'), ('{"cells": [1]}', '{"cells": [1]}'),
        ('{"cells": [{"cell_type": "code", "source": 5}]}', '{"cells": [{"cell_type": "code", "source": 5}]}'),
        ('{"cells": [{"cell_type": "code", "source": ["a", 5]}]}', '{"cells": [{"cell_type": "code", "source": ["a", 5]}]}'),
        ('{"cells": [{"cell_type": "markdown"}, {"source": "no type"}, {"cell_type": 3, "source": "x"}, {"cell_type": "markdown", "source": "y"}]}', "y"),
        ("{", "{"), ("", ""),
    ]
    df = spark.createDataFrame([(str(i), t) for i, (t, _) in enumerate(cases)], "file string, text string")
    plan = notebook_text(df)
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()
    got = {r.file: r.text for r in plan.collect()}
    for i, (t, want) in enumerate(cases):
        assert got[str(i)] == want, t


def _dict_reader(text):
    """The same rules by the standard library's reader."""
    import csv
    import io

    text = text.replace("\r\n", "\n").replace("\r", "\n")
    try:
        rows = list(csv.DictReader(io.StringIO(text)))
    except csv.Error:
        return None
    lines = []
    for i, row in enumerate(rows, 1):
        shown = " | ".join(f"{k}: {v}" for k, v in row.items() if k is not None and v)
        if shown:
            lines.append(f"Row {i}: {shown}")
    return "\n".join(lines) or None


def test_csv_text(spark):
    """By hand, and random texts of the characters that matter against the
    standard library."""
    import random

    rng = random.Random(4)
    texts = [
        'a,b\n1,\n,\n"x\ny","say ""hi"""\n', "", "only,header\n", "a\n1,2,3\n", "a,b,a\n1,2,3\n4,5\n", "a,b\r\n1,2\r\n\r\n3,4", 'a\n"never closed\nx',
        'a,b\n"q"z,5" pipe\n', "\n\na\n1\n", "é,ß\nü,ö\n", 'a\n""\n2\n', "a,b\n\n\n1,", "a\n" + "x" * 131_073 + "\n", "a\n" + "x" * 131_072 + "\n",
        'a\n"' + "y" * 140_000, "a\n" + '"' + '""' * 20_000 + '"\n', "a,b\n" + "1,2\n" * 3000,
    ]
    texts += ["".join(rng.choices('ab,"\n\r', [3, 2, 4, 3, 3, 1], k=rng.randint(1, 25))) for _ in range(400)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(-1, None)], "i long, t string")
    got = {r.i: r.x for r in df.select("i", csv_text("t").alias("x")).collect()}
    assert got[-1] == ""
    assert got[0] == 'Row 1: a: 1\nRow 3: a: x\ny | b: say "hi"'
    for i, t in enumerate(texts):
        if t[:1] in ("\n", "\r"):  # no header: nothing has a name
            assert got[i] == t
        else:
            want = _dict_reader(t)
            assert got[i] == (t if want is None else want), repr(t[:60])


def test_hidden_and_empty_files(spark):
    d = tempfile.mkdtemp(prefix="cf-hidden-")
    files = {"pkg/__init__.py": b"import a", "pkg/a.py": b"x = 1", "_conf.yml": b"k: v", "b.md": b"# b", "empty.md": b"", ".hidden.txt": b"h",
             ".git/config.toml": b"t", "b/z.md": b"z", ".bashrc": b"no suffix"}
    for p, b in files.items():
        os.makedirs(os.path.dirname(os.path.join(d, p)), exist_ok=True)
        with open(os.path.join(d, p), "wb") as fh:
            fh.write(b)
    got = scan_corpus(spark, d).collect()
    want = [".git/config.toml", ".hidden.txt", "_conf.yml", "b/z.md", "b.md", "empty.md", "pkg/__init__.py", "pkg/a.py"]
    assert [r.path[len("file:" + d) + 1 :] for r in got] == want
    assert {r.name: (r.text, r.length, r.error) for r in got}["empty.md"] == ("", 0, None)
    assert [r.name for r in scan_corpus(spark, d, max_files=4).collect()] == ["config.toml", ".hidden.txt", "_conf.yml", "z.md"]
    assert [r.name for r in scan_corpus(spark, "file://" + d, extensions=[".md"], recursive=False).collect()] == ["b.md", "empty.md"]
    # without a right to read, a file is an error row and the scan goes on
    rows = corpus_files.CorpusReader({"path": d, "suffixes": '[".md"]'})
    part = rows.partitions()[0]
    part.paths.append(os.path.join(d, "gone.md"))
    part.lengths.append(3)
    read = [r for b in rows.read(part) for r in b.to_pylist()]
    assert read[-1]["content"] is None and "gone.md" in read[-1]["error"] and len(read) == 4


def test_partitions_are_balanced():
    files = [(f"f{i}", n) for i, n in enumerate([5, 5, 5, 100, 1, 1])]
    step = corpus_files.OPEN_BYTES
    assert [[p for p, _ in part] for part in corpus_files.packed(files, 2 * step + 20)] == [["f0", "f1"], ["f2"], ["f3"], ["f4", "f5"]]
    flat = [f for part in corpus_files.packed(files, 3 * step) for f in part]
    assert flat == files and corpus_files.packed([], 10) == []


def test_written_files_are_scanned_back(spark):
    d = tempfile.mkdtemp(prefix="cf-write-")
    rows = [("x/_a.md", "é\n"), (".b.txt", ""), ("c.csv", "k\n1")]
    write_files(spark.createDataFrame(rows, "path string, content string").repartition(3), d)
    assert [(r.path[len("file:" + d) + 1 :], r.text) for r in scan_corpus(spark, d).collect()] == [(".b.txt", ""), ("c.csv", "k\n1"), ("x/_a.md", "é\n")]
    with pytest.raises(Exception):
        write_files(spark.createDataFrame([("../out.md", "x")], "path string, content string"), d)


def test_scan_and_types(spark):
    d = tempfile.mkdtemp(prefix="cf-scan-")
    os.makedirs(os.path.join(d, "sub", "deep"))
    files = {"a.md": b"# a", "B.JSON": b"[]", "sub/c.text": b"t", "sub/deep/d.py": b"x=1", "noext": b"n",
             "sub/e.xyz": b"z", "bad.txt": b"ok \xff\xfe end", "z.sql": b"select 1"}
    for p, b in files.items():
        with open(os.path.join(d, p), "wb") as fh:
            fh.write(b)
    got = scan_corpus(spark, d).collect()
    names = sorted(r.name for r in got)
    assert names == ["B.JSON", "a.md", "bad.txt", "c.text", "d.py", "z.sql"]
    types = {r.name: r.source_type for r in got}
    assert types["c.text"] == "code" and types["B.JSON"] == "json" and types["a.md"] == "markdown"
    assert {r.name: r.text for r in got}["bad.txt"] == "ok �� end"
    # a caller's own list is used as given: '.JSON' never matches the lower-cased suffix
    assert [r.name for r in scan_corpus(spark, d, extensions=[".JSON"]).collect()] == []
    assert sorted(r.name for r in scan_corpus(spark, d, recursive=False).collect()) == ["B.JSON", "a.md", "bad.txt", "z.sql"]
    assert [r.name for r in scan_corpus(spark, d, max_files=2).collect()] == ["B.JSON", "a.md"]
    out = os.path.join(d, "out")
    chunks = spark.createDataFrame([("u", "c", 1)], "url string, content string, token_estimate long")
    write_chunks(chunks, out)
    with pytest.raises(Exception):
        write_chunks(chunks, out)
