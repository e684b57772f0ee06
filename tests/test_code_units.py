"""C7-C11 on hand-written files with their units."""

from corpusflow.operators.code_units import python_units, sql_units, unit_urls

# (source, units as (type, name, first line, last line, text)): written by hand.
TRICKY = [
    ('"""Module doc."""\nimport os, sys as system\n\nX = call(\n    1,\n)\n\n# comment\n\ndef f(a,\n      b):\n    # inner\n    return os.path.join(a, b)\n    # trailing comment\n\n\nclass K(Base):\n    def m(self):\n        return system.argv\n\nif __name__ == "__main__":\n    f(1, 2)\n',
     [("global_scope", "<module>", 1, 1, '"""Module doc."""'), ("global_scope", "<module>", 3, 9, "X = call(\n    1,\n)\n\n# comment"),
      ("function", "f", 10, 13, "import os, sys as system\n\ndef f(a,\n      b):\n    # inner\n    return os.path.join(a, b)"),
      ("global_scope", "<module>", 14, 16, "# trailing comment"),
      ("class", "K", 17, 19, "import os, sys as system\n\nclass K(Base):\n    def m(self):\n        return system.argv"),
      ("global_scope", "<module>", 20, 22, 'if __name__ == "__main__":\n    f(1, 2)')]),
    ("from a import (\n    b,\n    c as d,\n)\n\n\n@dec\nasync def g():\n    return d\n\n\n\nY = [\n    1,\n]\nZ = 2\n",
     [("global_scope", "<module>", 5, 7, "@dec"), ("async_function", "g", 8, 9, "from a import (\n    b,\n    c as d,\n)\n\nasync def g():\n    return d"),
      ("global_scope", "<module>", 10, 16, "Y = [\n    1,\n]\nZ = 2")]),
    ("def size(\n    a,\n) -> int:\n    return a", [("function", "size", 1, 4, "def size(\n    a,\n) -> int:\n    return a")]),
    ('class C:\n    """doc\ncolumn zero\n# not a comment\n    """\n    def m(self):\n        pass\n', [("class", "C", 1, 7, 'class C:\n    """doc\ncolumn zero\n# not a comment\n    """\n    def m(self):\n        pass')]),
    ("def only():\n    pass", [("function", "only", 1, 2, "def only():\n    pass")]),
    ("x = 1\r\ny = 2\r\n", [("global_scope", "<module>", 1, 2, "x = 1\ny = 2")]),
    ("import os; x = 1\ndef f(): pass; \n", [("function", "f", 2, 2, "def f(): pass; ")]),
    ("import os\n\nfrom x import y\n", [("module", "<module>", 1, 3, "import os\n\nfrom x import y\n")]),
    ("def broken(:\n    pass\n", [("module", "<module>", 1, 2, "def broken(:\n    pass\n")]),
    ("", [("module", "<module>", 1, 1, "")]),
    (None, [("module", "<module>", 1, 1, "")]),
]


def test_python_units_by_hand(spark):
    df = spark.createDataFrame([(f"t{i}.py", s, 1) for i, (s, _) in enumerate(TRICKY)], "file string, text string, name int")
    units = python_units(df)
    assert "Exchange" not in units._jdf.queryExecution().toString()
    got = units.collect()
    for i, (src, want) in enumerate(TRICKY):
        mine = sorted(((r.type, r.name, r.line_start, r.line_end, r.text) for r in got if r.file == f"t{i}.py"), key=lambda u: u[2])
        assert mine == want, src


# (file, blocks as (index, type, text)): written by hand.
SQL_CASES = {
    "a.sql": ("-- lost\nCREATE OR REPLACE VIEW v AS\n  SELECT 1;\nINSERT INTO t\nSELECT 2;\n",
              [(0, "create_or_replace_view", "CREATE OR REPLACE VIEW v AS"), (1, "select", "SELECT 1;"), (2, "insert_into", "INSERT INTO t"), (3, "select", "SELECT 2;")]),
    "b.sql": ("comment on table t is 'x';\nCREATE  TABLE u (a int);\n", [(0, "unknown", "comment on table t is 'x';"), (1, "unknown", "CREATE  TABLE u (a int);")]),
    "c.sql": ("-- nothing here\n", [(0, "unknown", "-- nothing here\n")]),
    "d.sql": ("  with x as (select 1)\nselect * from x;\nGRANT ALL ON t TO r;\nmerge into t using s on 1=1;",
              [(0, "with", "with x as (select 1)"), (1, "select", "select * from x;"), (2, "grant", "GRANT ALL ON t TO r;"), (3, "merge", "merge into t using s on 1=1;")]),
}


def test_sql_units_by_hand(spark):
    df = spark.createDataFrame([(n, s) for n, (s, _) in SQL_CASES.items()], "file string, text string")
    got = sql_units(df).collect()
    for name, (_, want) in SQL_CASES.items():
        assert sorted((r.statement_index, r.statement_type, r.text) for r in got if r.file == name) == want, name
    urls = {r.url for r in unit_urls(sql_units(df), "file", "sql").collect()}
    assert "file://a.sql#create_or_replace_view_0" in urls and "file://c.sql#unknown_0" in urls


# Statements in any order: strings with quotes, brackets and hashes in them,
# continued lines, nested definitions, comments in and after bodies.
PIECES = [
    "import os", "import os.path as osp, sys", "from a.b import (c,  # why\n    d as e,\n)", "from . import x; y = 2", "from m import \\\n    n, \\\n    o",
    "x = 1", "s = 'it\\'s # no (comment'", 'doc = """a\nclass No:\n# no\n"quoted" \\""" (\n"""', "t = r'\\\\' + \"'\"", "v = f\"{x['a']}\" '''\ndef no(): '''",
    "z = {\n'k': [1,\n2],\n# in brackets\n}", "# comment (", "", "@dec(1,\n2)\ndef f(a,\nb=(1, 2)):\n    '''doc\nzero\n    '''\n    return a  # end",
    "class K(Base):\n    x = 1\n\n    def m(self): return '}'\n    # trailing", "async  def g():\n\tawait h()", "class Ü: pass", "if x:\n    def inner(): pass\nelse:\n    import q",
    "def one(): return 1; \n", "total = 1 + \\\n  2", "def s():\n    return \"\"\"\nend\"\"\"", "for i in range(3):\n    pass",
]


def _units_by_parser(text):
    """(type, name, first line, last line) of definitions, as Python's parser sees them."""
    import ast

    kinds = {ast.ClassDef: "class", ast.FunctionDef: "function", ast.AsyncFunctionDef: "async_function"}
    return [(kinds[type(n)], n.name, n.lineno, n.end_lineno) for n in ast.parse(text).body if type(n) in kinds]


def test_python_units_agree_with_the_parser(spark):
    import random

    rnd = random.Random(5)
    files = ["\n".join(rnd.choices(PIECES, k=rnd.randint(1, 12))) + rnd.choice(["", "\n", "\n\n# end\n"]) for _ in range(300)] + PIECES
    got = python_units(spark.createDataFrame(list(enumerate(files)), "file int, text string")).collect()
    mine: dict = {}
    for r in got:
        mine.setdefault(r.file, []).append((r.type, r.name, r.line_start, r.line_end))
    for i, text in enumerate(files):
        units = [u for u in mine[i] if u[0] not in ("module", "global_scope")]
        assert sorted(units, key=lambda u: u[2]) == _units_by_parser(text), text


def test_python_units_of_odd_sources(spark):
    """Broken sources are one module; long strings and many lines pass."""
    bad = ["x = '", 'y = """a\n', "def f(:\n  pass", "a)\n(b", "  x = 1\n", "x = \\", "\x02def f(): pass"]
    long = ["s = '''" + "\\' \n" * 100_000 + "'''\ndef f():\n    pass\n", "x = 1\n" * 20_000 + "def f(): pass\n"]
    got = python_units(spark.createDataFrame(list(enumerate(bad + long)), "file int, text string")).select("file", "type", "line_start").collect()
    assert sorted((r.file, r.type) for r in got if r.file < len(bad)) == [(i, "module") for i in range(len(bad))]
    assert [(r.file - len(bad), r.line_start) for r in sorted(got) if r.type == "function"] == [(0, 100_002), (1, 20_001)]
