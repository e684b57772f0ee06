"""Code-aware units of SQL and Python sources.

SQL (C7) is row-local: a file's lines, its boundary positions and its blocks
are arrays of the file's own row, so splitting needs no shuffle at all.

Python (C8-C10) is row-local too. One pattern cuts a source into strings,
comments and code, so lines are known as code with their brackets; a fold over
them gives the spans of the top-level statements. Texts, uncovered runs and
relevant imports are arrays of the file's row. A file whose quotes or brackets
do not pair up is kept whole; other errors of syntax are not looked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.functions.text import let

# The statement-start pattern and the statement types, in order.
SQL_STATEMENT = (
    r"(?i)^\s*("
    r"CREATE\s+(OR\s+REPLACE\s+)?(TABLE|VIEW|INDEX|PROCEDURE|FUNCTION|TRIGGER|SCHEMA|DATABASE|SEQUENCE|TYPE)"
    r"|ALTER\s+(TABLE|VIEW|INDEX|PROCEDURE|FUNCTION|SCHEMA|DATABASE|SEQUENCE|TYPE)"
    r"|DROP\s+(TABLE|VIEW|INDEX|PROCEDURE|FUNCTION|TRIGGER|SCHEMA|DATABASE|SEQUENCE|TYPE)"
    r"|INSERT\s+INTO"
    r"|UPDATE\s+\w"
    r"|DELETE\s+FROM"
    r"|SELECT\b"
    r"|WITH\b"
    r"|MERGE\b"
    r"|TRUNCATE\b"
    r"|GRANT\b"
    r"|REVOKE\b"
    r"|COMMENT\s+ON"
    r")"
)
SQL_TYPES = [
    "CREATE TABLE", "CREATE OR REPLACE TABLE", "CREATE VIEW", "CREATE OR REPLACE VIEW",
    "CREATE PROCEDURE", "CREATE OR REPLACE PROCEDURE", "CREATE FUNCTION", "CREATE OR REPLACE FUNCTION",
    "CREATE TRIGGER", "CREATE INDEX", "ALTER TABLE", "ALTER VIEW", "DROP TABLE", "DROP VIEW",
    "INSERT INTO", "UPDATE", "DELETE FROM", "SELECT", "WITH", "MERGE", "TRUNCATE", "GRANT", "REVOKE",
]
PY_STRIP = r"^[ \t\n\r\f\x0B]+|[ \t\n\r\f\x0B]+$"


def _strip(c):
    return F.regexp_replace(c, PY_STRIP, "")


def sql_type(first_line) -> F.Column:
    return _sql_type(F.upper(_strip(first_line)))


def _sql_type(up) -> F.Column:
    expr = F.lit("unknown")
    for kw in reversed(SQL_TYPES):
        expr = F.when(up.startswith(kw), F.lit(kw.lower().replace(" ", "_"))).otherwise(expr)
    return expr


def sql_units(files: DataFrame, file_col: str = "file", text_col: str = "text") -> DataFrame:
    """Statement blocks. A boundary line opens a block that runs to the
    next boundary; text stripped; index = boundary ordinal; lines before the
    first boundary are dropped. No boundary: one 'unknown' block, the whole
    text. Output: file, statement_index, statement_type, text."""
    lines = F.split(F.col(text_col), "\n")
    f = files.select(file_col, text_col, lines.alias("_l"))
    f = f.withColumn(
        "_b", F.filter(F.transform("_l", lambda l, i: F.when(l.rlike(SQL_STATEMENT), i).otherwise(F.lit(-1))), lambda x: x >= 0)
    )
    f = f.withColumn("_e", F.concat(F.slice("_b", 2, F.greatest(F.size("_b") - 1, F.lit(0))), F.array(F.size("_l"))))

    def unit(index: Column, kind: Column, text: Column) -> Column:
        return F.struct(index.alias("statement_index"), kind.alias("statement_type"), text.alias("text"))

    def block(z: Column, i: Column) -> Column:
        text = _strip(F.array_join(F.slice("_l", z["s"] + 1, z["e"] - z["s"]), "\n"))
        first = F.element_at("_l", z["s"] + 1)
        return let(text, lambda t: F.when(t != "", unit(i, let(F.upper(_strip(first)), _sql_type), t)))

    spans = F.arrays_zip(F.col("_b").alias("s"), F.col("_e").alias("e"))
    blocks = F.filter(F.transform(spans, block), lambda u: u.isNotNull())
    whole = F.array(unit(F.lit(0), F.lit("unknown"), F.col(text_col)))
    # One pass over a file: branches of a union would cut its lines once each.
    return f.select(file_col, F.inline(F.when(F.size("_b") > 0, blocks).when(F.size("_b") == 0, whole)))


# Comments, strings and line continuations of Python, then runs of
# anything else; possessive, so a long string costs no stack.
PY_TOKEN = (
    r"(?s)#[^\n]*+"
    r'|"""(?:[^"\\]++|\\.|"(?!""))*+"""'
    r"|'''(?:[^'\\]++|\\.|'(?!''))*+'''"
    r'|"(?:[^"\\\n]++|\\.)*+"'
    r"|'(?:[^'\\\n]++|\\.)*+'"
    r"|\\\n|[^#\"'\\]++|."
)
#: Begins a line that goes on from the one before, inside a string or after a
#: backslash. The character cannot stand in Python code.
_ON = "\x02"


def _code_lines(clean: Column) -> Column:
    """The lines of Python sources as code alone: a comment is ``#``, a string
    ``'``. Null where a quote or a backslash stands without its partner."""
    breaks = lambda t: F.regexp_replace(F.regexp_replace(t, r"[^\n]", ""), "\n", "\n" + _ON)
    plain = lambda t: (
        F.when(t.startswith("#"), F.lit("#"))
        .when(t == "\\\n", F.lit("\n" + _ON))
        .when(t.startswith('"') | t.startswith("'"), F.concat(F.lit("'"), breaks(t)))
        .otherwise(t)
    )
    open_ = lambda tokens: F.exists(tokens, lambda t: t.isin('"', "'", "\\") | F.contains(t, F.lit(_ON)) & ~t.startswith("#") & ~t.startswith('"') & ~t.startswith("'"))
    lines = lambda tokens: F.when(~open_(tokens), F.split(F.array_join(F.transform(tokens, plain), ""), "\n"))
    return let(F.regexp_extract_all(clean, F.lit(PY_TOKEN), F.lit(0)), lines)


def _bound_names(stmt: Column) -> Column:
    """The names that the imports of a line bind, as written after ``as``."""
    parts = F.filter(F.split(stmt, ";"), lambda p: p.rlike(r"^\s*(import|from)\b"))
    lists = F.transform(parts, lambda p: F.split(F.regexp_replace(F.regexp_replace(p, r"^\s*(from\b.*?\bimport\b|import\b)", ""), r"[()#\x02]", " "), ","))
    names = F.transform(F.flatten(lists), lambda n: F.regexp_replace(F.regexp_replace(n, r"^.*\sas\s", ""), r"\s", ""))
    return F.filter(names, lambda n: n != "")


def _spans(lines: Column) -> Column:
    """Top-level definitions and imports of code lines (``kind``, ``name``, first
    and last line ``s`` and ``e``, ``names`` that an import binds). A line in
    column 0, outside of brackets and strings, begins a statement, which ends
    with its last line of code. Null where brackets do not pair up or the first
    statement is indented."""
    word = r"([\w_][\w\d_]*)"

    def line(x, i):
        def named(pattern):
            return F.regexp_extract(x, r"(?U)^\f*" + pattern + r"\s+" + word, 1)

        def without(brackets):
            rest = x
            for b in brackets:
                rest = F.replace(rest, F.lit(b))
            return F.octet_length(rest)

        head = lambda kind, name: F.struct(F.lit(kind).alias("kind"), name.alias("name"))
        none, col0 = F.lit(""), x.rlike(r"^\f*[^\s\x02]")
        # Most lines are indented: one look.
        begun = (
            F.when(~col0, head("", none)).when(x.rlike(r"^\f*class\s"), head("class", named("class")))
            .when(x.rlike(r"^\f*def\s"), head("function", named("def"))).when(x.rlike(r"^\f*async\s+def\s"), head("async_function", named(r"async\s+def")))
            .when(x.rlike(r"^\f*(import|from)\b"), head("import", none)).otherwise(head("", none))
        )
        net = without(")]}") - without("([{")
        return F.struct((i + 1).alias("i"), col0.alias("col0"), begun.alias("head"), net.alias("net"))

    code = F.filter(F.transform(lines, lambda x, i: F.when(~x.rlike(r"^\s*#?$"), line(x, i))), lambda x: x.isNotNull())
    none = F.array().cast("array<struct<kind:string,name:string,s:int,e:int>>")

    def closed(acc):
        last = F.struct(acc["kind"].alias("kind"), acc["name"].alias("name"), acc["s"].alias("s"), acc["e"].alias("e"))
        return F.when(acc["kind"] != "", F.concat(acc["spans"], F.array(last))).otherwise(acc["spans"])

    def step(acc, x):
        begins = (acc["depth"] == 0) & x["col0"]
        new = lambda a, b: F.when(begins, a).otherwise(b)
        return F.struct(
            (acc["depth"] + x["net"]).alias("depth"),
            (acc["bad"] | (acc["depth"] + x["net"] < 0) | ((acc["s"] == 0) & ~x["col0"])).alias("bad"),
            new(x["head"]["kind"], acc["kind"]).alias("kind"), new(x["head"]["name"], acc["name"]).alias("name"),
            new(x["i"], acc["s"]).alias("s"), x["i"].alias("e"), new(closed(acc), acc["spans"]).alias("spans"),
        )

    start = F.struct(
        F.lit(0).alias("depth"), F.lit(False).alias("bad"), F.lit("").alias("kind"), F.lit("").alias("name"), F.lit(0).alias("s"), F.lit(0).alias("e"), none.alias("spans")
    )
    full = lambda x: F.struct(
        x["kind"].alias("kind"), x["name"].alias("name"), x["s"].alias("s"), x["e"].alias("e"),
        F.when(x["kind"] == "import", _bound_names(F.array_join(F.slice(lines, x["s"], x["e"] - x["s"] + 1), " "))).otherwise(F.array().cast("array<string>")).alias("names"),
    )
    return F.aggregate(code, start, step, lambda acc: F.when(~acc["bad"] & (acc["depth"] == 0), F.transform(closed(acc), full)))


def _text(first, last) -> Column:
    return F.array_join(F.slice("_l", first, last - first + 1), "\n")


def python_units(files: DataFrame, file_col: str = "file", text_col: str = "text") -> DataFrame:
    """Class / function / async_function units with the imports they
    use prepended (an import is used if a name that it binds occurs in the
    unit's text), global_scope blocks for runs of the other lines, or one
    'module' unit for a file that has neither or does not parse. Output: file,
    type, name, line_start, line_end, text. No shuffle."""
    raw = F.coalesce(F.col(text_col), F.lit(""))
    clean = F.when(F.contains(raw, F.lit("\r")), F.regexp_replace(raw, r"\r\n?", "\n")).otherwise(raw)
    f = files.select(file_col, raw.alias("_raw"), F.regexp_replace(clean, r"\n\z", "").alias("_c"))
    f = f.select(file_col, "_raw", F.split("_c", "\n").alias("_l"), _code_lines(F.col("_c")).alias("_m"))
    f = f.withColumn("_s", _spans(F.col("_m"))).drop("_m")
    imports = F.filter("_s", lambda x: x["kind"] == "import")
    f = f.withColumn("_imp", F.transform(imports, lambda x: F.struct(_text(x["s"], x["e"]).alias("stmt"), x["names"].alias("names"))))

    def row(kind, name, first, last, text):
        return F.struct(kind.alias("type"), name.alias("name"), first.cast("long").alias("line_start"), last.cast("long").alias("line_end"), text.alias("text"))

    def unit(x):
        def with_imports(src):
            def joined(used):
                head = F.concat(F.array_join(F.transform(used, lambda i: i["stmt"]), "\n"), F.lit("\n\n"))
                return F.when(F.size(used) > 0, F.concat(head, src)).otherwise(src)

            return let(F.filter("_imp", lambda i: F.exists(i["names"], lambda n: F.contains(src, n))), joined)

        return row(x["kind"], x["name"], x["s"], x["e"], let(_text(x["s"], x["e"]), with_imports))

    defs = F.transform(F.filter("_s", lambda x: x["kind"] != "import"), unit)
    # The runs between spans, each from the last line covered before it:
    # statements that share a line can overlap, hence the running maximum.
    n = F.size("_l")
    end = F.struct(F.lit("").alias("kind"), F.lit("").alias("name"), (n + 1).alias("s"), (n + 1).alias("e"), F.array().cast("array<string>").alias("names"))
    gaps = F.aggregate(
        F.concat(F.col("_s"), F.array(end)),
        F.struct(F.lit(0).alias("last"), F.array().cast("array<struct<s:int,e:int>>").alias("runs")),
        lambda acc, x: F.struct(
            F.greatest(acc["last"], x["e"]).alias("last"),
            F.when(x["s"] > acc["last"] + 1, F.concat(acc["runs"], F.array(F.struct((acc["last"] + 1).alias("s"), (x["s"] - 1).alias("e")))))
            .otherwise(acc["runs"]).alias("runs"),
        ),
    )["runs"]
    top = F.lit("<module>")
    blocks = F.transform(gaps, lambda g: row(F.lit("global_scope"), top, g["s"], g["e"], _strip(_text(g["s"], g["e"]))))
    blocks = F.filter(blocks, lambda u: u["text"] != "")
    found = f.select(file_col, "_raw", "_l", F.concat(defs, blocks).alias("_u"))
    module = F.array(row(F.lit("module"), top, F.lit(1), n, F.col("_raw")))
    units = F.when(F.col("_u").isNull() | (F.size("_u") == 0), module).otherwise(F.col("_u"))
    return found.select(file_col, F.explode(units).alias("_u")).select(file_col, "_u.*")


def unit_urls(units: DataFrame, file_col: str = "file", kind: str = "python") -> DataFrame:
    """C11: ``file://name.py#Unit`` (plain for module-level units) and
    ``file://name.sql#type_index``."""
    base = F.concat(F.lit("file://"), F.element_at(F.split(F.col(file_col), "/"), -1))
    if kind == "sql":
        url = F.concat(base, F.lit("#"), F.col("statement_type"), F.lit("_"), F.col("statement_index").cast("string"))
    else:
        url = F.when((F.col("name") != "") & (F.col("name") != "<module>"), F.concat(base, F.lit("#"), F.col("name"))).otherwise(base)
    return units.withColumn("url", url)
