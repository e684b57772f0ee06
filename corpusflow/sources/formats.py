"""Text out of file formats.

Each operator takes a table of (file, text) or already-parsed rows and is a
projection, an explode, or an aggregate whose group is one file (a file was
one row to begin with, so its group is bounded by that row).
"""

from __future__ import annotations

import csv
import io
import json
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.functions.html import decode_entities
from corpusflow.functions.text import let, row_blocks

# Keys that hold an item's text, in order.
JSON_TEXT_KEYS = ["text", "content", "html", "body", "markdown", "description"]
XML_TEXT = r"<(?:[A-Za-z_:]|[A-Za-z_:][^<>]*[^<>/])>([^<]+)"
XML_DOC = r"(?s)^\s*(?:<\?xml[^>]*\?>\s*)?(?:<!--.*?-->\s*)*<[A-Za-z_:][^>]*>.*</[A-Za-z_:][A-Za-z0-9_:.\-]*\s*>\s*$"
XML_TAG = r"""(?s)</?[A-Za-z_:](?:[^<>"']++|"[^"<]*+"|'[^'<]*+')*+>"""
PY_WS = r"^[ \t\n\r\f\x0B]+|[ \t\n\r\f\x0B]+$"


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, PY_WS, "")


def _vtype(v: Column) -> Column:
    return F.regexp_extract(F.schema_of_variant(v), r"^([A-Z]+)", 1)


def _first_text(item: Column, keys: Sequence[str]) -> Column:
    """First key whose value is a string that is not blank."""

    def value(k):
        string = _vtype(F.try_variant_get(item, f"$.{k}", "variant")) == "STRING"
        return let(F.when(string, F.try_variant_get(item, f"$.{k}", "string")), _if_text)

    return F.coalesce(*[value(k) for k in keys])


def _if_text(s: Column) -> Column:
    """A string that is not blank, else null."""
    return F.when(s.rlike(r"[^ \t\n\r\f\x0B]"), s)


def _item_url(item: Column, default: Column) -> Column:
    def val(k):
        s = F.try_variant_get(item, f"$.{k}", "string")
        return F.when(s != "", s)

    return F.coalesce(val("url"), val("link"), default)


def json_records(files: DataFrame, file_col: str = "file", text_col: str = "text",
                 text_keys: Sequence[str] = JSON_TEXT_KEYS) -> DataFrame:
    """A3: records of a JSON file. An array gives one record per object item
    (text = first key holding a non-blank string, else the item's JSON text)
    and per non-blank string item; numbers, nulls and lists are dropped;
    nothing kept gives one raw record. An object gives its text key or itself,
    indented by two; a JSON string gives that string; bad JSON gives the raw
    text. url = the item's url, else link, else file://name. An item's JSON
    text has a space after ',' and ':', key order and letters kept.
    Output: file, item_index, text, url."""
    src_url = F.concat(F.lit("file://"), F.element_at(F.split(F.col(file_col), "/"), -1))
    f = files.select(file_col, text_col, src_url.alias("_src"), F.try_parse_json(text_col).alias("_v"))
    f = f.withColumn("_t", F.when(F.col("_v").isNotNull(), _vtype(F.col("_v"))))
    items = F.arrays_zip(
        F.try_variant_get("_v", "$", "array<variant>").alias("v"),
        F.from_json(F.col(text_col), "array<string>").alias("j"),
    )

    def record(it, i):
        v = it["v"]

        def of_kind(t):
            def with_text(found):
                text = F.when(t == "OBJECT", F.coalesce(found, it["j"])).otherwise(found)
                url = F.when(t == "OBJECT", _item_url(v, F.col("_src"))).otherwise(F.col("_src"))
                form = F.when((t == "OBJECT") & found.isNull(), F.lit(1)).otherwise(F.lit(0))
                return F.struct(i.cast("int").alias("item_index"), text.alias("text"), url.alias("url"), form.alias("_form"))

            string = F.when(t == "STRING", let(F.try_variant_get(v, "$", "string"), _if_text))
            return let(F.when(t == "OBJECT", _first_text(v, text_keys)).otherwise(string), with_text)

        return let(_vtype(v), of_kind)

    def one(text, url, form=0):
        return F.array(F.struct(F.lit(0).alias("item_index"), text.alias("text"), url.alias("url"), F.lit(form).alias("_form")))

    kept = F.filter(F.transform(items, record), lambda r: r["text"].isNotNull())
    raw = one(F.col(text_col), F.col("_src"))
    of_object = lambda found: (
        F.when(found.isNotNull(), one(found, _item_url(F.col("_v"), F.col("_src")))).otherwise(one(F.col(text_col), F.col("_src"), 2))
    )
    recs = (
        F.when(F.col("_t") == "ARRAY", let(kept, lambda k: F.when(F.size(k) > 0, k).otherwise(raw)))
        .when(F.col("_t") == "OBJECT", let(_first_text(F.col("_v"), text_keys), of_object))
        .when(F.col("_t") == "STRING", one(F.try_variant_get("_v", "$", "string"), F.col("_src")))
        .otherwise(raw)
    )
    # Row-local: one file in, its records out; no join, no shuffle.
    out = f.select(file_col, F.inline(recs))
    written = _spaced_json(F.when(F.col("_form") > 0, F.col("text")), F.col("_form"))
    return out.withColumn("text", F.when(F.col("_form") > 0, F.coalesce(written, "text")).otherwise(F.col("text"))).drop("_form")


def _spaced_json(text: Column, form: Column) -> Column:
    """A JSON text written anew: on one line with spaces (form 1) or indented
    by two (form 2). Null stays null."""

    @F.pandas_udf("string")
    def run(texts: pd.Series, forms: pd.Series) -> pd.Series:
        def write(t, f):
            try:
                return json.dumps(json.loads(t), ensure_ascii=False, indent=2 if f == 2 else None)
            except (ValueError, RecursionError):
                return t

        return pd.Series([write(t, f) if isinstance(t, str) else None for t, f in zip(texts, forms)], dtype=object)

    return run(text, form)


#: A longer field makes the whole text unreadable as CSV.
CSV_FIELD_LIMIT = 131_072
#: Noncharacters; a text that holds one is not read as CSV.
CSV_RESERVED = ("\ufdd0", "\ufdd1", "\ufdd2")
#: Bytes of the CSV texts that a task holds as Python objects at once.
CSV_BLOCK_BYTES = 1 << 20


def csv_rows(text: str) -> str | None:
    """The rows of one CSV text as of ``csv_text``, None if it stays as it is."""
    if any(c in text for c in CSV_RESERVED):
        return None
    lines, n = [], 0
    try:
        rows = csv.reader(io.StringIO(text.replace("\r\n", "\n").replace("\r", "\n")))
        at = {name: i for i, name in enumerate(next(rows, []))}  # in the order of first places, with the last ones
        for row in rows:
            if row:
                n += 1
                if shown := " | ".join([f"{k}: {row[i]}" for k, i in at.items() if i < len(row) and row[i]]):
                    lines.append(f"Row {n}: {shown}")
    except csv.Error:
        return None
    return "\n".join(lines) or None


def csv_text(text: str | Column) -> Column:
    """A4 for a whole CSV text with a header, as a column: ``Row i: k: v | k: v``
    per row, empty values left out; blank lines do not count, a row without a
    value counts but is skipped; a value beyond the header has no name and is
    left out; of columns that share a name the last one counts. Quoted line
    breaks and doubled quotes belong to their field, a quote that is never
    closed runs to the end. A text without any row, and one that cannot be read
    (a field over ``CSV_FIELD_LIMIT`` characters), stays as it is; null is
    empty. A batch is answered in blocks of ``CSV_BLOCK_BYTES``."""
    c = F.col(text) if isinstance(text, str) else text
    raw = F.coalesce(c, F.lit(""))

    @F.arrow_udf("string")
    def read(it: Iterator[pa.Array]) -> Iterator[pa.Array]:
        csv.field_size_limit(CSV_FIELD_LIMIT)
        for texts in it:
            for s, e in row_blocks(np.asarray(pc.fill_null(pc.binary_length(texts), 0)), CSV_BLOCK_BYTES):
                block = texts.slice(s, e - s).cast(pa.binary()).to_pylist()
                yield pa.array([csv_rows(t.decode("utf-8", "replace")) for t in block], pa.string())

    return F.coalesce(read(raw), raw)


def row_text(rows: DataFrame, group: str, order: str, cols: Sequence[str]) -> DataFrame:
    """A4: CSV rows as ``Row i: k: v | k: v`` (empty values left out; a row
    with nothing left is skipped but still counts), newline-joined per file.
    ``order`` is the row number within the file (1-based)."""
    parts = [F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) != "", F.concat(F.lit(f"{c}: "), F.col(c).cast("string"))) for c in cols]
    r = rows.select(group, order, F.concat_ws(" | ", *parts).alias("_rt"))
    r = r.where(_strip(F.col("_rt")) != "").select(
        group, order, F.concat(F.lit("Row "), F.col(order).cast("string"), F.lit(": "), F.col("_rt")).alias("_line")
    )
    return r.groupBy(group).agg(
        F.array_join(F.sort_array(F.collect_list(F.struct(order, "_line"))).getField("_line"), "\n").alias("text")
    )


def sheet_text(rows: DataFrame, book: str, sheet: str, sheet_order: str, order: str, cols: Sequence[str]) -> DataFrame:
    """A5: ``## Sheet: name`` then the sheet's non-empty rows (cells joined by
    ' | ', nulls skipped); empty sheets dropped; sheets joined by a blank line."""
    cells = F.concat_ws(" | ", *[F.col(c).cast("string") for c in cols])
    r = rows.select(book, sheet, sheet_order, order, cells.alias("_r")).where(_strip(F.col("_r")) != "")
    s = r.groupBy(book, sheet, sheet_order).agg(
        F.array_join(F.sort_array(F.collect_list(F.struct(order, "_r"))).getField("_r"), "\n").alias("_rows")
    )
    s = s.select(book, sheet_order, F.concat(F.lit("## Sheet: "), F.col(sheet).cast("string"), F.lit("\n"), F.col("_rows")).alias("_s"))
    return s.groupBy(book).agg(
        F.array_join(F.sort_array(F.collect_list(F.struct(sheet_order, "_s"))).getField("_s"), "\n\n").alias("text")
    )


def gfm_table(rows: DataFrame, group: str, order: str, cols: Sequence[str], header: bool = True) -> DataFrame:
    """GitHub Markdown table per group: the first row (the header when
    ``header``), a dash separator, the rest; column width = longest cell, at
    least 3; cells left-justified. One grouping collects a table's rows and
    widths."""
    cols = list(cols)
    names = [f"_c{i}" for i in range(len(cols))]
    cells = rows.select(group, F.col(order).alias("_o"), *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in zip(cols, names)])
    g = cells.groupBy(group).agg(
        F.sort_array(F.collect_list(F.struct("_o", *names))).alias("_rows"), *[F.max(F.length(n)).alias(f"_w{i}") for i, n in enumerate(names)]
    )
    widths = [F.greatest(F.col(f"_w{i}"), F.lit(max(3, len(c) if header else 0))) for i, c in enumerate(cols)]

    def line(values: Sequence[Column]) -> Column:
        return F.concat(F.lit("| "), F.concat_ws(" | ", *[F.rpad(v, w, " ") for v, w in zip(values, widths)]), F.lit(" |"))

    dashes = line([F.repeat(F.lit("-"), w) for w in widths])
    body = F.transform("_rows", lambda r: line([r[n] for n in names]))
    if header:
        out = F.concat(F.array(line([F.lit(c) for c in cols]), dashes), body)
    else:
        out = let(body, lambda x: F.concat(F.slice(x, 1, 1), F.array(dashes), F.slice(x, 2, F.greatest(F.size(x) - 1, F.lit(0)))))
    return g.select(group, F.array_join(out, "\n").alias("text"))


def notebook_text(files: DataFrame, file_col: str = "file", text_col: str = "text") -> DataFrame:
    """Markdown cells as they are, code cells fenced as python, blank and
    other cells skipped, blocks joined by a blank line; ``source`` may be a
    string or a list of strings. A text that is no notebook stays raw: bad JSON,
    no object, cells or sources of another kind. Row-local."""
    v = F.try_parse_json(text_col)

    def source(c: Column) -> Column:
        src = F.try_variant_get(c, "$.source", "variant")
        joined = F.array_join(F.try_variant_get(c, "$.source", "array<string>"), "")
        return F.when(src.isNull(), F.lit("")).when(_vtype(src) == "ARRAY", joined).otherwise(F.try_variant_get(c, "$.source", "string"))

    def fits(c: Column) -> Column:
        src = F.try_variant_get(c, "$.source", "variant")
        parts = F.coalesce(F.try_variant_get(c, "$.source", "array<variant>"), F.array().cast("array<variant>"))
        kind = _vtype(src)
        strings = (kind == "STRING") | ((kind == "ARRAY") & ~F.exists(parts, lambda p: p.isNull() | (_vtype(p) != "STRING")))
        return c.isNotNull() & (_vtype(c) == "OBJECT") & (src.isNull() | strings)

    def block(c: Column) -> Column:
        kind = F.try_variant_get(c, "$.cell_type", "string")
        fenced = lambda s: F.concat(F.lit("```python\n"), s, F.lit("\n```"))
        return let(source(c), lambda s: F.when(_strip(s) == "", F.lit(None)).when(kind == "markdown", s).when(kind == "code", fenced(s)))

    f = files.select(file_col, text_col, v.alias("_v"))
    cells = F.try_variant_get("_v", "$.cells", "variant")
    listed = F.coalesce(F.try_variant_get("_v", "$.cells", "array<variant>"), F.array().cast("array<variant>"))
    good = (_vtype(F.col("_v")) == "OBJECT") & (cells.isNull() | (_vtype(cells) == "ARRAY")) & F.forall(listed, fits)
    text = F.array_join(F.filter(F.transform(listed, block), lambda b: b.isNotNull()), "\n\n")
    return f.select(file_col, F.when(F.coalesce(good, F.lit(False)), text).otherwise(F.col(text_col)).alias("text"))


def _plain_xml(x: Column) -> Column:
    """Without comments and processing instructions, CDATA as escaped text."""
    x = F.regexp_replace(x, r"(?s)<!--.*?-->", "")
    x = F.regexp_replace(x, r"(?s)<\?.*?\?>", "")
    pieces = F.split(x, r"<!\[CDATA\[")

    def unwrap(p: Column) -> Column:
        end = F.instr(p, "]]>")
        body = F.replace(F.replace(F.replace(F.substring(p, F.lit(1), end - 1), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
        return F.when(end > 0, F.concat(body, F.substring(p, end + 3, F.length(p)))).otherwise(F.concat(F.lit("<![CDATA["), p))

    rest = F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))), unwrap)
    return F.concat(pieces[0], F.array_join(rest, ""))


def _balanced(x: Column) -> Column:
    """Do the tags open and close in pairs, inside one root? The open names are
    a stack in one string; an end that does not fit leaves a mark."""
    tags = F.regexp_extract_all(x, F.lit(XML_TAG), 0)

    def step(stack: Column, tag: Column) -> Column:
        name = F.concat(F.regexp_extract(tag, r"^</?([^\s/>]+)", 1), F.lit("\u0002"))
        return (
            F.when(tag.startswith("</"), F.when(F.endswith(stack, F.concat(F.lit("\u0002"), name)), F.substring(stack, F.lit(1), F.length(stack) - F.length(name))).otherwise(F.lit("!")))
            .when(tag.endswith("/>"), stack)
            .otherwise(F.concat(stack, name))
        )

    return F.aggregate(tags, F.lit("\u0002"), step) == F.lit("\u0002")


def xml_text(files: DataFrame, file_col: str = "file", text_col: str = "text") -> DataFrame:
    """Each element's own leading text (tails ignored), stripped,
    non-blank, newline-joined in document order. Comments are no text, CDATA
    is; a document whose tags do not pair up stays raw."""
    x = F.col(text_col)
    plain = files.select(file_col, x.alias("_raw"), _plain_xml(x).alias("_x"))
    parts = F.filter(F.transform(F.regexp_extract_all("_x", F.lit(XML_TEXT), 1), lambda t: _strip(decode_entities(t))), lambda t: t != "")
    good = F.col("_x").rlike(XML_DOC) & _balanced(F.col("_x"))
    return plain.select(file_col, F.when(good, F.array_join(parts, "\n")).otherwise(F.col("_raw")).alias("text"))


def flatten_tables(df: DataFrame, id_col: str = "doc_id", tables_col: str = "tables") -> DataFrame:
    """Nested {page, table_index, rows[map]} to one row per cell."""
    t = df.select(id_col, F.explode(tables_col).alias("_t"))
    r = t.select(id_col, F.col("_t.page").alias("page"), F.col("_t.table_index").alias("table_index"),
                 F.posexplode("_t.rows").alias("row_index", "_r"))
    return r.select(id_col, "page", "table_index", "row_index", F.explode("_r").alias("column", "value"))
