"""HTML as column expressions: text, title, Markdown, entities.

Regex chains only, so a whole corpus of pages is converted inside one
whole-stage-codegen projection. A tag starts with ``<`` and a letter, ``/``,
``!`` or ``?`` and steps over quoted attribute values, so a bare ``<`` is text;
script and style that are never closed hide the rest of the page. All HTML5
character references are decoded, in one pass from left to right.
"""

from __future__ import annotations

import html.entities
import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusflow.functions.text import let

SEP = "\u0001"
#: What may follow a tag's name: quoted values are stepped over. Possessive, so
#: that a long tag neither backtracks nor recurses.
ATTRS = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
COMMENT = r"(?s)<!--.*?-->"
SCRIPT = r"(?is)<script\b" + ATTRS + r">.*?(?:</script\s*+>|\z)"
STYLE = r"(?is)<style\b" + ATTRS + r">.*?(?:</style\s*+>|\z)"
HEAD = r"(?is)<head\b" + ATTRS + r">.*?</head\s*+>"
TAG = r"(?s)<(?:/?[A-Za-z]" + ATTRS + r"|[!?/][^>]*+)>"
EDGE_WS = r"^[ \t\n\r\f\x0B\x{A0}]+|[ \t\n\r\f\x0B\x{A0}]+$"
DEC_REF = r"^#([0-9]+);?"
HEX_REF = r"^#[xX]([0-9a-fA-F]+);?"
NAME_REF = r"^([A-Za-z][A-Za-z0-9]{1,31};)"
#: Names that count without a semicolon, the longest first.
BARE_REF = "^(" + "|".join(sorted((n for n in html.entities.html5 if n[-1] != ";"), key=lambda n: (-len(n), n))) + ")"
TITLE = r"(?is)<title\b[^>]*>(.*?)</title\s*>"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _table(entries: dict[str, str]) -> Column:
    """A constant map (folded once per plan)."""
    return F.from_json(F.lit(json.dumps(entries)), "map<string,string>")


def code_point_char(n: Column) -> Column:
    """The character of code point ``n`` (a long), via a JSON \\u escape so it
    works beyond Latin-1; code points above U+FFFF become a surrogate pair."""

    def esc(x: Column) -> Column:
        return F.concat(F.lit("\\u"), F.lpad(F.hex(x), 4, "0"))

    hi = F.lit(0xD800) + F.shiftright(n - F.lit(0x10000), 10)
    lo = F.lit(0xDC00) + (n - F.lit(0x10000)).bitwiseAND(F.lit(0x3FF))
    body = F.when(n > F.lit(0xFFFF), F.concat(esc(hi), esc(lo))).otherwise(esc(n))
    return F.from_json(F.concat(F.lit('["'), body, F.lit('"]')), "array<string>").getItem(0)


def _numbered(n: Column) -> Column:
    """HTML5 rules of numeric references: 0, surrogates and numbers beyond
    Unicode are U+FFFD, 0x80-0x9F read as Windows-1252, other controls and
    non-characters vanish."""
    windows = {}
    for i in range(0x80, 0xA0):
        try:
            windows[str(i)] = bytes([i]).decode("cp1252")
        except UnicodeDecodeError:
            windows[str(i)] = chr(i)
    last = n.bitwiseAND(F.lit(0xFFFE))
    gone = n.between(1, 8) | (n == 0x0B) | n.between(0x0E, 0x1F) | (n == 0x7F) | n.between(0xFDD0, 0xFDEF) | (last == 0xFFFE)
    return (
        F.when(n.isNull() | (n == 0) | n.between(0xD800, 0xDFFF) | (n > 0x10FFFF), F.lit("\ufffd"))
        .when(n.between(0x80, 0x9F), F.element_at(_table(windows), n.cast("string")))
        .when(gone, F.lit(""))
        .otherwise(code_point_char(n))
    )


def _reference(piece: Column) -> Column:
    """The text after one ``&`` with its reference decoded, if it is one."""
    dec, hexa = F.regexp_extract(piece, DEC_REF, 1), F.regexp_extract(piece, HEX_REF, 1)
    name, bare = F.regexp_extract(piece, NAME_REF, 1), F.regexp_extract(piece, BARE_REF, 1)
    known = F.try_element_at(_table({k: v for k, v in html.entities.html5.items() if k[-1] == ";"}), name)
    short = F.try_element_at(_table({k: v for k, v in html.entities.html5.items() if k[-1] != ";"}), bare)

    def number(digits: Column, base: int) -> Column:
        d = F.regexp_replace(digits, "^0+(?=.)", "")
        n = d.cast("long") if base == 10 else F.conv(d, 16, 10).cast("long")
        return F.when(F.length(d) <= 7, n).otherwise(F.lit(0x110000).cast("long"))

    def rest(pattern: str) -> Column:
        return F.regexp_replace(piece, pattern, "")

    return (
        F.when(dec != "", F.concat(_numbered(number(dec, 10)), rest(DEC_REF)))
        .when(hexa != "", F.concat(_numbered(number(hexa, 16)), rest(HEX_REF)))
        .when((name != "") & known.isNotNull(), F.concat(known, rest(NAME_REF)))
        .when(bare != "", F.concat(short, rest(BARE_REF)))
        .otherwise(F.concat(F.lit("&"), piece))
    )


def decode_entities(col: str | Column) -> Column:
    """Every character reference, each decoded once (``&amp;lt;`` gives
    ``&lt;``). A text without ``&`` is passed through."""
    s = _c(col)

    def joined(pieces: Column) -> Column:
        decoded = F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))), _reference)
        return F.concat(pieces[0], F.array_join(decoded, ""))

    return F.when(F.contains(s, F.lit("&")), let(F.split(s, "&"), joined)).otherwise(s)


def strip_edges(col: str | Column) -> Column:
    return F.regexp_replace(_c(col), EDGE_WS, "")


def html_text(col: str | Column) -> Column:
    """Drop comments, script and style; every tag is a break; decode
    entities; strip the pieces, drop blank ones, join with one space."""
    s = _c(col)
    for pat in (COMMENT, SCRIPT, STYLE, TAG):
        s = F.regexp_replace(s, pat, SEP)
    s = let(s, decode_entities)
    parts = F.transform(F.split(s, SEP), strip_edges)
    return F.array_join(F.filter(parts, lambda p: p != F.lit("")), " ")


def page_title(col: str | Column) -> Column:
    """Decoded, stripped <title> text; null when absent or blank."""
    t = strip_edges(decode_entities(F.regexp_extract(_c(col), TITLE, 1)))
    return F.nullif(t, F.lit(""))


# Markdown rewrite rules, applied in order (pattern, replacement).
MARKDOWN_RULES = [
    (COMMENT, ""),
    (SCRIPT, ""),
    (STYLE, ""),
    (HEAD, ""),
    (r"(?is)<h1\b" + ATTRS + ">", "\n\n# "),
    (r"(?is)<h2\b" + ATTRS + ">", "\n\n## "),
    (r"(?is)<h3\b" + ATTRS + ">", "\n\n### "),
    (r"(?is)<h4\b" + ATTRS + ">", "\n\n#### "),
    (r"(?is)<h5\b" + ATTRS + ">", "\n\n##### "),
    (r"(?is)<h6\b" + ATTRS + ">", "\n\n###### "),
    (r"(?is)</h[1-6]\s*>", "\n\n"),
    (r"(?is)<li\b" + ATTRS + ">", "\n- "),
    (r"(?is)<br\s*/?>", "\n"),
    (r"(?is)</?(?:p|div|ul|ol|article|section|main|header|footer|nav|table|tr)\b" + ATTRS + ">", "\n\n"),
]
LINK = r"""(?is)<a\b(?:[^>"']|"[^"]*+"|'[^']*+')*?\bhref\s*=\s*["']([^"']*)["']""" + ATTRS + r">(.*?)</a\s*>"
LINES_TRIM = r"[ \t\x{A0}]*\n[ \t\x{A0}]*"
MANY_BREAKS = r"\n{3,}"


def html_to_markdown(col: str | Column) -> Column:
    """Headings to #, list items to "- ", p/div/br to breaks,
    <a href> to [text](href), other tags dropped, entities decoded, blank
    lines collapsed, edges stripped."""
    s = _c(col)
    for pat, rep in MARKDOWN_RULES:
        s = F.regexp_replace(s, pat, rep)
    s = F.regexp_replace(s, LINK, "[$2]($1)")
    s = F.regexp_replace(s, TAG, "")
    s = decode_entities(s)
    s = F.regexp_replace(s, LINES_TRIM, "\n")
    s = F.regexp_replace(s, MANY_BREAKS, "\n\n")
    return strip_edges(s)
