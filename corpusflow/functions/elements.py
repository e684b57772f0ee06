"""The elements of a page as intervals, and CSS selectors over them.

A row-local tag stack gives every element its place: where its opening tag
starts, where it ends and how deep it stands. Selectors are then questions about
intervals: an element stands inside another if its interval does.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusflow.functions.text import row_blocks

# Fixed values of HTML: elements without an end tag, elements whose content is
# text, which start tags end an open element, and where the search for it stops.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW_TEXT = ("script", "style", "textarea", "title")
ENDED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "thead", "tfoot"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"},
    "option": {"option", "optgroup"}, "thead": {"tbody", "tfoot"}, "tbody": {"tbody", "tfoot"},
    "p": set(
        "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()
    ),
}
SCOPES = {"ul", "ol", "dl", "table", "select", "td", "th", "body", "html", "div", "section", "article", "main"}

_TAG = re.compile(
    r"<(?:!--(?:.*?-->|.*)|(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))*+)(?:>|\Z)|[!?/][^>]*+(?:>|\Z))", re.S
)
_ATTR = re.compile(r"""(?<![^\s"'/])(id|class)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
TREE = "array<struct<tag:string,id:string,classes:array<string>,first:int,last:int,depth:int>>"
_TREE = pa.list_(pa.struct({"tag": pa.string(), "id": pa.string(), "classes": pa.list_(pa.string()), "first": pa.int32(), "last": pa.int32(), "depth": pa.int32()}))
#: Bytes of the pages whose elements a task holds as Python objects at once.
BLOCK_BYTES = 1 << 20
STEP = re.compile(r"\s*(>?)\s*([^\s>]+)")
SIMPLE = re.compile(r"([A-Za-z][A-Za-z0-9]*|\*)?((?:[#.][\w-]+)*)\Z")


def element_list(html: str) -> list[dict]:
    """Elements in document order; ``first`` and ``last`` are the places of
    the first character and after the last one. An end tag closes the nearest
    open element of its name and all inside it; one that fits none is ignored.
    An element that is never closed ends where what holds it ends, or where a
    start tag ends it by rule."""
    out: list[dict] = []
    stack: list[dict] = []

    def close(down_to: int, at: int) -> None:
        while len(stack) > down_to:
            stack.pop()["last"] = at

    at, end = 0, len(html)
    while m := _TAG.search(html, at):
        at = m.end()
        if not m[2]:
            continue
        name = m[2].lower()
        if m[1]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i]["tag"] == name:
                    close(i + 1, m.start())
                    close(i, at)
                    break
            continue
        while stack:
            for i in range(len(stack) - 1, -1, -1):
                if name in ENDED_BY.get(stack[i]["tag"], ()):
                    break
                if stack[i]["tag"] in SCOPES:
                    i = -1
                    break
            else:
                i = -1
            if i < 0:
                break
            close(i, m.start())
        found: dict[str, str] = {}
        for a in _ATTR.finditer(m[3]):
            found.setdefault(a[1].lower(), a[2] if a[2] is not None else a[3] if a[3] is not None else a[4])
        e = {"tag": name, "id": found.get("id"), "classes": found.get("class", "").split(), "first": m.start(), "last": at, "depth": len(stack)}
        out.append(e)
        if name in VOID or m[3].endswith("/"):
            continue
        stack.append(e)
        if name in RAW_TEXT:
            tail = re.compile(rf"</{name}\s*+>", re.I).search(html, at)
            at = tail.start() if tail else end
    close(0, end)
    return out


def elements(html: str | Column) -> Column:
    """Every element of the page, as of ``element_list``; places are counted in
    code points from 0. A batch of pages is answered in blocks of ``BLOCK_BYTES``
    (a longer page is a block of its own)."""

    @F.arrow_udf(TREE)
    def run(it: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for pages in it:
            for s, e in row_blocks(np.asarray(pc.fill_null(pc.binary_length(pages), 0)), BLOCK_BYTES):
                yield pa.array([[] if p is None else element_list(p) for p in pages.slice(s, e - s).to_pylist()], _TREE)

    return run(F.col(html) if isinstance(html, str) else html)


def parse_selector(selector: str) -> list[list[tuple[bool, str, str | None, list[str]]]]:
    """Alternatives (comma) of steps ``(child of the step before?, tag or '',
    id, classes)``. Steps are ``tag``, ``#id``, ``.class`` and compounds of
    them; a blank is a descendant, ``>`` a child."""
    out = []
    for alternative in selector.split(","):
        steps, at, text = [], 0, alternative.strip()
        while at < len(text):
            m = STEP.match(text, at)
            simple = SIMPLE.match(m[2]) if m else None
            if not simple or not m[2]:
                raise ValueError(f"unsupported selector {selector!r}: use tag, #id, .class, blanks, > and commas")
            marks = re.findall(r"[#.][\w-]+", simple[2])
            ids = [x[1:] for x in marks if x[0] == "#"]
            if len(ids) > 1:
                raise ValueError(f"unsupported selector {selector!r}: more than one id")
            steps.append((bool(m[1]), (simple[1] or "").lower().replace("*", ""), ids[0] if ids else None, [x[1:] for x in marks if x[0] == "."]))
            at = m.end()
        if not steps or steps[0][0]:
            raise ValueError(f"unsupported selector {selector!r}")
        out.append(steps)
    return out


def matching(tree: Column, selector: str) -> Column:
    """The elements of ``tree`` that ``selector`` matches, in document order."""

    def fits(e: Column, step) -> Column:
        _, tag, ident, classes = step
        cond = F.lit(True)
        if tag:
            cond = cond & (e["tag"] == tag)
        if ident is not None:
            cond = cond & (F.coalesce(e["id"], F.lit("")) == ident)
        for c in classes:
            cond = cond & F.array_contains(e["classes"], c)
        return cond

    def below(found: Column, step) -> Column:
        def inside(above: Column) -> Column:
            def under(e: Column) -> Column:
                return F.exists(above, lambda a: (a["first"] < e["first"]) & (a["last"] >= e["last"]) & ((a["depth"] + 1 == e["depth"]) | F.lit(not step[0])))

            return F.filter(tree, lambda e: fits(e, step) & under(e))

        return F.transform(F.array(found), inside)[0]  # found is computed once

    def walk(steps) -> Column:
        found = F.filter(tree, lambda e: fits(e, steps[0]))
        for step in steps[1:]:
            found = below(found, step)
        return found

    alternatives = [walk(steps) for steps in parse_selector(selector)]
    if len(alternatives) == 1:
        return alternatives[0]
    return F.array_sort(F.array_distinct(F.concat(*alternatives)), lambda a, b: a["first"] - b["first"])


def outer_html(html: Column, element: Column) -> Column:
    return F.substring(html, element["first"] + 1, element["last"] - element["first"])
