"""Pages to text and Markdown.

Everything is a projection over the ``pages`` table: no shuffle, and the
``html`` column is read only by the operators that need it. Selectors look at
the page's element tree, a row-local tag stack.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.functions.elements import elements, matching, outer_html
from corpusflow.functions.html import html_text, html_to_markdown, page_title
from corpusflow.functions.text import word_count

# Content sections we look for, in order.
CANDIDATE_SELECTORS = ["article", "main", "#main-content", ".content", ".post-body"]
THIN_CONTENT_WORDS = 50
THIN_CONTENT_WARNING = "Very little text was found on this page; the result may be incomplete."


def open_tag_pattern(selector: str) -> str:
    """Pattern of the opening tag a simple selector (tag, #id, .class) matches.
    Group 1 is the tag name."""
    sel = selector.strip()
    if sel.startswith("#"):
        ident = re.escape(sel[1:])
        return r"""(?is)<([a-z][a-z0-9]*)\b[^>]*\sid\s*=\s*["']""" + ident + r"""["'][^>]*>"""
    if sel.startswith("."):
        cls = re.escape(sel[1:])
        return (r"""(?is)<([a-z][a-z0-9]*)\b[^>]*\sclass\s*=\s*["'](?:[^"']*\s)?""" + cls
                + r"""(?:\s[^"']*)?["'][^>]*>""")
    if not re.fullmatch(r"[A-Za-z][A-Za-z0-9]*", sel):
        raise ValueError(f"unsupported selector {selector!r}: use tag, #id or .class")
    return r"(?is)<(" + sel + r")\b[^>]*>"


def select_sections(pages: DataFrame, selectors: dict[str, str], html_col: str = "html") -> DataFrame:
    """D2 for several selectors at once: one column per name with the first
    element that its selector matches, from its opening to its own closing tag;
    the whole page where none does. The page's elements are found once."""
    tree = pages.withColumn("_tree", elements(html_col))
    cols = {}
    for name, selector in selectors.items():
        first = F.try_element_at(matching(F.col("_tree"), selector), F.lit(1))
        cols[name] = F.transform(F.array(first), lambda e: F.when(e.isNull(), F.col(html_col)).otherwise(outer_html(F.col(html_col), e)))[0]
    return tree.withColumns(cols).drop("_tree")


def select_section(pages: DataFrame, selector: str | None, html_col: str = "html") -> DataFrame:
    """Restrict the page to the first element matching ``selector`` (tags,
    #ids, .classes and compounds of them, descendants, children, alternatives);
    no match keeps the whole page."""
    return select_sections(pages, {html_col: selector}, html_col) if selector else pages


def detect_selectors(pages: DataFrame, html_col: str = "html", candidates=CANDIDATE_SELECTORS) -> DataFrame:
    """D3: which candidate sections the page has, in candidate order."""
    found = F.array(*[F.when(F.col(html_col).rlike(open_tag_pattern(s)), F.lit(s)) for s in candidates])
    return pages.withColumn("selectors_found", F.filter(found, lambda x: x.isNotNull()))


def extract_text(pages: DataFrame, html_col: str = "html", out: str = "text") -> DataFrame:
    """Visible text of every page."""
    return pages.withColumn(out, html_text(html_col))


def page_titles(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """Page title, null when absent."""
    return pages.withColumn("title", page_title(html_col))


def to_markdown(pages: DataFrame, html_col: str = "html", selector: str | None = None) -> DataFrame:
    """D4 (with D1, D2, D3): one Markdown row per page."""
    p = detect_selectors(pages, html_col)
    p = p.withColumn("title", page_title(html_col))
    p = select_section(p, selector, html_col)
    return p.withColumn("markdown", html_to_markdown(html_col))


def thin_content(df: DataFrame, text_col: str = "markdown", min_words: int = THIN_CONTENT_WORDS) -> DataFrame:
    """A warning when the page gave fewer than ``min_words`` words."""
    return df.withColumn(
        "content_warning",
        F.when(word_count(text_col) < F.lit(min_words), F.lit(THIN_CONTENT_WARNING)),
    )
