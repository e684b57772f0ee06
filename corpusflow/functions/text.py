"""Column expressions for text: tokens, token estimates, search terms.

All columns are built-in Spark expressions, so they run inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (definitions we fix for the chunker and search; see SURVEY §2.0).
WHITESPACE = r"[ \t\n\r\f]+"
TERM_SPLIT = r"[^\p{L}\p{N}]+"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also where nothing finds common
    parts: in lambdas, generators and branches."""
    return F.transform(F.array(value), body)[0]


def squash_ws(col: str | Column) -> Column:
    """Collapse runs of space, tab, newline, CR and form feed; trim spaces."""
    return F.trim(F.regexp_replace(_c(col), WHITESPACE, " "))


def is_blank(col: str | Column) -> Column:
    return F.coalesce(squash_ws(col) == F.lit(""), F.lit(True))


def tokens(col: str | Column) -> Column:
    """Whitespace tokens. Callers drop blank texts first (a blank text would
    give one empty token)."""
    return F.split(squash_ws(col), " ")


def token_estimate(col: str | Column) -> Column:
    """floor(chars / 4)."""
    return F.floor(F.length(_c(col)) / F.lit(4)).cast("long")


def search_terms(col: str | Column) -> Column:
    """Lower-cased letter/digit runs, blanks removed (BM25 and text match)."""
    return F.filter(F.split(F.lower(_c(col)), TERM_SPLIT), lambda t: t != F.lit(""))


def term_text(col: str | Column) -> Column:
    """A text with the ``search_terms`` of the given one for a reader of bytes: its
    terms are the runs of ASCII letters (in either case), ASCII digits and bytes
    beyond ASCII. An ASCII text is passed through, as no letter needs a table."""

    def body(text: Column) -> Column:
        ascii_ = (F.length(text) == F.octet_length(text)) & F.is_valid_utf8(text)
        return F.when(ascii_, text).otherwise(F.regexp_replace(F.lower(text), TERM_SPLIT, " "))

    return let(_c(col), body)


def word_count(col: str | Column) -> Column:
    return F.when(is_blank(col), F.lit(0)).otherwise(F.size(tokens(col))).cast("long")


def row_blocks(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Cut the rows of an Arrow batch into runs ``(start, end)`` whose sizes add
    up to at most ``limit``; a larger row is a run of its own."""
    ends = np.cumsum(sizes, dtype=np.int64)
    s, done = 0, 0
    while s < len(ends):
        e = max(s + 1, int(np.searchsorted(ends, done + limit, "right")))
        yield s, e
        s, done = e, int(ends[e - 1])
