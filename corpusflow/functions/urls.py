"""URL expressions (B1, B2, B7): normalise, host, scope, resolve.

Pure column expressions: a link table of any size is scoped and resolved
in a narrow projection without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Registry labels that make the apex three labels long.
REGISTRY_PREFIXES = ["co", "com", "org", "net", "edu", "gov", "ac"]
# Suffixes a crawl never fetches (matched on the lower-cased URL).
SKIP_EXTENSIONS = [
    ".pdf", ".jpg", ".jpeg", ".png", ".gif", ".gifv", ".webp", ".mp4", ".avi", ".mov",
    ".svg", ".css", ".js", ".zip", ".tar", ".gz", ".xml", ".json", ".txt",
]

SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):"
NETLOC = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"
SKIP_RE = r"(?i)(?:" + "|".join(e.replace(".", r"\.") for e in SKIP_EXTENSIONS) + r")$"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def normalize_url(col: str | Column) -> Column:
    """B1: cut at the first '#', strip every trailing '/'; query kept."""
    return F.regexp_replace(F.substring_index(_c(col), "#", 1), "/+$", "")


def url_host(col: str | Column) -> Column:
    """Lower-cased host: netloc without user info (fix: the reference kept
    'user@' and so misread 'a.com:x@b.com' as a.com) and without port."""
    netloc = F.regexp_extract(_c(col), NETLOC, 1)
    host = F.regexp_replace(netloc, r"^.*@", "")
    return F.lower(F.substring_index(host, ":", 1))


def _apex(labels: Column, n: Column) -> Column:
    return F.array_join(F.slice(labels, -n, n), ".")


def in_scope(target: str | Column, root: str | Column, allow_subdomains: bool | Column = False) -> Column:
    """B2: same host; with subdomains also a child of the root host or a host
    sharing its apex (last 2 labels, 3 when the root's second-last label is a
    registry label). An empty host is never in scope."""
    th, rh = url_host(target), url_host(root)
    allow = allow_subdomains if isinstance(allow_subdomains, Column) else F.lit(bool(allow_subdomains))
    rl, tl = F.split(rh, r"\."), F.split(th, r"\.")
    apex_n = F.when(
        (F.size(rl) >= 3) & F.element_at(rl, -2).isin(REGISTRY_PREFIXES), F.lit(3)
    ).otherwise(F.lit(2))
    sub = F.endswith(th, F.concat(F.lit("."), rh)) | (
        (F.size(rl) >= apex_n) & (F.size(tl) >= apex_n) & (_apex(rl, apex_n) == _apex(tl, apex_n))
    )
    ok = (th == rh) | (allow & sub)
    return F.coalesce((th != F.lit("")) & (rh != F.lit("")) & ok, F.lit(False))


def skip_extension(col: str | Column) -> Column:
    return F.coalesce(F.lower(_c(col)).rlike(SKIP_RE), F.lit(False))


def _pop_push(acc: Column, seg: Column) -> Column:
    # Segments are kept in one string, each prefixed by \u0002; '..' pops.
    return (
        F.when(seg == F.lit(".."), F.regexp_replace(acc, "\u0002[^\u0002]*$", ""))
        .when(seg == F.lit("."), acc)
        .otherwise(F.concat(acc, F.lit("\u0002"), seg))
    )


def resolve_url(base: str | Column, href: str | Column) -> Column:
    """RFC 3986 reference resolution (as urllib's urljoin) of ``href``
    against ``base``, then B1. Other schemes (mailto:, javascript:) stay as
    they are and fail scope later."""
    b, h = _c(base), _c(href)
    b_scheme = F.lower(F.regexp_extract(b, SCHEME, 1))
    h_scheme = F.lower(F.regexp_extract(h, SCHEME, 1))
    b_nofrag = F.substring_index(b, "#", 1)
    b_origin = F.regexp_extract(b_nofrag, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    b_path = F.regexp_extract(b_nofrag, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)
    b_noquery = F.substring_index(b_nofrag, "?", 1)
    h_path = F.regexp_extract(h, r"^([^?#]*)", 1)
    h_rest = F.substring(h, F.length(h_path) + 1, 1 << 30)

    # Path merge: relative paths hang off the base directory; empty middle
    # segments are dropped (as urljoin does), then dot segments resolved.
    b_dir = F.regexp_replace(b_path, "[^/]*$", "")
    rel = F.split(F.concat(b_dir, h_path), "/")
    rel_mid = F.concat(
        F.slice(rel, 1, 1),
        F.filter(F.slice(rel, 2, F.greatest(F.size(rel) - 2, F.lit(0))), lambda x: x != F.lit("")),
        F.when(F.size(rel) > 1, F.slice(rel, -1, 1)).otherwise(F.array().cast("array<string>")),
    )
    segs = F.when(F.startswith(h_path, F.lit("/")), F.split(h_path, "/")).otherwise(rel_mid)
    acc = F.aggregate(segs, F.lit(""), _pop_push)
    tail_dot = F.element_at(segs, -1).isin(".", "..")
    joined = F.concat(F.regexp_replace(F.substring(acc, 2, 1 << 30), "\u0002", "/"), F.when(tail_dot, F.lit("/")).otherwise(F.lit("")))
    path = F.when(joined == F.lit(""), F.lit("/")).otherwise(
        F.when(F.startswith(joined, F.lit("/")), joined).otherwise(F.concat(F.lit("/"), joined))
    )
    resolved = (
        F.when(h == F.lit(""), b)
        .when((h_scheme != F.lit("")) & (h_scheme != b_scheme), h)
        .when(F.startswith(h, F.lit("//")), F.concat(b_scheme, F.lit(":"), h))
        .when((h_scheme != F.lit("")), h)
        .when(F.startswith(h, F.lit("#")), F.concat(b_nofrag, h))
        .when(F.startswith(h, F.lit("?")), F.concat(b_noquery, h))
        .otherwise(F.concat(b_origin, path, h_rest))
    )
    return normalize_url(resolved)
