"""B1, B2, B6, B7, A8 against the standard library on small tables."""

from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from corpusflow.functions.html import decode_entities, html_text, page_title
from corpusflow.functions.urls import in_scope, normalize_url, resolve_url
from corpusflow.operators.links import harvest_links
from tests.conftest import SF_SMALL

SCOPE = [
    # docstring pairs of the reference
    ("https://company.com/page", "https://company.com", False, True),
    ("https://wiki.company.com", "https://company.com", False, False),
    ("https://wiki.company.com", "https://company.com", True, True),
    ("https://wiki.company.co.uk", "https://company.co.uk", True, True),
    ("https://evil.co.uk", "https://company.co.uk", True, False),
    # siblings, ports, case
    ("https://docs.company.com", "https://wiki.company.com", True, True),
    ("https://docs.company.com", "https://wiki.company.com", False, False),
    ("https://Company.COM:8443/x", "https://company.com", False, True),
    # fixes: user info is not the host; empty hosts are never in scope
    ("https://company.com:x@evil.com/", "https://company.com", False, False),
    ("mailto:a@company.com", "https://company.com", True, False),
    ("", "", False, False),
]


def test_scope_table(spark):
    df = spark.createDataFrame(SCOPE, "t string, r string, sub boolean, want boolean")
    rows = df.select("want", F.when(F.col("sub"), in_scope(F.col("t"), F.col("r"), True))
                     .otherwise(in_scope(F.col("t"), F.col("r"), False)).alias("got")).collect()
    assert [r.got for r in rows] == [r.want for r in rows]


RESOLVE = [
    ("https://h.com/a/b/c", "/x"), ("https://h.com/a/b/c", "x"), ("https://h.com/a/b/c", "../y"),
    ("https://h.com/a/b/c", "../../../../y"), ("https://h.com/a/b/c?q=0", "?q=1"), ("https://h.com/a/b/c", "#top"),
    ("https://h.com/a/b/c", "//g.org/z/"), ("https://h.com/a/b/", "mailto:x@h.com"), ("https://h.com/a/b/c", "https://o.net/p/"),
    ("https://h.com", "x"), ("https://h.com/a/", "./"), ("https://h.com/a/b", "."), ("https://h.com/a/b", ".."),
    ("https://h.com/a//b/c", "d"), ("http://h.com/a/b/c#frag", ""), ("https://h.com/a/b/c", "/p/./q/../r"),
]


def test_resolve_matches_urljoin(spark):
    df = spark.createDataFrame(RESOLVE, "b string, h string")
    got = df.select(resolve_url(F.col("b"), F.col("h")).alias("r")).collect()
    want = [urljoin(b, h).split("#")[0].rstrip("/") for b, h in RESOLVE]
    assert [r.r for r in got] == want


def test_normalize(spark):
    df = spark.createDataFrame([("https://a.com/x/#top",), ("https://a.com/x//",), ("https://a.com/x?q=1#f",)], "u string")
    assert [r.n for r in df.select(normalize_url("u").alias("n")).collect()] == ["https://a.com/x", "https://a.com/x", "https://a.com/x?q=1"]


# (html, visible text, links): written by hand.
HTML_CASES = [
    ("<p>a &lt;b&gt; &#233;&#x41; &amp;lt;</p><a href='/q'>q</a><a href=/r>r</a><a href=\"\">e</a><!-- <a href='/no'> -->", "a <b> éA &lt; q r e", ["/q", "/r"]),
    ("<html><head><title> T &amp; t </title></head><body><SCRIPT>x<y</SCRIPT>  z  </body></html>", "T & t z", []),
    ("<p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2", []),
    ('<a title="1>0" href="/y">y</a>', "y", ["/y"]),
    ("<a title='a>b' href=/z>z</a><b>x</b>", "z x", ["/z"]),
    ("before<script>var a = '</p>'; <a href='/no'>", "before", []),
    ("before<style>p{}", "before", []),
    ("&eacute;&rarr;&notit;&copy 5 &unknown; & &#9999999; &#38;amp; &#0; &#x80; &AMP", "é→¬it;© 5 &unknown; & \ufffd &amp; \ufffd € &", []),
    ("<!DOCTYPE html><?php x ?>t<br/>u", "t u", []),
    ("", "", []),
]


def test_html_text_and_links_by_hand(spark):
    pages = spark.createDataFrame([(i, "https://x.com/", h) for i, (h, _, _) in enumerate(HTML_CASES)], "page_id long, url string, html string")
    text = {r.page_id: r.t for r in pages.select("page_id", html_text("html").alias("t")).collect()}
    links = {}
    for r in sorted(harvest_links(pages).collect(), key=lambda r: (r.page_id, r.pos)):
        links.setdefault(r.page_id, []).append(r.href)
    for i, (h, t, hrefs) in enumerate(HTML_CASES):
        assert text[i] == t, h
        assert links.get(i, []) == hrefs, h


def test_entities_equal_the_standard_library(spark):
    import html as stdlib
    import html.entities

    names = [f"x&{n}y &{n}" for n in html.entities.html5]
    names += [f"&#{n};|&#x{n:x};|&#{n}" for n in [*range(0, 300), 0xD800, 0xDFFF, 0xFDD0, 0xFFFE, 0xFFFF, 0x10000, 0x1F600, 0x10FFFF, 0x110000, 10**9]]
    names += ["&", "&;", "&#;", "&#x;", "&&lt;&", "a&b&c", "&ltx", "&amp;amp;", "no reference"]
    df = spark.createDataFrame([(n,) for n in names], "s string")
    for r in df.select("s", decode_entities("s").alias("d")).collect():
        assert r.d == stdlib.unescape(r.s), r.s


def test_long_tags_do_not_recurse(spark):
    page = "<a " + " ".join(f'data-{i}="{i}>"' for i in range(3000)) + ' href="/end">t</a>'
    df = spark.createDataFrame([(1, "https://x.com/", page)], "page_id long, url string, html string")
    assert [r.href for r in harvest_links(df).collect()] == ["/end"]
    assert df.select(html_text("html").alias("t")).first().t == "t"


def test_title(spark):
    df = spark.createDataFrame([("<title> A &amp; B </title>",), ("<p>none</p>",), ("<title>  </title>",)], "html string")
    assert [r.t for r in df.select(page_title("html").alias("t")).collect()] == ["A & B", None, None]
