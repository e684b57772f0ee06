"""Element trees, selectors, aligned lists and sitemap discovery, by hand."""

import pytest

from corpusflow.functions.elements import element_list, parse_selector
from corpusflow.operators import extraction as oe
from corpusflow.operators import html as oh
from corpusflow.operators import links as ol
from corpusflow.plans.ingest import sitemap_to_chunks


def spans(html):
    return [(e["tag"], html[e["first"] : e["last"]], e["depth"]) for e in element_list(html)]


def test_elements_end_where_they_should():
    assert spans("<div id='x'><div>in</div></div><div>out</div>") == [
        ("div", "<div id='x'><div>in</div></div>", 0), ("div", "<div>in</div>", 1), ("div", "<div>out</div>", 0)
    ]
    assert spans("<ul><li>a<li>b<ul><li>c</ul></ul>") == [
        ("ul", "<ul><li>a<li>b<ul><li>c</ul></ul>", 0), ("li", "<li>a", 1), ("li", "<li>b<ul><li>c</ul>", 1), ("ul", "<ul><li>c</ul>", 2), ("li", "<li>c", 3)
    ]
    assert spans("<p>one<p>two<div>three</div>") == [("p", "<p>one", 0), ("p", "<p>two", 0), ("div", "<div>three</div>", 0)]
    assert spans("<b>x</i></b></b>y") == [("b", "<b>x</i></b>", 0)]
    assert spans("<a><br><img src=x/>z") == [("a", "<a><br><img src=x/>z", 0), ("br", "<br>", 1), ("img", "<img src=x/>", 1)]
    assert spans("<script>'<div>'</script><!-- <p> --><q t='>'>v</q>") == [("script", "<script>'<div>'</script>", 0), ("q", "<q t='>'>v</q>", 0)]
    assert spans("<!-- never closed <p>") == [] and spans("a < b <") == [] and spans("") == []
    assert [e["classes"] for e in element_list("<i class=' a  b '><i CLASS=c id=d id=e data-id=f>")] == [["a", "b"], ["c"]]
    deep = "<div>" * 3000 + "x"
    assert len(element_list(deep)) == 3000 and element_list(deep)[-1]["last"] == len(deep)
    assert len(element_list("<p " + "a='b' " * 200_000 + ">x")) == 1


def test_selectors(spark):
    page = "<main><div class='a b'><p id=one>1</p></div><section><p class=a>2</p><div><p>3</p></div></section></main><p>4</p>"
    cases = {
        "p": "<p id=one>1</p>", "#one": "<p id=one>1</p>", "p.a": "<p class=a>2</p>", ".a.b": "<div class='a b'><p id=one>1</p></div>", "section p": "<p class=a>2</p>",
        "section > div p": "<p>3</p>", "main > p": page, "main section>p": "<p class=a>2</p>", "div > p": "<p id=one>1</p>", "table, section p": "<p class=a>2</p>",
        "MAIN > *": "<div class='a b'><p id=one>1</p></div>", "#gone": page, "section div > p": "<p>3</p>",
    }
    df = spark.createDataFrame([(1, page), (2, None), (3, "")], "page_id long, html string")
    for selector, want in cases.items():
        got = {r.page_id: r.html for r in oh.select_section(df, selector).collect()}
        assert got == {1: want, 2: None, 3: ""}, selector
    for bad in ("", "a:hover", "> p", "a[href]", "p ,", "#a#b"):
        with pytest.raises(ValueError):
            parse_selector(bad)
    wide = spark.createDataFrame([(1, "é😀<b>ü</b>")], "page_id long, html string")
    assert oh.select_section(wide, "b").first().html == "<b>ü</b>"
    plan = oh.select_section(df, "section p")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_missing_fields_stay_in_their_item(spark):
    spec, rules = {"name": "string", "price": "number"}, {"name": r"<b>(.*?)</b>", "price": r"<i>(.*?)</i>"}
    df = spark.createDataFrame([(1, "<i>0</i><b>A</b><b>B</b><i>2</i><b>C</b><i>x</i><i>3</i>"), (2, "nothing"), (3, None)], "page_id long, html string")
    got = [tuple(r) for r in oe.extract_list(df, spec, rules).collect()]
    assert got == [(1, 0, "A", None, 3), (1, 1, "B", 2.0, 3), (1, 2, "C", None, 3)]
    html = "<ul><li><i>1</i><b>A</b></li><li><b>B</b></li><li><i>3</i></li><li>empty</li></ul><b>no item</b>"
    got = [tuple(r) for r in oe.extract_list(spark.createDataFrame([(1, html)], "page_id long, html string"), spec, rules, record="ul > li").collect()]
    assert got == [(1, 0, "A", 1.0, 3), (1, 1, "B", None, 3), (1, 2, None, 3.0, 3)]


def test_sitemap_discovery(spark):
    h = "https://s.example.com"
    bodies = [
        (h + "/sitemap.xml", "<sitemapindex><sitemap><loc>" + h + "/b.xml</loc></sitemap><sitemap><loc>" + h + "/sitemap.xml</loc></sitemap><sitemap><loc>"
         + h + "/a.xml</loc></sitemap></sitemapindex>"),
        (h + "/a.xml", f"<urlset><url><loc>{h}/1</loc></url><url><loc>{h}/3</loc></url></urlset>"),
        (h + "/b.xml", f"<urlset><url><loc>{h}/2</loc></url><url><loc>{h}/1</loc></url><url><loc>https://other.org/9</loc></url></urlset>"),
        ("http://r.org/robots.txt", "sitemap: http://r.org/none.xml\nSiteMap: http://r.org/s.xml"), ("http://r.org/s.xml", "<urlset><url><loc>http://r.org/x</loc></url></urlset>"),
        ("http://r.org/sitemap.xml", "an error page"),
    ]
    roots = spark.createDataFrame([(h + "/start",), ("http://r.org",), ("http://bare.org/p",)], "root string")
    fetched = spark.createDataFrame(bodies + bodies[:1], "url string, body string")
    got = {}
    for r in ol.discover_sitemap_urls(roots, fetched).orderBy("root", "pos").collect():
        got.setdefault(r.root, []).append(r.url)
    assert got == {h + "/start": [h + "/2", h + "/1", "https://other.org/9", h + "/1", h + "/3"], "http://r.org": ["http://r.org/x"], "http://bare.org/p": ["http://bare.org/p"]}
    pages = spark.createDataFrame([(1, h + "/1", "<p>one</p>"), (2, h + "/2", "<p>two</p>"), (5, "http://bare.org/p", "<p>bare</p>")], "page_id long, url string, html string")
    chunks, report = sitemap_to_chunks(roots, fetched, pages, max_pages=2)
    assert sorted((r.root, r.content) for r in chunks.collect()) == [("http://bare.org/p", "bare"), (h + "/start", "one"), (h + "/start", "two")]
    rep = {r.root: (r.pages_discovered, r.pages_crawled, r.pages_failed, r.total_chunks) for r in report.collect()}
    assert rep == {h + "/start": (2, 2, 0, 2), "http://r.org": (1, 0, 1, 0), "http://bare.org/p": (1, 1, 0, 1)}
