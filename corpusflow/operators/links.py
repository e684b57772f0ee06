"""Links, sitemaps and URL lists.

Link harvesting and resolution are projections plus ``posexplode``. The
first-occurrence rule is a partial aggregate (min position per URL), and the
page cap is ``row_number() <= n``, which Spark plans as a partial
WindowGroupLimit, so a site with a third of all URLs still ships only n rows
per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusflow.functions.html import ATTRS, COMMENT, SCRIPT, STYLE, decode_entities, strip_edges
from corpusflow.functions.urls import in_scope, normalize_url, resolve_url, skip_extension, url_host
from corpusflow.plans.strategy import dense_position, materialize

A_TAG = r"(?is)<a\s" + ATTRS + ">"
HREF_DQ = r'(?is)\shref\s*=\s*"([^"]*)"'
HREF_SQ = r"(?is)\shref\s*=\s*'([^']*)'"
HREF_NQ = r"""(?is)\shref\s*=\s*([^\s"'>]+)"""
LOC_VALID = r"(?s)<loc\b[^>]*>(.*?)</loc\s*>"
LOC_RAW = r"<loc>(.*?)</loc>"
SITEMAP_DOC = r"(?s)^\s*(?:<\?xml[^>]*\?>\s*)?<(urlset|sitemapindex)\b[^>]*>.*</(urlset|sitemapindex)>\s*$"
DEFAULT_BATCH = 200


def _href(tag: Column) -> Column:
    return (
        F.when(tag.rlike(HREF_DQ), F.regexp_extract(tag, HREF_DQ, 1))
        .when(tag.rlike(HREF_SQ), F.regexp_extract(tag, HREF_SQ, 1))
        .when(tag.rlike(HREF_NQ), F.regexp_extract(tag, HREF_NQ, 1))
    )


def harvest_links(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Href of every <a> tag in document order; empty ones dropped,
    duplicates kept. Output: id, url, pos, href."""
    h = F.col(html_col)
    for pat in (COMMENT, SCRIPT, STYLE):
        h = F.regexp_replace(h, pat, "")
    tags = F.regexp_extract_all(h, F.lit(A_TAG), 0)
    out = pages.select(id_col, url_col, html_col).select(id_col, url_col, F.posexplode(tags).alias("pos", "_tag"))
    out = out.select(id_col, url_col, "pos", decode_entities(_href(F.col("_tag"))).alias("href"))
    return out.where(F.col("href").isNotNull() & (F.col("href") != ""))


def resolve_links(links: DataFrame, base_col: str = "url", href_col: str = "href", out: str = "target") -> DataFrame:
    """Absolute, normalised target of every link."""
    return links.withColumn(out, resolve_url(F.col(base_col), F.col(href_col)))


def filter_urls(
    urls: DataFrame,
    root_col: str = "root",
    url_col: str = "url",
    pos_col: str = "pos",
    include: str | None = None,
    exclude: str | None = None,
    max_pages: int | None = None,
    allow_subdomains: bool = False,
) -> DataFrame:
    """Drop empties; first occurrence of each raw string; scope; include
    and exclude substrings; skip extensions; the first ``max_pages`` per root."""
    u = urls.where(F.col(url_col).isNotNull() & (F.col(url_col) != ""))
    u = u.groupBy(root_col, url_col).agg(F.min(pos_col).alias(pos_col))
    cond = in_scope(F.col(url_col), F.col(root_col), allow_subdomains) & ~skip_extension(url_col)
    if include:
        cond = cond & F.col(url_col).contains(include)
    if exclude:
        cond = cond & ~F.col(url_col).contains(exclude)
    u = u.where(cond)
    if max_pages is not None:
        w = Window.partitionBy(root_col).orderBy(pos_col, url_col)
        u = u.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= max_pages).drop("_rn")
    return u


def sitemap_locs(sitemaps: DataFrame, xml_col: str = "xml") -> DataFrame:
    """Every <loc> of a urlset or sitemapindex in order. A well-formed
    document gives trimmed, entity-decoded values; otherwise the raw regex
    fallback. ``kind`` tells page entries from nested sitemap entries."""
    x = F.col(xml_col)
    valid = x.rlike(SITEMAP_DOC)
    locs = F.when(valid, F.transform(F.regexp_extract_all(x, F.lit(LOC_VALID), 1), lambda v: strip_edges(decode_entities(v)))).otherwise(
        F.regexp_extract_all(x, F.lit(LOC_RAW), 1)
    )
    kind = F.when(F.regexp_extract(x, SITEMAP_DOC, 1) == "sitemapindex", F.lit("sitemap")).otherwise(F.lit("page"))
    # The kind goes with every entry: above the explode it would be looked for
    # in the whole document once per entry.
    entries = F.transform(F.array(kind), lambda k: F.transform(locs, lambda v: F.struct(k.alias("kind"), v.alias("loc"))))[0]
    keep = [c for c in sitemaps.columns if c != xml_col]
    out = sitemaps.select(*keep, F.posexplode(entries).alias("pos", "_e"))
    return out.select(*keep, "_e.kind", "pos", "_e.loc").where(F.col("loc") != "")


def robots_sitemaps(robots: DataFrame, available: DataFrame | None = None, key: str = "host", text_col: str = "robots",
                    url_col: str = "sitemap_url") -> DataFrame:
    """The first ``Sitemap:`` line (any case) whose sitemap can be fetched;
    the value is the text after the first colon, stripped. ``available`` is
    the table of fetchable sitemap URLs (a semi-join), or None for all."""
    lines = robots.select(key, F.posexplode(F.split(F.col(text_col), r"\r\n|\r|\n")).alias("pos", "line"))
    s = lines.where(F.lower("line").startswith("sitemap:")).select(
        key, "pos", strip_edges(F.expr("substr(line, instr(line, ':') + 1)")).alias(url_col)
    )
    if available is not None:
        s = s.join(available.select(F.col(url_col)).distinct(), url_col, "left_semi")
    return s.groupBy(key).agg(F.min_by(url_col, "pos").alias(url_col))


def discover_sitemap_urls(roots: DataFrame, fetched: DataFrame, root_col: str = "root", url_col: str = "url", body_col: str = "body") -> DataFrame:
    """B4 and B5 as one job: the page URLs that each root's sitemaps list.

    ``fetched(url, body)`` holds what could be fetched. A root starts with
    /sitemap.xml, else /sitemap_index.xml (if they hold a urlset or an index),
    else the first fetched sitemap that its robots.txt names, else itself.
    Entries of a sitemap index are sitemaps and are followed, level by level,
    each once per root, so cycles end. Output: root, url, pos (the order of the
    entries, an index's entry standing for what it lists)."""
    docs = fetched.select(F.col(url_col).alias("_url"), F.col(body_col).alias("xml")).groupBy("_url").agg(F.max("xml").alias("xml"))
    base = F.concat(F.regexp_extract(root_col, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1), F.lit("://"), F.regexp_extract(root_col, r"^[^:]+://([^/?#]*)", 1))
    r = roots.select(F.col(root_col).alias("root"), base.alias("_base")).distinct()
    tries = r.select("root", "_base", F.posexplode(F.array(*[F.concat("_base", F.lit(p)) for p in ("/sitemap.xml", "/sitemap_index.xml", "/robots.txt")])).alias("_try", "_url"))
    got = materialize(tries.join(docs, "_url"), "tries")
    direct = got.where("_try < 2 and (contains(xml, '<urlset') or contains(xml, '<sitemapindex'))")
    direct = direct.groupBy("root").agg(F.min(F.struct("_try", "_url", "xml")).alias("s")).select("root", "s._url", "s.xml")
    robots = got.where("_try = 2").join(direct.select("root"), "root", "left_anti")
    named = robots_sitemaps(robots, docs.select(F.col("_url").alias("sitemap_url")), "root", "xml")
    named = named.join(docs.withColumnRenamed("_url", "sitemap_url"), "sitemap_url").select("root", F.col("sitemap_url").alias("_url"), "xml")
    level = materialize(direct.unionByName(named).withColumn("pos", F.lit("")), "sitemaps")
    seen = level.select("root", "_url")
    plain = r.join(level.select("root"), "root", "left_anti").select("root", F.col("root").alias("url"), F.lit("").alias("pos"))
    found = [plain]
    while True:
        locs = sitemap_locs(level.withColumnRenamed("pos", "_at")).withColumn("pos", F.concat("_at", F.lpad(F.col("pos").cast("string"), 10, "0")))
        locs = materialize(locs.select("root", "kind", F.col("loc").alias("url"), "pos"), "locs")
        found.append(locs.where("kind = 'page'").drop("kind"))
        nested = locs.where("kind = 'sitemap'").groupBy("root", F.col("url").alias("_url")).agg(F.min("pos").alias("pos"))
        level = materialize(nested.join(seen, ["root", "_url"], "left_anti").join(docs, "_url").select("root", "_url", "xml", "pos"), "sitemaps")
        if not level.head(1):
            break
        seen = seen.unionByName(level.select("root", "_url"))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def redact_credentials(requests: DataFrame, url_col: str = "url", root_col: str = "root",
                       cols=("cookies", "headers"), allow_subdomains: bool = False) -> DataFrame:
    """Cookies and headers only travel to in-scope URLs."""
    ok = in_scope(F.col(url_col), F.col(root_col), allow_subdomains)
    for c in cols:
        requests = requests.withColumn(c, F.when(ok, F.col(c)))
    return requests.withColumn("send_credentials", ok)


def auto_batch(df: DataFrame, part: list[str], order: list[str], size: int = DEFAULT_BATCH) -> DataFrame:
    """Runs of ``size`` rows per group in order (800 pages -> 4 batches).
    Positions come from ``dense_position``, so a hot group is never one task."""
    p = dense_position(df, part, order, "_pos")
    return p.withColumn("batch_index", F.floor((F.col("_pos") - 1) / F.lit(size)).cast("long")).drop("_pos")


def batch_report(batched: DataFrame, part: list[str], size: int = DEFAULT_BATCH) -> DataFrame:
    return batched.groupBy(*part).agg(
        F.count(F.lit(1)).alias("total_pages"),
        (F.max("batch_index") + 1).alias("batches"),
        F.lit(size).cast("long").alias("batch_size"),
    )


def page_keys(pages: DataFrame, url_col: str = "url", id_col: str = "page_id") -> DataFrame:
    """The fetch table of a crawl: normalised URL -> page (lowest id wins)."""
    return pages.select(normalize_url(url_col).alias("nurl"), id_col).groupBy("nurl").agg(F.min(id_col).alias(id_col))


SITEMAP_FILE_URLS = 50_000  # sitemap protocol limit per file


def build_sitemaps(pages: DataFrame, url_col: str = "url", id_col: str = "page_id") -> DataFrame:
    """Sitemap documents per host, as a site would publish them: one urlset
    file per 50,000 URLs (the protocol's limit), so no file is unbounded.
    Hosts whose name starts with 'm.' publish a truncated (malformed) file,
    which exercises the regex fallback of ``sitemap_locs``."""
    p = pages.select(
        url_host(url_col).alias("host"),
        F.floor(F.col(id_col) / F.lit(SITEMAP_FILE_URLS)).alias("part"),
        F.col(id_col),
        F.col(url_col),
    )
    g = p.groupBy("host", "part").agg(F.sort_array(F.collect_list(F.struct(id_col, url_col))).alias("_u"))
    entries = F.array_join(
        F.transform(F.col("_u"), lambda e: F.concat(F.lit("<url><loc>"), F.replace(e[url_col], F.lit("&"), F.lit("&amp;")), F.lit("</loc></url>"))),
        "\n",
    )
    body = F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?>\n<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">\n'), entries)
    xml = F.when(F.col("host").startswith("m."), body).otherwise(F.concat(body, F.lit("\n</urlset>")))
    return g.select("host", "part", F.concat(F.lit("https://"), F.col("host"), F.lit("/sitemap.xml")).alias("sitemap_url"), xml.alias("xml"))


def build_robots(hosts: DataFrame, host_col: str = "host") -> DataFrame:
    """robots.txt per host: a dead sitemap line, then the live one."""
    text = F.concat(
        F.lit("User-agent: *\nDisallow: /private\nSITEMAP: https://"), F.col(host_col), F.lit("/old-sitemap.xml\n"),
        F.lit("Sitemap:  https://"), F.col(host_col), F.lit("/sitemap.xml \n"),
    )
    return hosts.select(F.col(host_col).alias("host"), text.alias("robots"))
