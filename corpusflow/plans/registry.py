"""Registered queries: one per operator of SURVEY §2, each over whole tables.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and, where the operator is
expressible in SQL, ``ORACLE[name]`` with the same columns for DuckDB.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.functions.text import word_count
from corpusflow.operators import chunking as ch
from corpusflow.operators import index as ix
from corpusflow.operators import retrieval as rt
from corpusflow.plans import sql_parts as S
from corpusflow.plans.strategy import materialize, spread
from corpusflow.session import read_table, shared_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def T(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_table(spark, sf, name)


def _bench_queries(spark, sf) -> DataFrame:
    return T(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def _chunks(spark, sf, size=512, overlap=50) -> DataFrame:
    return ch.chunk_text(T(spark, sf, "documents"), "doc_id", "text", size, overlap)


# ---------------------------------------------------------------- C: chunking

register(
    "chunk_text",
    f"WITH {S.chunks_cte()} SELECT doc_id, chunk_index, content, n_tokens, token_estimate FROM chunks",
)(lambda spark, sf: _chunks(spark, sf))


def _hier_sql() -> str:
    return f"""WITH {S.chunks_cte('parents')},
kids_w AS (
  SELECT doc_id, chunk_index AS parent_index, content AS parent_text, string_split(content, ' ') AS toks,
         unnest(range(0, len(string_split(content, ' ')), 128)) AS s
  FROM parents
)
SELECT doc_id, CAST(parent_index * 4 + s // 128 AS INTEGER) AS chunk_index,
       array_to_string(toks[s + 1 : s + 128], ' ') AS content,
       parent_text, parent_index, true AS is_hierarchical,
       CAST(floor(length(array_to_string(toks[s + 1 : s + 128], ' ')) / 4) AS BIGINT) AS token_estimate
FROM kids_w"""


register("chunk_hierarchical", _hier_sql())(
    lambda spark, sf: ch.chunk_hierarchical(T(spark, sf, "documents"), "doc_id", "text", 512, 128, 50)
)


def _contexts(spark, sf) -> DataFrame:
    # Context per chunk from the labels table: labelled good documents get a
    # context line, labelled bad ones a blank one, unlabelled ones none.
    keys = _chunks(spark, sf).select("doc_id", "chunk_index")
    labels = T(spark, sf, "labels")
    docs = T(spark, sf, "documents").select("doc_id", "lang", "source")
    return keys.join(labels, "doc_id").join(docs, "doc_id").select(
        "doc_id",
        "chunk_index",
        F.when(F.col("quality") == 1, F.concat(F.lit("Part "), F.col("chunk_index").cast("string"), F.lit(" of "), F.col("source"), F.lit(" ("), F.col("lang"), F.lit(")")))
        .otherwise(F.lit("  ")).alias("context"),
    )


@register(
    "contextualize",
    f"""WITH {S.chunks_cte()},
ctx AS (
  SELECT c.doc_id, c.chunk_index,
         CASE WHEN l.quality = 1 THEN 'Part ' || CAST(c.chunk_index AS VARCHAR) || ' of ' || d.source || ' (' || d.lang || ')'
              ELSE '  ' END AS context
  FROM chunks c JOIN labels l USING (doc_id) JOIN documents d USING (doc_id)
),
good AS (SELECT * FROM ctx WHERE {S.squash('context')} <> '')
SELECT c.doc_id, c.chunk_index, c.n_tokens, c.token_estimate,
       CASE WHEN g.context IS NOT NULL THEN 'Context: ' || g.context || chr(10) || chr(10) || c.content ELSE c.content END AS content,
       g.context AS context,
       CASE WHEN g.context IS NOT NULL THEN c.content END AS original_text
FROM chunks c LEFT JOIN good g USING (doc_id, chunk_index)""",
)
def q_contextualize(spark, sf):
    return ch.contextualize(_chunks(spark, sf), _contexts(spark, sf))


@register(
    "truncate_words",
    f"""SELECT doc_id, len(string_split({S.squash('text')}, ' ')) > 1000 AS content_truncated,
       CASE WHEN {S.squash('text')} <> '' AND len(string_split({S.squash('text')}, ' ')) > 1000
            THEN array_to_string(string_split({S.squash('text')}, ' ')[1:1000], ' ') ELSE text END AS text
FROM documents""",
)
def q_truncate_words(spark, sf):
    return ch.truncate_words(T(spark, sf, "documents").select("doc_id", "text"), "text", 1000)


register(
    "cap_chunks",
    f"WITH {S.chunks_cte(size=64, overlap=0)} SELECT doc_id, chunk_index, CAST(chunk_index // 10 AS INTEGER) AS request_index FROM chunks",
)(lambda spark, sf: ch.cap_chunks(_chunks(spark, sf, 64, 0), 10).select("doc_id", "chunk_index", "request_index"))


register(
    "chunk_stats",
    f"""WITH {S.chunks_cte()}
SELECT doc_id, count(*) AS total_chunks, sum(token_estimate) AS total_tokens FROM chunks GROUP BY doc_id""",
)(lambda spark, sf: ch.chunk_stats(_chunks(spark, sf), "doc_id"))


register(
    "reassemble",
    f"""WITH {S.chunks_cte()}
SELECT doc_id, trim(string_agg(content, chr(10) || chr(10) ORDER BY chunk_index)) AS text FROM chunks GROUP BY doc_id""",
)(lambda spark, sf: ch.reassemble(_chunks(spark, sf)))


# ---------------------------------------------------------------- F: retrieval

_BM25_SQL = f"""WITH {S.chunks_cte()},
{S.bm25_ctes('chunks', 'doc_id, chunk_index', 'content', 'benchmark', 'item_id', 'text')}
{S.topk('bm25', 'query_id', 'score', 'doc_id, chunk_index', 5, 'query_id, rank, doc_id, chunk_index, score')}"""

register("bm25_topk", _BM25_SQL)(
    lambda spark, sf: rt.bm25_topk(_bench_queries(spark, sf), _chunks(spark, sf)).select(
        "query_id", "rank", "doc_id", "chunk_index", "score"
    )
)

register(
    "match_text",
    f"""WITH q AS (
  SELECT DISTINCT item_id AS query_id, unnest({S.terms('text')}) AS term FROM benchmark WHERE {S.squash('text')} <> ''
),
need AS (SELECT query_id, count(*) AS n FROM q GROUP BY query_id),
dt AS (SELECT DISTINCT doc_id, unnest({S.terms('text')}) AS term FROM documents),
have AS (SELECT q.query_id, dt.doc_id, count(*) AS n FROM dt JOIN q USING (term) GROUP BY ALL)
SELECT h.query_id, h.doc_id FROM have h JOIN need n ON h.query_id = n.query_id AND h.n = n.n""",
)(lambda spark, sf: rt.match_text(_bench_queries(spark, sf), T(spark, sf, "documents")))


def _query_vectors(spark, sf, dim=64) -> DataFrame:
    return ix.embed_hashed(_bench_queries(spark, sf), "query_id", "text", dim)


_VEC_SQL = f"""WITH {S.hashed_cte('qv', 'benchmark', 'item_id', 'text', 64)},
ev AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos FROM embeddings),
vn AS (SELECT vec_id, sqrt(sum(x * x)) AS n FROM ev GROUP BY vec_id),
qn AS (SELECT item_id, sqrt(sum(weight * weight)) AS n FROM qv GROUP BY item_id),
dots AS (SELECT q.item_id AS query_id, e.vec_id, sum(q.weight * e.x) AS dot FROM qv q JOIN ev e ON q.bucket = e.pos GROUP BY ALL),
sc AS (SELECT d.query_id, d.vec_id, round((1 + d.dot / (vn.n * qn.n)) / 2, 6) AS score
       FROM dots d JOIN vn USING (vec_id) JOIN qn ON qn.item_id = d.query_id)
{S.topk('sc', 'query_id', 'score', 'vec_id', 5, 'query_id, rank, vec_id, score')}"""

register("vector_topk", _VEC_SQL)(
    lambda spark, sf: rt.vector_topk(_query_vectors(spark, sf), T(spark, sf, "embeddings")).select(
        "query_id", "rank", "vec_id", "score"
    )
)


def _chunk_index(spark, sf, dim=64) -> DataFrame:
    return _chunks(spark, sf).withColumn("embedding", ix.embed_column("content", dim))


def q_hybrid(spark, sf):
    queries = _bench_queries(spark, sf).join(_query_vectors(spark, sf), "query_id")
    from corpusflow.plans.strategy import materialize

    # Both halves read the chunk index: write it once.
    h = rt.hybrid_search(queries, materialize(_chunk_index(spark, sf), "hybrid-index"), k=5)
    return h.select(
        "query_id", "rank", "doc_id", "chunk_index", "rrf_score", "score",
        F.array_join("hybrid_sources", ",").alias("hybrid_sources"),
    )


_HYBRID_SQL = f"""WITH {S.chunks_cte()},
{S.hashed_cte('qv', 'benchmark', 'item_id', 'text', 64)},
{S.hashed_cte('cv', 'chunks', 'doc_id, chunk_index', 'content', 64)},
qn AS (SELECT item_id, sqrt(sum(weight * weight)) AS n FROM qv GROUP BY item_id),
cn AS (SELECT doc_id, chunk_index, sqrt(sum(weight * weight)) AS n FROM cv GROUP BY ALL),
dots AS (SELECT q.item_id AS query_id, c.doc_id, c.chunk_index, sum(q.weight * c.weight) AS dot
         FROM qv q JOIN cv c ON q.bucket = c.bucket GROUP BY ALL),
pairs AS (
  SELECT qn.item_id AS query_id, cn.doc_id, cn.chunk_index,
         round((1 + coalesce(d.dot, 0) / (qn.n * cn.n)) / 2, 6) AS score
  FROM qn CROSS JOIN cn
  LEFT JOIN dots d ON d.query_id = qn.item_id AND d.doc_id = cn.doc_id AND d.chunk_index = cn.chunk_index
),
vec AS ({S.topk('pairs', 'query_id', 'score', 'doc_id, chunk_index', 50)}),
{S.bm25_ctes('chunks', 'doc_id, chunk_index', 'content', 'benchmark', 'item_id', 'text')},
kw AS ({S.topk('bm25', 'query_id', 'score', 'doc_id, chunk_index', 50)}),
lists AS (
  SELECT query_id, doc_id, chunk_index, 'vector' AS list, 0 AS o, rank FROM vec
  UNION ALL SELECT query_id, doc_id, chunk_index, 'keyword' AS list, 1 AS o, rank FROM kw
),
fused AS (
  SELECT query_id, doc_id, chunk_index, round(sum(1.0::DOUBLE / (60 + rank)), 6) AS rrf_score,
         string_agg(list, ',' ORDER BY o) AS hybrid_sources
  FROM lists GROUP BY ALL
),
top AS ({S.topk('fused', 'query_id', 'rrf_score', 'doc_id, chunk_index', 5)})
SELECT t.query_id, t.rank, t.doc_id, t.chunk_index, t.rrf_score, v.score, t.hybrid_sources
FROM top t LEFT JOIN vec v USING (query_id, doc_id, chunk_index)"""

register("hybrid_search", _HYBRID_SQL)(q_hybrid)


def q_expand_parents(spark, sf):
    kids = ch.chunk_hierarchical(T(spark, sf, "documents"), "doc_id", "text", 512, 128, 50)
    hits = rt.bm25_topk(_bench_queries(spark, sf), kids, k=10)
    hits = hits.join(kids, ["doc_id", "chunk_index"])
    return rt.expand_parents(hits).select("query_id", "doc_id", "unit_kind", "unit_index", "rank", "context")


_EXPAND_SQL = f"""WITH kids AS ({_hier_sql()}),
{S.bm25_ctes('kids', 'doc_id, chunk_index', 'content', 'benchmark', 'item_id', 'text')},
hits AS ({S.topk('bm25', 'query_id', 'score', 'doc_id, chunk_index', 10)}),
j AS (SELECT h.query_id, h.rank, k.* FROM hits h JOIN kids k USING (doc_id, chunk_index))
SELECT query_id, doc_id, 'parent' AS unit_kind, parent_index AS unit_index, min(rank) AS rank, any_value(parent_text) AS context
FROM j GROUP BY query_id, doc_id, parent_index"""

register("expand_parents", _EXPAND_SQL)(q_expand_parents)


def _with_hit_text(spark, sf, hits: DataFrame, size=512, overlap=50) -> DataFrame:
    """Attach chunk text to top-k hits by re-chunking only the documents that
    were hit (a size-checked broadcast semi-join), not the whole corpus."""
    from corpusflow.plans.strategy import bounded_broadcast, materialize

    hits = materialize(hits, "hits")  # k rows per query, used twice
    hit_docs, _ = bounded_broadcast(hits.select("doc_id").distinct())
    docs = T(spark, sf, "documents").join(hit_docs, "doc_id", "left_semi")
    return hits.join(ch.chunk_text(docs, "doc_id", "text", size, overlap), ["doc_id", "chunk_index"])


def q_assemble_context(spark, sf):
    chunks = _chunks(spark, sf)
    hits = _with_hit_text(spark, sf, rt.bm25_topk(_bench_queries(spark, sf), chunks, k=5))
    return rt.assemble_context(hits, _bench_queries(spark, sf), text_col="content", max_chars=6000)


register(
    "assemble_context",
    f"""WITH {S.chunks_cte()},
{S.bm25_ctes('chunks', 'doc_id, chunk_index', 'content', 'benchmark', 'item_id', 'text')},
hits AS ({S.topk('bm25', 'query_id', 'score', 'doc_id, chunk_index', 5)}),
h AS (SELECT h.query_id, h.rank, '[' || CAST(h.rank AS VARCHAR) || '] ' || c.content AS t
      FROM hits h JOIN chunks c USING (doc_id, chunk_index)),
r AS (SELECT *, sum(length(t) + 2) OVER (PARTITION BY query_id ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM h),
g AS (SELECT query_id, string_agg(t, chr(10) || chr(10) ORDER BY rank) AS context, count(*) AS n FROM r WHERE run - 2 <= 6000 GROUP BY query_id)
SELECT b.query_id, coalesce(g.context, 'No relevant context found.') AS context, CAST(coalesce(g.n, 0) AS BIGINT) AS chunks_retrieved
FROM (SELECT DISTINCT item_id AS query_id FROM benchmark) b LEFT JOIN g USING (query_id)""",
)(q_assemble_context)


register(
    "history_window",
    """WITH m AS (SELECT * FROM conversations WHERE role <> 'system'),
h AS (
  SELECT conv_id, turn, role, text,
         list(role || ': ' || text) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) AS hist
  FROM m
)
SELECT conv_id, turn, text AS query, coalesce(array_to_string(hist, chr(10)), '') AS history,
       CAST(coalesce(len(hist), 0) AS BIGINT) AS history_messages
FROM h WHERE role = 'user'""",
)(lambda spark, sf: rt.history_window(T(spark, sf, "conversations")))


def q_present_hits(spark, sf):
    chunks = _chunks(spark, sf)
    docs = T(spark, sf, "documents").select("doc_id", "source")
    hits = _with_hit_text(spark, sf, rt.bm25_topk(_bench_queries(spark, sf), chunks, k=5)).join(docs, "doc_id")
    return rt.present_hits(hits).select("query_id", "rank", "doc_id", "chunk_index", "shown_score", "preview", "source_label")


register(
    "present_hits",
    f"""WITH {S.chunks_cte()},
{S.bm25_ctes('chunks', 'doc_id, chunk_index', 'content', 'benchmark', 'item_id', 'text')},
hits AS ({S.topk('bm25', 'query_id', 'score', 'doc_id, chunk_index', 5)})
SELECT h.query_id, h.rank, h.doc_id, h.chunk_index, round(h.score, 4) AS shown_score,
       substr(c.content, 1, 500) AS preview, coalesce(d.source, '') AS source_label
FROM hits h JOIN chunks c USING (doc_id, chunk_index) JOIN documents d USING (doc_id)""",
)(q_present_hits)


# ---------------------------------------------------------------- A8, D: pages
from corpusflow.functions import html as fh  # noqa: E402
from corpusflow.functions import urls as fu  # noqa: E402
from corpusflow.operators import html as oh  # noqa: E402
from corpusflow.operators import links as ol  # noqa: E402


def _pages(spark, sf, *cols) -> DataFrame:
    p = T(spark, sf, "pages")
    return p.select(*cols) if cols else p


register("html_text", f"SELECT page_id, {S.html_text('html')} AS text FROM pages")(
    lambda spark, sf: oh.extract_text(_pages(spark, sf, "page_id", "html")).select("page_id", "text")
)

def _odd_pages(spark, sf) -> DataFrame:
    """Pages whose text and links are known, built around their id and url."""
    i = F.col("page_id").cast("string")
    body = F.concat(
        F.lit('<title>No &'), i, F.lit('</title><p title="1>0">'), i, F.lit(" &lt; &eacute;&rarr; 1 < 2 and 3 > 2 &#38;amp; &#9999999;</p>"),
        F.lit("<!-- <a href='/gone'> --><a title=\'x>y\' href=/q/"), i, F.lit(">q</a> <a\n href = '?p=1&amp;r=2'>r</a><a name=n>n</a>"),
    )
    end = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("<script>var a = '</p>' <a href='/no'>"), i)).otherwise(F.lit("<style>p{}</style>end"))
    return _pages(spark, sf, "page_id", "url").withColumn("html", F.concat(body, end))


register(
    "html_text_odd",
    """SELECT page_id, 'No &' || page_id || ' ' || page_id || ' < é→ 1 < 2 and 3 > 2 &amp; ' || chr(65533) || ' q r n'
       || CASE WHEN page_id % 2 = 0 THEN '' ELSE ' end' END AS text FROM pages""",
)(lambda spark, sf: oh.extract_text(_odd_pages(spark, sf)).select("page_id", "text"))

register("page_title", f"SELECT page_id, {S.title('html')} AS title FROM pages")(
    lambda spark, sf: oh.page_titles(_pages(spark, sf, "page_id", "html")).select("page_id", "title")
)


def _nested_pages(spark, sf) -> DataFrame:
    """Pages whose sections are known: nested, unclosed and quoted elements
    around the page's id."""
    i = F.col("page_id").cast("string")
    html = F.concat(
        F.lit("<body><!-- <div id=x> --><script>'<div id=x>'</script><div id='x'><div>in "), i, F.lit("</div></div><div class='a x'>out</div><ul><li>one "), i,
        F.lit("<li>two<ul><li>deep</ul><li class=\"last b\">three</ul><div title='</div>'><p>first<p class=q>second "), i, F.lit("</div><br class=q><section><p class='b'>open "), i,
    )
    return _pages(spark, sf, "page_id").withColumn("html", html)


NESTED = {
    "by_id": "#x", "child": "ul > li.last", "deep": "li li", "unclosed": "div p.q", "open_end": "section .b", "either": ".missing, div.a", "none": "table td",
}


def q_nested_sections(spark, sf):
    return oh.select_sections(_nested_pages(spark, sf), NESTED).drop("html")


_ARTICLE_SQL = "CASE WHEN regexp_matches(html, '(?is)<article[\\s>]') THEN regexp_extract(html, '(?is)(<article[\\s>].*?</article\\s*>)', 1) ELSE html END"

register(
    "select_section",
    f"""SELECT page_id, {_ARTICLE_SQL} AS article,
  CASE WHEN regexp_matches(html, '(?is)<div class="ad"') THEN regexp_extract(html, '(?is)(<div class="ad".*?</div\\s*>)', 1) ELSE html END AS ad FROM pages""",
)(lambda spark, sf: oh.select_sections(_pages(spark, sf, "page_id", "html"), {"article": "article", "ad": ".ad"}).select("page_id", "article", "ad"))

register(
    "select_nested_section",
    """SELECT page_id, '<div id=''x''><div>in ' || page_id || '</div></div>' AS by_id, '<li class="last b">three' AS child, '<li>deep' AS deep,
  '<p class=q>second ' || page_id AS unclosed, '<p class=''b''>open ' || page_id AS open_end, '<div class=''a x''>out</div>' AS either,
  '<body><!-- <div id=x> --><script>''<div id=x>''</script><div id=''x''><div>in ' || page_id || '</div></div><div class=''a x''>out</div><ul><li>one ' || page_id
    || '<li>two<ul><li>deep</ul><li class="last b">three</ul><div title=''</div>''><p>first<p class=q>second ' || page_id || '</div><br class=q><section><p class=''b''>open '
    || page_id AS "none" FROM pages""",
)(q_nested_sections)

register(
    "detect_selectors",
    "SELECT page_id, array_to_string(list_filter(["
    + ", ".join(f"CASE WHEN regexp_matches(html, {S.q(oh.open_tag_pattern(s))}) THEN {S.q(s)} END" for s in oh.CANDIDATE_SELECTORS)
    + "], lambda x: x IS NOT NULL), ',') AS selectors_found FROM pages",
)(
    lambda spark, sf: oh.detect_selectors(_pages(spark, sf, "page_id", "html")).select(
        "page_id", F.array_join("selectors_found", ",").alias("selectors_found")
    )
)

register(
    "html_to_markdown",
    f"SELECT page_id, {S.title('html')} AS title, {S.markdown('html')} AS markdown FROM pages",
)(lambda spark, sf: oh.to_markdown(_pages(spark, sf, "page_id", "html")).select("page_id", "title", "markdown"))


def _words_sql(expr: str) -> str:
    return f"(CASE WHEN {S.squash(expr)} = '' THEN 0 ELSE len(string_split({S.squash(expr)}, ' ')) END)"


register(
    "thin_content",
    f"""SELECT page_id, CAST({_words_sql('md')} AS BIGINT) AS n_words,
       CASE WHEN {_words_sql('md')} < 50 THEN {S.q(oh.THIN_CONTENT_WARNING)} END AS content_warning
FROM (SELECT page_id, {S.markdown(_ARTICLE_SQL)} AS md FROM pages)""",
)(
    lambda spark, sf: oh.thin_content(oh.to_markdown(_pages(spark, sf, "page_id", "html"), selector="article")).select(
        "page_id", word_count("markdown").alias("n_words"), "content_warning"
    )
)


# ---------------------------------------------------------------- B: URLs and links

register("normalize_url", f"SELECT page_id, url, {S.normalize_url('url')} AS nurl FROM pages")(
    lambda spark, sf: _pages(spark, sf, "page_id", "url").withColumn("nurl", fu.normalize_url("url"))
)


def _roots_spark(spark, sf) -> DataFrame:
    p = _pages(spark, sf, "page_id", "url").withColumn("_h", fu.url_host("url"))
    apex2 = F.array_join(F.slice(F.split("_h", r"\."), -2, 2), ".")
    roots = F.array(
        F.struct(F.lit("same").alias("root_kind"), F.concat(F.lit("https://"), F.col("_h")).alias("root")),
        F.struct(F.lit("apex").alias("root_kind"), F.concat(F.lit("https://"), apex2, F.lit("/")).alias("root")),
        F.struct(F.lit("sibling").alias("root_kind"), F.concat(F.lit("http://www."), F.col("_h"), F.lit(":8080")).alias("root")),
        F.struct(F.lit("foreign").alias("root_kind"), F.concat(F.lit("https://"), F.col("_h"), F.lit(".evil.co.uk")).alias("root")),
        F.struct(F.lit("userinfo").alias("root_kind"), F.concat(F.lit("https://"), F.col("_h"), F.lit(":x@evil.com/")).alias("root")),
    )
    return p.select("page_id", "url", F.inline(roots))


def _roots_sql() -> str:
    h = S.host("url")
    apex2 = f"array_to_string(string_split({h}, '.')[-2:], '.')"
    return f"""roots AS (
  SELECT page_id, url, unnest(['same', 'apex', 'sibling', 'foreign', 'userinfo']) AS root_kind,
         unnest(['https://' || {h}, 'https://' || {apex2} || '/', 'http://www.' || {h} || ':8080',
                 'https://' || {h} || '.evil.co.uk', 'https://' || {h} || ':x@evil.com/']) AS root
  FROM pages
)"""


register(
    "in_scope",
    f"""WITH {_roots_sql()}
SELECT page_id, root_kind, root, {S.in_scope('url', 'root', False)} AS exact, {S.in_scope('url', 'root', True)} AS with_subdomains
FROM roots""",
)(
    lambda spark, sf: _roots_spark(spark, sf).select(
        "page_id", "root_kind", "root",
        fu.in_scope(F.col("url"), F.col("root"), False).alias("exact"),
        fu.in_scope(F.col("url"), F.col("root"), True).alias("with_subdomains"),
    )
)

register("harvest_links", f"WITH {S.links_cte()} SELECT page_id, pos, href FROM links")(
    lambda spark, sf: ol.harvest_links(_pages(spark, sf, "page_id", "url", "html")).select("page_id", "pos", "href")
)

register("resolve_links", f"WITH {S.links_cte()} SELECT page_id, pos, href, {S.resolve('url', 'href')} AS target FROM links")(
    lambda spark, sf: ol.resolve_links(ol.harvest_links(_pages(spark, sf, "page_id", "url", "html"))).select(
        "page_id", "pos", "href", "target"
    )
)


def _sitemaps_sql() -> str:
    h = S.host("url")
    return f"""sm AS (
  SELECT host, part, 'https://' || host || '/sitemap.xml' AS sitemap_url,
         '<?xml version="1.0" encoding="UTF-8"?>' || chr(10) || '<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">' || chr(10)
         || string_agg('<url><loc>' || replace(url, '&', '&amp;') || '</loc></url>', chr(10) ORDER BY page_id, url)
         || CASE WHEN starts_with(host, 'm.') THEN '' ELSE chr(10) || '</urlset>' END AS xml
  FROM (SELECT {h} AS host, floor(page_id / 50000) AS part, page_id, url FROM pages) GROUP BY host, part
),
locs_l AS (
  SELECT host, part, sitemap_url,
         CASE WHEN regexp_extract(xml, {S.q(ol.SITEMAP_DOC)}, 1) = 'sitemapindex' THEN 'sitemap' ELSE 'page' END AS kind,
         CASE WHEN regexp_matches(xml, {S.q(ol.SITEMAP_DOC)})
              THEN list_transform(regexp_extract_all(xml, {S.q(ol.LOC_VALID)}, 1), lambda v: {S.strip_edges(S.decode('v'))})
              ELSE regexp_extract_all(xml, {S.q(ol.LOC_RAW)}, 1) END AS locs
  FROM sm
),
locs AS (
  SELECT * FROM (SELECT host, part, sitemap_url, kind, unnest(locs) AS loc, CAST(unnest(range(len(locs))) AS INTEGER) AS pos FROM locs_l)
  WHERE loc <> ''
)"""


def _locs_spark(spark, sf) -> DataFrame:
    return ol.sitemap_locs(ol.build_sitemaps(_pages(spark, sf, "page_id", "url")))


register("sitemap_locs", f"WITH {_sitemaps_sql()} SELECT host, part, kind, pos, loc FROM locs")(
    lambda spark, sf: _locs_spark(spark, sf).select("host", "part", "kind", "pos", "loc")
)


register(
    "filter_urls",
    f"""WITH {_sitemaps_sql()},
u AS (SELECT 'https://' || host AS root, loc AS url, min(pos) AS pos FROM locs WHERE loc IS NOT NULL AND loc <> '' GROUP BY ALL),
f AS (SELECT * FROM u WHERE {S.in_scope('url', 'root', False)} AND NOT {S.skip_ext('url')} AND NOT contains(url, 'utm_source'))
SELECT root, url, pos FROM (SELECT *, row_number() OVER (PARTITION BY root ORDER BY pos, url) AS rn FROM f) WHERE rn <= 3""",
)(
    lambda spark, sf: ol.filter_urls(
        _locs_spark(spark, sf).select(F.concat(F.lit("https://"), F.col("host")).alias("root"), F.col("loc").alias("url"), "pos"),
        exclude="utm_source", max_pages=3,
    ).select("root", "url", "pos")
)


def q_robots(spark, sf):
    sm = ol.build_sitemaps(_pages(spark, sf, "page_id", "url"))
    robots = ol.build_robots(sm.select("host").distinct())
    return ol.robots_sitemaps(robots, sm.select("sitemap_url"))


register(
    "robots_sitemaps",
    f"""WITH {_sitemaps_sql()},
rb AS (SELECT DISTINCT host, 'User-agent: *' || chr(10) || 'Disallow: /private' || chr(10) || 'SITEMAP: https://' || host || '/old-sitemap.xml'
       || chr(10) || 'Sitemap:  https://' || host || '/sitemap.xml ' || chr(10) AS robots FROM sm),
ln AS (SELECT host, unnest(string_split_regex(robots, '\\r\\n|\\r|\\n')) AS line,
              unnest(range(len(string_split_regex(robots, '\\r\\n|\\r|\\n')))) AS pos FROM rb),
s AS (SELECT host, pos, {S.strip_edges("substr(line, instr(line, ':') + 1)")} AS sitemap_url FROM ln WHERE starts_with(lower(line), 'sitemap:'))
SELECT host, arg_min(sitemap_url, pos) AS sitemap_url FROM s WHERE sitemap_url IN (SELECT sitemap_url FROM sm) GROUP BY host""",
)(q_robots)


_HREFS = ["/abs", "rel", "../up", "./here", "?q=1", "#top", "//other.example.com/x", "mailto:a@b.c", "https://else.example.org/y?z#f", "a/../b/."]


def _varied_links(spark, sf) -> DataFrame:
    """One link of every kind per page."""
    return _pages(spark, sf, "page_id", "url").select("page_id", "url", F.posexplode(F.array(*map(F.lit, _HREFS))).alias("pos", "href"))


_VARIED_SQL = f"""v AS (SELECT page_id, url, CAST(unnest(range({len(_HREFS)})) AS INTEGER) AS pos, unnest([{", ".join(S.q(h) for h in _HREFS)}]) AS href FROM pages)"""

# The expected target of each kind, from the url's scheme, host, path and query.
_TARGET_SQL = """p AS (
  SELECT *, regexp_extract(url, '^([a-z]+):', 1) AS sch, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) AS org,
    regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS pa, split_part(url, '#', 1) AS nofrag FROM v
), d AS (SELECT *, regexp_replace(pa, '[^/]*$', '') AS dir FROM p),
t AS (SELECT page_id, url, pos, href, regexp_replace(split_part(CASE pos
    WHEN 0 THEN org || '/abs' WHEN 1 THEN org || dir || 'rel' WHEN 2 THEN org || regexp_replace(rtrim(dir, '/'), '[^/]*$', '') || CASE WHEN rtrim(dir, '/') = '' THEN '/up' ELSE 'up' END
    WHEN 3 THEN org || dir || 'here' WHEN 4 THEN split_part(nofrag, '?', 1) || '?q=1' WHEN 5 THEN nofrag
    WHEN 6 THEN sch || '://other.example.com/x' WHEN 7 THEN 'mailto:a@b.c' WHEN 8 THEN 'https://else.example.org/y?z' WHEN 9 THEN org || dir || 'b/'
    END, '#', 1), '/+$', '') AS target FROM d)"""

register("resolve_links_varied", f"WITH {_VARIED_SQL}, {_TARGET_SQL} SELECT page_id, pos, href, target FROM t")(
    lambda spark, sf: ol.resolve_links(_varied_links(spark, sf)).select("page_id", "pos", "href", "target")
)


def q_redact(spark, sf):
    links = ol.resolve_links(_varied_links(spark, sf))
    req = links.select(
        "page_id", "pos", F.col("target").alias("url"), F.col("url").alias("root"),
        F.concat(F.lit("session="), F.col("page_id").cast("string")).alias("cookies"),
        F.concat(F.lit("X-Page: "), F.col("page_id").cast("string")).alias("headers"),
    )
    return ol.redact_credentials(req).select("page_id", "pos", "url", "cookies", "headers", "send_credentials")


register(
    "redact_credentials",
    f"""WITH {_VARIED_SQL}, {_TARGET_SQL},
h AS (SELECT *, lower(regexp_extract(target, '^[a-z]+://([^/?#:]*)', 1)) AS th, lower(regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1)) AS rh FROM t),
s AS (SELECT *, th <> '' AND th = rh AS ok FROM h)
SELECT page_id, pos, target AS url, CASE WHEN ok THEN 'session=' || CAST(page_id AS VARCHAR) END AS cookies,
       CASE WHEN ok THEN 'X-Page: ' || CAST(page_id AS VARCHAR) END AS headers, ok AS send_credentials FROM s""",
)(q_redact)


register(
    "auto_batch",
    "SELECT page_id, CAST(floor((row_number() OVER (ORDER BY page_id) - 1) / 200) AS BIGINT) AS batch_index FROM pages",
)(lambda spark, sf: ol.auto_batch(_pages(spark, sf, "page_id"), [], ["page_id"], 200).select("page_id", "batch_index"))


# ---------------------------------------------------------------- B8, B11: crawl
from corpusflow.operators import crawl as oc  # noqa: E402
from corpusflow.sources.crawl_store import CrawlStore  # noqa: E402


def _crawl_inputs(spark, sf):
    pages = _pages(spark, sf, "page_id", "url", "html")
    seeds = pages.groupBy(fu.url_host("url").alias("host")).agg(F.min_by("url", "page_id").alias("root")).select("root")
    real = ol.resolve_links(ol.harvest_links(pages)).select("page_id", F.col("pos").cast("long").alias("pos"), "target")
    links = real.unionByName(oc.site_tree_links(pages.select("page_id", "url")))
    return seeds, pages.select("page_id", "url"), links


def _crawl_sql_ctes() -> str:
    h = S.host("url")
    return f"""{S.links_cte()},
real AS (SELECT page_id, CAST(pos AS BIGINT) AS pos, {S.resolve('url', 'href')} AS target FROM links),
hp AS (SELECT page_id, url, {h} AS host, row_number() OVER (PARTITION BY {h} ORDER BY page_id) - 1 AS i FROM pages),
edges AS (
  SELECT page_id, CAST(e.pos AS BIGINT) AS pos, CAST(e.j AS BIGINT) AS j, host FROM (
    SELECT page_id, host, unnest([{{'pos': 100, 'j': 2 * i + 1}}, {{'pos': 101, 'j': 2 * i + 2}},
                                  {{'pos': 102, 'j': CAST(floor((i - 1) / 2) AS BIGINT)}}]) AS e FROM hp)
  WHERE e.j >= 0
),
tree AS (SELECT e.page_id, e.pos, {S.normalize_url('t.url')} AS target FROM edges e JOIN hp t ON t.host = e.host AND t.i = e.j),
all_links AS (SELECT * FROM real UNION ALL SELECT * FROM tree),
fetchable AS (SELECT {S.normalize_url('url')} AS url, min(page_id) AS page_id FROM pages GROUP BY 1),
seeds AS (SELECT arg_min(url, page_id) AS root FROM pages GROUP BY {h}),
bfs(root, url, depth) USING KEY (root, url) AS (
  SELECT root, {S.normalize_url('root')}, 0 FROM seeds
  WHERE {S.normalize_url('root')} <> '' AND {S.in_scope(S.normalize_url('root'), 'root', False)} AND NOT {S.skip_ext(S.normalize_url('root'))}
  UNION
  SELECT b.root, l.target, b.depth + 1
  FROM bfs b JOIN fetchable f ON f.url = b.url JOIN all_links l ON l.page_id = f.page_id
  WHERE l.target IS NOT NULL AND l.target <> '' AND {S.in_scope('l.target', 'b.root', False)} AND NOT {S.skip_ext('l.target')}
    AND NOT EXISTS (SELECT 1 FROM recurring.bfs r WHERE r.root = b.root AND r.url = l.target)
),
visits AS (SELECT b.root, b.url, b.depth, f.page_id, f.page_id IS NOT NULL AS ok FROM bfs b LEFT JOIN fetchable f USING (url))"""


def q_crawl(spark, sf):
    seeds, pages, links = _crawl_inputs(spark, sf)
    return oc.crawl_frontier(seeds, pages, links, max_pages=None, with_rank=False).select("root", "url", "depth", "page_id", "ok")


register("crawl_frontier", f"WITH RECURSIVE {_crawl_sql_ctes()} SELECT root, url, depth, page_id, ok FROM visits")(q_crawl)


CRAWL_CAP = 5


def q_crawl_capped(spark, sf):
    seeds, pages, links = _crawl_inputs(spark, sf)
    return oc.crawl_frontier(seeds, pages, links, max_pages=CRAWL_CAP).select("root", "crawl_rank", "url", "depth", "page_id", "ok")


def q_crawl_resumed(spark, sf):
    """A crawl with a store that is stopped after two levels and goes on."""
    seeds, pages, links = _crawl_inputs(spark, sf)
    links = materialize(links, "links")  # of both crawls
    base = shared_path(spark, f"crawls/{uuid.uuid4().hex[:16]}")
    oc.crawl_frontier(seeds, pages, links, max_pages=None, max_levels=2, with_rank=False, store=CrawlStore(spark, base))
    visits = oc.crawl_frontier(seeds, pages, links, max_pages=None, with_rank=False, store=CrawlStore(spark, base))
    return visits.select("root", "url", "depth", "page_id", "ok")


register("crawl_frontier_resumed", f"WITH RECURSIVE {_crawl_sql_ctes()} SELECT root, url, depth, page_id, ok FROM visits")(q_crawl_resumed)


# A visit's place in the queue is the path of link positions that led to it
# first; a capped crawl is the uncapped order up to the last page it may fetch.
register(
    "crawl_frontier_capped",
    f"""WITH RECURSIVE {_crawl_sql_ctes()},
keys(root, url, depth, k) AS (
  SELECT root, url, depth, [CAST(0 AS BIGINT)] FROM visits WHERE depth = 0
  UNION ALL
  SELECT v.root, v.url, v.depth, min(list_append(p.k, l.pos))
  FROM keys p JOIN visits pv ON pv.root = p.root AND pv.url = p.url AND pv.ok JOIN all_links l ON l.page_id = pv.page_id
    JOIN visits v ON v.root = p.root AND v.url = l.target AND v.depth = p.depth + 1 GROUP BY v.root, v.url, v.depth
),
o AS (
  SELECT v.*, row_number() OVER w AS crawl_rank, coalesce(count(*) FILTER (WHERE v.ok) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS done
  FROM visits v JOIN keys k USING (root, url) WINDOW w AS (PARTITION BY v.root ORDER BY v.depth, k.k)
)
SELECT root, crawl_rank, url, depth, page_id, ok FROM o WHERE done < {CRAWL_CAP}""",
)(q_crawl_capped)


def _page_chunks(spark, sf) -> DataFrame:
    md = oh.to_markdown(_pages(spark, sf, "page_id", "html")).select("page_id", "markdown")
    return ch.chunk_text(md, "page_id", "markdown")


def q_crawl_report(spark, sf):
    seeds, pages, links = _crawl_inputs(spark, sf)
    visits = oc.crawl_frontier(seeds, pages, links, max_pages=None, with_rank=False)
    return oc.crawl_report(visits, _page_chunks(spark, sf))


register(
    "crawl_report",
    f"""WITH RECURSIVE {_crawl_sql_ctes()},
md AS (SELECT page_id, {S.markdown('html')} AS markdown FROM pages),
{S.chunks_cte('pc', table='md', id_col='page_id', text_col='markdown')},
per_page AS (SELECT page_id, count(*) AS c, sum(token_estimate) AS t FROM pc GROUP BY page_id),
rep AS (SELECT root, count(*) AS pages_discovered, count(*) FILTER (WHERE ok) AS pages_crawled,
               count(*) FILTER (WHERE NOT ok) AS pages_failed FROM visits GROUP BY root),
tot AS (SELECT v.root, CAST(coalesce(sum(p.c), 0) AS BIGINT) AS total_chunks, CAST(coalesce(sum(p.t), 0) AS BIGINT) AS total_tokens
        FROM visits v LEFT JOIN per_page p USING (page_id) WHERE v.ok GROUP BY v.root)
SELECT r.root, r.pages_discovered, r.pages_crawled, r.pages_failed,
       CAST(coalesce(t.total_chunks, 0) AS BIGINT) AS total_chunks, CAST(coalesce(t.total_tokens, 0) AS BIGINT) AS total_tokens
FROM rep r LEFT JOIN tot t USING (root)""",
)(q_crawl_report)


# ---------------------------------------------------------------- E, A13: index
from corpusflow.sources import catalog as cat  # noqa: E402


register(
    "embed_hashed",
    f"""WITH {S.hashed_cte('hv', 'documents', 'doc_id', 'text', 64)}
SELECT doc_id, bucket, round(weight, 6) AS weight FROM hv WHERE weight <> 0""",
)(
    lambda spark, sf: ix.embed_hashed(T(spark, sf, "documents").select("doc_id", "text"), "doc_id", "text", 64)
    .select("doc_id", F.posexplode("embedding").alias("bucket", "weight"))
    .where(F.col("weight") != 0)
    .select("doc_id", "bucket", F.round("weight", 6).alias("weight"))
)


def q_index_rows(spark, sf):
    docs = T(spark, sf, "documents").select("doc_id", "text", F.col("source").alias("url"))
    chunks = ch.chunk_text(docs, ["doc_id", "url"], "text").withColumn("embedding", ix.embed_column("content", 64))
    rows = ix.index_rows(chunks)
    return rows.select(
        "id", "doc_id", "chunk_index", F.size("embedding").alias("dimension"), "text",
        F.col("metadata")["url"].alias("meta_url"), F.col("metadata")["chunk_index"].alias("meta_chunk_index"),
        F.col("metadata")["is_hierarchical"].alias("meta_is_hierarchical"),
    )


register(
    "index_rows",
    f"""WITH {S.chunks_cte()},
c AS (SELECT c.*, d.source AS url FROM chunks c JOIN documents d USING (doc_id)),
{S.hashed_cte('cv', 'c', 'doc_id, chunk_index', 'content', 64)},
has AS (SELECT DISTINCT doc_id, chunk_index FROM cv)
SELECT sha256(url || '|' || CAST(chunk_index AS VARCHAR) || '|' || content) AS id, doc_id, chunk_index,
       64 AS dimension, content AS text, url AS meta_url, CAST(chunk_index AS VARCHAR) AS meta_chunk_index,
       'false' AS meta_is_hierarchical
FROM c JOIN has USING (doc_id, chunk_index)""",
)(q_index_rows)


register(
    "inspect_index",
    """SELECT label, CAST(CASE WHEN min(len(embedding)) = max(len(embedding)) AND min(len(embedding)) > 0 THEN min(len(embedding)) ELSE 0 END AS INTEGER) AS dimension,
       coalesce(min(len(embedding)) = max(len(embedding)) AND min(len(embedding)) > 0, false) AS dimension_known,
       count(*) AS total_vectors
FROM embeddings GROUP BY ROLLUP (label)""",
)(lambda spark, sf: ix.inspect_index(T(spark, sf, "embeddings"), "embedding", "label"))


def _mixed_index(spark, sf) -> DataFrame:
    docs = ix.embed_hashed(T(spark, sf, "documents").select("doc_id", "text"), "doc_id", "text", 1024)
    return T(spark, sf, "embeddings").select(F.lit("embeddings").alias("namespace"), "embedding").unionByName(
        docs.select(F.lit("documents").alias("namespace"), "embedding")
    )


_MODELS_SQL = "(VALUES " + ", ".join(f"({S.q(p)}, {S.q(m)}, {d})" for p, m, d in cat.EMBEDDING_MODELS) + ") AS models(provider, model, dimension)"

register(
    "suggest_models",
    f"""WITH {S.hashed_cte('dv', 'documents', 'doc_id', 'text', 1024)},
idx AS (
  SELECT 'embeddings' AS namespace, len(embedding) AS d FROM embeddings
  UNION ALL SELECT 'documents' AS namespace, 1024 AS d FROM (SELECT DISTINCT doc_id FROM dv)
),
ins AS (
  SELECT namespace, CAST(CASE WHEN min(d) = max(d) AND min(d) > 0 THEN min(d) ELSE 0 END AS INTEGER) AS dimension,
         coalesce(min(d) = max(d) AND min(d) > 0, false) AS dimension_known, count(*) AS total_vectors
  FROM idx GROUP BY ROLLUP (namespace)
)
SELECT i.dimension, i.namespace, i.dimension_known, i.total_vectors, m.provider, m.model
FROM ins i JOIN {_MODELS_SQL} ON m.dimension = i.dimension WHERE i.dimension_known""".replace("AS models(", "AS m("),
)(lambda spark, sf: ix.suggest_models(ix.inspect_index(_mixed_index(spark, sf), "embedding", "namespace")))


def q_upsert(spark, sf):
    existing = T(spark, sf, "embeddings").select("vec_id", "embedding", F.lit(0).alias("version"))
    incoming = ix.embed_hashed(_bench_queries(spark, sf), "query_id", "text", 64).select(
        F.col("query_id").alias("vec_id"), F.col("embedding").cast("array<float>").alias("embedding"), F.lit(1).alias("version")
    )
    up = ix.upsert_index(existing, incoming, "vec_id", "version")
    return up.select("vec_id", "version", F.size("embedding").alias("dimension"),
                     F.round(F.element_at("embedding", 1).cast("double"), 6).alias("first_value"))


register(
    "upsert_index",
    f"""WITH {S.hashed_cte('qv', 'benchmark', 'item_id', 'text', 64)},
inc AS (SELECT item_id AS vec_id, 1 AS version,
               round(CAST(CAST(coalesce(max(weight) FILTER (WHERE bucket = 0), 0) AS FLOAT) AS DOUBLE), 6) AS first_value
        FROM qv GROUP BY item_id),
ex AS (SELECT vec_id, 0 AS version, round(CAST(embedding[1] AS DOUBLE), 6) AS first_value FROM embeddings),
u AS (SELECT vec_id, version, 64 AS dimension, first_value FROM inc UNION ALL SELECT vec_id, version, len(e.embedding), first_value FROM ex JOIN embeddings e USING (vec_id))
SELECT vec_id, version, CAST(dimension AS INTEGER) AS dimension, first_value FROM (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY version DESC) AS rn FROM u) WHERE rn = 1""",
)(q_upsert)


def q_index_store(spark, sf):
    """Chunks of all documents in a keyed store: inserted, partly revised and
    deleted, the revision sent twice, compacted, revised again."""
    import uuid

    from corpusflow.sources.index_store import IndexStore

    docs = T(spark, sf, "documents").select("doc_id", "text")
    store = IndexStore(spark, shared_path(spark, f"store/{uuid.uuid4().hex[:16]}"), "doc_id", 16)

    def chunks(cond: str, head: str = "") -> DataFrame:
        return ch.chunk_text(docs.where(cond).withColumn("text", F.concat(F.lit(head), "text")), "doc_id", "text").withColumn("head", F.lit(head))

    store.commit(chunks("true"), writer="a", batch=0)
    for _ in range(2):
        store.commit(chunks("doc_id % 5 = 1", "revised "), deletes=docs.where("doc_id % 7 = 3").select("doc_id"), writer="a", batch=1)
    store.compact()
    store.commit(chunks("doc_id % 11 = 2 and doc_id % 7 != 3", "again "), writer="b", batch=0)
    return store.read().select("doc_id", "head", "chunk_index", "token_estimate", F.sha2("content", 256).alias("content_sha256"))


register(
    "index_store",
    f"""WITH f AS (
  SELECT doc_id, CASE WHEN doc_id % 11 = 2 AND doc_id % 7 <> 3 THEN 'again ' WHEN doc_id % 5 = 1 THEN 'revised ' ELSE '' END AS head, text FROM documents
  WHERE doc_id % 7 <> 3 OR doc_id % 5 = 1
), u AS (SELECT doc_id, head, head || text AS text FROM f),
{S.chunks_cte('ck', table='u', id_col='doc_id, head', text_col='text')}
SELECT doc_id, head, chunk_index, token_estimate, sha256(content) AS content_sha256 FROM ck""",
)(q_index_store)


# ---------------------------------------------------------------- G: extraction
from corpusflow.operators import accounting as oa  # noqa: E402
from corpusflow.operators import extraction as oe  # noqa: E402

EXTRACT_SPEC = {
    "title": "string — the page title",
    "lang": "string — the page language",
    "track_id": "number — the tracking id",
    "has_ad": "boolean — whether an ad block is present",
    "price": "number — a price in dollars",
}
EXTRACT_RULES = {
    "title": r"(?is)<title[^>]*>(.*?)</title>",
    "lang": r'<html[^>]*\slang="([^"]*)"',
    "track_id": r"track\((\d+)\)",
    "has_ad": r'class="(ad)"',
    "price": r"\$\s*([0-9]+(?:\.[0-9]+)?)",
}
LIST_SPEC = {"label": "string — link text", "href": "string — link target"}
LIST_RULES = {"label": r'<li><a href="[^"]*">([^<]*)</a></li>', "href": r'<li><a href="([^"]*)">[^<]*</a></li>'}


def _typed_sql(expr: str, t: str) -> str:
    v = f"nullif(trim({expr}), '')"
    if t == "number":
        return f"TRY_CAST({v} AS DOUBLE)"
    if t == "boolean":
        tw = ", ".join(S.q(x) for x in oe.TRUE_WORDS)
        fw = ", ".join(S.q(x) for x in oe.FALSE_WORDS)
        return f"(CASE WHEN lower({v}) IN ({tw}) THEN true WHEN lower({v}) IN ({fw}) THEN false WHEN {v} IS NOT NULL THEN true END)"
    return v


def _extract_sql() -> str:
    _, rows = oe.parse_schema(EXTRACT_SPEC)
    cols = ", ".join(f"{_typed_sql(f'regexp_extract(html, {S.q(EXTRACT_RULES[f])}, 1)', t)} AS {f}" for f, t, _ in rows)
    found = " OR ".join(f"{f} IS NOT NULL" for f, _, _ in rows)
    return f"""ex AS (SELECT page_id, {cols} FROM pages),
st AS (SELECT *, CASE WHEN {found} THEN 'ok' ELSE 'error' END AS status FROM ex)"""


def _extracted(spark, sf) -> DataFrame:
    ex = oe.extract_fields(_pages(spark, sf, "page_id", "url", "html"), EXTRACT_SPEC, EXTRACT_RULES)
    return oe.page_status(ex, EXTRACT_SPEC)


register("extract_fields", f"WITH {_extract_sql()} SELECT page_id, title, lang, track_id, has_ad, price, status FROM st")(
    lambda spark, sf: _extracted(spark, sf).select("page_id", "extracted.*", "status")
)

register(
    "extract_list",
    f"""WITH l AS (
  SELECT page_id, regexp_extract_all(html, {S.q(LIST_RULES['label'])}, 1) AS a, regexp_extract_all(html, {S.q(LIST_RULES['href'])}, 1) AS b FROM pages
)
SELECT page_id, CAST(unnest(range(greatest(len(a), len(b)))) AS INTEGER) AS item_index,
       {_typed_sql('unnest(a)', 'string')} AS label, {_typed_sql('unnest(b)', 'string')} AS href,
       CAST(greatest(len(a), len(b)) AS BIGINT) AS item_count
FROM l""",
)(lambda spark, sf: oe.extract_list(_pages(spark, sf, "page_id", "html"), LIST_SPEC, LIST_RULES))

def _shop_pages(spark, sf) -> DataFrame:
    """Five items a page; every third price and every fourth name left out."""
    i = F.col("page_id")

    def item(k) -> F.Column:
        n = i * 5 + k
        name = F.when(n % 4 != 0, F.concat(F.lit("<b>name "), n.cast("string"), F.lit("</b>"))).otherwise(F.lit(""))
        price = F.when(n % 3 != 0, F.concat(F.lit("<i>$"), (n % 97).cast("string"), F.lit("</i>"))).otherwise(F.lit(""))
        return F.concat(F.lit('<div class="item"><div><u>'), n.cast("string"), F.lit("</u>"), price, name, F.lit("</div></div>"))

    return _pages(spark, sf, "page_id").withColumn("html", F.concat(F.lit("<i>$0</i>"), F.array_join(F.transform(F.sequence(F.lit(0), F.lit(4)), item), "\n"), F.lit("<b>end</b>")))


SHOP_SPEC = {"sku": "number — the number", "name": "string — the name", "price": "number — the price"}
SHOP_RULES = {"sku": r"<u>([0-9]+)</u>", "name": r"<b>(name[^<]*)</b>", "price": r"<i>\$([0-9]+)</i>"}
_SHOP_SQL = """SELECT page_id, CAST(k AS INTEGER) AS item_index, CAST(page_id * 5 + k AS DOUBLE) AS sku,
  CASE WHEN (page_id * 5 + k) % 4 <> 0 THEN 'name ' || (page_id * 5 + k) END AS name,
  CASE WHEN (page_id * 5 + k) % 3 <> 0 THEN CAST((page_id * 5 + k) % 97 AS DOUBLE) END AS price, CAST(5 AS BIGINT) AS item_count
FROM pages, range(5) AS r(k)"""

register("extract_list_aligned", _SHOP_SQL)(lambda spark, sf: oe.extract_list(_shop_pages(spark, sf), SHOP_SPEC, SHOP_RULES))
register("extract_list_records", _SHOP_SQL)(lambda spark, sf: oe.extract_list(_shop_pages(spark, sf), SHOP_SPEC, SHOP_RULES, record="div.item"))

register(
    "extract_report",
    f"""WITH {_extract_sql()}
SELECT count(*) AS pages_attempted, count(*) FILTER (WHERE status = 'ok') AS pages_extracted,
       count(*) FILTER (WHERE status <> 'ok') AS pages_failed, count(*) AS pages_discovered FROM st""",
)(lambda spark, sf: oe.extract_report(_extracted(spark, sf)))

MODELS = ["gpt-4o-mini", "claude-sonnet-4"]

register(
    "model_window",
    f"""WITH t AS (SELECT page_id, {S.html_text('html')} AS text FROM pages),
m AS (SELECT unnest([{', '.join(S.q(m) for m in MODELS)}]) AS model)
SELECT page_id, model, CASE WHEN regexp_matches(model, '(?i)(mini|flash|haiku|lite|nano)') THEN 8000 ELSE 30000 END AS window_chars,
       substr(text, 1, CASE WHEN regexp_matches(model, '(?i)(mini|flash|haiku|lite|nano)') THEN 8000 ELSE 30000 END) AS text_sent
FROM t, m""",
)(
    lambda spark, sf: oe.model_window(
        oh.extract_text(_pages(spark, sf, "page_id", "html")).select(
            "page_id", "text", F.explode(F.array(*[F.lit(m) for m in MODELS])).alias("model")
        ),
        F.col("model"),
    ).select("page_id", "model", "window_chars", "text_sent")
)

register(
    "rate_slots",
    "SELECT page_id, CAST(floor((row_number() OVER (ORDER BY page_id) - 1) / 10) AS BIGINT) AS minute_slot FROM pages",
)(lambda spark, sf: oe.rate_slots(_pages(spark, sf, "page_id"), 10, [], ["page_id"]).select("page_id", "minute_slot"))


# ---------------------------------------------------------------- H: accounting

def _rates_sql() -> str:
    return "(VALUES " + ", ".join(f"({S.q(o)}, CAST({r} AS DECIMAL(18,4)))" for o, r in oa.RATES) + ") AS r(operation, rate)"


def q_cost_rows(spark, sf):
    chunks = ch.chunk_stats(_chunks(spark, sf), "doc_id")
    labels = T(spark, sf, "labels").select("doc_id", "toxic")
    docs = T(spark, sf, "documents").select("doc_id").join(chunks, "doc_id", "left").join(labels, "doc_id", "left")
    n = F.coalesce(F.col("total_chunks"), F.lit(0)).cast("long")
    doc_usage = docs.select(
        F.lit("doc").alias("source"), F.col("doc_id").alias("id"),
        F.explode(F.array(
            F.struct(F.lit("chunk").alias("operation"), n.alias("quantity"), F.lit(True).alias("ok")),
            F.struct(F.lit("injection").alias("operation"), n.alias("quantity"), F.coalesce(F.col("toxic") == 0, F.lit(True)).alias("ok")),
        )).alias("u"),
    ).select("source", "id", "u.*", F.lit(0).alias("fields"))
    st = _extracted(spark, sf).select("page_id", "status")
    page_usage = st.select(
        F.lit("page").alias("source"), F.col("page_id").alias("id"),
        F.explode(F.array(
            F.struct(F.lit("url_local").alias("operation"), F.lit(1).cast("long").alias("quantity"), F.lit(True).alias("ok")),
            F.struct(F.lit("extract").alias("operation"), F.lit(1).cast("long").alias("quantity"), (F.col("status") == "ok").alias("ok")),
        )).alias("u"),
    ).select("source", "id", "u.*", F.lit(len(EXTRACT_SPEC)).alias("fields"))
    q_usage = _bench_queries(spark, sf).select(
        F.lit("query").alias("source"), F.col("query_id").alias("id"), F.lit("query").alias("operation"),
        F.lit(5).cast("long").alias("quantity"), F.lit(True).alias("ok"), F.lit(0).alias("fields"),
    )
    usage = doc_usage.unionByName(page_usage).unionByName(q_usage)
    return oa.cost_rows(usage).select("source", "id", "operation", "quantity", "ok", F.col("credits").cast("double").alias("credits"))


register(
    "cost_rows",
    f"""WITH {S.chunks_cte()},
cs AS (SELECT doc_id, count(*) AS n FROM chunks GROUP BY doc_id),
d AS (SELECT d.doc_id, CAST(coalesce(cs.n, 0) AS BIGINT) AS n, l.toxic FROM documents d LEFT JOIN cs USING (doc_id) LEFT JOIN labels l USING (doc_id)),
{_extract_sql()},
usage AS (
  SELECT 'doc' AS source, doc_id AS id, 'chunk' AS operation, n AS quantity, true AS ok, 0 AS fields FROM d
  UNION ALL SELECT 'doc', doc_id, 'injection', n, coalesce(toxic = 0, true), 0 FROM d
  UNION ALL SELECT 'page', page_id, 'url_local', 1, true, 0 FROM st
  UNION ALL SELECT 'page', page_id, 'extract', 1, status = 'ok', {len(EXTRACT_SPEC)} FROM st
  UNION ALL SELECT 'query', item_id, 'query', 5, true, 0 FROM benchmark
)
SELECT u.source, u.id, u.operation, CAST(u.quantity AS BIGINT) AS quantity, u.ok,
       CAST(CAST(CASE WHEN u.ok THEN (CASE WHEN u.operation = 'extract'
            THEN r.rate + CAST(0.0001 AS DECIMAL(18,4)) * u.fields + CAST(0.0020 AS DECIMAL(18,4)) ELSE r.rate END) * u.quantity
            ELSE 0 END AS DECIMAL(18,4)) AS DOUBLE) AS credits
FROM usage u LEFT JOIN {_rates_sql()} ON r.operation = u.operation""",
)(q_cost_rows)


def q_balance(spark, sf):
    ev = T(spark, sf, "events").select("event_id", "ts", F.col("user_id").alias("account"), "value")
    costs = ev.withColumn("credits", (F.round(F.col("value") * 100).cast("long") * F.lit(Decimal("0.0001"))).cast(oa.MONEY))
    b = oa.running_balance(costs, 5.0, "account", ["ts", "event_id"])
    return b.select("event_id", F.col("account").alias("user_id"), F.col("credits_remaining").cast("double").alias("credits_remaining"), "overdrawn")


register(
    "running_balance",
    """WITH c AS (SELECT event_id, ts, user_id, CAST(CAST(round(value * 100) AS BIGINT) * CAST(0.0001 AS DECIMAL(18,4)) AS DECIMAL(18,4)) AS credits FROM events),
r AS (SELECT *, CAST(CAST(5.0 AS DECIMAL(18,4)) - sum(credits) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(18,4)) AS rem FROM c)
SELECT event_id, user_id, CAST(rem AS DOUBLE) AS credits_remaining, rem < 0 AS overdrawn FROM r""",
)(q_balance)


def q_ingest_report(spark, sf):
    docs = T(spark, sf, "documents").select("doc_id", "lang")
    labels = T(spark, sf, "labels").select("doc_id", "toxic")
    files = docs.join(labels, "doc_id", "left").select(
        F.col("lang").alias("job"), F.col("doc_id").alias("file"),
        F.when(F.col("toxic") == 1, F.lit("rejected: toxic content")).alias("error"),
        F.when(F.col("doc_id") % 3 != 0, 5_000_000 - F.col("doc_id")).alias("left"),
    )
    chunks = _chunks(spark, sf).select(F.col("doc_id").alias("file"))
    r = oa.ingest_report(files, chunks, remaining="left")
    return r.withColumn("credits_used", F.col("credits_used").cast("double"))


register(
    "ingest_report",
    f"""WITH {S.chunks_cte()},
cs AS (SELECT doc_id, count(*) AS n FROM chunks GROUP BY doc_id),
f AS (SELECT d.lang AS job, d.doc_id, CASE WHEN l.toxic = 1 THEN 'rejected: toxic content' END AS error, cs.n
      FROM documents d LEFT JOIN labels l USING (doc_id) LEFT JOIN cs USING (doc_id)),
g AS (SELECT job, count(*) FILTER (WHERE error IS NULL) AS files_processed, count(*) FILTER (WHERE error IS NOT NULL) AS files_failed,
             CAST(coalesce(sum(n) FILTER (WHERE error IS NULL), 0) AS BIGINT) AS total_chunks,
             5000000 - max(doc_id) FILTER (WHERE error IS NULL AND doc_id % 3 <> 0) AS credits_remaining FROM f GROUP BY job)
SELECT job, files_processed, files_failed, total_chunks, total_chunks AS vectors_upserted, credits_remaining,
       CAST(CAST(total_chunks * CAST(0.0035 AS DECIMAL(18,4)) AS DECIMAL(18,4)) AS DOUBLE) AS credits_used,
       CASE WHEN files_failed = 0 THEN 'success' ELSE 'partial' END AS status FROM g""",
)(q_ingest_report)


_STATUSES = [200, 204, 401, 402, 403, 404, 418, 422, 429, 500, 502, 503]


def q_status(spark, sf):
    """Every event is a response: its id picks a status and a retry_after that
    is a number, a text or missing."""
    i = F.col("event_id")
    log = T(spark, sf, "events").select(
        F.element_at(F.array(*map(F.lit, _STATUSES)), (i % len(_STATUSES) + 1).cast("int")).alias("status"),
        F.when(i % 5 == 0, F.lit("30")).when(i % 5 == 1, F.lit("soon")).when(i % 5 == 2, F.lit("")).when(i % 5 == 3, (i % 600).cast("string")).alias("retry_after"),
    )
    return oa.classify_status(log).groupBy("error_class").agg(
        F.count(F.lit(1)).alias("n"), F.count("retry_after_s").alias("n_retry"), F.sum("retry_after_s").cast("long").alias("retry_s")
    )


register(
    "classify_status",
    f"""WITH lg AS (
  SELECT {_STATUSES}[event_id % {len(_STATUSES)} + 1] AS status,
    CASE event_id % 5 WHEN 0 THEN 30 WHEN 3 THEN event_id % 600 END AS retry FROM events
)
SELECT CASE WHEN status IN (200, 204) THEN 'ok' WHEN status = 402 THEN 'credits' WHEN status IN (401, 403) THEN 'auth'
            WHEN status = 422 THEN 'validation' WHEN status = 429 THEN 'rate_limit' WHEN status = 503 THEN 'busy'
            WHEN status IN (500, 502) THEN 'server' ELSE 'generic' END AS error_class, count(*) AS n,
  count(retry) FILTER (WHERE status = 503) AS n_retry, CAST(sum(retry) FILTER (WHERE status = 503) AS BIGINT) AS retry_s
FROM lg GROUP BY 1""",
)(q_status)


# ---------------------------------------------------------------- A: formats
from corpusflow.operators import code_units as cu  # noqa: E402
from corpusflow.sources import files as sfiles  # noqa: E402
from corpusflow.sources import formats as fm  # noqa: E402


def _json_files(spark, sf) -> DataFrame:
    """One JSON export per document, built from its chunks; the shape depends
    on the language: en = objects with text, fr = blank text then content and
    a link, de = strings plus a number and a null, es = one object."""
    chunks = _chunks(spark, sf)
    docs = T(spark, sf, "documents").select("doc_id", "lang", "source")
    per = chunks.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("chunk_index", "content"))).alias("_c"))
    d = docs.join(per, "doc_id", "left").withColumn("_c", F.coalesce("_c", F.array().cast(per.schema["_c"].dataType)))
    texts = F.col("_c.content")
    en = F.to_json(F.transform("_c", lambda c: F.struct(F.col("source").alias("url"), c["content"].alias("text"))))
    fr = F.to_json(F.transform("_c", lambda c: F.struct(F.lit("  ").alias("text"), c["content"].alias("content"),
                                                         F.concat(F.lit("https://x.example.com/"), F.col("doc_id").cast("string")).alias("link"))))
    de = F.concat(F.lit("["), F.array_join(F.transform(texts, lambda t: F.to_json(F.array(t)).substr(F.lit(2), F.length(F.to_json(F.array(t))) - 2)), ","),
                  F.when(F.size("_c") > 0, F.lit(",")).otherwise(F.lit("")), F.lit("3,null]"))
    es = F.to_json(F.struct(F.try_element_at(texts, F.lit(1)).alias("body"), F.col("source").alias("url")))
    body = F.when(F.col("lang") == "en", en).when(F.col("lang") == "fr", fr).when(F.col("lang") == "de", de).otherwise(es)
    return d.select(F.concat(F.lit("docs/"), F.col("doc_id").cast("string"), F.lit(".json")).alias("file"), body.alias("text"))


register(
    "json_records",
    f"""WITH {S.chunks_cte()},
d AS (SELECT doc_id, lang, source, 'docs/' || CAST(doc_id AS VARCHAR) || '.json' AS file FROM documents)
SELECT d.file, c.chunk_index AS item_index, c.content AS text,
       CASE d.lang WHEN 'en' THEN d.source WHEN 'fr' THEN 'https://x.example.com/' || CAST(d.doc_id AS VARCHAR)
                   ELSE 'file://' || CAST(d.doc_id AS VARCHAR) || '.json' END AS url
FROM d JOIN chunks c USING (doc_id)
WHERE d.lang IN ('en', 'fr', 'de') AND {S.squash('c.content')} <> ''
UNION ALL
SELECT d.file, 0, c.content, d.source FROM d JOIN chunks c USING (doc_id) WHERE d.lang NOT IN ('en', 'fr', 'de') AND c.chunk_index = 0""",
)(lambda spark, sf: fm.json_records(_json_files(spark, sf)))


def _lines(spark, sf) -> DataFrame:
    return T(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus")


register(
    "row_text",
    """WITH r AS (SELECT l_orderkey, l_linenumber, 'Row ' || CAST(l_linenumber AS VARCHAR) || ': ' ||
       concat_ws(' | ', 'l_partkey: ' || CAST(l_partkey AS VARCHAR), 'l_quantity: ' || CAST(l_quantity AS VARCHAR),
                 CASE WHEN l_returnflag <> '' THEN 'l_returnflag: ' || l_returnflag END) AS line, l_linenumber
FROM lineitem)
SELECT l_orderkey, string_agg(line, chr(10) ORDER BY l_linenumber, line) AS text FROM r GROUP BY l_orderkey""",
)(lambda spark, sf: fm.row_text(_lines(spark, sf), "l_orderkey", "l_linenumber", ["l_partkey", "l_quantity", "l_returnflag"]))

register(
    "sheet_text",
    """WITH s AS (
  SELECT l_orderkey, l_linestatus, string_agg(concat_ws(' | ', CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR), CAST(l_quantity AS VARCHAR)),
                                             chr(10) ORDER BY l_linenumber, concat_ws(' | ', CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR), CAST(l_quantity AS VARCHAR))) AS r
  FROM lineitem GROUP BY ALL
)
SELECT l_orderkey, string_agg('## Sheet: status ' || l_linestatus || chr(10) || r, chr(10) || chr(10) ORDER BY l_linestatus) AS text
FROM s GROUP BY l_orderkey""",
)(
    lambda spark, sf: fm.sheet_text(
        _lines(spark, sf).withColumn("sheet", F.concat(F.lit("status "), F.col("l_linestatus"))),
        "l_orderkey", "sheet", "l_linestatus", "l_linenumber", ["l_partkey", "l_suppkey", "l_quantity"],
    )
)

_GFM_COLS = ["l_linenumber", "l_partkey", "l_quantity", "l_returnflag"]


def _gfm_sql() -> str:
    cells = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in _GFM_COLS)
    heads = ", ".join(f"'{c}'" for c in _GFM_COLS)
    widths = ", ".join(f"greatest(max(length({c})), 3) AS w_{i}" for i, c in enumerate(_GFM_COLS))
    line = " || ' | ' || ".join(f"rpad({c}, CAST(w_{i} AS INTEGER), ' ')" for i, c in enumerate(_GFM_COLS))
    sep = " || ' | ' || ".join(f"repeat('-', CAST(w_{i} AS INTEGER))" for i in range(len(_GFM_COLS)))
    return f"""WITH c AS (
  SELECT l_orderkey, 1 AS h, l_linenumber AS o, {cells} FROM lineitem
  UNION ALL SELECT DISTINCT l_orderkey, 0, NULL, {heads} FROM lineitem
),
w AS (SELECT l_orderkey, {widths} FROM c GROUP BY l_orderkey),
r AS (SELECT c.l_orderkey, h, o, '| ' || {line} || ' |' AS l, '| ' || {sep} || ' |' AS sep FROM c JOIN w USING (l_orderkey))
SELECT l_orderkey, string_agg(CASE WHEN h = 0 THEN l || chr(10) || sep ELSE l END, chr(10) ORDER BY h, o, l) AS text FROM r GROUP BY l_orderkey"""


register("gfm_table", _gfm_sql())(lambda spark, sf: fm.gfm_table(_lines(spark, sf), "l_orderkey", "l_linenumber", _GFM_COLS))


def _notebooks(spark, sf) -> DataFrame:
    """One notebook per conversation: user turns are markdown cells, assistant
    turns code cells, system turns raw cells; odd turns carry the source as a
    list of one string."""
    c = T(spark, sf, "conversations")
    kind = F.when(F.col("role") == "user", "markdown").when(F.col("role") == "assistant", "code").otherwise("raw")
    src = F.when(F.col("turn") % 2 == 1, F.to_json(F.array("text"))).otherwise(
        F.expr("substr(to_json(array(text)), 2, length(to_json(array(text))) - 2)")
    )
    cell = F.concat(F.lit('{"cell_type": "'), kind, F.lit('", "source": '), src, F.lit("}"))
    # A notebook holds at most 1,000 turns, so no file (group) is unbounded.
    g = c.groupBy("conv_id", F.floor(F.col("turn") / 1000).alias("part")).agg(
        F.sort_array(F.collect_list(F.struct("turn", cell.alias("j")))).alias("_c"))
    return g.select(F.concat(F.lit("conv_"), F.col("conv_id").cast("string"), F.lit("_"), F.col("part").cast("string"), F.lit(".ipynb")).alias("file"),
                    F.concat(F.lit('{"cells": ['), F.array_join(F.col("_c.j"), ", "), F.lit("]}")).alias("text"))


register(
    "notebook_text",
    f"""SELECT 'conv_' || CAST(conv_id AS VARCHAR) || '_' || CAST(CAST(floor(turn / 1000) AS BIGINT) AS VARCHAR) || '.ipynb' AS file,
       coalesce(string_agg(CASE WHEN role = 'user' THEN text ELSE '```python' || chr(10) || text || chr(10) || '```' END,
                           chr(10) || chr(10) ORDER BY turn) FILTER (WHERE role IN ('user', 'assistant') AND {S.strip_edges('text')} <> ''), '') AS text
FROM conversations GROUP BY conv_id, floor(turn / 1000)""",
)(lambda spark, sf: fm.notebook_text(_notebooks(spark, sf)))


register(
    "xml_text",
    f"""WITH {_sitemaps_sql()}
SELECT sitemap_url AS file, CASE WHEN ends_with(xml, '</urlset>')
  THEN array_to_string(list_filter(list_transform(regexp_extract_all(xml, '<loc>([^<]+)', 1), lambda t: {S.strip_edges(S.decode('t'))}), lambda t: t <> ''), chr(10))
  ELSE xml END AS text FROM sm""",
)(
    lambda spark, sf: fm.xml_text(ol.build_sitemaps(_pages(spark, sf, "page_id", "url")).select(F.col("sitemap_url").alias("file"), F.col("xml").alias("text")))
)


def q_flatten(spark, sf):
    li = _lines(spark, sf)
    per = li.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_quantity"))).alias("_r"))
    rows = F.transform("_r", lambda r: F.create_map(F.lit("part"), r["l_partkey"].cast("string"), F.lit("qty"), r["l_quantity"].cast("string")))
    tables = per.select("l_orderkey", F.array(F.struct(F.lit(1).alias("page"), F.lit(0).alias("table_index"), rows.alias("rows"))).alias("tables"))
    return fm.flatten_tables(tables, "l_orderkey")


register(
    "flatten_tables",
    """WITH r AS (SELECT l_orderkey, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity) - 1 AS INTEGER) AS row_index,
                  CAST(l_partkey AS VARCHAR) AS part, CAST(l_quantity AS VARCHAR) AS qty FROM lineitem)
SELECT l_orderkey, 1 AS page, 0 AS table_index, row_index, 'part' AS "column", part AS value FROM r
UNION ALL SELECT l_orderkey, 1, 0, row_index, 'qty', qty FROM r""",
)(q_flatten)


def _corpus_folder(spark, sf) -> str:
    """A folder with one file per document and page, named by rule: plain,
    hidden and underscored names and folders, other suffixes, empty files."""
    import uuid

    base = shared_path(spark, f"corpus/{uuid.uuid4().hex[:12]}")
    i = F.col("doc_id")
    n = i.cast("string")
    name = (
        F.when(i % 8 == 0, F.concat(F.lit("docs/_"), n, F.lit(".md")))
        .when(i % 8 == 1, F.concat(F.lit("docs/."), n, F.lit(".txt")))
        .when(i % 8 == 2, F.concat(F.lit(".store/"), n, F.lit(".RST")))
        .when(i % 8 == 3, F.concat(F.lit("docs/_deep/"), n, F.lit(".MD")))
        .otherwise(F.concat(F.lit("docs/"), n, F.lit(".txt")))
    )
    docs = T(spark, sf, "documents").select(name.alias("path"), F.when(i % 9 == 0, F.lit("")).otherwise(F.coalesce("text", F.lit(""))).alias("content"))
    page = T(spark, sf, "pages").select(F.concat(F.lit("site/"), F.col("page_id").cast("string"), F.lit(".html")).alias("path"), F.col("html").alias("content"))
    table = T(spark, sf, "nation").select(
        F.concat(F.lit("tables/"), F.col("n_nationkey").cast("string"), F.lit(".csv")).alias("path"),
        F.concat(F.lit("key,name\n"), F.col("n_nationkey").cast("string"), F.lit(",\""), F.col("n_name"), F.when(F.col("n_nationkey") % 2 == 0, F.lit('"\n')).otherwise(F.lit("")))
        .alias("content"),
    )
    codec = T(spark, sf, "region").select(F.concat(F.lit("tables/"), F.col("r_name"), F.lit(".xlsx")).alias("path"), F.lit("bytes").alias("content"))
    sfiles.write_files(docs.unionByName(page).unionByName(table).unionByName(codec), base)
    return base


_CORPUS_SQL = """corpus AS (
  SELECT CASE doc_id % 8 WHEN 0 THEN 'docs/_' || doc_id || '.md' WHEN 1 THEN 'docs/.' || doc_id || '.txt' WHEN 2 THEN '.store/' || doc_id || '.RST'
      WHEN 3 THEN 'docs/_deep/' || doc_id || '.MD' ELSE 'docs/' || doc_id || '.txt' END AS path,
    CASE WHEN doc_id % 9 = 0 THEN '' ELSE coalesce(text, '') END AS text,
    CASE WHEN doc_id % 8 IN (0, 3) THEN 'markdown' ELSE 'text' END AS source_type FROM documents WHERE doc_id % 8 <> 2
  UNION ALL SELECT 'site/' || page_id || '.html', html, 'html' FROM pages
  UNION ALL SELECT 'tables/' || n_nationkey || '.csv', 'key,name' || chr(10) || n_nationkey || ',"' || n_name || CASE WHEN n_nationkey % 2 = 0 THEN '"' || chr(10) ELSE '' END, 'csv' FROM nation
  UNION ALL SELECT 'tables/' || r_name || '.xlsx', 'bytes', 'excel' FROM region
)"""


def q_scan(spark, sf):
    """One row per file of a folder that holds names of every kind."""
    base = _corpus_folder(spark, sf)
    found = sfiles.scan_corpus(spark, base)
    at = F.regexp_replace(F.col("path"), r"^.*?/corpus/[0-9a-f]{12}/", "")
    return found.select(at.alias("path"), "name", "suffix", "source_type", "length", F.sha2("text", 256).alias("text_sha256"), F.col("error").isNotNull().alias("failed"))


register(
    "scan_corpus",
    f"""WITH {_CORPUS_SQL}
SELECT path, string_split(path, '/')[-1] AS name, lower(regexp_extract(path, '(\\.[^./]+)$', 1)) AS suffix, source_type,
  CAST(strlen(text) AS BIGINT) AS length, sha256(text) AS text_sha256, false AS failed FROM corpus""",
)(q_scan)


def q_missing(spark, sf):
    provs = [p for p, *_ in cat.VECTOR_DB_PROVIDERS] + ["unknown_db"]
    c = T(spark, sf, "customer")
    cfg = F.create_map(
        F.lit("api_key"), F.col("c_name"), F.lit("url"), F.col("c_mktsegment"),
        F.lit("collection_name"), F.when(F.col("c_acctbal") > 0, F.lit("col")).otherwise(F.lit("")),
        F.lit("table_name"), F.when(F.col("c_acctbal") > 5000, F.lit("t")).otherwise(F.lit(" ")),
        F.lit("connection_string"), F.lit("postgresql://db"),
    )
    configs = c.select(
        F.col("c_custkey").alias("name"),
        F.element_at(F.array(*[F.lit(p) for p in provs]), (F.col("c_nationkey") % F.lit(len(provs))) + 1).alias("provider"),
        cfg.alias("config"),
    )
    return cat.missing_fields(configs)


def _missing_sql() -> str:
    provs = [p for p, *_ in cat.VECTOR_DB_PROVIDERS] + ["unknown_db"]
    req = " UNION ALL ".join(f"SELECT {S.q(p)} AS provider, unnest([{', '.join(S.q(x) for x in r)}]::VARCHAR[]) AS field"
                             for p, _, r, _, _ in cat.VECTOR_DB_PROVIDERS if r)
    return f"""WITH cfg AS (
  SELECT c_custkey AS name, [{', '.join(S.q(p) for p in provs)}][c_nationkey % {len(provs)} + 1] AS provider,
         MAP {{'api_key': c_name, 'url': c_mktsegment, 'collection_name': CASE WHEN c_acctbal > 0 THEN 'col' ELSE '' END,
              'table_name': CASE WHEN c_acctbal > 5000 THEN 't' ELSE ' ' END, 'connection_string': 'postgresql://db'}} AS config
  FROM customer
),
req AS ({req})
SELECT c.name, c.provider, r.field FROM cfg c JOIN req r USING (provider)
WHERE coalesce(trim(element_at(c.config, r.field)[1]), '') = ''
UNION ALL SELECT name, provider, NULL FROM cfg WHERE provider NOT IN (SELECT provider FROM req)"""


register("missing_fields", _missing_sql())(q_missing)


# ---------------------------------------------------------------- C7-C11: code units

def _sql_files(spark, sf) -> DataFrame:
    """One SQL script per customer; the market segment picks a variant so all
    quirks occur: a leading comment, CREATE OR REPLACE, INSERT then SELECT on
    the next line, COMMENT ON, a double space, a file with no statement."""
    c = spread(T(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment"))
    k = F.col("c_custkey").cast("string")
    seg = F.col("c_mktsegment")
    body = (
        F.when(seg == "BUILDING", F.concat(F.lit("-- customer "), F.col("c_name"), F.lit("\nCREATE TABLE c_"), k, F.lit(" (k BIGINT);\nINSERT INTO c_"), k,
                                           F.lit("\nSELECT "), F.col("c_acctbal").cast("string"), F.lit(";\n")))
        .when(seg == "AUTOMOBILE", F.concat(F.lit("create or replace view v_"), k, F.lit(" as\n  select 1;\n\ncomment on view v_"), k, F.lit(" is 'x';\n")))
        .when(seg == "MACHINERY", F.concat(F.lit("CREATE  TABLE d_"), k, F.lit(" (x INT);\nUPDATE d_"), k, F.lit(" SET x = 1;\nDELETE FROM d_"), k, F.lit(";\n")))
        .when(seg == "FURNITURE", F.concat(F.lit("WITH a AS (SELECT 1)\nSELECT * FROM a;\nGRANT SELECT ON a TO r_"), k, F.lit(";\n")))
        .otherwise(F.concat(F.lit("-- nothing to run for "), F.col("c_name"), F.lit("\n")))
    )
    return c.select(F.concat(F.lit("c_"), k, F.lit(".sql")).alias("file"), body.alias("text"))


def _sql_units_sql() -> str:
    k = "CAST(c_custkey AS VARCHAR)"
    types = "".join(f"WHEN starts_with(upper({S.strip_edges('first_line')}), {S.q(t)}) THEN {S.q(t.lower().replace(' ', '_'))} " for t in cu.SQL_TYPES)
    return f"""WITH files AS (
  SELECT 'c_' || {k} || '.sql' AS file, CASE c_mktsegment
    WHEN 'BUILDING' THEN '-- customer ' || c_name || chr(10) || 'CREATE TABLE c_' || {k} || ' (k BIGINT);' || chr(10) || 'INSERT INTO c_' || {k} || chr(10) || 'SELECT ' || CAST(c_acctbal AS VARCHAR) || ';' || chr(10)
    WHEN 'AUTOMOBILE' THEN 'create or replace view v_' || {k} || ' as' || chr(10) || '  select 1;' || chr(10) || chr(10) || 'comment on view v_' || {k} || ' is ''x'';' || chr(10)
    WHEN 'MACHINERY' THEN 'CREATE  TABLE d_' || {k} || ' (x INT);' || chr(10) || 'UPDATE d_' || {k} || ' SET x = 1;' || chr(10) || 'DELETE FROM d_' || {k} || ';' || chr(10)
    WHEN 'FURNITURE' THEN 'WITH a AS (SELECT 1)' || chr(10) || 'SELECT * FROM a;' || chr(10) || 'GRANT SELECT ON a TO r_' || {k} || ';' || chr(10)
    ELSE '-- nothing to run for ' || c_name || chr(10) END AS text
  FROM customer
),
l AS (SELECT file, text, string_split(text, chr(10)) AS ls FROM files),
b AS (SELECT file, text, ls, list_filter(list_transform(ls, lambda x, i: CASE WHEN regexp_matches(x, {S.q(cu.SQL_STATEMENT)}) THEN i - 1 ELSE -1 END), lambda x: x >= 0) AS bs FROM l),
z AS (SELECT file, ls, unnest(bs) AS s, unnest(list_concat(bs[2:], [len(ls)])) AS e, unnest(range(len(bs))) AS idx FROM b WHERE len(bs) > 0),
u AS (SELECT file, CAST(idx AS INTEGER) AS statement_index, ls[s + 1] AS first_line,
             {S.rx('array_to_string(ls[s + 1 : e], chr(10))', cu.PY_STRIP, "''")} AS text FROM z)
SELECT file, statement_index, CASE {types}ELSE 'unknown' END AS statement_type, text FROM u WHERE text <> ''
UNION ALL SELECT file, 0, 'unknown', text FROM b WHERE len(bs) = 0"""


register("sql_units", _sql_units_sql())(lambda spark, sf: cu.sql_units(_sql_files(spark, sf)))

register(
    "unit_urls",
    f"""WITH q AS ({_sql_units_sql()})
SELECT file, statement_index, 'file://' || file || '#' || statement_type || '_' || CAST(statement_index AS VARCHAR) AS url FROM q""",
)(lambda spark, sf: cu.unit_urls(cu.sql_units(_sql_files(spark, sf)), "file", "sql").select("file", "statement_index", "url"))


_PY_HEAD = "import os\nfrom typing import List as L, Dict\nfrom collections import (\n    OrderedDict,\n    defaultdict,\n)\n\n"


def _py_files(spark, sf) -> DataFrame:
    """One Python module per part: aliased and bracketed imports, a decorated
    class whose docstring has text in column 0, an async function, a signature
    over several lines, module code between them; every seventh is broken."""
    p = spread(T(spark, sf, "part").select("p_partkey", "p_size", "p_name", "p_brand"))
    k, size = F.col("p_partkey").cast("string"), F.col("p_size").cast("string")
    text = F.concat(
        F.lit(_PY_HEAD + "SIZE = "), size, F.lit("\n\n@register\nclass Part"), k, F.lit(':\n    """'), F.col("p_name"),
        F.lit('\ncolumn zero\n    """\n\n    def price(self) -> Dict:\n        # list price\n        return '), size,
        F.lit("\n\n\n# helpers\nasync def fetch_"), k, F.lit("(x):\n    return L[x]\n\n\nBRAND = '"), F.col("p_brand"),
        F.lit("'\nif SIZE > 25:\n    BRAND = BRAND.lower()\n\n\ndef size_"), k, F.lit("(\n    a,\n    b,\n) -> int:\n    return os.path.join(a, b)\n"),
        F.when(F.col("p_partkey") % 7 == 0, F.lit("x = (\n")).otherwise(F.lit("")),
    )
    return p.select(F.concat(F.lit("part_"), k, F.lit(".py")).alias("file"), text.alias("text"))


# The units of these modules are known; SQL states them. E'' strings read \n.
_PY_SQL = r"""p AS (
  SELECT 'part_' || p_partkey || '.py' AS file, p_partkey % 7 = 0 AS broken, p_partkey AS k, p_size AS z,
    'class Part' || p_partkey || E':\n    \"\"\"' || p_name || E'\ncolumn zero\n    \"\"\"\n\n    def price(self) -> Dict:\n        # list price\n        return ' || p_size AS c,
    'async def fetch_' || p_partkey || E'(x):\n    return L[x]' AS a,
    'def size_' || p_partkey || E'(\n    a,\n    b,\n) -> int:\n    return os.path.join(a, b)' AS d,
    E'BRAND = \'' || p_brand || E'\'\nif SIZE > 25:\n    BRAND = BRAND.lower()' AS g FROM part
), u AS (
  SELECT file, 'class' AS type, 'Part' || k AS name, 11 AS line_start, 18 AS line_end, c AS src FROM p WHERE NOT broken
  UNION ALL SELECT file, 'async_function', 'fetch_' || k, 22, 23, a FROM p WHERE NOT broken
  UNION ALL SELECT file, 'function', 'size_' || k, 31, 35, d FROM p WHERE NOT broken
  UNION ALL SELECT file, 'global_scope', '<module>', 7, 10, 'SIZE = ' || z || E'\n\n@register' FROM p WHERE NOT broken
  UNION ALL SELECT file, 'global_scope', '<module>', 19, 21, '# helpers' FROM p WHERE NOT broken
  UNION ALL SELECT file, 'global_scope', '<module>', 24, 30, g FROM p WHERE NOT broken
  UNION ALL SELECT file, 'module', '<module>', 1, 36,
    E'import os\nfrom typing import List as L, Dict\nfrom collections import (\n    OrderedDict,\n    defaultdict,\n)\n\nSIZE = ' || z
    || E'\n\n@register\n' || c || E'\n\n\n# helpers\n' || a || E'\n\n\n' || g || E'\n\n\n' || d || E'\nx = (\n' FROM p WHERE broken
), i AS (
  SELECT *, CASE WHEN type IN ('class', 'function', 'async_function') THEN array_to_string(list_filter([
      CASE WHEN contains(src, 'os') THEN 'import os' END,
      CASE WHEN contains(src, 'L') OR contains(src, 'Dict') THEN 'from typing import List as L, Dict' END,
      CASE WHEN contains(src, 'OrderedDict') OR contains(src, 'defaultdict') THEN
        E'from collections import (\n    OrderedDict,\n    defaultdict,\n)' END
    ], lambda x: x IS NOT NULL), chr(10)) ELSE '' END AS used FROM u
)"""


def _py_units(spark, sf) -> DataFrame:
    return cu.python_units(_py_files(spark, sf))


register(
    "python_units",
    f"""WITH {_PY_SQL}
SELECT file, type, name, CAST(line_start AS BIGINT) AS line_start, CAST(line_end AS BIGINT) AS line_end,
  CASE WHEN used = '' THEN src ELSE used || chr(10) || chr(10) || src END AS text,
  'file://' || file || CASE WHEN name = '<module>' THEN '' ELSE '#' || name END AS url FROM i""",
)(lambda spark, sf: cu.unit_urls(_py_units(spark, sf)).select("file", "type", "name", "line_start", "line_end", "text", "url"))

register(
    "uncovered_blocks",
    f"WITH {_PY_SQL} SELECT file, CAST(line_start AS BIGINT) AS line_start, CAST(line_end AS BIGINT) AS line_end, src AS text FROM i WHERE type = 'global_scope'",
)(lambda spark, sf: _py_units(spark, sf).where("type = 'global_scope'").select("file", "line_start", "line_end", "text"))

register(
    "relevant_imports",
    f"WITH {_PY_SQL} SELECT file, name, used AS imports FROM i WHERE type IN ('class', 'function', 'async_function')",
)(
    lambda spark, sf: _py_units(spark, sf).where("type in ('class', 'function', 'async_function')").select(
        "file", "name", F.regexp_extract("text", r"(?s)\A(.*?)(?:\A|\n\n)(?:class|def|async def) ", 1).alias("imports")
    )
)


# ---------------------------------------------------------------- whole jobs
from corpusflow.plans import ingest as ing  # noqa: E402


def _mixed_files(spark, sf) -> DataFrame:
    """Documents as Markdown, JSON exports, Python and SQL sources, HTML pages
    and one CSV per order."""
    md = T(spark, sf, "documents").select(F.concat(F.lit("md/"), F.col("doc_id").cast("string"), F.lit(".MD")).alias("file"), "text")
    html = _pages(spark, sf, F.concat(F.lit("site/"), F.col("page_id").cast("string"), F.lit(".htm")).alias("file"), F.col("html").alias("text"))
    o = T(spark, sf, "orders")
    table = o.select(
        F.concat(F.lit("orders/"), F.col("o_orderkey").cast("string"), F.lit(".csv")).alias("file"),
        F.concat(F.lit('id,status,none,"a ""note"""\n'), F.col("o_orderkey").cast("string"), F.lit(","), F.col("o_orderstatus"), F.lit(',,"line 1\nline 2"\n,,,\n')).alias("text"),
    )
    out = md
    for other in (_json_files(spark, sf), _py_files(spark, sf), _sql_files(spark, sf), html, table):
        out = out.unionByName(other.select("file", "text"))
    return out


def _chunk_digest(rows: DataFrame, *cols: str) -> DataFrame:
    """One row per chunk: its text's digest and a number that depends on every
    component of its vector."""
    weighed = F.aggregate(F.transform("embedding", lambda x, i: x * (i + 1)), F.lit(0.0), lambda a, x: a + x)
    return rows.select(*cols, "chunk_index", "token_estimate", F.sha2("content", 256).alias("content_sha256"), F.round(F.coalesce(weighed, F.lit(0.0)), 5).alias("vector"))


def _chunk_digest_sql(units: str, cols: str, cols_of_vector: str) -> str:
    return f"""{S.chunks_cte('ck', table='units', id_col=cols_of_vector, text_col='text')},
{S.hashed_cte('cv', 'ck', cols_of_vector + ', chunk_index', 'content', 64)},
vec AS (SELECT {cols_of_vector}, chunk_index, sum(weight * (bucket + 1)) AS vector FROM cv GROUP BY ALL)
SELECT {cols}, chunk_index, token_estimate, sha256(content) AS content_sha256, round(coalesce(vector, 0), 5) AS vector
FROM ck LEFT JOIN vec USING ({cols_of_vector}, chunk_index)"""


def q_ingest_files(spark, sf):
    return _chunk_digest(ing.ingest_files(_mixed_files(spark, sf)), "file", "source_type")


register(
    "ingest_files",
    f"""WITH {_PY_SQL},
js AS ({ORACLE["json_records"]}),
sq AS ({_sql_units_sql()}),
raw AS (
  SELECT 'md/' || doc_id || '.MD' AS file, 'markdown' AS source_type, text FROM documents
  UNION ALL SELECT file, 'json', text FROM js
  UNION ALL SELECT file, 'code', CASE WHEN used = '' THEN src ELSE used || chr(10) || chr(10) || src END FROM i
  UNION ALL SELECT file, 'code', text FROM sq
  UNION ALL SELECT 'site/' || page_id || '.htm', 'html', {S.html_text('html')} FROM pages
  UNION ALL SELECT 'orders/' || o_orderkey || '.csv', 'csv', 'Row 1: id: ' || o_orderkey || ' | status: ' || o_orderstatus || ' | a "note": line 1' || chr(10) || 'line 2' FROM orders
),
units AS (SELECT *, row_number() OVER () AS unit FROM raw),
{_chunk_digest_sql('units', 'file, source_type', 'file, source_type, unit')}""",
)(q_ingest_files)


def q_ingest_folder(spark, sf):
    """Scan a folder with names of every kind, chunk and embed what it holds.
    The report's error rows stand beside the chunks, without one."""
    rows, _ = ing.ingest_folder(spark, _corpus_folder(spark, sf))
    at = F.regexp_replace(F.col("file"), r"^.*?/corpus/[0-9a-f]{12}/", "")
    return _chunk_digest(rows.withColumn("file", at), "file", "source_type", "url")


register(
    "ingest_folder",
    f"""WITH {_CORPUS_SQL},
units AS (
  SELECT path AS file, source_type, 'file://' || string_split(path, '/')[-1] AS url, CASE source_type
    WHEN 'html' THEN {S.html_text('text')}
    WHEN 'csv' THEN 'Row 1: key: ' || regexp_extract(text, chr(10) || '([0-9]+),', 1) || ' | name: ' || regexp_extract(text, '"([^"]+)', 1)
    ELSE text END AS text FROM corpus WHERE source_type <> 'excel'
),
{_chunk_digest_sql('units', 'file, source_type, url', 'file, source_type, url')}""",
)(q_ingest_folder)


def q_folder_report(spark, sf):
    """The job's report: files that need a codec failed, empty ones did not."""
    _, report = ing.ingest_folder(spark, _corpus_folder(spark, sf), "all")
    return report.withColumn("credits_used", F.col("credits_used").cast("double"))


register(
    "folder_report",
    f"""WITH {_CORPUS_SQL},
units AS (SELECT path AS file, CASE source_type WHEN 'html' THEN {S.html_text('text')} ELSE text END AS text FROM corpus WHERE source_type <> 'excel'),
{S.chunks_cte('ck', table='units', id_col='file', text_col='text')},
n AS (SELECT count(*) AS n FROM ck)
SELECT 'all' AS job, count(*) FILTER (WHERE source_type <> 'excel') AS files_processed, count(*) FILTER (WHERE source_type = 'excel') AS files_failed,
  any_value(n.n) AS total_chunks, any_value(n.n) AS vectors_upserted, any_value(n.n) * 0.0035::DOUBLE AS credits_used, 'partial' AS status
FROM corpus, n""",
)(q_folder_report)


def q_crawl_chunks(spark, sf):
    pages = _pages(spark, sf, "page_id", "url", "html")
    seeds, _, links = _crawl_inputs(spark, sf)
    _, report = ing.crawl_to_chunks(seeds, pages, links, max_pages=None, with_rank=False)
    return report


register("crawl_to_chunks", ORACLE["crawl_report"])(q_crawl_chunks)


def _sitemap_inputs(spark, sf):
    """Four kinds of sites by the length of the host's name: a urlset; an index
    that names itself and a urlset; robots.txt whose second sitemap is an index
    of an index; nothing at all."""
    p = _pages(spark, sf, "page_id", "url", "html").withColumn("host", fu.url_host("url"))
    top = F.concat(F.lit("https://"), F.col("host"))
    entries = p.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("page_id", "url"))).alias("e"))
    urlset = F.concat(F.lit("<urlset>"), F.array_join(F.transform("e", lambda x: F.concat(F.lit("<url><loc> "), F.replace(x["url"], F.lit("&"), F.lit("&amp;")), F.lit("</loc></url>"))), ""), F.lit("</urlset>"))

    def index(*paths: str):
        return F.concat(F.lit("<sitemapindex>"), *[F.concat(F.lit("<sitemap><loc>"), top, F.lit(x + "</loc></sitemap>")) for x in paths], F.lit("</sitemapindex>"))

    def at(path: str, body):
        return F.struct(F.concat(top, F.lit(path)).alias("url"), body.alias("body"))

    kind = F.length("host") % 4
    docs = (
        F.when(kind == 0, F.array(at("/sitemap.xml", urlset)))
        .when(kind == 1, F.array(at("/sitemap.xml", F.lit("not found")), at("/sitemap_index.xml", index("/sitemap_index.xml", "/a.xml", "/gone.xml")), at("/a.xml", urlset)))
        .when(kind == 2, F.array(at("/robots.txt", F.concat(F.lit("User-agent: *\nSitemap: "), top, F.lit("/no.xml\nSITEMAP: "), top, F.lit("/deep.xml"))),
                                 at("/deep.xml", index("/deeper.xml")), at("/deeper.xml", index("/deep.xml", "/last.xml")), at("/last.xml", urlset)))
        .otherwise(F.array(at("/robots.txt", F.lit("User-agent: *"))))
    )
    return entries.select(top.alias("root")), entries.select(F.inline(docs)), p.drop("host")


_SITE_SQL = f"""u AS (
  SELECT page_id, url, html, 'https://' || {S.host("url")} AS root, length({S.host("url")}) % 4 AS kind FROM pages
), ok AS (SELECT * FROM u WHERE kind < 3 AND {S.in_scope('url', 'root', False)} AND NOT {S.skip_ext('url')}),
md AS (SELECT root, page_id, {S.markdown('html')} AS markdown FROM ok),
{S.chunks_cte('ck', table='md', id_col='root, page_id', text_col='markdown')}"""


def q_sitemap_chunks(spark, sf):
    chunks, _ = ing.sitemap_to_chunks(*_sitemap_inputs(spark, sf))
    return chunks.select("root", "page_id", "chunk_index", "token_estimate", F.sha2("content", 256).alias("content_sha256"))


register(
    "sitemap_to_chunks",
    f"WITH {_SITE_SQL} SELECT root, page_id, chunk_index, token_estimate, sha256(content) AS content_sha256 FROM ck",
)(q_sitemap_chunks)


def q_sitemap_report(spark, sf):
    _, report = ing.sitemap_to_chunks(*_sitemap_inputs(spark, sf))
    return report


register(
    "sitemap_report",
    f"""WITH {_SITE_SQL},
r AS (SELECT DISTINCT root, kind FROM u), n AS (SELECT root, count(DISTINCT url) AS n FROM ok GROUP BY root), c AS (SELECT root, count(*) AS n FROM ck GROUP BY root)
SELECT root, CASE WHEN kind = 3 THEN 1 ELSE coalesce(n.n, 0) END AS pages_discovered, coalesce(n.n, 0) AS pages_crawled, coalesce(c.n, 0) AS total_chunks,
  CASE WHEN kind = 3 THEN 1 ELSE 0 END AS pages_failed FROM r LEFT JOIN n USING (root) LEFT JOIN c USING (root)""",
)(q_sitemap_report)


# ---------------------------------------------------------------- I: streaming
from corpusflow.streaming import streams as st  # noqa: E402


def q_stream_ingest(spark, sf):
    docs = st.file_stream(spark, sf, "documents.parquet", T(spark, sf, "documents").schema)
    base, ck = st.run_dir(spark, "index"), st.run_dir(spark, "ingest-ckpt")
    st.stream_ingest(docs.select("doc_id", "text"), base, ck).awaitTermination()
    idx = st.read_index(spark, base)
    return idx.select("doc_id", "chunk_index", "token_estimate", F.size("embedding").alias("dimension"))


register(
    "stream_ingest",
    f"""WITH {S.chunks_cte()},
{S.hashed_cte('cv', 'chunks', 'doc_id, chunk_index', 'content', 64)},
has AS (SELECT DISTINCT doc_id, chunk_index FROM cv)
SELECT doc_id, chunk_index, token_estimate, 64 AS dimension FROM chunks JOIN has USING (doc_id, chunk_index)""",
)(q_stream_ingest)


def q_stream_twice(spark, sf):
    """Two streams with checkpoints of their own feed one index; the second
    brings other texts for every third document."""
    docs = st.file_stream(spark, sf, "documents.parquet", T(spark, sf, "documents").schema).select("doc_id", "text")
    base = st.run_dir(spark, "index")
    st.stream_ingest(docs, base, st.run_dir(spark, "ingest-ckpt")).awaitTermination()
    third = docs.where("doc_id % 3 = 0").withColumn("text", F.concat(F.lit("second "), "text"))
    st.stream_ingest(third, base, st.run_dir(spark, "ingest-ckpt")).awaitTermination()
    return st.read_index(spark, base).select("doc_id", "chunk_index", "token_estimate", F.sha2("content", 256).alias("content_sha256"))


register(
    "stream_ingest_twice",
    f"""WITH d AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'second ' || text ELSE text END AS text FROM documents),
{S.chunks_cte(table='d')},
{S.hashed_cte('cv', 'chunks', 'doc_id, chunk_index', 'content', 64)},
has AS (SELECT DISTINCT doc_id, chunk_index FROM cv)
SELECT doc_id, chunk_index, token_estimate, sha256(content) AS content_sha256 FROM chunks JOIN has USING (doc_id, chunk_index)""",
)(q_stream_twice)


def _event_urls(df: DataFrame) -> DataFrame:
    url = F.concat(
        F.lit("https://shop.example.com/"), F.col("event_type"), F.lit("/"), F.get_json_object("props", "$.k"),
        F.when(F.col("value") > 25, F.lit("/#top")).otherwise(F.lit("")),
    )
    return df.select("event_id", "ts", url.alias("url"))


def q_stream_dedupe(spark, sf):
    ev = st.file_stream(spark, sf, "events.parquet", T(spark, sf, "events").schema)
    out = st.stream_dedupe_urls(_event_urls(ev), "url", "ts", "1 hour").select("nurl")
    path, ck = st.run_dir(spark, "dedupe"), st.run_dir(spark, "dedupe-ckpt")
    st.run_available_now(out, ck, "append", path=path)
    return spark.read.parquet(path)


_EVENT_URLS_SQL = f"""SELECT DISTINCT {S.normalize_url("'https://shop.example.com/' || event_type || '/' || json_extract_string(props, '$.k') || CASE WHEN value > 25 THEN '/#top' ELSE '' END")} AS nurl FROM events"""

register("stream_dedupe_urls", _EVENT_URLS_SQL)(q_stream_dedupe)


def q_stream_visited(spark, sf):
    """The events of odd ids, then after a restart from the checkpoint those of
    even ids: every URL passes once, though its repeats come days later."""
    ev = T(spark, sf, "events")
    src, path, ck = (st.run_dir(spark, f"visited{x}") for x in ("-src", "", "-ckpt"))
    for part in (1, 0):
        ev.where(F.col("event_id") % 2 == part).write.mode("append").parquet(src)
        urls = _event_urls(spark.readStream.schema(ev.schema).parquet(src))
        st.run_available_now(st.stream_visited_urls(urls), ck, "append", path=path)
    return spark.read.parquet(path)


register("stream_visited_urls", _EVENT_URLS_SQL)(q_stream_visited)


def q_stream_rate(spark, sf):
    ev = st.file_stream(spark, sf, "events.parquet", T(spark, sf, "events").schema)
    out = st.stream_rate(ev.select("ts"), rpm=1)
    base, ck = st.run_dir(spark, "rate"), st.run_dir(spark, "rate-ckpt")
    st.run_available_now(out, ck, "update", sink=st.updates_writer(base))
    r = spark.read.parquet(base).groupBy("window").agg(F.max("calls").alias("calls"))
    return r.select(
        F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "calls", (F.col("calls") > 1).alias("over_budget")
    )


register(
    "stream_rate",
    """SELECT strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS calls, count(*) > 1 AS over_budget
FROM events GROUP BY 1""",
)(q_stream_rate)


def q_write_chunks(spark, sf):
    """Export chunks (url, content, token_estimate) to a fresh folder in
    the shared checkpoint area (never over an earlier run) and read it back."""
    chunks = _chunks(spark, sf).join(T(spark, sf, "documents").select("doc_id", F.col("source").alias("url")), "doc_id")
    path = st.run_dir(spark, "export")
    sfiles.write_chunks(chunks, path, "parquet")
    return spark.read.parquet(path)


register(
    "write_chunks",
    f"""WITH {S.chunks_cte()}
SELECT d.source AS url, c.content, c.token_estimate FROM chunks c JOIN documents d USING (doc_id)""",
)(q_write_chunks)
