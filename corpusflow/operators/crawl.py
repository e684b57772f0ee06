"""Breadth-first crawl over a link table (B8) and its report.

The reference pops one URL at a time from a FIFO queue. FIFO over a graph is
level order, so we run one Spark job per level for all crawl roots at once:

  level d+1 = (ok pages of level d) join links
              - out of scope / skipped suffix / empty
              - first occurrence per (root, url): min of the FIFO key
              - anti join with everything already visited

The FIFO key of a URL is its parent's key with the link position appended:
at one level all keys have the same length, and their lexicographic order is
the queue order. Each level is written as a parquet table in the shared
``spark.checkpoint.dir`` and read back, so lineage stays one level deep and a
lost executor only recomputes one level. The driver sees counts only. With a
``CrawlStore`` the levels are committed there instead, and a crawl that was
stopped goes on from its last committed level.

``max_pages`` stops a root after that many successful fetches (failures are
visited but not counted). Within the level that crosses the budget the cut is
found from the first ``remaining`` successes per root, a top-k that Spark
runs as a partial WindowGroupLimit, so no root is gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusflow.functions.urls import in_scope, normalize_url, skip_extension
from corpusflow.plans.strategy import dense_position, fits_broadcast, materialize
from corpusflow.sources.crawl_store import CrawlStore, union_levels

DEFAULT_MAX_PAGES = 50


def _pop_filter(url, include: str | None, exclude: str | None):
    cond = F.lit(True)
    if include:
        cond = cond & url.contains(include)
    if exclude:
        cond = cond & ~url.contains(exclude)
    return cond


def crawl_frontier(
    seeds: DataFrame,
    pages: DataFrame,
    links: DataFrame,
    max_pages: int | None = DEFAULT_MAX_PAGES,
    include: str | None = None,
    exclude: str | None = None,
    allow_subdomains: bool = False,
    max_levels: int | None = None,
    with_rank: bool = True,
    store: CrawlStore | None = None,
) -> DataFrame:
    """Visits of a FIFO breadth-first crawl per root.

    seeds: (root) seed URLs; pages: (url, page_id) the fetchable pages;
    links: (page_id, pos, target) with resolved, normalised targets.
    Output: root, url, depth, fifo_key, page_id (null when the fetch
    failed), ok, crawl_rank (1-based visit order per root; left out when
    ``with_rank`` is false, which saves a distributed sort).

    With ``store`` every level is committed as it ends. A later call with the
    same store, settings and inputs (after a stop, a failure, or
    ``max_levels``) reads what is committed, runs the levels that lack, and
    returns what one uninterrupted crawl returns.
    """
    settings = {"max_pages": max_pages, "include": include, "exclude": exclude, "allow_subdomains": allow_subdomains}
    # Both tables are read at every level: materialise them once instead of
    # re-running their regex work per level.
    fetch = pages.select(normalize_url("url").alias("url"), "page_id").groupBy("url").agg(F.min("page_id").alias("page_id"))
    fetch = materialize(fetch, "crawl-fetch")
    lk = materialize(links.select("page_id", F.col("pos").cast("long").alias("pos"), F.col("target")), "crawl-links")

    seed_rows = seeds.select(F.col("root"), normalize_url("root").alias("url")).where(
        (F.col("url") != "") & in_scope(F.col("url"), F.col("root"), allow_subdomains)
        & ~skip_extension("url") & _pop_filter(F.col("url"), include, exclude)
    ).dropDuplicates(["root"])
    level = seed_rows.select("root", "url", F.lit(0).alias("depth"), F.array(F.lit(0).cast("long")).alias("fifo_key"))

    def fetch_and_cut(lv: DataFrame, done: DataFrame | None) -> DataFrame:
        lv = lv.join(fetch, "url", "left").withColumn("ok", F.col("page_id").isNotNull())
        if max_pages is None:
            return lv
        remaining = F.lit(max_pages) - F.coalesce(F.col("_done"), F.lit(0))
        if done is not None:
            lv = lv.join(done, "root", "left")
        else:
            lv = lv.withColumn("_done", F.lit(0).cast("long"))
        lv = lv.where(remaining > 0)
        # Key of the remaining-th success per root: nodes after it are never popped.
        w = Window.partitionBy("root").orderBy("fifo_key")
        succ = lv.where("ok").withColumn("_rn", F.row_number().over(w))
        succ = succ.where((F.col("_rn") <= F.lit(max_pages)) & (F.col("_rn") <= remaining))
        cut = succ.where(F.col("_rn") == remaining).select("root", F.col("fifo_key").alias("_cut"))
        lv = lv.join(cut, "root", "left").where(F.col("_cut").isNull() | (F.col("fifo_key") <= F.col("_cut")))
        return lv.drop("_cut", "_done")

    def keep(depth: int, rows: DataFrame) -> DataFrame:
        return store.commit(depth, rows, settings) if store else materialize(rows, "crawl-level")

    def successes(rows: DataFrame) -> DataFrame:
        return rows.groupBy("root").agg(F.count_if(F.col("ok")).alias("_done"))

    levels = (store.levels(settings) if store else []) or [keep(0, fetch_and_cut(level, None))]
    visited, level, depth = union_levels(levels), levels[-1], len(levels) - 1
    # Successes per root, carried from level to level.
    done = materialize(successes(visited), "crawl-done") if max_pages is not None else None
    has_ok = level.where("ok").limit(1).count() > 0
    while has_ok and (max_levels is None or depth < max_levels):
        if done is not None:
            open_roots = done.where(F.col("_done") < max_pages).select("root")
            parents = level.where("ok").join(open_roots, "root", "left_semi")
        else:
            parents = level.where("ok")
        cand = parents.select("root", "page_id", "fifo_key").join(lk, "page_id").select(
            "root", F.col("target").alias("url"), F.concat("fifo_key", F.array("pos")).alias("fifo_key")
        )
        cand = cand.where(
            F.col("url").isNotNull() & (F.col("url") != "")
            & in_scope(F.col("url"), F.col("root"), allow_subdomains) & ~skip_extension("url")
        )
        # First occurrence per (root, url), then drop what earlier levels
        # visited. When the level's candidates pass the size check their keys
        # are broadcast and the visited set is only scanned (no shuffle of
        # the growing visited set); otherwise a shuffle anti-join.
        # The candidates are written once; their size is read from that.
        cand = materialize(cand.groupBy("root", "url").agg(F.min("fifo_key").alias("fifo_key")), "crawl-candidates")
        before = (store.hit(visited, cand) if store else visited).select("root", "url")
        if fits_broadcast(cand):
            seen = before.join(F.broadcast(cand.select("root", "url")), ["root", "url"], "left_semi")
            cand = cand.join(F.broadcast(seen), ["root", "url"], "left_anti")
        else:
            cand = cand.join(before, ["root", "url"], "left_anti")
        cand = cand.where(_pop_filter(F.col("url"), include, exclude))
        depth += 1
        nxt = keep(depth, fetch_and_cut(cand.withColumn("depth", F.lit(depth)), done))
        size = nxt.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("ok")).alias("k")).first()
        if size["n"] == 0:
            break
        # Every level is its own written table: the union stays one scan deep.
        visited = visited.unionByName(nxt)
        level = nxt
        has_ok = size["k"] > 0
        if done is not None and has_ok:
            done = done.unionByName(successes(nxt)).groupBy("root").agg(F.sum("_done").alias("_done"))
            done = materialize(done, "crawl-done")
    if not with_rank:
        return visited.select("root", "url", "depth", "fifo_key", "page_id", "ok")
    ranked = dense_position(visited, ["root"], ["depth", "fifo_key"], "crawl_rank")
    return ranked.select("root", "url", "depth", "fifo_key", "page_id", "ok", "crawl_rank")


def crawl_report(visits: DataFrame, chunks: DataFrame | None = None, page_col: str = "page_id") -> DataFrame:
    """Per root, pages discovered / crawled / failed and, given the chunks
    of the crawled pages, total chunks and tokens. A page whose chunking gave
    nothing still counts as crawled (as in the reference)."""
    rep = visits.groupBy("root").agg(
        F.count(F.lit(1)).alias("pages_discovered"),
        F.count_if(F.col("ok")).alias("pages_crawled"),
        F.count_if(~F.col("ok")).alias("pages_failed"),
    )
    if chunks is None:
        return rep
    per_page = chunks.groupBy(page_col).agg(
        F.count(F.lit(1)).alias("_c"), F.sum("token_estimate").alias("_t")
    )
    v = visits.where("ok").select("root", page_col).join(per_page, page_col, "left")
    tot = v.groupBy("root").agg(
        F.coalesce(F.sum("_c"), F.lit(0)).cast("long").alias("total_chunks"),
        F.coalesce(F.sum("_t"), F.lit(0)).cast("long").alias("total_tokens"),
    )
    return rep.join(tot, "root", "left").select(
        "root", "pages_discovered", "pages_crawled", "pages_failed",
        F.coalesce("total_chunks", F.lit(0)).cast("long").alias("total_chunks"),
        F.coalesce("total_tokens", F.lit(0)).cast("long").alias("total_tokens"),
    )


def site_tree_links(pages: DataFrame) -> DataFrame:
    """A link graph derived from the pages table (its own links point outside
    the table): within each host, pages in id order form a binary tree, page
    i linking to pages 2i+1 and 2i+2 and back to its parent. Positions follow
    the page's own links (100 + k)."""
    from corpusflow.functions.urls import url_host

    p = pages.select("page_id", "url", url_host("url").alias("host"))
    p = dense_position(p, ["host"], ["page_id"], "_i").withColumn("_i", F.col("_i") - 1)
    kids = p.select(
        "host", "page_id",
        F.explode(F.array(
            F.struct(F.lit(100).alias("pos"), (F.col("_i") * 2 + 1).alias("_j")),
            F.struct(F.lit(101).alias("pos"), (F.col("_i") * 2 + 2).alias("_j")),
            F.struct(F.lit(102).alias("pos"), F.floor((F.col("_i") - 1) / 2).alias("_j")),
        )).alias("e"),
    ).select("host", "page_id", "e.pos", "e._j").where(F.col("_j") >= 0)
    tgt = p.select("host", F.col("_i").alias("_j"), normalize_url("url").alias("target"))
    return kids.join(tgt, ["host", "_j"]).select("page_id", F.col("pos").cast("long").alias("pos"), "target")
