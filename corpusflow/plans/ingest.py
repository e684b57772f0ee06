"""Whole jobs composed of the operators: folder ingest and crawl to chunks.

A folder is scanned once; its texts are written once, in a folder per route, so
that every source type reads its own files alone. All steps from a file to its
chunk rows are row-local.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.functions.html import html_text
from corpusflow.operators.accounting import ingest_report
from corpusflow.operators.chunking import DEFAULT_OVERLAP, DEFAULT_SIZE, chunk_text
from corpusflow.operators.code_units import python_units, sql_units, unit_urls
from corpusflow.operators.crawl import crawl_frontier, crawl_report
from corpusflow.operators.html import to_markdown
from corpusflow.operators.index import embed_column
from corpusflow.operators.links import discover_sitemap_urls, filter_urls
from corpusflow.plans.strategy import materialize
from corpusflow.session import shared_path
from corpusflow.sources.files import classify_source_type, file_suffix, scan_corpus
from corpusflow.sources.formats import csv_text, json_records, notebook_text, xml_text

#: Types whose text needs a codec that is not part of this library.
BINARY_TYPES = ("pdf", "excel", "docx")
UNSUPPORTED = "unsupported file type"
#: Texts of a file that a route reads. Scans are cut by compressed bytes, and
#: short texts that are alike take few: a task would read millions of them.
ROUTE_FILE_ROWS = 10_000


def file_units(files: DataFrame, file_col: str = "file", text_col: str = "text") -> DataFrame:
    """``file, source_type, unit, url, text``: the pieces of each file that are
    chunked on their own. JSON files give their records, Python and SQL sources
    their units, CSV, HTML, XML and notebooks their text, all others the file.
    ``unit`` orders the pieces of a file. Types that need a codec give none.
    The texts are written once, partitioned by route, ``ROUTE_FILE_ROWS`` to a
    file; a route reads its own."""
    name = F.element_at(F.split(F.col(file_col), "/"), -1)
    f = files.select(
        F.col(file_col).alias("file"), F.col(text_col).alias("text"), classify_source_type(file_col).alias("source_type"),
        file_suffix(name).alias("_sfx"), F.concat(F.lit("file://"), name).alias("url"),
    ).withColumn("_route", F.when(F.col("_sfx").isin(".py", ".sql"), F.col("_sfx")).otherwise(F.col("source_type")))
    special = ("json", "csv", "html", "xml", "notebook", ".py", ".sql")
    f = f.where(~F.col("_route").isin(*BINARY_TYPES))
    f = f.withColumn("_route", F.when(F.col("_route").isin(*special), F.regexp_replace("_route", r"^\.", "")).otherwise(F.lit("whole")))
    path = shared_path(files.sparkSession, f"tables/routes-{uuid.uuid4().hex[:16]}")
    f.drop("_sfx").write.option("maxRecordsPerFile", ROUTE_FILE_ROWS).partitionBy("_route").parquet(path)
    written = files.sparkSession.read.schema(f.drop("_sfx").schema).parquet(path)
    first = F.lit(0).cast("long").alias("unit")

    def route(kind: str) -> DataFrame:
        return written.where(F.col("_route") == kind)

    def whole(df: DataFrame, text: Column) -> DataFrame:
        return df.select("file", "source_type", first, "url", text.alias("text"))

    parts = [
        whole(route("whole"), F.col("text")),
        whole(route("csv"), csv_text(F.col("text"))),
        whole(route("html"), html_text("text")),
        json_records(route("json")).select("file", F.lit("json").alias("source_type"), F.col("item_index").cast("long").alias("unit"), "url", "text"),
    ]
    for kind, convert in (("xml", xml_text), ("notebook", notebook_text)):
        url = F.concat(F.lit("file://"), F.element_at(F.split("file", "/"), -1))
        parts.append(whole(convert(route(kind)).withColumn("source_type", F.lit(kind)).withColumn("url", url), F.col("text")))
    py = unit_urls(python_units(route("py")))
    parts.append(py.select("file", F.lit("code").alias("source_type"), F.col("line_start").alias("unit"), "url", "text"))
    sql = unit_urls(sql_units(route("sql")), "file", "sql")
    parts.append(sql.select("file", F.lit("code").alias("source_type"), F.col("statement_index").cast("long").alias("unit"), "url", "text"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def ingest_files(files: DataFrame, size: int = DEFAULT_SIZE, overlap: int = DEFAULT_OVERLAP, dim: int = 64) -> DataFrame:
    """Chunk rows with vectors of a table of files ``(file, text)``."""
    chunks = chunk_text(file_units(files), ["file", "source_type", "unit", "url"], "text", size, overlap)
    return chunks.withColumn("embedding", embed_column("content", dim))


def ingest_folder(spark: SparkSession, path: str, job: str = "folder", **options) -> tuple[DataFrame, DataFrame]:
    """Scan ``path`` and return (chunk rows, report). Files that cannot be read
    and files whose type needs a codec are reported as failed, the others go
    on. ``options`` go to ``ingest_files``."""
    files = materialize(scan_corpus(spark, path).select(F.col("path").alias("file"), "text", "source_type", "error"), "scan")
    rows = materialize(ingest_files(files.where("error is null").select("file", "text"), **options), "ingest")
    return rows, ingest_report(folder_errors(files, job), rows.select("file"))


def folder_errors(files: DataFrame, job: str = "folder") -> DataFrame:
    """``job, file, error`` of scanned files: why a file gave no text, or null."""
    error = F.coalesce("error", F.when(F.col("source_type").isin(*BINARY_TYPES), F.lit(UNSUPPORTED)))
    return files.select(F.lit(job).alias("job"), "file", error.alias("error"))


def sitemap_to_chunks(roots: DataFrame, fetched: DataFrame, pages: DataFrame, selector: str | None = None, **options) -> tuple[DataFrame, DataFrame]:
    """Discover the URLs of ``roots`` from the sitemaps among ``fetched(url,
    body)``, filter them (``options`` of ``filter_urls``), take those that are
    in ``pages(page_id, url, html)``, convert and chunk them: (chunks with
    their root, report per root). A URL without a page failed."""
    urls = filter_urls(discover_sitemap_urls(roots, fetched), **options)
    urls = materialize(urls.join(pages.select("page_id", "url"), "url", "left"), "urls")
    text = to_markdown(pages.select("page_id", "url", "html").join(urls.select("page_id").distinct(), "page_id", "left_semi"), selector=selector)
    chunks = chunk_text(text.select("page_id", "url", "markdown"), ["page_id", "url"], "markdown")
    chunks = materialize(urls.where("page_id is not null").select("root", "page_id", "pos").join(chunks, "page_id"), "chunks")
    per_root = chunks.groupBy("root").agg(F.count(F.lit(1)).alias("total_chunks"))
    report = urls.groupBy("root").agg(
        F.count_distinct("url").alias("pages_discovered"), F.count_distinct(F.when(F.col("page_id").isNotNull(), F.col("url"))).alias("pages_crawled")
    )
    report = roots.select("root").distinct().join(report, "root", "left").join(per_root, "root", "left").na.fill(0, ["pages_discovered", "pages_crawled", "total_chunks"])
    return chunks, report.withColumn("pages_failed", F.col("pages_discovered") - F.col("pages_crawled"))


def crawl_to_chunks(seeds: DataFrame, pages: DataFrame, links: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """Crawl from ``seeds`` over ``pages(page_id, url, html)`` and ``links``,
    convert what was fetched to Markdown and chunk it: (chunks, report per
    root). ``options`` go to ``crawl_frontier``."""
    visits = materialize(crawl_frontier(seeds, pages.select("page_id", "url"), links, **options), "visits")
    fetched = visits.where("ok").select("page_id").distinct()
    text = to_markdown(pages.select("page_id", "url", "html").join(fetched, "page_id", "left_semi"))
    chunks = chunk_text(text.select("page_id", "url", "markdown"), ["page_id", "url"], "markdown")
    return chunks, crawl_report(visits, chunks.select("page_id", "token_estimate"))
