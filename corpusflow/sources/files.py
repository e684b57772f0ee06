"""Folder scan, source types and chunk export.

The scan is a data source of its own (``corpus_files``): one listing, files
dealt by size to partitions that executors read.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.plans.strategy import MAX_BROADCAST_ROWS
from corpusflow.sources import corpus_files

# Default suffixes of a folder ingest.
DEFAULT_EXTENSIONS = [
    ".md", ".txt", ".text", ".json", ".yaml", ".yml", ".csv", ".xlsx", ".xls", ".docx", ".ipynb",
    ".html", ".htm", ".xml", ".toml", ".ini", ".cfg",
    ".py", ".js", ".ts", ".jsx", ".tsx", ".sql", ".go", ".rb", ".java", ".cs", ".cpp", ".c", ".rs",
    ".php", ".sh", ".bash", ".zsh", ".r", ".swift", ".kt", ".scala",
]
# Suffixes read as code (tested first), then the type table.
CODE_EXTENSIONS = [
    ".py", ".js", ".ts", ".jsx", ".tsx", ".sql", ".go", ".rb", ".java", ".cs", ".cpp", ".c", ".rs",
    ".php", ".sh", ".bash", ".zsh", ".r", ".swift", ".kt", ".scala", ".toml", ".ini", ".cfg", ".text",
]
SOURCE_TYPES = [
    (".pdf", "pdf"), (".md", "markdown"), (".txt", "text"), (".text", "text"), (".yaml", "yaml"),
    (".yml", "yaml"), (".json", "json"), (".csv", "csv"), (".xlsx", "excel"), (".xls", "excel"),
    (".docx", "docx"), (".ipynb", "notebook"), (".html", "html"), (".htm", "html"), (".xml", "xml"),
]


def file_suffix(name: str | Column) -> Column:
    """Lower-cased last suffix, as pathlib's ``suffix``: none for '.bashrc'."""
    c = F.col(name) if isinstance(name, str) else name
    return F.lower(F.regexp_extract(c, r"^.+(\.[^./]+)$", 1))


def classify_source_type(path: str | Column) -> Column:
    """A2: suffix -> pdf / markdown / text / yaml / json / csv / excel / docx /
    notebook / html / xml / code; unknown -> text. Code is tested first, so
    '.text' is code."""
    c = F.col(path) if isinstance(path, str) else path
    sfx = file_suffix(F.element_at(F.split(c, "/"), -1))
    m = F.create_map(*[x for k, v in SOURCE_TYPES for x in (F.lit(k), F.lit(v))])
    return F.when(sfx.isin(CODE_EXTENSIONS), F.lit("code")).otherwise(F.coalesce(m[sfx], F.lit("text")))


def scan_corpus(
    spark: SparkSession,
    path: str,
    extensions: Sequence[str] | None = None,
    recursive: bool = True,
    max_files: int | None = None,
) -> DataFrame:
    """A1: files whose lower-cased suffix is in ``extensions`` (a caller's own
    list is used as given, so '.JSON' never matches), in the order of their
    paths, the first ``max_files``. Bytes that are not UTF-8 become U+FFFD.
    Output: path, name, suffix, source_type, length, text, error (null, or why
    the file could not be read; its text is null then).

    Names that begin with a dot or an underscore and empty files are listed
    too. Suffixes and ``max_files`` are decided on the listing alone; only the
    files that stay are read. A store that only Spark reaches is listed by
    Spark, which leaves out such names.
    """
    exts = list(DEFAULT_EXTENSIONS if extensions is None else extensions)
    if corpus_files.readable(path):
        corpus_files.register(spark)
        reader = spark.read.format(corpus_files.FORMAT).option("suffixes", json.dumps(exts)).option("recursive", str(recursive).lower())
        raw = (reader if max_files is None else reader.option("first", str(max_files))).load(path)
    else:
        raw = _spark_scan(spark, path, exts, recursive, max_files).withColumn("error", F.lit(None).cast("string"))
    name = F.element_at(F.split("path", "/"), -1)
    return raw.select(
        "path", name.alias("name"), file_suffix(name).alias("suffix"), classify_source_type("path").alias("source_type"), "length",
        F.make_valid_utf8(F.col("content").cast("string")).alias("text"), "error",
    )


def _spark_scan(spark: SparkSession, path: str, exts: list[str], recursive: bool, max_files: int | None) -> DataFrame:
    """path, length, content by Spark's own listing; the suffixes are a glob of
    the listing, so other files are never opened."""
    glob = "*{" + ",".join("".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in e) for e in exts) + "}"
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    df = raw.select("path", "length", "content").where(file_suffix(F.element_at(F.split("path", "/"), -1)).isin(exts))
    if not recursive:
        root = path.rstrip("/")
        df = df.where(F.regexp_replace("path", r"^[a-z0-9]+:", "").rlike("^(?:/+)?" + re.escape(re.sub("^[a-z0-9]+:", "", root).lstrip("/")) + "/[^/]+$"))
    if max_files is not None:
        first = df.select("path").orderBy("path").limit(max_files)  # the content is pruned here
        df = df.join(F.broadcast(first) if max_files <= MAX_BROADCAST_ROWS else first, "path", "left_semi").orderBy("path")
    return df


def write_files(rows: DataFrame, path: str, name_col: str = "path", content_col: str = "content") -> None:
    """One file per row below ``path``, named by ``name_col`` (a relative path,
    folders are made); text is written as UTF-8."""
    corpus_files.register(rows.sparkSession)
    out = rows.select(F.col(name_col).alias("path"), F.col(content_col).alias("content"))
    out.write.format(corpus_files.FORMAT).mode("append").save(path)


def write_chunks(chunks: DataFrame, path: str, fmt: str = "json", url_col: str = "url") -> None:
    """Save url, content, token_estimate; an existing output is never
    overwritten (``errorifexists``)."""
    chunks.select(F.col(url_col).alias("url"), "content", "token_estimate").write.mode("errorifexists").format(fmt).save(path)
