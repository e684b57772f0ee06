"""Chunking (C1-C6, C12, A10).

A text of n tokens gives windows starting at 0, step, 2*step, ... up to
max(n - overlap - 1, 0), step = size - overlap; a window holds tokens
[s, s + size). So no window is made only of overlap, and only the last window
of a text can be short.

Everything is one narrow projection plus ``posexplode``: no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.functions.text import is_blank, squash_ws, token_estimate, tokens

# Chunk size bounds and defaults.
MIN_CHUNK, MAX_CHUNK = 64, 4096
DEFAULT_SIZE, DEFAULT_OVERLAP, DEFAULT_CHILD = 512, 50, 128
MAX_WORDS = 75_000
MAX_CHUNKS_PER_REQUEST = 10_000


def _check(size: int, overlap: int) -> None:
    if not (MIN_CHUNK <= size <= MAX_CHUNK):
        raise ValueError(f"chunk size must be in [{MIN_CHUNK}, {MAX_CHUNK}], got {size}")
    if not (0 <= overlap < size):
        raise ValueError(f"overlap must be in [0, size), got {overlap}")


def _windows(text, size: int, overlap: int):
    """The windows of a text, as an array that is empty for a blank one. One
    expression, so a text that is itself computed (Markdown of a page, say) is
    computed once: a filter or a second use would repeat it."""

    def window(toks, s):
        return F.struct(
            F.array_join(F.slice(toks, s + 1, F.lit(size)), " ").alias("content"),
            F.least(F.size(toks) - s, F.lit(size)).cast("int").alias("n_tokens"),
        )

    def cut(toks):
        last = F.greatest(F.size(toks) - F.lit(overlap + 1), F.lit(0))
        return F.transform(F.sequence(F.lit(0), last, F.lit(size - overlap)), lambda s: window(toks, s))

    whole = F.filter(F.array(squash_ws(text)), lambda w: w != F.lit(""))
    return F.flatten(F.transform(F.transform(whole, lambda w: F.split(w, " ")), cut))


def chunk_text(
    df: DataFrame,
    id_cols: str | Sequence[str] = "doc_id",
    text_col: str = "text",
    size: int = DEFAULT_SIZE,
    overlap: int = DEFAULT_OVERLAP,
) -> DataFrame:
    """Token windows with overlap. Output: ids, chunk_index, content,
    n_tokens, token_estimate. Blank texts give no chunk."""
    _check(size, overlap)
    ids = [id_cols] if isinstance(id_cols, str) else list(id_cols)
    out = df.select(*ids, F.posexplode(_windows(text_col, size, overlap)).alias("chunk_index", "_w"))
    out = out.select(*ids, F.col("chunk_index").cast("int").alias("chunk_index"), "_w.content", "_w.n_tokens")
    return out.withColumn("token_estimate", token_estimate("content"))


def chunk_hierarchical(
    df: DataFrame,
    id_cols: str | Sequence[str] = "doc_id",
    text_col: str = "text",
    size: int = DEFAULT_SIZE,
    child_size: int = DEFAULT_CHILD,
    overlap: int = DEFAULT_OVERLAP,
) -> DataFrame:
    """Parents as in C2, each re-windowed at ``child_size`` with no overlap.

    Every parent but the last of a text is full, so a child's running index
    is parent_index * ceil(size / child_size) + position: no window needed.
    """
    if not (0 < child_size <= size):
        raise ValueError("child_size must be in (0, size]")
    ids = [id_cols] if isinstance(id_cols, str) else list(id_cols)
    parents = chunk_text(df, ids, text_col, size, overlap)
    per_parent = -(-size // child_size)
    p = parents.select(
        *ids,
        F.col("chunk_index").alias("parent_index"),
        F.col("content").alias("parent_text"),
        F.split("parent_text", " ").alias("_toks"),
    )
    kids = p.select(
        *ids,
        "parent_index",
        "parent_text",
        "_toks",
        F.posexplode(F.sequence(F.lit(0), F.size("_toks") - 1, F.lit(child_size))).alias("_pos", "_s"),
    )
    return kids.select(
        *ids,
        (F.col("parent_index") * per_parent + F.col("_pos")).cast("int").alias("chunk_index"),
        F.array_join(F.slice("_toks", F.col("_s") + 1, F.lit(child_size)), " ").alias("content"),
        "parent_text",
        "parent_index",
        F.lit(True).alias("is_hierarchical"),
    ).withColumn("token_estimate", token_estimate("content"))


def contextualize(
    chunks: DataFrame,
    contexts: DataFrame,
    keys: Sequence[str] = ("doc_id", "chunk_index"),
) -> DataFrame:
    """C4: ``Context: {context}\\n\\n{text}`` where a non-blank context exists.

    ``contexts`` holds one row per chunk key with a ``context`` column. It is
    joined on the chunk key, so both sides shuffle on it (or AQE broadcasts a
    small context table).
    """
    keys = list(keys)
    ctx = contexts.select(*keys, F.col("context").alias("_ctx")).where(~is_blank("_ctx"))
    j = chunks.join(ctx, keys, "left")
    has = F.col("_ctx").isNotNull()
    return j.select(
        *[c for c in chunks.columns if c != "content"],
        F.when(has, F.concat(F.lit("Context: "), F.col("_ctx"), F.lit("\n\n"), F.col("content")))
        .otherwise(F.col("content"))
        .alias("content"),
        F.when(has, F.col("_ctx")).alias("context"),
        F.when(has, F.col("content")).alias("original_text"),
    )


def contextual_stats(enriched: DataFrame) -> DataFrame:
    return enriched.agg(
        F.count(F.lit(1)).alias("total_chunks"),
        F.count("context").alias("enriched_chunks"),
    )


def truncate_words(df: DataFrame, text_col: str = "text", max_words: int = MAX_WORDS) -> DataFrame:
    """Cut texts over ``max_words`` whitespace tokens; flag the cut."""
    n = F.when(is_blank(text_col), F.lit(0)).otherwise(F.size(tokens(text_col)))
    over = n > F.lit(max_words)
    return df.withColumn("content_truncated", over).withColumn(
        text_col,
        F.when(over, F.array_join(F.slice(tokens(text_col), 1, max_words), " ")).otherwise(F.col(text_col)),
    )


def cap_chunks(chunks: DataFrame, n: int = MAX_CHUNKS_PER_REQUEST) -> DataFrame:
    """The server takes at most ``n`` chunks per request, so a source's
    chunks are split into requests of ``n``. chunk_index is dense per source,
    so the request number is arithmetic: no window, no shuffle, no row lost."""
    return chunks.withColumn("request_index", F.floor(F.col("chunk_index") / F.lit(n)).cast("int"))


def chunk_stats(chunks: DataFrame, group: str | Sequence[str] = "doc_id") -> DataFrame:
    """Chunks and tokens per source (partial aggregation before shuffle)."""
    g = [group] if isinstance(group, str) else list(group)
    return chunks.groupBy(*g).agg(
        F.count(F.lit(1)).alias("total_chunks"),
        F.sum("token_estimate").alias("total_tokens"),
    )


def flatten_pages(results: DataFrame, id_col: str = "page_id", list_col: str = "chunks") -> DataFrame:
    """A nested per-page list of chunks flattened in order."""
    return results.select(id_col, F.posexplode(list_col).alias("chunk_index", "chunk")).select(
        id_col, "chunk_index", "chunk.*"
    )


def reassemble(chunks: DataFrame, group: str = "doc_id", order: str = "chunk_index", text: str = "content") -> DataFrame:
    """A10: chunk texts per source joined by a blank line, then trimmed.

    One group is one source text, which already existed as one row, so the
    group is bounded by the largest source.
    """
    parts = chunks.groupBy(group).agg(F.sort_array(F.collect_list(F.struct(order, text))).alias("_p"))
    return parts.select(group, F.trim(F.array_join(F.col(f"_p.{text}"), "\n\n")).alias("text"))

