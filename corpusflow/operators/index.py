"""Embedding and index.

Model calls are external, so E1 gives deterministic signed feature-hashing
vectors (md5 of each search term picks a bucket and a sign, L2-normalised), or
joins a supplied vector table. The index is a parquet table; upsert keeps the
newest version of each id and writes a new version folder, never in place.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType
from pyspark.sql.window import Window

from corpusflow.functions.text import row_blocks, term_text
from corpusflow.sources.catalog import embedding_models


def _ids(cols: str | Sequence[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


#: Terms whose bucket a Python worker remembers.
MAX_KNOWN_TERMS = 300_000
#: Terms and vector components of the rows that a task embeds at once.
BLOCK_CELLS = 1 << 19


#: Lower-cased bytes of terms; 0 ends a term.
_TERM_BYTES = np.array([0 if b < 128 and not chr(b).isalnum() else b | 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def _terms(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The terms of texts as written by ``term_text``, and the row of each."""
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1]
    low = _TERM_BYTES[np.frombuffer(data or b"", np.uint8)[ends[0] : ends[-1]]]
    ends = ends - ends[0]
    word = low != 0
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    rows = ends[:-1][ends[:-1] < ends[1:]]  # a row begins a term of its own
    begins[rows] = word[rows]
    at = np.flatnonzero(begins)
    places = np.append(np.cumsum(word, dtype=np.int32)[at] - 1, np.count_nonzero(word)).astype(np.int32)
    terms = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(places), pa.py_buffer(low[word])])
    return terms, np.searchsorted(ends, at, "right") - 1


def _embed_column(texts: Column, dim: int) -> Column:
    """Dense signed feature-hashing vector of a ``term_text``, L2-normalised;
    null if there is no term or the signs cancel out. A worker cuts the terms out
    of a block's bytes at once. Nothing is exploded, and a batch is answered in
    blocks of ``BLOCK_CELLS``, so what a worker holds does not depend on the rows
    of a batch."""

    @F.arrow_udf(ArrayType(DoubleType()))
    def embed(it: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known: dict[bytes, int] = {}  # bucket + 1, below zero for the other sign

        def code(t: bytes) -> int:
            hit = known.get(t)
            if hit is None:
                if len(known) >= MAX_KNOWN_TERMS:
                    known.clear()
                h = hashlib.md5(t).digest()
                at = int.from_bytes(h[:4]) % dim + 1
                hit = known[t] = at if h[4] < 128 else -at
            return hit

        for batch in it:
            most = (np.asarray(pc.fill_null(pc.binary_length(batch), 0)).astype(np.int64) + 1) // 2
            for s, e in row_blocks(most + dim, BLOCK_CELLS):
                terms, row = _terms(batch.slice(s, e - s))
                coded = terms.dictionary_encode()
                found = [known.get(t) or code(t) for t in coded.dictionary.to_numpy(zero_copy_only=False).tolist()]
                codes = np.array(found, np.int64)[np.asarray(coded.indices)]
                v = np.bincount(row * dim + np.abs(codes) - 1, np.sign(codes), (e - s) * dim).reshape(e - s, dim)
                n = np.sqrt((v * v).sum(axis=1))
                held = n > 0
                v = v[held] / n[held][:, None]
                ends = np.concatenate([[0], np.cumsum(np.where(held, dim, 0))]).astype(np.int32)
                yield pa.ListArray.from_arrays(pa.array(ends), pa.array(v.ravel()), mask=pa.array(~held))

    # A filter on the vector then reads it: a deterministic UDF would run once
    # more below the filter.
    return embed.asNondeterministic()(texts)


def embed_column(text_col: str | Column, dim: int = 64) -> Column:
    """E1 as a column of the text: a projection, no shuffle."""
    text = F.col(text_col) if isinstance(text_col, str) else text_col
    return _embed_column(term_text(F.coalesce(text, F.lit(""))), dim)


def embed_hashed(df: DataFrame, id_cols="doc_id", text_col: str = "text", dim: int = 64, keep: Sequence[str] = ()) -> DataFrame:
    """One dense ARRAY<DOUBLE> of ``dim`` per row with at least one term,
    next to its ids and the ``keep`` columns."""
    return df.select(*_ids(id_cols), *keep, embed_column(text_col, dim).alias("embedding")).where("embedding is not null")


def attach_embeddings(chunks: DataFrame, vectors: DataFrame, keys: Sequence[str] = ("doc_id", "chunk_index")) -> DataFrame:
    """E1 (supplied vectors): equi-join on the chunk key."""
    return chunks.join(vectors, list(keys), "inner")


def index_rows(
    chunks: DataFrame, vectors: DataFrame | None = None, keys: Sequence[str] = ("doc_id", "chunk_index"), url_col: str = "url"
) -> DataFrame:
    """Stored rows. id = sha256(source|chunk_index|content); the child text is
    embedded, the parent text rides in metadata. Without ``vectors`` the chunks
    carry their own ``embedding`` and nothing is joined."""
    keys = list(keys)
    j = chunks.where("embedding is not null") if vectors is None else chunks.join(vectors, keys, "inner")
    cols = j.columns
    src = F.col(url_col).cast("string") if url_col in cols else F.col(keys[0]).cast("string")

    def opt(name):
        return F.col(name).cast("string") if name in cols else F.lit(None).cast("string")

    meta = F.map_from_arrays(
        F.array(*[F.lit(x) for x in ("url", "chunk_index", "parent_text", "parent_index", "is_hierarchical")]),
        F.array(src, F.col("chunk_index").cast("string"), opt("parent_text"), opt("parent_index"),
                F.coalesce(opt("is_hierarchical"), F.lit("false"))),
    )
    return j.select(
        F.sha2(F.concat_ws("|", src, F.col("chunk_index").cast("string"), F.col("content")), 256).alias("id"),
        *keys,
        F.col("embedding"),
        F.col("content").alias("text"),
        meta.alias("metadata"),
    )


def inspect_index(index: DataFrame, vec_col: str = "embedding", namespace: str | None = None) -> DataFrame:
    """Dimension (0 if unknown or mixed), dimension_known and counts.
    With ``namespace`` one row per namespace plus the overall row (namespace null)."""
    size = F.size(vec_col)
    aggs = [
        F.min(size).alias("_lo"),
        F.max(size).alias("_hi"),
        F.count(F.lit(1)).alias("total_vectors"),
    ]
    if namespace:
        g = index.rollup(namespace).agg(*aggs)
    else:
        g = index.agg(*aggs)
    known = (F.col("_lo") == F.col("_hi")) & (F.col("_lo") > 0)
    out = g.select(
        *([namespace] if namespace else []),
        F.when(known, F.col("_lo")).otherwise(F.lit(0)).cast("int").alias("dimension"),
        F.coalesce(known, F.lit(False)).alias("dimension_known"),
        F.col("total_vectors").cast("long").alias("total_vectors"),
    )
    return out


def suggest_models(inspected: DataFrame) -> DataFrame:
    """Known embedding models whose dimension equals the index's.
    The catalog is a fixed table of a few rows, so it is broadcast."""
    cat = F.broadcast(embedding_models())
    return inspected.where("dimension_known").join(cat, "dimension", "inner")


def upsert_index(existing: DataFrame, incoming: DataFrame, key: str = "id", version: str = "version") -> DataFrame:
    """A13 over two frames: the newest version of each id wins, among equal
    versions the incoming row. Both sides shuffle on the id once; ids are unique
    per version, so no key is hot. ``IndexStore`` keeps an index over many
    commits without rewriting it."""
    both = existing.withColumn("_new", F.lit(0)).unionByName(incoming.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    w = Window.partitionBy(key).orderBy(F.col(version).desc(), F.col("_new").desc())
    return both.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r", "_new")


def upserted_count(incoming: DataFrame) -> DataFrame:
    return incoming.agg(F.count(F.lit(1)).alias("vectors_upserted"))


def write_index_version(index: DataFrame, base: str, version: int) -> str:
    """Write a new immutable version folder; readers pick the highest one."""
    path = os.path.join(base, f"v={version:08d}")
    index.write.mode("errorifexists").parquet(path)
    return path
