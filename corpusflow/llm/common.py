"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.plans.strategy import materialize

#: Upper bound on the characters that one numpy block of texts holds at once
#: (a single longer text is a block of its own).
BLOCK_CHARS = 4_000_000

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


def text_blocks(texts: pd.Series, max_chars: int = BLOCK_CHARS) -> Iterator[list[str]]:
    """Cut an Arrow batch of texts into runs of at most ``max_chars``
    characters. A null text is the empty text."""
    block: list[str] = []
    size = 0
    for t in texts:
        t = t if isinstance(t, str) else ""
        if block and size + len(t) > max_chars:
            yield block
            block, size = [], 0
        block.append(t)
        size += len(t)
    if block:
        yield block


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only. ``lower`` is used where the text is pure ASCII (it
    then does the same); other letters must stay as they are."""
    pure = F.octet_length(text) == F.char_length(text)
    return F.when(pure, F.lower(text)).otherwise(F.translate(text, ASCII_UPPER, ASCII_LOWER))


def bucket_of(id_col: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``: the fixed folds."""
    return F.crc32(id_col.cast("string").cast("binary")) % F.lit(modulus)


def held_out(id_col: Column, modulus: int, fold: int) -> Column:
    """Is the row in the held-out fold? A null id is not."""
    return F.coalesce(bucket_of(id_col, modulus) == F.lit(fold), F.lit(False))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, train: Column, per_class: dict[int, int],
    id_col: str = "doc_id", text_col: str = "text", max_chars: int | None = None,
) -> tuple[DataFrame, dict[int, float]]:
    """At most ``per_class[c]`` labelled documents of each class, the ones with
    the smallest hash of their id, and the weight (all labelled rows of the
    class / sampled rows) of each class.

    ``train`` is a condition over ``id_col``. With ``max_chars`` only documents
    of at most so many characters are sampled and counted, before the limit, so
    that long ones do not thin the sample. Only ids are shuffled to draw it: its
    ids (at most the sum of ``per_class``) are broadcast and the documents are
    scanned for them. Conflicting labels of one id count as the larger one.
    """
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    lab = (
        labels.select(F.col(id_col).alias("_id"), F.col(label).cast("int").alias("_y"))
        .where(F.col("_id").isNotNull() & F.col("_y").isin(*per_class))
        .groupBy("_id").agg(F.max("_y").alias("_y"))
        .withColumnRenamed("_id", id_col).where(train).withColumnRenamed(id_col, "_id")
    )
    if max_chars is not None:
        texts = texts.where(F.char_length(F.coalesce("_text", F.lit(""))) <= max_chars)
        lab = materialize(lab.join(texts.select("_id").distinct(), "_id", "left_semi"), "labelled")
    total = {r["_y"]: r["n"] for r in lab.groupBy("_y").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = [
        lab.where(F.col("_y") == c).orderBy(F.xxhash64("_id"), "_id").limit(n) for c, n in sorted(per_class.items())
    ]
    picked = parts[0]
    for p in parts[1:]:
        picked = picked.unionByName(p)
    sample = texts.join(F.broadcast(picked), "_id")
    weight = {c: total.get(c, 0) / max(1, min(n, total.get(c, 0))) for c, n in per_class.items()}
    return sample, weight


def fit_platt(x, y, w, steps: int = 50) -> tuple[float, float]:
    """Weighted logistic regression of y (0/1) on one number x, by Newton
    steps with a small ridge; returns (intercept, slope)."""
    import numpy as np

    if len(x) == 0:
        return 0.0, 0.0
    X = np.stack([np.ones(len(x)), np.asarray(x, float)], axis=1)
    b = np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(X @ b, -30, 30)))
        g = X.T @ (w * (y - p)) - 1e-3 * b
        h = (X * (w * p * (1 - p))[:, None]).T @ X + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, g)
        b = b + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(b[0]), float(b[1])
