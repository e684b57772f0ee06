"""Quality classifier: naive Bayes support vectors (Wang and Manning, 2012).

Indicators of byte n-grams and of word repetition are scaled by the log ratio
of their class counts; a linear hinge-loss model over the scaled, normalised
indicators is fitted by dual coordinate descent and its margin calibrated.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import fit_platt, labelled_sample, text_blocks
from corpusflow.llm.toxicity import model_broadcast

#: Hashed buckets of the indicators.
BUCKETS = 1 << 18
#: Training sample: documents per class and the longest document taken.
PER_CLASS = {0: 2000, 1: 2000}
TRAIN_CHARS = 20_000
THRESHOLD = 0.3
REPEATS = (1, 2, 4, 8)


def _gram_ids(data: np.ndarray, n: int) -> np.ndarray:
    """Bucket of every byte n-gram."""
    h = np.full(len(data) - n + 1, n, np.uint32)
    for i in range(n):
        h = (h ^ data[i : len(data) - n + 1 + i]) * np.uint32(16777619)
    h ^= h >> np.uint32(15)
    return (h % np.uint32(BUCKETS - 16)).astype(np.int32)


def indicators(text: str, seen: np.ndarray) -> np.ndarray:
    """Distinct buckets of one whole text: byte 2-, 3- and 4-grams of the text
    and runs of a repeated word. ``seen`` is scratch space of BUCKETS ints."""
    data = np.frombuffer((" " + text + " ").encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    words = text.split()
    same = list(map(operator.eq, words[1:], words))
    extra = [BUCKETS - 16] if not words else []
    if any(same):
        edges = np.flatnonzero(np.diff(np.r_[0, np.array(same, np.int8), 0]))
        longest = int((edges[1::2] - edges[::2]).max())
        extra += [BUCKETS - 15 + i for i, r in enumerate(REPEATS) if longest >= r]
    out = [np.array(extra, np.int32)]
    for s in range(0, len(data), 1 << 20):  # runs of 1 MB with 3 bytes overlap
        part = data[s : s + (1 << 20) + 3]
        for n in (2, 3, 4):
            if len(part) >= n:
                ids = _gram_ids(part, n)
                seen[ids] = np.arange(len(ids))
                out.append(ids[seen[ids] == np.arange(len(ids))])
    ids = np.concatenate(out)
    seen[ids] = np.arange(len(ids))
    return ids[seen[ids] == np.arange(len(ids))]


def dual_coordinate_descent(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, c: np.ndarray, rounds: int = 12) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear L1-hinge support vector machine over
    normalised ``ratio``-scaled indicators (Hsieh et al., 2008); ``c`` is the
    upper bound of each row's dual variable."""
    w, bias = np.zeros(len(ratio)), 0.0
    alpha = np.zeros(len(rows))
    norm = [np.sqrt((ratio[r] ** 2).sum()) or 1.0 for r in rows]
    rng = np.random.default_rng(5)
    for _ in range(rounds):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            r = rows[i]
            x = ratio[r] / norm[i]
            g = y[i] * (w[r] @ x + bias) - 1.0
            new = min(max(alpha[i] - g / 2.0, 0.0), c[i])  # |x|^2 = 1, bias feature 1
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[r] += step * x
                bias += step
                moved = max(moved, abs(step))
                alpha[i] = new
        if moved < 1e-4:
            break
    return w, bias


class QualityModel:
    """``ratio`` (log-count ratios), ``weight`` = model weights * ratio."""

    def __init__(self):
        self.ratio, self.weight, self.bias, self.platt = np.zeros(BUCKETS, np.float32), np.zeros(BUCKETS, np.float32), 0.0, (0.0, 0.0)

    def margin(self, ids: np.ndarray) -> float:
        norm = float(np.sqrt((self.ratio[ids] ** 2).sum())) or 1.0
        return float(self.weight[ids].sum()) / norm + self.bias

    def score(self, ids: np.ndarray) -> float:
        z = self.platt[0] + self.platt[1] * self.margin(ids)
        return float(1 / (1 + np.exp(-np.clip(z, -60, 60))))


def _indicator_column(text: Column) -> Column:
    @F.pandas_udf("array<int>")
    def run(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
        seen = np.zeros(BUCKETS, np.int64)
        for texts in it:
            yield pd.Series([indicators(t, seen) for block in text_blocks(texts) for t in block], dtype=object)

    return run(text)


def fit_quality(docs: DataFrame, labels: DataFrame, train: Column, label: str = "quality", per_class=PER_CLASS, max_chars: int = TRAIN_CHARS) -> QualityModel:
    """Fit on at most ``per_class`` documents of at most ``max_chars``
    characters (a bounded sample whose indicators are collected); with one
    class alone every score is that class."""
    sample, weight = labelled_sample(docs, labels, label, train, per_class, max_chars=max_chars)
    got = sample.select("_id", "_y", _indicator_column(F.col("_text")).alias("f")).toArrow()
    table = zip(got["_id"].to_pylist(), got["_y"].to_pylist(), got["f"])
    table = sorted(((i, k, f.values.to_numpy().astype(np.int32)) for i, k, f in table), key=lambda r: (r[0], len(r[2])))
    rows, y = [r[2] for r in table], np.array([r[1] for r in table], int)
    del got, table
    return train_quality(rows, y, weight)


def train_quality(rows: list[np.ndarray], y: np.ndarray, weight: dict[int, float]) -> QualityModel:
    """Fit on the indicators and the labels (0 or 1) of documents; ``weight``
    is how many labelled rows a row of each class stands for."""
    model = QualityModel()
    if len(rows) == 0 or y.min() == y.max():
        model.platt = (0.0 if len(rows) == 0 else 6.0 * (2 * int(y[0]) - 1), 0.0)
        return model
    p, q = np.ones(BUCKETS), np.ones(BUCKETS)
    for r, k in zip(rows, y):
        (p if k else q)[r] += 1
    ratio = np.log((p / p.sum()) / (q / q.sum()))
    sign = 2.0 * y - 1
    # Margins for the calibration come from the half that did not fit them.
    half = np.arange(len(rows)) % 2
    margins = np.zeros(len(rows))
    for h in (0, 1):
        part = np.flatnonzero(half != h)
        w, b = dual_coordinate_descent([rows[i] for i in part], sign[part], ratio, np.full(len(part), 1.0))
        for i in np.flatnonzero(half == h):
            x = ratio[rows[i]]
            margins[i] = (w[rows[i]] @ x) / (np.sqrt((x**2).sum()) or 1.0) + b
    model.platt = fit_platt(margins, y, np.array([weight[int(k)] for k in y], float))
    w, model.bias = dual_coordinate_descent(rows, sign, ratio, np.full(len(rows), 1.0))
    model.ratio, model.weight = ratio.astype(np.float32), (w * ratio).astype(np.float32)
    return model


def quality_column(text: Column, model: QualityModel) -> Column:
    """Score of each text; null text is empty."""
    shared = model_broadcast(model)

    @F.pandas_udf("double")
    def run(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m, seen = shared.value, np.zeros(BUCKETS, np.int64)
        for texts in it:
            yield pd.Series([m.score(indicators(t, seen)) for block in text_blocks(texts) for t in block], dtype="float64")

    return run(text)


def quality_scores(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``score`` (0 to 1, higher is
    better) and ``predicted``.

    Defined cases: a null text is empty; an empty text has an indicator of its
    own; repeated rows and null ids are kept; an empty table gives no rows;
    other columns are ignored. Row-local, no shuffle.
    """
    d = docs.select(F.col(id_col).alias("doc_id"), quality_column(F.col(text_col), model).alias("score"))
    return d.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
