"""Toxicity: a linear-chain CRF tags toxic words; forward-backward marginals
give document scores and offending offsets.

Labels come per document. Words of labelled documents become labelled tokens:
a word of a toxic document is tagged toxic if it, or a prefix of it, occurs in
toxic and not in clean documents by far more than chance. The CRF is trained
on windows around such words and on windows without any.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark import SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import fit_platt, labelled_sample, text_blocks
from corpusflow.llm.crf import CRF

#: Training sample: documents per class (0 clean, 1 toxic), the longest
#: document taken, words per window and windows per document: with a toxic
#: word, with words that begin like one, and others. These bound the fit alone;
#: scoring covers all rows and texts.
PER_CLASS = {0: 3000, 1: 1500}
TRAIN_CHARS = 20_000
WINDOW, HIT_WINDOWS, HARD_WINDOWS, PLAIN_WINDOWS = 16, 3, 3, 1
#: Log-likelihood ratio, and share of toxic documents among those with it (as
#: weighted), from which a word or prefix is evidence.
EVIDENCE, PRECISION = 30.0, 0.5
THRESHOLD = 0.3
#: A word belongs to a reported span from this marginal on.
SPAN_AT = 0.5
#: Marginals up to this one do not count towards a document's score, so that
#: length alone adds nothing.
NOISE = 0.1
#: Words of one piece of a long document.
PIECE = 512
MAX_CACHED_WORDS = 150_000

_WORD = re.compile(r"[^\W_]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text)


def _stems(w: str) -> list[str]:
    return ["w:" + w, *[w[:n] for n in range(3, min(len(w), 9))]]


def features(word: str) -> list[str]:
    w = word.lower()
    n = len(w)
    # The length splits a stem by what may follow it.
    return ["b:", *_stems(w), "s:" + w[-3:], "n:" + str(min(n, 12)), *[f"{n}:{w[:k]}" for k in (5, 7) if n > k]]


def _llr(a: int, b: int, na: int, nb: int) -> float:
    """Signed log-likelihood ratio of a of na against b of nb."""
    p = (a + b) / (na + nb)

    def part(k: int, n: int) -> float:
        out = 0.0
        if k:
            out += k * math.log(k / (n * p))
        if k < n:
            out += (n - k) * math.log((n - k) / (n * (1 - p)))
        return out

    g = 2 * (part(a, na) + part(b, nb)) if 0 < p < 1 else 0.0
    return g if a * nb > b * na else -g


def _sketch(words: list[str]) -> tuple[int, int]:
    """Two min-hashes of word 5-grams: near copies mostly share one."""
    grams = [" ".join(words[i : i + 5]).encode() for i in range(max(1, len(words) - 4))]
    return min(zlib.crc32(g) for g in grams), min(zlib.crc32(g, 77) for g in grams)


class _Emissions(dict):
    """Emission (toxic minus clean) of each word, filled on demand."""

    def __init__(self, weight: dict[str, float]):
        super().__init__()
        self.weight = weight

    def __missing__(self, word: str) -> float:
        get = self.weight.get
        e = self[word] = sum([get(f, 0.0) for f in features(word)])
        return e


class ToxicityModel:
    """The CRF's emission (toxic minus clean) of a word, the transition
    scores, and the calibration of document scores."""

    def __init__(self):
        self.weight: dict[str, float] = {}
        self.start = 0.0
        self.trans = np.zeros((2, 2))
        self.platt = (-30.0, 0.0)
        self._cache = _Emissions(self.weight)

    def __getstate__(self):
        return self.__dict__ | {"_cache": None}

    def __setstate__(self, state):
        self.__dict__ |= state
        self._cache = _Emissions(self.weight)

    def marginals(self, docs: list[list[str]]) -> list[np.ndarray]:
        """Toxic log-odds of every word by the two-state forward-backward
        recursion on log ratios, over all documents of a block at once.

        One step maps log ratios by log((ot + x tt) / (oo + x to)), which
        shrinks differences by at most tanh(|log(oo tt / (ot to))| / 4). Long
        documents are therefore cut into pieces that start ``warm`` words early
        (or late, backwards) from any value: what is left of the difference is
        below 1e-12."""
        lens = np.array([len(d) for d in docs], np.int64)
        n = int(lens.sum())
        if not n:
            return [np.zeros(0)] * len(docs)
        flat = np.fromiter(map(self._cache.__getitem__, chain.from_iterable(docs)), float, n)
        if len(self._cache) > MAX_CACHED_WORDS:
            self._cache.clear()
        (oo, ot), (to, tt) = self.trans
        shrink = math.tanh(abs(oo + tt - ot - to) / 4)
        warm = 0 if shrink == 0 else min(n, math.ceil(math.log(1e-12 / 240) / math.log(shrink))) if shrink < 1 else n
        off = np.cumsum(lens) - lens
        counts = -(-lens // PIECE)
        doc = np.repeat(np.arange(len(docs)), counts)
        piece = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
        lo = off[doc] + piece * PIECE
        hi = np.minimum(lo + PIECE, off[doc] + lens[doc])
        begin, stop = np.maximum(lo - warm, off[doc]), np.minimum(hi + warm, off[doc] + lens[doc])
        fwd = self._run(flat, begin, hi - begin, lo - begin, 1, np.where(begin == off[doc], self.start, 0.0), (oo, ot, to, tt))
        # Backwards the recursion runs over b + e with the matrix transposed.
        bwd = self._run(flat, stop - 1, stop - lo, stop - hi, -1, np.zeros(len(doc)), (oo, to, ot, tt))
        odds = fwd + bwd - flat
        return np.split(odds, np.cumsum(lens)[:-1])

    @staticmethod
    def _run(flat, first, length, skip, way, begin, trans) -> np.ndarray:
        """r[i] = e[i] + step(r[i - way]) along every piece; the first ``skip``
        values of a piece only warm it up."""
        oo, ot, to, tt = map(math.exp, trans)
        out = np.zeros(len(flat))
        order = np.argsort(-length, kind="stable")
        first, length, skip, r = first[order], length[order], skip[order], begin[order]
        live = np.searchsorted(-length, -np.arange(int(length[0]) if len(length) else 0), "left")
        for i, n in enumerate(live):
            at = first[:n] + way * i
            if i:
                x = np.exp(np.clip(r[:n], -60, 60))
                r = np.log((ot + x * tt) / (oo + x * to))
            r = r[:n] + flat[at]
            keep = skip[:n] <= i
            out[at[keep]] = r[keep]
        return out

    @staticmethod
    def strength(odds: np.ndarray) -> float:
        """Log-odds that any word is toxic, from the words whose marginal is
        above ``NOISE``, as if independent, between -4 (none) and 10."""
        odds = odds[odds > math.log(NOISE / (1 - NOISE))]
        clean = -np.logaddexp(0.0, odds).sum() if len(odds) else 0.0
        return float(np.clip(np.log(-np.expm1(clean)) - clean, -4, 10)) if clean < 0 else -4.0

    def score(self, odds: np.ndarray) -> float:
        z = self.platt[0] + self.platt[1] * self.strength(odds)
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, z))))


def fit_toxicity(docs: DataFrame, labels: DataFrame, train: Column, label: str = "toxic", per_class=PER_CLASS, max_chars: int = TRAIN_CHARS) -> ToxicityModel:
    """Fit on at most ``per_class`` documents of at most ``max_chars``
    characters (a bounded sample, collected); without toxic labels every score
    is near 0."""
    sample, weight = labelled_sample(docs, labels, label, train, per_class, max_chars=max_chars)
    rows = sample.select("_id", F.coalesce("_text", F.lit("")).alias("_text"), "_y").collect()
    return train_toxicity(sorted((r["_id"], r["_text"], r["_y"]) for r in rows), weight)


def train_toxicity(rows: list[tuple], weight: dict[int, float]) -> ToxicityModel:
    """Fit on (id, text, 0 or 1) rows; ``weight`` is how many labelled rows a
    row of each class stands for."""
    ids: dict[str, int] = {}  # every word once; texts as arrays of word ids
    texts, ys, seen = [], [], set()
    for _, text, y in rows:
        words = words_of(text)
        if not words:
            continue
        sketch = [(y, i, h) for i, h in enumerate(_sketch(words))]
        if len(words) >= 20 and not seen.isdisjoint(sketch):
            continue  # a near copy would count its words again as evidence
        seen.update(sketch)
        texts.append(np.array([ids.setdefault(w, len(ids)) for w in words], np.int32))
        ys.append(y)
    model = ToxicityModel()
    n1 = sum(ys)
    n0 = len(ys) - n1
    if not n1 or not n0:
        return model
    words = list(ids)
    counts = Counter()
    for t, y in zip(texts, ys):
        if y:
            counts.update({s for i in np.unique(t).tolist() for s in _stems(words[i].lower())})
    tox = {s: a for s, a in counts.items() if a >= 3}
    del counts
    clean = dict.fromkeys(tox, 0)
    for t, y in zip(texts, ys):
        if not y:
            for s in {s for i in np.unique(t).tolist() for s in _stems(words[i].lower()) if s in tox}:
                clean[s] += 1
    evidence = {
        s for s, a in tox.items()
        if a * weight[1] >= PRECISION * (a * weight[1] + clean[s] * weight[0]) and _llr(a, clean[s], n1, n0) >= EVIDENCE
    }
    bad = np.array([not evidence.isdisjoint(_stems(w.lower())) for w in words])
    # Words that begin like a toxic one are what the model has to tell apart.
    begins = {s for w, y in zip(words, bad) if y for s in _stems(w.lower())[1:]}
    alike = np.array([not y and not begins.isdisjoint(_stems(w.lower())) for w, y in zip(words, bad)])

    known: dict[int, list[str]] = {}  # equal words share one feature list
    sequences, tags = [], []
    for t, y in zip(texts, ys):
        gold = bad[t].astype(int) if y else np.zeros(len(t), int)
        cuts = range(0, len(t), WINDOW)
        near = alike[t] | (bad[t] & (gold == 0))
        by_hash = sorted(cuts, key=lambda c: zlib.crc32(f"{c}:{len(t)}".encode()))
        hit = [c for c in by_hash if gold[c : c + WINDOW].any()]
        rest = [c for c in by_hash if not gold[c : c + WINDOW].any()]
        hard = [c for c in rest if near[c : c + WINDOW].any()]
        for c in dict.fromkeys([*hit[:HIT_WINDOWS], *hard[:HARD_WINDOWS], *rest[:PLAIN_WINDOWS]]):
            part = t[c : c + WINDOW].tolist()
            for i in part:
                if i not in known:
                    known[i] = features(words[i])
            sequences.append([known[i] for i in part])
            tags.append(gold[c : c + WINDOW].tolist())
    crf = CRF(["clean", "toxic"]).fit(sequences, tags, epochs=8, min_count=2).pruned()
    model.weight |= {f: float(crf.weights[i, 1] - crf.weights[i, 0]) for f, i in crf.index.items()}
    model.start, model.trans = float(crf.start[1] - crf.start[0]), crf.trans
    del sequences, tags, known
    x = [
        model.strength(o) for i in range(0, len(texts), 256) for o in model.marginals([[words[j] for j in t.tolist()] for t in texts[i : i + 256]])
    ]
    model.platt = fit_platt(x, np.array(ys), np.array([weight[y] for y in ys], float))
    return model


def toxicity_column(text: Column, model: ToxicityModel) -> Column:
    """struct(score, spans): spans are ``[start, end)`` in code points of runs
    of toxic words. Null text is empty."""
    shared = model_broadcast(model)

    @F.pandas_udf("score double, spans array<struct<start:int,end:int,odds:double>>")
    def run(it: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        bar = math.log(SPAN_AT / (1 - SPAN_AT))
        for texts in it:
            scores, spans = [], []
            for block in text_blocks(texts):
                for t, odds in zip(block, m.marginals([words_of(t) for t in block])):
                    scores.append(m.score(odds))
                    spans.append(_spans(t, odds, bar) if len(odds) and odds.max() >= bar else [])
            yield pd.DataFrame({"score": pd.Series(scores, dtype="float64"), "spans": pd.Series(spans, dtype=object)})

    return run(text)


def model_broadcast(model):
    """Ship a fitted model (a few MB) to the executors."""
    return SparkContext.getOrCreate().broadcast(model)


def _spans(text: str, odds: np.ndarray, bar: float) -> list[dict]:
    out: list[dict] = []
    last = -2
    for i, m in enumerate(_WORD.finditer(text)):
        if odds[i] < bar:
            continue
        if last == i - 1:
            out[-1]["end"], out[-1]["odds"] = m.end(), max(out[-1]["odds"], float(odds[i]))
        else:
            out.append({"start": m.start(), "end": m.end(), "odds": float(odds[i])})
        last = i
    return out


def toxicity_scores(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``score`` (0 to 1), ``predicted``
    and ``spans``.

    Defined cases: a null text is empty; an empty text has the lowest score
    and no spans; repeated rows and null ids are kept; an empty table gives no
    rows; other columns are ignored. Row-local, no shuffle.
    """
    d = docs.select(F.col(id_col).alias("doc_id"), toxicity_column(F.col(text_col), model).alias("_s"))
    return d.select("doc_id", F.col("_s.score").alias("score"), (F.col("_s.score") >= threshold).cast("int").alias("predicted"), F.col("_s.spans").alias("spans"))
