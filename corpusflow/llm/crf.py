"""Linear-chain conditional random field in numpy: training by the exact
gradient (forward-backward in log space over padded batches), marginals and
Viterbi decoding. Features are strings; unknown ones weigh nothing."""

from __future__ import annotations

from collections import Counter

import numpy as np


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis=axis, keepdims=True)
    return (m + np.log(np.exp(x - m).sum(axis=axis, keepdims=True))).squeeze(axis)


def forward_backward(e: np.ndarray, lens: np.ndarray, start: np.ndarray, trans: np.ndarray):
    """Marginals of padded emissions ``e[n, t, k]`` and the sums of pair
    marginals: (p[n, t, k], pairs[k, k])."""
    n, t, k = e.shape
    a, b = np.zeros_like(e), np.zeros_like(e)
    a[:, 0] = start + e[:, 0]
    for i in range(1, t):
        a[:, i] = e[:, i] + _lse(a[:, i - 1, :, None] + trans, 1)
    for i in range(t - 2, -1, -1):
        inner = (i + 1 < lens)[:, None]
        b[:, i] = np.where(inner, _lse(trans + (e[:, i + 1] + b[:, i + 1])[:, None, :], 2), 0.0)
    rows = np.arange(n)
    z = _lse(a[rows, lens - 1], 1)
    live = (np.arange(t) < lens[:, None])[:, :, None]
    p = np.where(live, np.exp(np.minimum(a + b - z[:, None, None], 0.0)), 0.0)
    pairs = np.zeros((k, k))
    for i in range(t - 1):
        use = i + 1 < lens
        if use.any():
            pairs += np.exp(
                a[use, i, :, None] + trans + (e[use, i + 1] + b[use, i + 1])[:, None, :] - z[use, None, None]
            ).sum(axis=0)
    return p, pairs


class CRF:
    """Weights: ``index`` (feature -> row of ``weights[., k]``), ``start`` and
    ``trans[from, to]``."""

    def __init__(self, tags: list[str]):
        self.tags = tags
        k = len(tags)
        self.index: dict[str, int] = {}
        self.weights = np.zeros((1, k))
        self.start, self.trans = np.zeros(k), np.zeros((k, k))

    def fit(
        self, sequences: list[list[list[str]]], tags: list[list[int]], epochs: int = 20, batch: int = 256, rate: float = 0.3,
        ridge: float = 1e-4, min_count: int = 1, tag_bias: bool = True,
    ) -> CRF:
        """``sequences[i][t]`` are the feature strings of a token, ``tags`` the
        gold tags. AdaGrad on the exact gradient; the order is fixed, so equal
        data give an equal model."""
        k = len(self.tags)
        count = Counter(f for s in sequences for tok in s for f in tok)
        names = sorted(f for f, c in count.items() if c >= min_count)
        self.index = {f: i for i, f in enumerate(names)}
        d = len(names)
        self.weights = np.zeros((d + 1, k))  # the last row is the padding
        codes = {id(tok): [self.index[f] for f in tok if f in self.index] for s in sequences for tok in s}
        coded = [[codes[id(tok)] for tok in s] for s in sequences]
        width = max((len(tok) for s in coded for tok in s), default=1) or 1
        order = np.random.default_rng(7).permutation(len(coded)) if coded else np.array([], int)
        order = sorted(order.tolist(), key=lambda i: len(coded[i]) // 8)
        batches = []
        for i in range(0, len(order), batch):
            ids = [j for j in order[i : i + batch] if coded[j]]
            if not ids:
                continue
            t = max(len(coded[j]) for j in ids)
            feats = np.full((len(ids), t, width), d, np.int32)
            gold = np.zeros((len(ids), t), np.int64)
            for r, j in enumerate(ids):
                for c, tok in enumerate(coded[j]):
                    feats[r, c, : len(tok)] = tok
                gold[r, : len(tags[j])] = tags[j]
            batches.append((feats, gold, np.array([len(coded[j]) for j in ids])))
        seen = [np.full_like(x, 1e-6) for x in (self.weights, self.start, self.trans)]
        rng = np.random.default_rng(11)
        for _ in range(epochs):
            for at in rng.permutation(len(batches)):
                feats, gold, lens = batches[at]
                n, t, w = feats.shape
                live = np.arange(t) < lens[:, None]
                p, pairs = forward_backward(self.weights[feats].sum(axis=2), lens, self.start, self.trans)
                hot = np.zeros_like(p)
                hot[np.arange(n)[:, None], np.arange(t)[None, :], gold] = 1.0
                diff = np.where(live[:, :, None], hot - p, 0.0)
                flat = feats.reshape(-1)
                grad_w = np.stack(
                    [np.bincount(flat, np.repeat(diff[:, :, j].ravel(), w), d + 1) for j in range(k)], axis=1
                )
                grad_s = diff[:, 0].sum(axis=0)
                gold_pairs = np.zeros((k, k))
                both = live[:, 1:]
                np.add.at(gold_pairs, (gold[:, :-1][both], gold[:, 1:][both]), 1.0)
                grad_t = gold_pairs - pairs
                for x, g, s in zip((self.weights, self.start, self.trans), (grad_w, grad_s, grad_t), seen):
                    g = g / n - ridge * x
                    s += g * g
                    x += rate * g / np.sqrt(s)
                self.weights[d] = 0.0
        return self

    def emission(self, features: list[str]) -> np.ndarray:
        rows = [self.index[f] for f in features if f in self.index]
        return self.weights[rows].sum(axis=0) if rows else np.zeros(len(self.tags))

    def pruned(self, least: float = 1e-3) -> CRF:
        """The same model without features whose weights are all tiny."""
        out = CRF(self.tags)
        keep = [(f, i) for f, i in self.index.items() if np.abs(self.weights[i]).max() >= least]
        out.index = {f: j for j, (f, _) in enumerate(keep)}
        out.weights = np.vstack([self.weights[[i for _, i in keep]], np.zeros((1, len(self.tags)))])
        out.start, out.trans = self.start, self.trans
        return out


def viterbi(e: np.ndarray, lens: np.ndarray, first: np.ndarray, trans: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Best paths of padded emissions ``e[n, t, k]``; ``first[n, k]`` and
    ``last[n, k]`` are added at the ends of each sequence. Ties go to the
    smaller tag."""
    n, t, k = e.shape
    back = np.zeros((n, t, k), np.int8)
    d = first + e[:, 0]
    score = np.where((lens == 1)[:, None], d + last, 0.0)
    for i in range(1, t):
        live = i < lens
        step = d[:, :, None] + trans
        back[:, i] = step.argmax(axis=1)
        d = step.max(axis=1) + e[:, i]
        score = np.where((lens == i + 1)[:, None], d + last, score)
        if not live.any():
            break
    path = np.zeros((n, t), np.int64)
    now = score.argmax(axis=1)
    rows = np.arange(n)
    for i in range(t - 1, -1, -1):
        inside = i < lens
        path[:, i] = np.where(inside, now, 0)
        if i:
            now = np.where(inside & (i > 0), back[rows, i, now], now)
    return path
