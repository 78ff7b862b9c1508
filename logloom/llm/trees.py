"""Small decision trees over binned features, for bounded training samples:
gradient boosting with logistic loss, and random forests. Deterministic."""

from __future__ import annotations

import numpy as np

BINS = 32


def _edges(x: np.ndarray) -> list[np.ndarray]:
    return [np.unique(np.quantile(col, np.linspace(0, 1, BINS + 1)[1:-1])) for col in x.T]


def _binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, col, side="left") for e, col in zip(edges, x.T)], axis=1) if len(edges) else x


class Tree:
    """A regression tree on gradients g and hessians h: value -sum(g)/(sum(h)+reg)."""

    def __init__(self, bins, g, h, depth, reg=1.0, least=5, features=None, rng=None):
        self.feature, self.cut, self.left, self.right, self.value = [], [], [], [], []
        self._grow(bins, g, h, np.arange(len(g)), depth, reg, least, features, rng)

    def _grow(self, bins, g, h, rows, depth, reg, least, features, rng) -> int:
        node = len(self.value)
        for name, value in (("feature", -1), ("cut", 0), ("left", 0), ("right", 0), ("value", -g[rows].sum() / (h[rows].sum() + reg))):
            getattr(self, name).append(value)
        if depth == 0 or len(rows) < 2 * least:
            return node
        all_f = np.arange(bins.shape[1])
        pick = all_f if features is None else np.sort(rng.choice(all_f, min(features, len(all_f)), replace=False))
        gs, hs = g[rows].sum(), h[rows].sum()
        best = (1e-9, None, None)
        for f in pick:
            b = bins[rows, f]
            n = np.cumsum(np.bincount(b, minlength=BINS))
            gl = np.cumsum(np.bincount(b, weights=g[rows], minlength=BINS))
            hl = np.cumsum(np.bincount(b, weights=h[rows], minlength=BINS))
            gain = gl ** 2 / (hl + reg) + (gs - gl) ** 2 / (hs - hl + reg) - gs ** 2 / (hs + reg)
            gain[(n < least) | (len(rows) - n < least)] = -1
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (gain[k], f, k)
        if best[1] is None:
            return node
        go = bins[rows, best[1]] <= best[2]
        self.feature[node], self.cut[node] = int(best[1]), int(best[2])
        self.left[node] = self._grow(bins, g, h, rows[go], depth - 1, reg, least, features, rng)
        self.right[node] = self._grow(bins, g, h, rows[~go], depth - 1, reg, least, features, rng)
        return node

    def plain(self) -> tuple[np.ndarray, ...]:
        return tuple(map(np.array, (self.feature, self.cut, self.left, self.right, self.value)))

    def predict(self, bins: np.ndarray) -> np.ndarray:
        return _predict(self.plain(), bins)


def _predict(tree: tuple[np.ndarray, ...], bins: np.ndarray) -> np.ndarray:
    feature, cut, left, right, value = tree
    at = np.zeros(len(bins), dtype=np.int64)
    while len(bins):
        f = feature[at]
        inner = f >= 0
        if not inner.any():
            break
        low = bins[np.arange(len(bins)), np.maximum(f, 0)] <= cut[at]
        at = np.where(inner, np.where(low, left[at], right[at]), at)
    return value[at]


def predict(model: tuple, x: np.ndarray) -> np.ndarray:
    """Scores by the plain arrays of a model (``plain()``), which tasks can read
    without this package: a broadcast object is pickled by reference."""
    kind, edges, base, factor, trees = model
    bins = _binned(x, edges)
    total = base + factor * sum(_predict(t, bins) for t in trees)
    return 1 / (1 + np.exp(-total)) if kind == "boosted" else total


class Boosted:
    """Gradient boosted trees; ``score`` is a probability."""

    def __init__(self, x, y, rounds=40, depth=3, rate=0.2):
        self.edges, self.rate = _edges(x), rate
        bins = _binned(x, self.edges)
        p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.base, self.trees = float(np.log(p / (1 - p))), []
        f = np.full(len(y), self.base)
        for _ in range(rounds):
            q = 1 / (1 + np.exp(-f))
            self.trees.append(Tree(bins, q - y, q * (1 - q), depth))
            f = f + rate * self.trees[-1].predict(bins)

    def plain(self) -> tuple:
        return "boosted", self.edges, self.base, self.rate, [t.plain() for t in self.trees]

    def score(self, x) -> np.ndarray:
        return predict(self.plain(), x)


class Forest:
    """Random forest of trees on bootstrap samples; ``score`` is the mean vote."""

    def __init__(self, x, y, trees=40, depth=8, seed=7):
        rng = np.random.default_rng(seed)
        self.edges, self.trees = _edges(x), []
        bins = _binned(x, self.edges)
        some = max(1, int(round(np.sqrt(x.shape[1]))))
        for _ in range(trees):
            rows = rng.integers(0, len(y), len(y))
            # squared loss around 0: a leaf's value is the share of positives
            self.trees.append(Tree(bins[rows], -y[rows].astype(float), np.ones(len(y)), depth, reg=1e-9, least=2, features=some, rng=rng))

    def plain(self) -> tuple:
        return "forest", self.edges, 0.0, 1 / len(self.trees), [t.plain() for t in self.trees]

    def score(self, x) -> np.ndarray:
        return predict(self.plain(), x)


def threshold(score: np.ndarray, y: np.ndarray, precision: float, weight: np.ndarray | None = None) -> float:
    """The lowest score from which on the share of positives, with one negative
    added for chance, reaches ``precision``; 1.01 (nothing) if there is none.
    With ``weight``, each row counts as that many."""
    weight = np.ones(len(y)) if weight is None else weight
    order = np.argsort(-score, kind="stable")
    good = np.cumsum((weight * y)[order])
    share = good / (np.cumsum(weight[order]) + 1)
    last = np.append(score[order][1:] != score[order][:-1], True)
    at = np.flatnonzero((share >= precision) & last)
    return float(score[order][at[-1]]) if len(at) else 1.01
