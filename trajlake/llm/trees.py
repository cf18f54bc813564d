"""Gradient-boosted regression trees with monotonic constraints, as flat numpy node arrays.

Small and exact: histogram splits over at most `bins` quantiles of a bounded training sample, squared
loss, depth-wise growth. Scoring walks all rows down one tree level at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Forest:
    feature: np.ndarray  # int16 [trees, nodes], -1 at a leaf
    threshold: np.ndarray  # float64 [trees, nodes]; go right if value > threshold
    value: np.ndarray  # float64 [trees, nodes]
    base: float
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """Predictions for rows of features; NaN goes left."""
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for f, t, v in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                split = f[node]
                inner = split >= 0
                right = x[rows, np.maximum(split, 0)] > t[node]
                node = np.where(inner, 2 * node + 1 + right, node)
            out += v[node]
        return out


def fit(x: np.ndarray, y: np.ndarray, monotone: list[int], rounds: int = 40, depth: int = 3, rate: float = 0.25, bins: int = 64, least: int = 8) -> Forest:
    """Trees for y; monotone[i] is 1 where the score must not fall as feature i grows, -1 where it must not rise, else 0.

    An empty sample gives the constant 0. A constrained split needs ordered means, and the halves' leaves
    are kept on their side of the split's middle value, so the constraint holds for whole trees and the sum.
    """
    nodes = 2 ** (depth + 1) - 1
    feature = np.full((rounds, nodes), -1, np.int16)
    threshold = np.zeros((rounds, nodes))
    value = np.zeros((rounds, nodes))
    if not len(y):
        return Forest(feature[:0], threshold[:0], value[:0], 0.0, depth)
    base = float(y.mean())
    rest = y - base
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    for k in range(rounds):
        work = [(0, np.arange(len(y)), -np.inf, np.inf, 0)]
        while work:
            node, rows, lo, hi, level = work.pop()
            r = rest[rows]
            mean = float(np.clip(r.mean(), lo, hi))
            value[k, node] = mean * rate
            if level == depth or len(rows) < 2 * least:
                continue
            best = (1e-12, None)
            for j, c in enumerate(cuts):
                if not len(c):
                    continue
                side = np.searchsorted(c, x[rows, j], side="left")  # values <= c[i] lie left of cut i
                n = np.cumsum(np.bincount(side, minlength=len(c) + 1))[:-1]
                s = np.cumsum(np.bincount(side, r, minlength=len(c) + 1))[:-1]
                m, t = len(rows) - n, r.sum() - s
                ok = (n >= least) & (m >= least)
                with np.errstate(divide="ignore", invalid="ignore"):
                    left, right = s / n, t / m
                    gain = np.where(ok, s * left + t * right - r.sum() ** 2 / len(rows), -1.0)
                    if monotone[j]:
                        gain = np.where(ok & ((right - left) * monotone[j] < 0), -1.0, gain)
                i = int(np.argmax(gain))
                if gain[i] > best[0]:
                    best = (gain[i], (j, c[i], left[i], right[i]))
            if best[1] is None:
                continue
            j, cut, left, right = best[1]
            feature[k, node], threshold[k, node] = j, cut
            mid = float(np.clip((left + right) / 2, lo, hi))
            go = x[rows, j] > cut
            low, high = (lo, hi), (lo, hi)
            if monotone[j] > 0:
                low, high = (lo, mid), (mid, hi)
            elif monotone[j] < 0:
                low, high = (mid, hi), (lo, mid)
            work.append((2 * node + 1, rows[~go], *low, level + 1))
            work.append((2 * node + 2, rows[go], *high, level + 1))
        one = Forest(feature[k : k + 1], threshold[k : k + 1], value[k : k + 1], 0.0, depth)
        rest = rest - one.score(x)
    return Forest(feature, threshold, value, base, depth)
