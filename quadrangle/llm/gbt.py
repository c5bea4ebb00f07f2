"""Histogram gradient-boosted trees on a bounded training sample.

Trees are complete binary trees of one depth, stored as flat arrays, so a batch
goes down all trees with a few vectorised numpy steps per level, and a tree can
as well be written as nested SQL conditions.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Trees:
    depth: int
    base: float
    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray  # go right where the value is above
    value: np.ndarray  # trees x leaves

    def raw(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        for f, t, v in zip(self.feature, self.threshold, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, f[node]] > t[node])
            out += v[node - len(f)]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.raw(x)))


def fit(x: np.ndarray, y: np.ndarray, *, trees: int = 60, depth: int = 4, bins: int = 64, rate: float = 0.15, ridge: float = 1.0, least: int = 20) -> Trees:
    """Logistic loss, second-order splits. With no rows or one class only, the model is a constant."""
    n, d = x.shape
    share = min(max((y.sum() + 0.5) / (n + 1), 1e-3), 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    inner, leaves = 2**depth - 1, 2**depth
    if n == 0 or y.min() == y.max():
        return Trees(depth, base, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)))
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(d)]
    code = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)  # code <= k means x <= cuts[k]
    width = max(len(c) for c in cuts) + 1
    score = np.full(n, base)
    all_f, all_t, all_v = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, p * (1 - p)
        feature, threshold, value = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(leaves)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            local = node - first
            best = np.full(count, 1e-6)
            for j in range(d):
                key = local * width + code[:, j]
                sg, sh, sn = (np.bincount(key, w, count * width).reshape(count, width).cumsum(1) for w in (g, h, None))
                tg, th, tn = sg[:, -1:], sh[:, -1:], sn[:, -1:]
                gain = sg**2 / (sh + ridge) + (tg - sg) ** 2 / (th - sh + ridge) - tg**2 / (th + ridge)
                gain[(sn < least) | (tn - sn < least)] = 0
                gain = gain[:, : len(cuts[j])]
                if gain.shape[1] == 0:
                    continue
                k = gain.argmax(1)
                top = gain[np.arange(count), k]
                for m in np.flatnonzero(top > best):
                    best[m], feature[first + m], threshold[first + m] = top[m], j, cuts[j][k[m]]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > threshold[node])
        leaf = node - inner
        value = rate * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + ridge)
        score = score + value[leaf]
        all_f.append(feature)
        all_t.append(threshold)
        all_v.append(value)
    return Trees(depth, base, np.array(all_f), np.array(all_t), np.array(all_v))


def logistic(x: np.ndarray, y: np.ndarray, *, ridge: float = 1e-3, steps: int = 50) -> np.ndarray:
    """Weights of a logistic model by Newton steps, the intercept last."""
    z = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w)), z.T @ (y - p) - ridge * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w
