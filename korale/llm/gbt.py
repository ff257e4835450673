"""Gradient-boosted trees in numpy.

Histogram trees of a fixed depth, squared or logistic loss, optional monotonic
constraints. A fitted model is a set of flat node arrays (feature, cut, left
child, value), so a batch of rows is scored with a few vectorised gathers per
level of depth and the model travels to the executors as plain bytes.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Forest:
    """Flat node arrays of all trees; leaves have feature -1."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float
    logistic: bool
    names: tuple[str, ...] = field(default=())

    def raw(self, x: np.ndarray) -> np.ndarray:
        """Sum of the leaf values of each row of x."""
        x = np.ascontiguousarray(x, dtype=np.float32)
        rows = np.arange(len(x))
        out = np.full(len(x), self.base)
        for root in self.roots:
            node = np.full(len(x), root, dtype=np.int32)
            for _ in range(self.depth):
                f = self.feature[node]
                inner = f >= 0
                if not inner.any():
                    break
                right = x[rows, np.maximum(f, 0)] > self.cut[node]
                node = np.where(inner, self.left[node] + right, node)
            out += self.value[node]
        return out

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probability (logistic) or expected value (squared loss)."""
        raw = self.raw(x)
        return 1.0 / (1.0 + np.exp(-raw)) if self.logistic else raw


def fit(
    x: np.ndarray,
    y: np.ndarray,
    *,
    logistic: bool,
    trees: int = 60,
    depth: int = 4,
    rate: float = 0.15,
    bins: int = 48,
    least: int = 8,
    ridge: float = 1.0,
    monotone: dict[int, int] | None = None,
    weight: np.ndarray | None = None,
    names: tuple[str, ...] = (),
) -> Forest:
    """Fit a forest on the rows x with targets y.

    monotone maps a feature's column to +1 (the score may not fall as it rises)
    or -1. A split against its sign is refused, and the children of an accepted
    one get the middle of their two values as a bound, so the whole tree keeps
    the order. Missing values (nan) count as the lowest.
    """
    x = np.nan_to_num(np.asarray(x, dtype=np.float32), nan=-1e30, posinf=1e30, neginf=-1e30)
    y = np.asarray(y, dtype=np.float64)
    w = np.ones(len(y)) if weight is None else np.asarray(weight, dtype=np.float64)
    monotone = monotone or {}
    n, k = x.shape
    if not n:  # nothing to learn from: one leaf of value 0
        return Forest(np.array([-1], np.int16), np.zeros(1, np.float32), np.array([-1], np.int32), np.zeros(1), np.zeros(1, np.int32), depth, 0.0, logistic, names)
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for j in range(k)]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1).astype(np.int64)
    width = bins + 1
    flat = binned + np.arange(k) * width
    mean = float(np.average(y, weights=w)) if n else 0.0
    base = float(np.log((mean + 1e-6) / (1 - mean + 1e-6))) if logistic else mean
    score = np.full(n, base)
    feature, cut, left, value, roots = [], [], [], [], []

    def new_node() -> int:
        feature.append(-1)
        cut.append(0.0)
        left.append(-1)
        value.append(0.0)
        return len(feature) - 1

    for _ in range(trees):
        p = 1 / (1 + np.exp(-score)) if logistic else score
        g, h = w * (y - p), w * (np.maximum(p * (1 - p), 1e-6) if logistic else np.ones(n))
        root = new_node()
        roots.append(root)
        open_nodes = [(root, np.arange(n), -np.inf, np.inf, 0)]
        while open_nodes:
            node, rows, low, high, level = open_nodes.pop()
            gs, hs = g[rows].sum(), h[rows].sum()
            here = float(np.clip(gs / (hs + ridge), low, high))
            best = None
            if level < depth and len(rows) >= 2 * least:
                cells = flat[rows].ravel()
                gh = np.bincount(cells, np.repeat(g[rows], k), k * width).reshape(k, width)
                hh = np.bincount(cells, np.repeat(h[rows], k), k * width).reshape(k, width)
                ch = np.bincount(cells, minlength=k * width).reshape(k, width)
                gl, hl, cl = gh.cumsum(1)[:, :-1], hh.cumsum(1)[:, :-1], ch.cumsum(1)[:, :-1]
                gr, hr, cr = gs - gl, hs - hl, len(rows) - cl
                vl, vr = np.clip(gl / (hl + ridge), low, high), np.clip(gr / (hr + ridge), low, high)
                gain = gl * vl - 0.5 * (hl + ridge) * vl**2 + gr * vr - 0.5 * (hr + ridge) * vr**2
                gain -= gs * here - 0.5 * (hs + ridge) * here**2
                gain[(cl < least) | (cr < least)] = -np.inf
                for j, sign in monotone.items():
                    gain[j, (vr[j] - vl[j]) * sign < 0] = -np.inf
                for j in range(k):
                    gain[j, len(cuts[j]) :] = -np.inf
                j, b = np.unravel_index(int(np.argmax(gain)), gain.shape)
                if gain[j, b] > 1e-6:
                    best = (int(j), int(b), float(vl[j, b]), float(vr[j, b]))
            if best is None:
                value[node] = rate * here
                score[rows] += rate * here
                continue
            j, b, a, c = best
            feature[node], cut[node] = j, float(cuts[j][b])
            l, r = new_node(), new_node()
            left[node] = l
            goes = binned[rows, j] > b
            bounds = [(low, high), (low, high)]
            if j in monotone:
                middle = (a + c) / 2
                bounds = [(low, middle), (middle, high)] if monotone[j] > 0 else [(middle, high), (low, middle)]
            open_nodes.append((l, rows[~goes], *bounds[0], level + 1))
            open_nodes.append((r, rows[goes], *bounds[1], level + 1))
    return Forest(
        np.array(feature, np.int16), np.array(cut, np.float32), np.array(left, np.int32), np.array(value, np.float64),
        np.array(roots, np.int32), depth, base, logistic, names,
    )
