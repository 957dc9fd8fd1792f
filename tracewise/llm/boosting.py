"""Gradient-boosted trees in numpy with monotonic constraints, flattened into
node arrays (used by operators 3 and 9).

Trees are grown level by level on quantile bins with logistic loss.  A feature
may be constrained: +1 means the score never falls as the feature rises, -1
that it never rises.  A split on such a feature is taken only if its leaf
values are ordered, and the children inherit the midpoint as a bound, so the
whole tree keeps the order.  All trees sit in flat arrays (feature, threshold,
left, right, value); scoring walks every row through a tree at once."""

from __future__ import annotations

import numpy as np


class Boosted:
    def __init__(self, n_features: int, monotone: dict[int, int] | None = None, trees: int = 40, depth: int = 3,
                 rate: float = 0.2, bins: int = 64, min_rows: int = 8, l2: float = 1.0):
        self.n_features, self.trees, self.depth, self.rate = n_features, trees, depth, rate
        self.bins, self.min_rows, self.l2 = bins, min_rows, l2
        self.monotone = np.zeros(n_features, int)
        for k, sign in (monotone or {}).items():
            self.monotone[k] = sign
        self.base = 0.0
        self.roots = np.empty(0, int)
        self.feature = np.empty(0, int)
        self.threshold = np.empty(0)
        self.left = np.empty(0, int)
        self.right = np.empty(0, int)
        self.value = np.empty(0)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        """x: rows by features; y: 0 or 1."""
        share = min(max(float(y.mean()), 1e-3), 1 - 1e-3) if len(y) else 0.5
        self.base = float(np.log(share / (1 - share)))
        if not len(y) or y.min() == y.max():
            return self
        edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, self.bins + 1)[1:-1])) for k in range(x.shape[1])]
        binned = np.stack([np.searchsorted(e, x[:, k]) for k, e in enumerate(edges)], axis=1)
        nodes, roots = [], []
        f = np.full(len(y), self.base)
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-f))
            roots.append(len(nodes))
            f += self._grow(nodes, binned, edges, p - y, p * (1 - p))
        self.roots = np.array(roots)
        self.feature, self.threshold, self.left, self.right, self.value = (
            np.array(c, t) for c, t in zip(zip(*nodes, strict=True), (int, float, int, int, float), strict=True))
        return self

    def _grow(self, nodes: list, binned: np.ndarray, edges: list, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        out = np.zeros(len(g))
        level = [(len(nodes), np.arange(len(g)), -np.inf, np.inf)]
        nodes.append([0, 0.0, -1, -1, 0.0])
        for d in range(self.depth + 1):
            below = []
            for at, rows, low, high in level:
                value = float(np.clip(-g[rows].sum() / (h[rows].sum() + self.l2), low, high))
                split = self._split(binned, rows, g, h, low, high) if d < self.depth else None
                if split is None:
                    nodes[at][4] = self.rate * value
                    out[rows] = self.rate * value
                    continue
                k, cut, vl, vr = split
                go = binned[rows, k] <= cut
                nodes[at][:4] = [k, float(edges[k][cut]), len(nodes), len(nodes) + 1]
                middle = (vl + vr) / 2
                sign = self.monotone[k]
                bounds = {1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}.get(
                    sign, ((low, high), (low, high)))
                for part, (a, b) in zip((rows[go], rows[~go]), bounds, strict=True):
                    below.append((len(nodes), part, a, b))
                    nodes.append([0, 0.0, -1, -1, 0.0])
            level = below
        return out

    def _split(self, binned, rows, g, h, low, high):
        best, found = 1e-6, None
        for k in range(binned.shape[1]):
            b = binned[rows, k]
            n = np.bincount(b, minlength=2)
            gs, hs = np.cumsum(np.bincount(b, g[rows], len(n))), np.cumsum(np.bincount(b, h[rows], len(n)))
            ns = np.cumsum(n)
            gl, hl, gr, hr = gs[:-1], hs[:-1], gs[-1] - gs[:-1], hs[-1] - hs[:-1]
            vl = np.clip(-gl / (hl + self.l2), low, high)
            vr = np.clip(-gr / (hr + self.l2), low, high)
            whole = np.clip(-gs[-1] / (hs[-1] + self.l2), low, high)

            def loss(gsum, hsum, v):
                return gsum * v + 0.5 * (hsum + self.l2) * v * v

            gain = loss(gs[-1], hs[-1], whole) - loss(gl, hl, vl) - loss(gr, hr, vr)
            ok = (ns[:-1] >= self.min_rows) & (ns[-1] - ns[:-1] >= self.min_rows)
            if self.monotone[k]:
                ok &= self.monotone[k] * (vr - vl) >= 0
            gain = np.where(ok, gain, 0)
            at = int(gain.argmax()) if len(gain) else 0
            if len(gain) and gain[at] > best:
                best, found = gain[at], (k, at, float(vl[at]), float(vr[at]))
        return found

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(self.depth):
                inner = self.left[at] >= 0
                go = x[rows, self.feature[at]] <= self.threshold[at]
                at = np.where(inner, np.where(go, self.left[at], self.right[at]), at)
            out += self.value[at]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))
