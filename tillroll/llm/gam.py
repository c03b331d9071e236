"""A generalised additive model with pairwise interactions, in numpy.

Every feature is cut into bins at its quantiles. The model is an intercept, one
lookup table per feature and one two-way table per chosen pair. Tables are learned
by cyclic boosting: round after round each feature (then each pair) in turn gets a
shallow tree on its bins alone, fitted to the gradient of the log loss and added
to its table with a small step. Scoring is one table lookup per feature and pair,
summed for all rows at once.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

import numpy as np

BINS, PAIR_BINS = 48, 12
ROUNDS, PAIR_ROUNDS = 150, 60
PAIRS = 6
STEP = 0.15
#: Least sum of second derivatives in a leaf, and its shrinkage.
LEAST, RIDGE = 4.0, 2.0


@dataclass
class Gam:
    edges: list[np.ndarray]
    pair_edges: list[np.ndarray]
    intercept: float
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """The chance of label 1 for each row of features."""
        out = np.full(len(rows), self.intercept)
        for k, table in enumerate(self.tables):
            out += table[np.searchsorted(self.edges[k], rows[:, k], side="right")]
        if self.pairs:
            bins = binned(rows, self.pair_edges)
            for (i, j), table in zip(self.pairs, self.pair_tables):
                out += table[bins[:, i], bins[:, j]]
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def quantile_edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.arange(1, bins) / bins)) if len(values) else np.zeros(0)


def binned(rows: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, rows[:, k], side="right") for k, e in enumerate(edges)], axis=1)


def gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return np.where(h >= LEAST, g**2 / (h + RIDGE), -np.inf)


def best_cut(g: np.ndarray, h: np.ndarray) -> tuple[int, float]:
    """Where to cut a run of bins in two, and what it gains."""
    if len(g) < 2:
        return 0, 0.0
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    both = gain(left_g, left_h) + gain(g.sum() - left_g, h.sum() - left_h)
    cut = int(np.argmax(both))
    whole = g.sum() ** 2 / (h.sum() + RIDGE)
    return cut + 1, float(both[cut] - whole)


def shallow_tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """The leaf value of every bin for a tree of ``depth`` levels of cuts."""
    cut, more = best_cut(g, h)
    if depth and more > 0:
        return np.concatenate([shallow_tree(g[:cut], h[:cut], depth - 1), shallow_tree(g[cut:], h[cut:], depth - 1)])
    return np.full(len(g), g.sum() / (h.sum() + RIDGE))


def shallow_pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """Cut one feature, then the other on either side; the better order of the two."""
    options = []
    for a, b in ((g, h), (g.T, h.T)):
        for cut in range(1, len(a)):
            parts = [(a[:cut].sum(axis=0), b[:cut].sum(axis=0)), (a[cut:].sum(axis=0), b[cut:].sum(axis=0))]
            options.append((sum(max(0.0, best_cut(*p)[1]) + p[0].sum() ** 2 / (p[1].sum() + RIDGE) for p in parts), cut, a is g))
    if not options:
        return np.zeros_like(g), 0.0
    top, cut, straight = max(options)
    a, b = (g, h) if straight else (g.T, h.T)
    rows = [shallow_tree(x.sum(axis=0), y.sum(axis=0), 1) for x, y in ((a[:cut], b[:cut]), (a[cut:], b[cut:]))]
    out = np.concatenate([np.tile(rows[0], (cut, 1)), np.tile(rows[1], (len(a) - cut, 1))])
    return out if straight else out.T, top - g.sum() ** 2 / (h.sum() + RIDGE)


def fit(rows: np.ndarray, labels: np.ndarray) -> Gam:
    """Learn from rows of features and labels 0 or 1; no rows: one half everywhere."""
    n, k = rows.shape
    edges = [quantile_edges(rows[:, i], BINS) for i in range(k)]
    pair_edges = [quantile_edges(rows[:, i], PAIR_BINS) for i in range(k)]
    rate = (labels.sum() + 1) / (n + 2)
    model = Gam(edges, pair_edges, float(np.log(rate / (1 - rate))), [np.zeros(len(e) + 1) for e in edges])
    if not n:
        return model
    bins, pair_bins = binned(rows, edges), binned(rows, pair_edges)
    margin = np.full(n, model.intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-margin))
        return labels - p, p * (1 - p)

    for _ in range(ROUNDS):
        for i, table in enumerate(model.tables):
            g, h = slopes()
            size = len(table)
            step = STEP * shallow_tree(np.bincount(bins[:, i], g, size), np.bincount(bins[:, i], h, size))
            table += step
            margin += step[bins[:, i]]

    def cells(i: int, j: int) -> tuple[np.ndarray, tuple[int, int]]:
        shape = len(pair_edges[i]) + 1, len(pair_edges[j]) + 1
        return pair_bins[:, i] * shape[1] + pair_bins[:, j], shape

    def sums(i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        at, shape = cells(i, j)
        g, h = slopes()
        return tuple(np.bincount(at, x, shape[0] * shape[1]).reshape(shape) for x in (g, h))

    ranked = sorted(combinations(range(k), 2), key=lambda p: -shallow_pair_tree(*sums(*p))[1])
    model.pairs = ranked[:PAIRS]
    model.pair_tables = [np.zeros(cells(i, j)[1]) for i, j in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for (i, j), table in zip(model.pairs, model.pair_tables):
            step = STEP * shallow_pair_tree(*sums(i, j))[0]
            table += step
            margin += step.ravel()[cells(i, j)[0]]
    return model
