"""Gradient-boosted trees for a yes/no answer over a few numeric features, and calibrated thresholds.

Trees see rows by bins of their features only, and only as sums over blocks of rows, which may lie anywhere.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np

TREES = 40
DEPTH = 3
RATE = 0.3
BINS = 32
LEAST_ROWS = 10
SHRINK = 1.0
#: Parts of one that are summed, and that probabilities are told apart by in thresholds.
UNIT = 2**20
LEVELS = 2**14


@dataclass
class Tree:
    """A full binary tree as arrays: node k has the children 2k+1 and 2k+2. ``bin`` is the last one left of a cut."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    bin: np.ndarray

    def descend(self, bins: np.ndarray, levels: int = DEPTH) -> np.ndarray:
        """The node that each row, given by bins, is in after so many ``levels``."""
        node = np.zeros(len(bins), dtype=np.int64)
        for _ in range(levels):
            node = 2 * node + 1 + (bins[np.arange(len(bins)), self.feature[node]] > self.bin[node])
        return node

    def __call__(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), dtype=np.int64)
        for _ in range(DEPTH):
            right = x[np.arange(len(x)), self.feature[node]] > self.cut[node]
            node = 2 * node + 1 + right
        return self.value[node]


@dataclass
class Boosted:
    """Sum of trees fitted one after the other to the gradient of the logistic loss."""

    base: float = 0.0
    trees: list[Tree] = field(default_factory=list)

    def probability(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for tree in self.trees:
            total += tree(x)
        return 1 / (1 + np.exp(-total))

    def binned_probability(self, bins: np.ndarray) -> np.ndarray:
        total = np.full(len(bins), self.base)
        for tree in self.trees:
            total += tree.value[tree.descend(bins)]
        return 1 / (1 + np.exp(-total))


@dataclass
class Rows:
    """A block of rows by the bins of their features; equal rows are one with their number ``n``."""

    bins: np.ndarray
    n: np.ndarray
    right: np.ndarray
    known: np.ndarray
    held: np.ndarray
    group: np.ndarray
    alike: np.ndarray


#: Sums over all blocks of what a function makes of one.
Total = Callable[[Callable[[Rows], np.ndarray]], np.ndarray]
#: What the rows of a block are fitted to, and how much each counts.
Target = Callable[[Rows], tuple[np.ndarray, np.ndarray]]


def quantiles(x: np.ndarray) -> list[np.ndarray]:
    """Where the bins of each feature are cut: values up to a cut, but not to the one before, share a bin."""
    return [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[:-1])) for f in range(x.shape[1])]


def binned(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    columns = [np.searchsorted(c, x[:, f], side="left").astype(np.uint8) for f, c in enumerate(cuts)]
    return np.stack(columns, axis=1)


def fit(x: np.ndarray, y: np.ndarray) -> Boosted:
    """``y`` is 1 for right and 0 for wrong, or a chance between them."""
    if not len(y):
        return Boosted(base=-20.0)
    cuts, no = quantiles(x), np.zeros(len(y), dtype=bool)
    rows = Rows(binned(x, cuts), np.ones(len(y)), no, no, no, no, no)
    return fit_total(lambda part: part(rows), cuts, lambda rows: (y, rows.n))


def fit_total(total: Total, cuts: list[np.ndarray], target: Target) -> Boosted:
    """Trees fitted to rows that are only seen as sums over blocks: three of them a tree, one for each level."""
    rows, right = total(lambda rows: np.array(_outline(*target(rows))))
    if right <= 0 or right >= rows:
        return Boosted(base=20.0 if rows and right else -20.0)
    model = Boosted(base=float(np.log(right / (rows - right))))
    for _ in range(TREES):
        model.trees.append(_grow(total, cuts, target, model))
    return model


def _outline(y: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    return float(n.sum()), float((_whole(y) * n).sum() / UNIT)


def chances(
    x: np.ndarray, right: np.ndarray, known: np.ndarray, held: np.ndarray, group: np.ndarray, alike: np.ndarray
) -> np.ndarray:
    """The chance that each row is right: 1 or 0 if that is ``known``, otherwise estimated from the others.

    Learning from positive and unlabelled rows (Elkan and Noto, 2008): trees fitted with unknown rows as wrong tell how
    likely a row is to be *known* as right. Their mean over right rows that are ``alike`` unknown ones, and were
    ``held`` back, tells how many of such rows are known at all. Without any in a group its unknown rows count as wrong.
    """
    cuts = quantiles(x[~held]) if not held.all() else [np.zeros(1)] * x.shape[1]
    rows = Rows(binned(x, cuts), np.ones(len(x)), right, known, held, group, alike)
    groups = int(group.max(initial=0)) + 1
    return chances_total(lambda part: part(rows), cuts, groups, lambda rows: rows.n * ~rows.held)(rows)


def balance(total: Total, groups: int) -> Callable[[Rows], np.ndarray]:
    """How much the rows of a block that are not held back count: all groups about the same, however rare.

    Factors are powers of two, which keeps sums exact.
    """
    counts = total(lambda rows: np.bincount(rows.group, weights=rows.n * ~rows.held, minlength=groups))
    mean = counts.sum() / max(1, np.count_nonzero(counts))
    factors = 2.0 ** np.rint(np.log2(max(mean, 1) / np.maximum(counts, 1)))
    return lambda rows: rows.n * ~rows.held * factors[rows.group]


def chances_total(
    total: Total, cuts: list[np.ndarray], groups: int, weight: Callable[[Rows], np.ndarray]
) -> Callable[[Rows], np.ndarray]:
    """:func:`chances` of the rows of a block, estimated from all blocks; trees are fitted with a ``weight``."""

    def labelled(rows: Rows) -> np.ndarray:
        p, n = _whole(first.binned_probability(rows.bins)), rows.n * (rows.held & rows.alike)
        return np.stack([np.bincount(rows.group, weights=w, minlength=groups) for w in (p * n, n)])

    if not total(lambda rows: np.array([(rows.n * ~rows.known).sum()]))[0]:
        return lambda rows: rows.right.astype(float)
    first = fit_total(total, cuts, lambda rows: (rows.right.astype(float), weight(rows)))
    sums, found = total(labelled)
    share = np.maximum(sums / UNIT / np.maximum(found, 1), 1e-9)

    def chance(rows: Rows) -> np.ndarray:
        p = first.binned_probability(rows.bins)
        of = share[rows.group]
        estimate = np.minimum(1, p / np.maximum(1 - p, 1e-9) * (1 - of) / of)
        return np.where(rows.known, rows.right, np.where(found[rows.group] > 0, estimate, 0.0))

    return chance


def thresholds(
    total: Total, model: Boosted, chance: Callable[[Rows], np.ndarray], groups: int, precision: float
) -> list[float]:
    """The :func:`threshold` of each group on rows that were held back, with probabilities of LEVELS steps."""

    def counted(rows: Rows) -> np.ndarray:
        level = np.rint(model.binned_probability(rows.bins) * LEVELS).astype(np.int64) + rows.group * (LEVELS + 1)
        weights = rows.n * rows.held, rows.n * rows.held * np.round(chance(rows))
        return np.stack([np.bincount(level, weights=w, minlength=groups * (LEVELS + 1)) for w in weights])

    out = []
    for n, right in total(counted).reshape(2, groups, LEVELS + 1).swapaxes(0, 1):
        (at,) = np.nonzero(n)
        out.append(threshold(at / LEVELS, right[at] / n[at], precision, n[at]))
    return out


def _whole(v: np.ndarray) -> np.ndarray:
    """Whole numbers of 1/UNIT: their sums are exact, so that no order of adding shows in a tree."""
    return np.rint(v * UNIT)


def _grow(total: Total, cuts: list[np.ndarray], target: Target, model: Boosted) -> Tree:
    inner, nodes = 2**DEPTH - 1, 2 ** (DEPTH + 1) - 1
    tree = Tree(np.zeros(nodes, dtype=np.int64), np.full(nodes, np.inf), np.zeros(nodes), np.full(nodes, BINS + 1))
    offsets = np.cumsum([0, *[len(c) + 1 for c in cuts]])

    def histograms(rows: Rows) -> np.ndarray:
        y, weight = target(rows)
        used = weight > 0
        bins, y, weight = rows.bins[used], y[used], weight[used]
        p = model.binned_probability(bins)
        weights = _whole(y - p) * weight, _whole(p * (1 - p)) * weight, rows.n[used]
        node = (tree.descend(bins, level) - (2**level - 1)) * offsets[-1]
        size = 2**level * offsets[-1]
        out = np.zeros((3, size))
        for f, start in enumerate(offsets[:-1]):
            at = node + start + bins[:, f]
            for k, w in enumerate(weights):
                out[k] += np.bincount(at, weights=w, minlength=size)
        return out

    sums = {}
    for level in range(DEPTH):
        seen = total(histograms).reshape(3, 2**level, offsets[-1]) / np.array([UNIT, UNIT, 1]).reshape(3, 1, 1)
        for k in range(2**level - 1, 2 ** (level + 1) - 1):
            here = seen[:, k - (2**level - 1)]
            g, w, n = sums[k] = here[:, : offsets[1]].sum(axis=1)
            best = (1e-6, 0, None, None)
            whole = g**2 / (w + SHRINK)
            for f in range(len(cuts)):
                if n < 2 * LEAST_ROWS:
                    break
                low, heavy, few = np.cumsum(here[:, offsets[f] : offsets[f + 1]], axis=1)[:, :-1]
                enough = (few >= LEAST_ROWS) & (n - few >= LEAST_ROWS)
                gain = low**2 / (heavy + SHRINK) + (g - low) ** 2 / (w - heavy + SHRINK) - whole
                gain[~enough] = 0
                at = int(np.argmax(gain))
                if gain[at] > best[0]:
                    best = (gain[at], f, at, np.array([low[at], heavy[at], few[at]]))
            _, f, at, left = best
            if at is None:  # everything goes left, with this node's value
                left = sums[k]
            else:
                tree.feature[k], tree.cut[k], tree.bin[k] = f, cuts[f][at], at
            sums[2 * k + 1], sums[2 * k + 2] = left, sums[k] - left
    for k in range(nodes):
        tree.value[k] = RATE * sums[k][0] / (sums[k][1] + SHRINK)
    return tree


def threshold(p: np.ndarray, y: np.ndarray, precision: float, n: np.ndarray | None = None) -> float:
    """The lowest threshold, 0.5 at least, at which ``precision`` of those above are right.

    It lies half way between the least probable one taken and the next one below. Above 1 if none is right. ``n``
    counts rows with the same values.
    """
    n = np.ones(len(p)) if n is None else n
    order = np.argsort(-p, kind="stable")
    p = p[order]
    right = np.cumsum((y * n)[order]) / np.cumsum(n[order])
    last = np.append(np.diff(p) != 0, True)[: len(order)]
    good = np.flatnonzero((right >= precision) & last)
    if not len(good):
        return 1.01
    below = p[good[-1] + 1] if good[-1] + 1 < len(p) else 0.0
    return max(0.5, float(p[good[-1]] + below) / 2)
