"""Pitman-Yor restaurants: Gibbs draws of how many tables each dish occupies, for many dishes at a time.

A restaurant serves dishes (symbols) to customers (observations). A customer of a dish sits down at one of
its tables, with weight size - d, or opens a new table, with weight (theta + d * tables of the restaurant)
times the probability of the dish in the parent restaurant. Every table is a customer of the parent. Here
the product for a new table is called the ``mass`` of a dish; it is held fixed during a draw.

Predictions need of a seating only the number of tables of each dish. Given c customers and mass a it has the
weights S(c, t) * a**t, with generalized Stirling numbers S of the discount d: all seatings with t tables
together. A draw takes t from this law at once, so it does not depend on the seating before, however many
customers there are, where moving customers one by one would hardly move a full dish.

Up to ``EXACT`` customers the law is tabulated. Beyond, t is the number of jumps of a compound Poisson process with
Sibuya(d) jump sizes, given that their sum is c; its mean and variance come from contour integrals of the
generating function, and a binomial law with these is drawn from.
"""

from __future__ import annotations

from functools import cache

import numpy as np

THETA = 1.0
EXACT = 256
#: Dishes times tables weighed at a time.
CELLS = 1 << 20
#: Up to this scale of the saddle point the contour integrals are taken, beyond the saddle point itself.
FAR = 20.0
NEAR = 1e-6


@cache
def log_stirling(d: float, most: int = EXACT) -> np.ndarray:
    """log S(c, t) for c, t up to ``most``: S(c + 1, t) = S(c, t - 1) + (c - t d) S(c, t)."""
    out = np.full((most + 1, most + 1), -np.inf)
    out[0, 0] = 0
    t = np.arange(1, most + 1)
    for c in range(most):
        with np.errstate(divide="ignore", invalid="ignore"):
            stay = np.where(t <= c, np.log(np.maximum(c - t * d, 1e-300)) + out[c, 1:], -np.inf)
        out[c + 1, 1:] = np.logaddexp(out[c, :-1], stay)
    return out


@cache
def moments(d: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Over a grid of log s: what a mean is above b, and a variance above the mean, as b and c grow together.

    With b = a / d and s = (b d / c**d) ** (1 / (1 - d)), coefficient c of (1 - x)**(k d) exp(-b (1 - x)**d) is
    c**(-1 - k d) times the integral of u**(k d) exp(u - beta u**d) around the negative axis, beta = b / c**d.
    """
    grid = np.linspace(np.log(NEAR), np.log(FAR) + 0.1, 400)
    theta = np.linspace(-8, 8, 3001)
    above, spread = [], []
    for s in np.exp(grid):
        beta = s ** (1 - d) / d
        u = max(1.0, s) * (1 + 1j * theta) ** 2
        weight = np.exp(u - beta * u**d - max(1.0, s)) * (1 + 1j * theta)
        h = [(u ** (k * d) * weight).real.sum() for k in range(3)]
        above.append(-beta * h[1] / h[0])
        spread.append(beta**2 * (h[2] / h[0] - (h[1] / h[0]) ** 2))
    return grid, np.array(above), np.array(spread)


def many(c: np.ndarray, mass: np.ndarray, d: float) -> tuple[np.ndarray, np.ndarray]:
    """Mean and variance of the number of tables of many customers."""
    b = mass / d
    with np.errstate(divide="ignore"):
        log_s = (np.log(mass) - d * np.log(c)) / (1 - d)
    grid, above, spread = moments(d)
    mean = b + np.interp(log_s, grid, above, left=1.0)
    variance = mean + np.interp(log_s, grid, spread, left=-1.0)
    far = np.flatnonzero(log_s > np.log(FAR))
    if len(far):
        # mass * x * (1 - x)**(d - 1) = c, solved for log(1 - x) by bisection; it falls with 1 - x.
        low, high = np.full(len(far), -60.0), np.zeros(len(far))
        for _ in range(60):
            middle = (low + high) / 2
            more = np.log(mass[far]) + np.log1p(-np.exp(middle)) + (d - 1) * middle > np.log(c[far])
            low, high = np.where(more, middle, low), np.where(more, high, middle)
        rest = np.exp((low + high) / 2)
        mean[far] = b[far] * (1 - rest**d)
        variance[far] = mean[far] - c[far] / (1 + (1 - d) * (1 - rest) / rest)
    return np.clip(mean, 1, c), np.maximum(variance, 0)


def draw_tables(c: np.ndarray, mass: np.ndarray, d: float, rng: np.random.Generator) -> np.ndarray:
    """A number of tables for each dish, from the law given its customers ``c`` and ``mass``."""
    c = np.asarray(c, dtype=np.int64)
    mass = np.maximum(mass, 1e-300)
    t = np.minimum(c, 1)
    table = log_stirling(d)
    order = np.argsort(c, kind="stable")
    order = order[np.searchsorted(c[order], 2) :]
    full = int(np.searchsorted(c[order], EXACT, side="right"))
    found, first = np.unique(c[order[:full]], return_index=True)
    first = [*first, full]
    for n, lo, hi in zip(found, first, first[1:], strict=False):
        tables = np.arange(1, n + 1)
        for start in range(lo, hi, max(1, CELLS // n)):
            own = order[start : min(hi, start + max(1, CELLS // n))]
            weight = table[n, 1 : n + 1] + np.log(mass[own])[:, None] * tables
            weight = np.cumsum(np.exp(weight - weight.max(axis=1, keepdims=True)), axis=1)
            t[own] = 1 + (weight[:, :-1] < (rng.random(len(own)) * weight[:, -1])[:, None]).sum(axis=1)
    own = order[full:]
    if len(own):
        mean, variance = many(c[own].astype(np.float64), mass[own], d)
        more = mean - 1
        p = np.clip(1 - variance / np.maximum(more, 1e-12), 0, 1)
        steady = p < 0.02
        n = np.maximum(np.round(more / np.maximum(p, 0.02)), 1).astype(np.int64)
        drawn = np.where(steady, rng.poisson(more), rng.binomial(n, np.clip(more / n, 0, 1)))
        t[own] = np.clip(1 + drawn, 1, c[own])
    return t


def discount_of(counts: np.ndarray, weights: np.ndarray | None = None) -> float:
    """The usual estimate n1 / (n1 + 2 n2), in hundredths and kept away from 0 and 1."""
    weights = np.ones(len(counts)) if weights is None else weights
    n1, n2 = weights[counts == 1].sum(), weights[counts == 2].sum()
    return round(float(np.clip(n1 / (n1 + 2 * n2), 0.1, 0.9)), 2) if n1 + n2 else 0.5
