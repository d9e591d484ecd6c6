"""Centroid clustering against brute force."""

import hashlib
import itertools
import math

import numpy as np

from voltlake.llm import clustering

SCHEMA = "vec_id bigint, embedding array<float>, label int, cluster string, place string, v string, ids string"


def brute(rows, clusters=40, rounds=5, dimensions=64):
    kept = [
        (i, [math.floor(256 * float(x)) for x in v])
        for i, v in rows
        if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)
    ]
    if not kept:
        return []
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in first[:clusters]]

    def nearest():
        out = []
        for _, v in kept:
            distances = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centroids]
            out.append((distances.index(min(distances)), min(distances)))
        return out

    for _ in range(rounds):
        at = nearest()
        for k in range(len(centroids)):
            own = [v for (_, v), (c, _) in zip(kept, at, strict=True) if c == k]
            if own:
                centroids[k] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    at = nearest()
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    inertia = [sum(d for c, d in at if c == k) for k in range(len(centroids))]
    return sorted(
        ((i, c, d, inertia[c], sum(inertia), digest[c]) for (i, _), (c, d) in zip(kept, at, strict=True)), key=repr
    )


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "a", "b", "c", "d") for i, v in rows], SCHEMA).repartition(3)


def results(rows):
    return sorted(map(tuple, rows.collect()), key=repr)


def vectors(n, dimensions=64, groups=6, seed=3, spread=0.02):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(groups, dimensions)) / 8
    x = middle[rng.integers(groups, size=n)] + spread * rng.normal(size=(n, dimensions))
    return [(k, [float(v) for v in row]) for k, row in enumerate(x.astype(np.float32))]


def test_neighbours_on_the_curve_are_neighbours_in_space():
    for axes, bits in ((2, 5), (3, 3), (5, 2), (1, 4)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=axes)))
        place = clustering.hilbert(cells, bits)
        assert sorted(place) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(place)], axis=0)).sum(axis=1) == 1).all()


def test_boxes_keep_every_nearest_centroid_and_skip_most_of_the_others():
    x = np.array([[math.floor(256 * v) for v in row] for _, row in vectors(2_000)])
    centroids = x[::50]
    kept = 0
    for group in range(0, len(x), 10):
        own = x[group : group + 10]
        found = clustering.candidates(own.min(axis=0), own.max(axis=0), centroids)
        distance = ((own[:, None] - centroids) ** 2).sum(axis=2)
        ties = np.flatnonzero((distance == distance.min(axis=1)[:, None]).any(axis=0))
        assert set(ties) <= set(found)
    for k in range(6):  # a tight box among far groups
        own = x[((x - x[k]) ** 2).sum(axis=1) < 3_000]
        kept += len(clustering.candidates(own.min(axis=0), own.max(axis=0), centroids))
    assert kept < 6 * len(centroids) / 2


def test_against_brute_force(spark):
    rows = vectors(700)
    rows += [(10_000 + k, rows[5][1]) for k in range(300)]  # copies, and so ties
    got = results(clustering.clusters(table(spark, rows), block=64))
    assert got == brute(rows)


def test_awkward_rows(spark):
    rows = vectors(30, spread=1.0)
    nan, inf = float("nan"), float("inf")
    rows += [
        (100, None),
        (101, []),
        (102, [0.5] * 63),
        (103, [0.5] * 65),
        (104, [0.5] * 63 + [nan]),
        (105, [-inf] + [0.5] * 63),
        (106, [None] + [0.5] * 63),
        (107, [1e30] * 63 + [inf]),
        (108, [20_000.25] * 32 + [-20_000.75] * 32),  # beyond exact products of doubles
        (109, [-0.0] * 64),
        (None, [0.25] * 64),
        (None, [0.125] * 64),
        *[(7, rows[7][1])] * 3,
    ]
    assert results(clustering.clusters(table(spark, rows))) == brute(rows)
    assert results(clustering.clusters(table(spark, rows), clusters=3)) == brute(rows, clusters=3)
    assert clustering.clusters(table(spark, [(1, None), (2, [0.0])])).isEmpty()
    assert clustering.clusters(spark.createDataFrame([], SCHEMA)).isEmpty()
    # Squared distances of such vectors exceed 64 bits.
    assert clustering.clusters(table(spark, [(1, [3e38] * 64)])).isEmpty()
