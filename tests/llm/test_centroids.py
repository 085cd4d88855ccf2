"""Centroid clustering against plain integer arithmetic."""

import hashlib
import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from vhist.llm import centroids

LONG = (1 << 63) - 1


def plain(rows, k, rounds, dim, scale=256):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(scale * Fraction(x)) for x in v], v))
    key = lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[2])
    cents = [q for _, q, _ in sorted(kept, key=key)[:k]]

    def place():
        out = []
        for _, q, _ in kept:
            d = [sum((a - b) ** 2 for a, b in zip(q, c, strict=True)) for c in cents]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        at = place()
        for c in range(len(cents)):
            mine = [q for (_, q, _), (n, _) in zip(kept, at, strict=True) if n == c]
            if mine:
                cents[c] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    at = place()
    total = sum(d for _, d in at)
    out = []
    for (i, _, _), (c, d) in zip(kept, at, strict=True):
        mine = sum(e for n, e in at if n == c)
        sha = hashlib.sha256(",".join(map(str, cents[c])).encode()).hexdigest()
        out.append((i, c, min(d, LONG), min(mine, LONG), min(total, LONG), sha))
    return sorted(out, key=repr)


def frame(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for clash in ("v", "apex", "cluster", "distance", "h"):
        df = df.withColumn(clash, F.lit("clash"))
    return df.repartition(3)


def check(spark, rows, k, rounds, dim, **more):
    got = centroids.cluster_vectors(frame(spark, rows), k=k, rounds=rounds, dim=dim, **more)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain(rows, k, rounds, dim)


@pytest.mark.parametrize("seed,dim,k,pivots", [(1, 8, 5, 4), (2, 3, 7, 16), (3, 64, 12, 16), (4, 2, 4, 1), (5, 1, 3, 3)])
def test_clusters_equal_plain(spark, seed, dim, k, pivots):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 3, (4, dim))
    rows = [(i, (centres[rng.integers(4)] + rng.normal(0, 0.3, dim)).tolist()) for i in range(200)]
    rows += [(1000 + i, [float(i % 3)] * dim) for i in range(30)]  # many ties and copies
    check(spark, rows, k, 4, dim, pivots=pivots)


def test_defined_cases(spark):
    good = [(i, [float(i % 4), 1.0, -0.5]) for i in range(12)]
    rows = good + good[:5] + [(None, [0.1, 0.2, 0.3]), (None, [0.1, 0.2, 0.4])]
    rows += [(50, None), (51, []), (52, [1.0, 2.0]), (53, [1.0, None, 2.0]), (54, [float("nan"), 1.0, 1.0]), (55, [float("inf"), 1.0, 1.0])]
    check(spark, rows, 6, 3, 3)
    check(spark, rows, 100, 2, 3)  # fewer vectors than centroids
    check(spark, [(1, [1.0, 1.0])] * 7, 3, 2, 2)  # all one vector: empty centroids stay
    assert centroids.cluster_vectors(frame(spark, []), dim=3).count() == 0


def test_large_components(spark):
    rng = np.random.default_rng(6)
    rows = [(i, (rng.normal(0, 1, 3) * 10.0 ** rng.integers(0, 40)).tolist()) for i in range(60)]
    rows += [(100 + i, rng.normal(0, 1, 3).tolist()) for i in range(60)] + [(300, [1e307, -1e308, 5.0])]
    check(spark, rows, 5, 3, 3)


def test_bounds_hold(spark):
    rng = np.random.default_rng(7)
    q = centroids.integers(rng.normal(0, 1, (300, 64)))
    simplex = centroids.Simplex(q[:40])
    a = simplex.apexes(q)
    assert 2 <= len(simplex.pivots) <= centroids.PIVOTS
    near = ((a[:, None, :-1] - a[None, :40, :-1]) ** 2).sum(-1)
    true = ((q[:, None] - q[None, :40]) ** 2).sum(-1)
    lower, upper = near + (a[:, None, -1] - a[None, :40, -1]) ** 2, near + (a[:, None, -1] + a[None, :40, -1]) ** 2
    assert (lower <= true + 1e-6 * (true.max() + 1)).all() and (upper >= true - 1e-6 * (true.max() + 1)).all()
