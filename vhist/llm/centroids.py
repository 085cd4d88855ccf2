"""Exact centroid clustering with n-simplex filtering.

Components become integers, floor(scale * x).  The first centroids are the
vectors with the smallest hash of their id; each round assigns every vector to
its nearest centroid and replaces a centroid by the floor of its vectors' mean.

A few pivots (the first seeds that are not nearly dependent) span a simplex.
A vector's distances to them are cached once, as the coordinates of its apex
over that simplex.  For any two apexes the Euclidean distance is a lower bound
of the true distance, and the distance after mirroring one at the base an upper
one.  A centroid whose lower bound exceeds the smallest upper bound of a vector
cannot be its nearest; only the others are compared, in exact integers.

Centroids (k rows) are the only data that go through the driver; a task sends k
partial sums per component.

Defined cases: vectors that are null, of another length, or hold null or
non-finite components take no part and have no row.  Ties of distance go to the
smaller number.  Repeated rows are vectors of their own; seeds with one hash
are ordered by their components.  Rows without id come last among the seeds.
Fewer vectors than k give as many centroids; an empty table gives no rows.
Components too large for 64-bit sums of squares are compared as Python
integers; distances and sums beyond 2^63 - 1 are returned as that.  Columns
other than id and vector are left behind.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vhist.llm.common import written

DIM = 64
SCALE = 256
K = 40
ROUNDS = 5
SEED = 2
PIVOTS = 16
ROWS = 2048  # vectors bounded at once
_SMALL = 1 << 27  # up to this, 64 squared differences fit a long
_LONG = (1 << 63) - 1
_LIMB = 80
_SPREAD = 1e7  # vectors further away than so many times the lowest pivot are compared without bounds


def usable_vectors(vectors: DataFrame, dim: int = DIM, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, v) of the vectors that take part."""
    rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vec_col].cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(F.col("v").isNotNull() & (F.size("v") == dim)).filter(F.coalesce(finite, F.lit(False)))


def integers(x: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x): int64 where squares of all differences fit, else Python integers."""
    q = np.floor(x * scale)
    if not q.size or np.abs(q).max() < _SMALL:
        return q.astype(np.int64)
    return np.array([[math.floor(c) if math.isfinite(c) else math.floor(v) * scale for c, v in zip(r, s)] for r, s in zip(q, x)], object)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows."""
    if a.dtype == object or b.dtype == object:
        a, b = a.astype(object), b.astype(object)
    d = a - b
    return (d * d).sum(axis=1)


def _floats(d: np.ndarray) -> np.ndarray:
    if d.dtype != object:
        return d.astype(float)
    return np.array([float(x) if x < 1 << 1000 else np.nan for x in d])


class Simplex:
    """Base simplex over pivots, and apexes of vectors above it."""

    def __init__(self, seeds: np.ndarray, most: int = PIVOTS):
        self.pivots: list[int] = []
        self.base = np.zeros((0, 0))  # row i: pivot i + 1 in the first i + 1 coordinates
        self.seeds = seeds
        for i in range(len(seeds)):
            if len(self.pivots) == most:
                break
            if not self.pivots:
                self.pivots.append(i)
                continue
            apex = self.apexes(seeds[i : i + 1])[0]
            if apex[-1] > 0.05 * np.sqrt((apex * apex).sum()):  # far enough from the span of the others
                n = len(self.pivots)
                base = np.zeros((n, n))
                base[: n - 1, : n - 1] = self.base
                base[n - 1] = apex
                self.base = base
                self.pivots.append(i)

    @property
    def scale(self) -> float:
        return float((self.base * self.base).sum(axis=1).max()) if len(self.base) else 0.0

    def distances(self, q: np.ndarray) -> np.ndarray:
        """Squared distances to the pivots."""
        return np.stack([_floats(squared(q, self.seeds[p : p + 1])) for p in self.pivots], axis=1)

    def apexes(self, q: np.ndarray) -> np.ndarray:
        """Coordinates in which the base's points have the distances that the
        vector has to the pivots; the last one is the height over the base.
        Not a number where doubles cannot tell them well enough."""
        d = self.distances(q)
        if not len(self.base):
            return np.sqrt(d)
        d[d.max(axis=1) > (_SPREAD * np.diag(self.base).min()) ** 2] = np.nan
        rhs = (d[:, :1] + (self.base * self.base).sum(axis=1) - d[:, 1:]) / 2
        x = np.linalg.solve(self.base, rhs.T).T
        height = np.sqrt(np.maximum(d[:, 0] - (x * x).sum(axis=1), 0))
        return np.concatenate([x, height[:, None]], axis=1)


def candidates(apexes: np.ndarray, centroid_apexes: np.ndarray, scale: float = 0.0) -> np.ndarray:
    """Which centroids may be nearest: rows x centroids.  ``scale`` is the
    largest squared length of the base's points."""
    near = np.zeros((len(apexes), len(centroid_apexes)))
    for i in range(apexes.shape[1] - 1):
        near += (apexes[:, i : i + 1] - centroid_apexes[:, i]) ** 2
    h, g = apexes[:, -1:], centroid_apexes[:, -1]
    lower, upper = near + (h - g) ** 2, near + (h + g) ** 2
    size = (apexes * apexes).sum(axis=1)[:, None] + (centroid_apexes * centroid_apexes).sum(axis=1)
    slack = 1e-6 * (size + scale)  # far above the rounding of the coordinates
    upper = np.where(np.isnan(upper), np.inf, upper + slack).min(axis=1)[:, None]
    return ~(lower - slack > upper)  # what cannot be bounded is compared


def nearest(q: np.ndarray, apexes: np.ndarray, centroids: np.ndarray, centroid_apexes: np.ndarray, scale: float = 0.0):
    """(number, squared distance) of each row's nearest centroid, exactly."""
    row, number = np.nonzero(candidates(apexes, centroid_apexes, scale))
    d = squared(q[row], centroids[number])
    starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    best = np.minimum.reduceat(d, starts)
    hit = np.flatnonzero(d == np.repeat(best, np.diff(np.r_[starts, len(row)])))
    first = hit[np.r_[True, row[hit[1:]] != row[hit[:-1]]]]
    return number[first], best


def _blocks(rows, dim: int, scale: int):
    """(ids, integer vectors, apexes or None) of at most ROWS rows."""
    for batch in rows:
        for s in range(0, batch.num_rows, ROWS):
            part = batch.slice(s, ROWS)
            v = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, dim)
            apex = part.column(2).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1) if part.num_columns > 2 else None
            yield part.column(0), integers(v, scale), apex


def _lists(m: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(0, m.size + 1, m.shape[1], dtype=np.int32), m.ravel())


def _with_apexes(kept: DataFrame, simplex: Simplex, dim: int, scale: int) -> DataFrame:
    def run(rows):
        for batch in rows:
            for s in range(0, batch.num_rows, ROWS):
                part = batch.slice(s, ROWS)
                (_, q, _), = _blocks([part], dim, scale)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), _lists(simplex.apexes(q))], names=["vec_id", "v", "apex"])

    return kept.mapInArrow(run, "vec_id long, v array<double>, apex array<double>")


def _means(placed: DataFrame, centroids: np.ndarray, simplex: Simplex, dim: int, scale: int) -> np.ndarray:
    """The next centroids: floors of the means of the vectors nearest to each."""
    centroid_apexes = simplex.apexes(centroids)

    def run(rows):
        k = len(centroids)
        n, total = np.zeros(k, np.int64), np.zeros((k, dim), object)
        for _, q, apex in _blocks(rows, dim, scale):
            number, _ = nearest(q, apex, centroids, centroid_apexes, simplex.scale)
            n += np.bincount(number, minlength=k)
            order = np.argsort(number, kind="stable")
            found, at = np.unique(number[order], return_index=True)
            total[found] += np.add.reduceat(q[order], at, axis=0).astype(object)
        for c in np.flatnonzero(n).tolist():
            cells = [(c, at, limb, str(x)) for at, t in enumerate([*total[c], n[c]]) for limb, x in _limbs(int(t))]
            columns = zip(*cells, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types, strict=True)], names=["cluster", "at", "limb", "total"])

    types = [pa.int32(), pa.int32(), pa.int32(), pa.string()]
    parts = placed.mapInArrow(run, "cluster int, at int, limb int, total string")
    sums = parts.groupBy("cluster", "at", "limb").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    cells: dict = {}
    for r in sums.collect():  # k x (dim + 1) rows; more limbs only for components beyond 2^80
        cells[r.cluster, r.at] = cells.get((r.cluster, r.at), 0) + (int(r.total) << (_LIMB * r.limb))
    out = [[cells[c, i] // cells[c, dim] for i in range(dim)] if (c, dim) in cells else [int(x) for x in centroids[c]] for c in range(len(centroids))]
    return _exact(out)


def _limbs(total: int) -> list[tuple[int, int]]:
    """A whole number as (position, signed part below 2^80), so that sums of any size fit decimals."""
    sign, rest, out = (-1 if total < 0 else 1), abs(total), []
    while rest or not out:
        out.append((len(out), sign * (rest & ((1 << _LIMB) - 1))))
        rest >>= _LIMB
    return out


def _exact(rows: list[list[int]]) -> np.ndarray:
    wide = any(abs(x) >= _SMALL for r in rows for x in r)
    return np.array(rows, object if wide else np.int64)


def cluster_vectors(
    vectors: DataFrame,
    k: int = K,
    rounds: int = ROUNDS,
    dim: int = DIM,
    scale: int = SCALE,
    seed: int = SEED,
    pivots: int = PIVOTS,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    kept = usable_vectors(vectors, dim, id_col, vec_col)
    spark = kept.sparkSession
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = kept.withColumn("h", key).orderBy(F.col("h").asc_nulls_last(), "v").limit(k).collect()  # k rows
    if not first:
        return spark.createDataFrame([], schema)
    centroids = _exact([[int(x) for x in r] for r in integers(np.array([r.v for r in first]), scale)])
    simplex = Simplex(centroids, pivots)
    placed = written(_with_apexes(kept, simplex, dim, scale), "apexes")
    for _ in range(rounds):
        centroids = _means(placed, centroids, simplex, dim, scale)
    centroid_apexes = simplex.apexes(centroids)
    texts = [",".join(str(int(x)) for x in c) for c in centroids]
    sha = [hashlib.sha256(t.encode()).hexdigest() for t in texts]

    def assign(rows):
        for ids, q, apex in _blocks(rows, dim, scale):
            number, d = nearest(q, apex, centroids, centroid_apexes, simplex.scale)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(number, pa.int32()), pa.array([min(int(x), _LONG) for x in d.tolist()], pa.int64())], names=["vec_id", "cluster", "distance"]
            )

    rows = written(placed.mapInArrow(assign, "vec_id long, cluster int, distance long"), "assigned")
    sums = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()  # k rows
    total = sum(int(r.s) for r in sums)
    info = [(int(r.cluster), min(int(r.s), _LONG), min(total, _LONG), sha[r.cluster]) for r in sums]
    info = spark.createDataFrame(info, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(info), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
