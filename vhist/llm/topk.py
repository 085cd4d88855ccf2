"""Exact top-k inner products over norm-sorted vectors.

Components become floor(1024 x).  Candidates are processed by descending
length: a candidate whose length times the query's cannot reach the query's
k-th best score so far ends the block for that query.  Vectors are rotated by
the eigenvectors of the corpus' second-moment matrix (its SVD), so a few
leading components carry most of an inner product; the rest is bounded by
Cauchy-Schwarz on the residual lengths, and only what passes that bound is
scored exactly, in integers.

Queries go in blocks of about ``query_block`` vectors, each block against all
rows; a block's result is written before the next one is sent, so neither the
plan nor what the driver holds grows with the queries.  The first thresholds
come from a search of the longest ``seeds`` vectors.  Each partition returns at
most k rows per query.

Defined cases: null vectors, and vectors holding null or non-finite
components, take no part; neither do rows without id.  Rows repeated under one
id are rows of their own: each is a candidate, and each one that is a query
gets its own k rows.  Shorter vectors count as padded with zeros.  Ties go to the smaller vec_id.  Components and scores
that a long cannot hold are cut to plus or minus 2^63 - 1.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vhist.llm.common import batches, discard, kept, scratch_path

SCALE = 1024
QUERY_BLOCK = 4096
SEEDS = 4096
HEAD = 16  # rotated components of the partial sum
CELLS = 4 << 20  # scores held at once

_FOUND = "query_row long, query_id long, vec_id long, score long"
_EXACT = float(1 << 53)


def integer_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, v: array<double> of whole numbers, norm), a row per usable row."""
    whole = lambda y: F.when(F.abs(y) < _EXACT, F.floor(y).cast("double")).otherwise(y)  # noqa: E731 -- larger doubles are whole
    v = F.transform(F.col("v"), lambda x: whole(x.cast("double") * SCALE))
    finite = F.forall(F.col("v"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vec_col].cast("array<double>").alias("v"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).filter(F.coalesce(finite, F.lit(False)))
    rows = rows.select("vec_id", v.alias("v"))
    return rows.withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)))


def _matrix(lists, width: int) -> np.ndarray:
    out = np.zeros((len(lists), width))
    for i, x in enumerate(lists):
        out[i, : len(x)] = x
    return out


def rotation(rows: DataFrame, width: int) -> np.ndarray:
    """Eigenvectors of the sum of outer products, largest first: width x width."""

    def moments(batches_):
        total = np.zeros((width, width))
        for (vs,) in batches(batches_, "v"):
            m = _matrix(vs, width)
            m /= np.maximum(1.0, np.abs(m).max(axis=1, initial=0.0))[:, None]  # only directions matter
            total += m.T @ m
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "row"])

    parts = rows.select("v").mapInArrow(moments, "i int, row array<double>")
    sums = parts.select("i", F.posexplode("row").alias("j", "x")).groupBy("i", "j").agg(F.sum("x").alias("x"))
    total = np.zeros((width, width))
    for r in sums.collect():  # width squared numbers
        total[r.i, r.j] = r.x
    return np.linalg.eigh(total)[1][:, ::-1]


def _exact(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products of matching rows as integers."""
    if (np.abs(q).max(initial=0) * np.abs(c).max(initial=0)) * q.shape[1] < _EXACT:
        return np.einsum("ij,ij->i", q, c).astype(np.int64)
    top, low = (1 << 63) - 1, 1 - (1 << 63)  # negating either stays in range
    return np.array([min(top, max(low, sum(int(x) * int(y) for x, y in zip(a, b)))) for a, b in zip(q, c)], np.int64)


class _Best:
    """The k best (score, vec_id) per query so far; equal pairs of different rows count each."""

    def __init__(self, floor: np.ndarray, k: int):
        self.k, self.floor = k, floor.copy()  # no score below the floor can be among the k best
        self.found: dict[int, list] = {}

    def add(self, which: np.ndarray, ids: np.ndarray, scores: np.ndarray):
        order = np.lexsort((ids, -scores, which))
        which, ids, scores = which[order], ids[order], scores[order]
        starts = np.flatnonzero(np.r_[True, which[1:] != which[:-1]]) if len(which) else []
        for s, e in zip(starts, [*starts[1:], len(which)]):
            q = int(which[s])
            e = min(e, s + self.k)
            merged = sorted([*self.found.get(q, []), *zip((-scores[s:e]).tolist(), ids[s:e].tolist())])[: self.k]
            self.found[q] = merged
            if len(merged) == self.k:
                self.floor[q] = max(self.floor[q], -merged[-1][0])


def _search(own, ids, vectors, norms, queries, best: _Best, turn, head: int):
    """One batch of candidates (``own``: their row ids) against one block of queries."""
    q_own, _, q, q_norms, q_turned, q_rest = queries
    order = np.argsort(-norms, kind="stable")
    own, ids, vectors, norms = own[order], ids[order], vectors[order], norms[order]
    turned = vectors @ turn
    rest = np.sqrt(np.maximum(0.0, norms**2 - (turned[:, :head] ** 2).sum(1)))
    step = max(1, CELLS // max(1, len(q_own)))
    for s in range(0, len(ids), step):
        part = slice(s, s + step)
        # by length: queries whose floor even the longest vector of this part cannot reach are done
        slack = 1e-9 * (1.0 + q_norms * norms[s])
        open_ = np.flatnonzero(q_norms * norms[s] + slack >= best.floor)
        if not len(open_):
            return
        bound = q_turned[open_, :head] @ turned[part, :head].T + q_rest[open_, None] * rest[None, part]
        bound = np.maximum(bound, -(2.0**63))  # scores are cut there
        a, b = np.nonzero((bound + slack[open_, None] + 1e-6 >= best.floor[open_, None]) & (q_own[open_, None] != own[None, part]))
        for k in range(0, len(a), 1 << 16):
            which, at = open_[a[k : k + (1 << 16)]], b[k : k + (1 << 16)] + s
            scores = _exact(q[which], vectors[at])
            keep = scores >= best.floor[which]
            best.add(which[keep], ids[at[keep]], scores[keep])


def _block(queries: list, width: int, turn: np.ndarray, head: int):
    q = _matrix([r.v for r in queries], width)
    norms = np.sqrt((q**2).sum(1))
    turned = q @ turn
    rest = np.sqrt(np.maximum(0.0, norms**2 - (turned[:, :head] ** 2).sum(1)))
    return np.array([r.row_id for r in queries], np.int64), np.array([r.vec_id for r in queries], np.int64), q, norms, turned, rest


def _matches(rows: DataFrame, sent, k: int, width: int, head: int) -> DataFrame:
    """The k best of each partition of ``rows`` per query of the sent (block, floor, turn)."""

    def search(parts):
        block, floor, turn = sent.value
        best = _Best(floor, k)
        for own, ids, vs in batches(parts, "row_id", "vec_id", "v"):
            m = _matrix(vs, width)
            _search(np.array(own, np.int64), np.array(ids, np.int64), m, np.sqrt((m**2).sum(1)), block, best, turn, head)
        out = [(int(block[0][q]), int(block[1][q]), i, -s) for q, x in best.found.items() for s, i in x]
        cols = list(zip(*out)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["query_row", "query_id", "vec_id", "score"])

    return rows.select("row_id", "vec_id", "v").mapInArrow(search, _FOUND)


def _floors(longest: DataFrame, block, turn, k: int, width: int, head: int) -> np.ndarray:
    """Each query's k-th best score among the longest vectors (minus infinity where they are fewer)."""
    sent = longest.sparkSession.sparkContext.broadcast((block, np.full(len(block[0]), -np.inf), turn))
    scores = F.sort_array(F.collect_list("score"), asc=False)  # at most k per query and partition of a bounded table
    kth = _matches(longest, sent, k, width, head).groupBy("query_row").agg(F.get(scores, F.lit(k - 1)).alias("s"))
    found = {r.query_row: r.s for r in kth.filter("s IS NOT NULL").collect()}  # a number per query of the block
    sent.destroy()
    return np.array([found.get(int(q), -np.inf) for q in block[0]], float)


def top_inner_products(
    vectors: DataFrame, k: int = 10, query_mod: int = 100, query_block: int = QUERY_BLOCK, seeds: int = SEEDS,
    id_col: str = "vec_id", vec_col: str = "embedding",
) -> DataFrame:
    """Each query's k best candidates: query_id, rank, vec_id, score.

    Queries are the rows whose id is divisible by ``query_mod``; candidates are
    all rows but the query's own.
    """
    spark = vectors.sparkSession
    # longest first, in ranges of length, so that later partitions hold short vectors; row ids are fixed by the write
    ordered = integer_vectors(vectors, id_col, vec_col).repartitionByRange(F.col("norm").desc(), F.col("vec_id")).sortWithinPartitions(F.col("norm").desc(), "vec_id")
    rows, _ = kept(ordered.withColumn("row_id", F.monotonically_increasing_id()), "vectors")
    width = rows.agg(F.max(F.size("v"))).first()[0] or 0
    if width == 0:
        rows = rows.withColumn("v", F.array(F.lit(0.0)))
        width = 1
    head = min(HEAD, width)
    turn = rotation(rows, width)
    longest, seeds_path = kept(rows.orderBy(F.col("norm").desc(), "row_id").limit(seeds), "longest")
    queries = rows.filter(F.col("vec_id") % query_mod == 0)
    blocks = max(1, -(-queries.count() // query_block))
    path = scratch_path(spark, "found")
    for n in range(blocks):
        block = _block(queries.filter(F.pmod(F.xxhash64("row_id"), F.lit(blocks)) == n).collect(), width, turn, head)
        sent = spark.sparkContext.broadcast((block, _floors(longest, block, turn, k, width, head), turn))
        _matches(rows, sent, k, width, head).write.mode("append").parquet(path)
        sent.destroy()
    discard(spark, seeds_path)
    order = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id")
    ranked = spark.read.schema(_FOUND).parquet(path).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
