"""Connected components of an edge table, by alternating large and small stars.

Every round links each node's larger neighbours, then its smaller ones, to the
smallest node it sees; the number of rounds grows with the logarithm of the
longest path.  Minima are aggregated map-side; the joins read written tables,
so that a node with very many neighbours is split as a skewed join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vhist.llm.common import written

MAX_ROUNDS = 60


def _state(edges: DataFrame):
    r = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("x")).first()
    return r.n, r.x


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long): the root is the
    smallest node of its component.  Self-edges and repeated edges are allowed;
    no edge gives no row."""
    nodes = edges.filter("a = b").select(F.col("a").alias("node"))
    e = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = written(e, "edges")
    state = _state(e)
    for _ in range(MAX_ROUNDS):
        if not state[0]:
            break
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = written(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")), "least")
        large = written(both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "large")
        least = written(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = written(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
        before, state = state, _state(e)
        if state == before:
            break
    else:
        raise RuntimeError(f"no fixed point after {MAX_ROUNDS} rounds")
    stars = e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("root")))
    alone = nodes.select("node", F.col("node").alias("root"))
    return stars.unionByName(alone).groupBy("node").agg(F.min("root").alias("root"))
