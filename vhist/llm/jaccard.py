"""Near-duplicate documents: Jaccard join of word shingles by chosen paths.

A document is the set of its shingles of five consecutive words (all its words
if it has fewer).  Documents with equal sets are one member of the join.  A
run picks from each set the shared tokens whose hash is below 1 / (c |x|), so
similar sets expect about one common pick; a pick puts the set into that
token's bucket.  Buckets of more than ``limit`` members are split again by
picks under a hash of the path so far, down to ``depth`` levels; what still is
large, and what no pick breaks up (a large group of near copies), is cut into
blocks; large buckets that hold nearly the same members (a group of near copies
shares most picks) are tried and cut as one.  Of small buckets,
members whose size allows no link there and buckets that lie within another
one are left out, which loses no pair.  Members of a
small bucket first send a sketch of their set, some four bits a token, which
bounds each intersection from above; only those that may have a partner there
send the set itself; other sketches are not exchanged either.  A set is known by
the hash of one of its texts.  Their texts are found again by a Bloom filter of
text and id, so other texts are not exchanged, and go to the bucket of that hash,
so that each task writes one file of sets, which every later join reads in place.  Small buckets and
pairs of blocks are compared by brute force with exact intersections.  Runs
are repeated until a pair at the threshold is found with the target recall,
even where all its buckets are split down to the last level.

Pairs are never written.  A bucket returns, per member, the smallest member it
is connected with there and its number of links; a pair that meets in several
buckets counts in the first one only, which each member's bucket list tells.

Result: one row per document row: doc_id, class_id (smallest doc_id of the
connected class; its own where it has no link), n_links (document rows linked
to it directly, equal sets included).

Defined cases: null texts, and texts without words, link to nothing; rows
repeated under one id are rows of their own (exact copies of each other, if
their texts are); a null doc_id counts as a row, and never names a class that
has an id; an empty table gives no row; where two sets' texts have the same hash,
all texts are hashed anew with another seed.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vhist.llm.common import batches, bucketed, discard, kept, text_rows, words_of, written
from vhist.llm.components import components
from vhist.llm.sieve import Sieve

WORDS = 5
SIMILARITY = 0.8
TARGET_RECALL = 0.9999  # of a pair at the threshold that every level must keep
DEPTH = 3
DEEPER = 3  # times as many picks at the levels below the first
LIMIT = 256  # members of a bucket that is compared at once
SEEDS = 8  # of text hashes, tried until no two sets have the same
BLOCK = 1024  # members of a block of a bucket that no pick splits
CELLS = 2 << 20  # cells of an incidence matrix held at once
ROWS = 256  # rows of a pair matrix worked on at once
BITS = 4  # bits of a sketch per token, about
MOST_BITS = 1 << 14  # of a sketch; larger sets fill theirs more

_MIX = np.uint64(0x9E3779B97F4A7C15)
_random = np.random.default_rng(23)
_BYTE = _random.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0xD1342543DE82EF95)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out, dtype=np.uint64)


_POWERS = {"n": 0}


def _power_tables(n: int):
    if _POWERS["n"] < n:
        size = max(n, 1 << 16)
        _POWERS.update(n=size, up=_powers(_BASE, size), down=_powers(_BASE_INVERSE, size))
    return _POWERS["up"][:n], _POWERS["down"]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * _MIX
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def shingle_set(raw: bytes, words: int = WORDS) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's shingles."""
    w = words_of(raw)
    if not w:
        return np.zeros(0, np.uint64)
    text = b" ".join(w)
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1)  # one past each word's space
    starts = ends - np.fromiter(map(len, w), np.int64, len(w)) - 1
    k = min(words, len(w))
    up, down = _power_tables(len(text) + 1)
    sums = np.zeros(len(text) + 1, np.uint64)
    np.cumsum(_BYTE[np.frombuffer(text, np.uint8)] * up[: len(text)], dtype=np.uint64, out=sums[1:])
    s, e = starts[: len(w) - k + 1], ends[k - 1 :] - 1
    return np.unique(_mixed((sums[e] - sums[s]) * down[s]))


def runs_for(recall: float, depth: int, factor: float, deeper: float = 1.0) -> int:
    """Runs after which a pair at the threshold, of which about 1/factor picks
    are shared at the first level and ``deeper`` times as many at each further
    one, is found with probability ``recall`` at any depth."""
    alive = 1.0
    for level in range(depth, 0, -1):  # survival of a branching process with Poisson offspring
        alive = 1 - math.exp(-alive * (deeper if level > 1 else 1.0) / factor)
    return math.ceil(math.log(1 - recall) / math.log(1 - alive))


def _odd(seed: int) -> np.uint64:
    return np.uint64(xxhash.xxh64_intdigest(seed.to_bytes(8, "little", signed=True), seed=7) | 1)


def _picks(tokens: np.ndarray, path: int, factor: float) -> np.ndarray:
    """Paths that a set's picks under ``path`` lead to (signed 64-bit)."""
    rank = tokens * _odd(path)
    bound = min(float(1 << 64) - 2049, float(1 << 64) / (factor * len(tokens)))
    chosen = tokens[rank < np.uint64(int(bound))]
    return _mixed(chosen ^ _odd(path ^ 0x5DEECE66D)).view(np.int64)


def _first_paths(tokens: np.ndarray, runs: int, factor: float) -> np.ndarray:
    if len(tokens) < 4:  # smaller sets reach no similarity of 0.8 but with equal sets
        return np.zeros(0, np.int64)
    return np.unique(np.concatenate([_picks(tokens, -1 - r, factor) for r in range(runs)]))


def sketch(tokens: np.ndarray) -> bytes:
    """A set's tokens as the bits of a small map, whose length is a power of two
    of eight at least.  Folding a map in half gives the map of half the length."""
    bits = 64
    while bits < min(BITS * len(tokens), MOST_BITS):
        bits *= 2
    out = np.zeros(bits, bool)
    out[(_mixed(tokens) & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(out).tobytes()


def possible(sketches: list[bytes], sizes: np.ndarray, similarity: float) -> np.ndarray:
    """Members that may be similar enough to another one.  A bit that x has and y
    lacks is a token of x outside y, so their sizes bound the intersection."""
    width = min(map(len, sketches))
    folded = []
    for s in sketches:
        x = np.frombuffer(s, np.uint8)
        folded.append(np.bitwise_or.reduce(x.reshape(-1, width), axis=0))
    x = np.unpackbits(np.stack(folded), axis=1).astype(np.float32)
    both, own = x @ x.T, x.sum(1)
    most = np.minimum(sizes[:, None] - (own[:, None] - both), sizes[None, :] - (own[None, :] - both))
    may = most >= similarity * (sizes[:, None] + sizes[None, :] - most) - 1e-6
    np.fill_diagonal(may, False)
    return may.any(1)


def _hopeful(assigned: DataFrame, sketches: DataFrame, similarity: float) -> DataFrame:
    """(bucket, node) of small buckets without the members that no other one of
    the bucket can be similar enough to: they need not send their sets."""

    def run(rows):
        bucket, held = None, []

        def done():
            if len(held) < 2:
                return []
            nodes, sizes, sketches = zip(*held)
            may = possible(list(sketches), np.array(sizes, np.float64), similarity)
            return [(bucket, n) for n, m in zip(nodes, may.tolist()) if m]

        def found(out):
            cols = list(zip(*out)) or [()] * 2
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["bucket", "node"])

        for cols in batches(rows, "bucket", "node", "size", "sketch"):
            out = []
            for b, node, size, bits in zip(*cols):
                if b != bucket:
                    out += done()
                    bucket, held = b, []
                held.append((node, size, bits))
            yield found(out)
        yield found(done())

    rows = assigned.join(sketches, "node").select("bucket", "node", "size", "sketch")
    return rows.repartition("bucket").sortWithinPartitions("bucket", "node").mapInArrow(run, "bucket long, node long")


def _named(documents: DataFrame, id_col: str, seed: int) -> DataFrame:
    """doc_id, raw, and the hash of the text by which a set is known: node."""
    return text_rows(documents, id_col).withColumn("node", F.xxhash64(F.lit(seed), "raw"))


def _members(documents: DataFrame, runs: int, factor: float, words: int, id_col: str, seed: int) -> DataFrame:
    """node, doc_id, set key (null without words), set size, paths, sketch."""

    def run(rows):
        for nodes, ids, raws in batches(rows, "node", "doc_id", "raw"):
            sets = [shingle_set(r, words) for r in raws]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(nodes, pa.int64()), pa.array(ids, pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                    pa.array([len(s) for s in sets], pa.int32()), pa.array([_first_paths(s, runs, factor) for s in sets], pa.list_(pa.int64())),
                    pa.array([sketch(s) for s in sets], pa.binary()),
                ],
                names=["node", "doc_id", "key", "size", "paths", "sketch"],
            )

    return _named(documents, id_col, seed).mapInArrow(run, "node long, doc_id long, key binary, size int, paths array<long>, sketch binary")


def _sets_of(documents: DataFrame, runs: int, factor: float, words: int, id_col: str):
    """(seed, members, path, distinct sets, path): ``node`` names one set each.

    A set's row is that of its smallest text hash, with an id if there is one."""
    for seed in range(SEEDS):
        members, members_path = kept(_members(documents, runs, factor, words, id_col, seed), "members")
        reps, reps_path = kept(
            members.filter("key is not null").groupBy("key").agg(
                F.min(F.struct("node", F.col("doc_id").isNull().alias("none"), "doc_id")).alias("rep"), F.min("doc_id").alias("smallest"), F.count("*").alias("copies"), F.first("size").alias("size"), F.first("paths").alias("paths"), F.first("sketch").alias("sketch")
            ).select("key", "rep.node", "rep.doc_id", "smallest", "copies", "size", "paths", "sketch"),
            "reps",
        )
        if reps.groupBy("node").count().filter("count > 1").isEmpty():
            return seed, members, members_path, reps, reps_path
        discard(documents.sparkSession, members_path, reps_path)
    raise RuntimeError(f"texts of different sets have equal hashes under each of {SEEDS} seeds")


def _candidate_sets(documents: DataFrame, wanted: DataFrame, words: int, id_col: str, seed: int) -> DataFrame:
    """node, copies, size, tokens (bytes) and sketch of the wanted (node, doc_id,
    key, copies), dealt and sorted by node.

    Rows whose text hash and id are certainly not wanted stay where they are, so
    copies of a wanted text are not exchanged."""

    def run(rows):
        last = None
        for nodes, copies, keys, raws in batches(rows, "node", "copies", "key", "raw"):
            out = []
            for node, n, key, raw in zip(nodes, copies, keys, raws):
                if node == last:
                    continue
                tokens = shingle_set(raw, words)
                if xxhash.xxh3_128_digest(tokens.tobytes()) == key:  # another text may have this hash
                    out.append((node, n, len(tokens), tokens.tobytes(), sketch(tokens)))
                    last = node
            cols = list(zip(*out)) or [()] * 5
            types = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["node", "copies", "size", "tokens", "sketch"])

    spot = F.xxhash64("node", "doc_id").alias("spot")
    docs = Sieve(wanted.select(spot), "spot").passing(_named(documents, id_col, seed).select("node", "raw", spot), "spot")
    buckets = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # as ``bucketed`` has
    met = docs.select("node", "raw").repartition(buckets, "node").join(wanted.select("node", "copies", "key"), "node").sortWithinPartitions("node")
    return met.select("node", "copies", "key", "raw").mapInArrow(run, "node long, copies long, size int, tokens binary, sketch binary")


def _children(big: DataFrame, sets: DataFrame, factor: float) -> DataFrame:
    """(path, node, size, parent) one pick further down from (path, node)."""

    def run(rows):
        for nodes, tokens, paths in batches(rows, "node", "tokens", "paths"):
            out_nodes, out_paths, out_sizes, out_parents = [], [], [], []
            for node, t, ps in zip(nodes, tokens, paths):
                t = np.frombuffer(t, np.uint64)
                each = [_picks(t, p, factor) for p in ps]
                got = np.concatenate(each)
                out_nodes.append(np.full(len(got), node))
                out_paths.append(got)
                out_parents.append(np.repeat(np.array(ps, np.int64), [len(x) for x in each]))
                out_sizes.append(np.full(len(got), len(t)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x) if x else [], pa.int64()) for x in (out_paths, out_nodes, out_sizes, out_parents)], names=["path", "node", "size", "parent"]
            )

    per = big.groupBy("node").agg(F.collect_list("path").alias("paths"))
    return sets.select("node", "tokens").join(per, "node").mapInArrow(run, "path long, node long, size long, parent long").distinct()


def _united(big: DataFrame) -> DataFrame:
    """``big`` with the ``unit`` of each bucket: the bucket that three quarters of
    its members at least have as their largest, and that has itself as its unit;
    else the bucket itself."""
    top = big.groupBy("node").agg(F.max(F.struct("n", "path")).alias("top")).select("node", F.col("top.path").alias("unit"))
    votes = big.join(top, "node").groupBy("path", "unit").agg(F.count("*").alias("k"), F.first("n").alias("n"))
    votes = written(votes.filter("4 * k >= 3 * n").select("path", "unit"), "votes")
    units = votes.filter("path <> unit").join(votes.filter("path = unit").select("unit"), "unit", "left_semi")
    return big.join(units, "path", "left").withColumn("unit", F.coalesce("unit", "path"))


def _split(big: DataFrame, sets: DataFrame, factor: float):
    """(path, n, node) of buckets that no pick breaks up, and the children of the
    others: a bucket of which one child still has half the members is compared as
    it is, in blocks, which loses no pair, instead of once per child.

    Buckets of one unit are tried as one, with all their members; where that
    breaks up, each of them has children of its own."""
    big = written(_united(big), "units")
    units = written(big.groupBy("unit", "node").agg(F.first("size").alias("size")).withColumnRenamed("unit", "path"), "members")
    children = written(_children(units, sets, factor), "children")
    sizes = children.groupBy("parent", "path").agg(F.count("*").alias("k")).groupBy("parent").agg(F.max("k").alias("k"))
    own = units.groupBy("path").agg(F.count("*").alias("n"))
    whole = written(sizes.join(own, sizes["parent"] == own["path"]).filter("2 * k >= n").select("path", "n"), "whole")
    again = written(big.filter("path <> unit").join(whole.select(F.col("path").alias("unit")), "unit", "left_anti").select("path", "node"), "again")
    rest = children.join(whole, children["parent"] == whole["path"], "left_anti").drop("parent")
    if not again.isEmpty():
        rest = rest.unionByName(_children(again, sets, factor).drop("parent"))
    return units.join(whole, "path").select("path", "n", "node"), rest


def _met(rows: DataFrame) -> DataFrame:
    """(path, node, size, n) of the buckets with at least two members."""
    rows, picks = kept(rows, "picks")
    counts, own = kept(rows.groupBy("path").agg(F.count("*").alias("n")).filter("n > 1"), "counts")
    met = written(rows.join(counts, "path"), "met")
    discard(rows.sparkSession, picks, own)
    return met


def _buckets(small: DataFrame, similarity: float) -> DataFrame:
    """(nodes, bucket) of small buckets: members that no other's size lets be
    similar enough leave, and buckets with the same members are one."""
    by_size = small.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("size", "node"))).alias("m"))
    close = lambda a, b: F.coalesce(a["size"] >= similarity * b["size"] - 1e-6, F.lit(False))
    near = F.filter("m", lambda x, i: (close(F.get("m", i - 1), x) & (i > 0)) | close(x, F.get("m", i + 1)))
    lists = by_size.select("path", F.array_sort(F.transform(near, lambda x: x["node"])).alias("nodes")).filter(F.size("nodes") > 1)
    return lists.groupBy("nodes").agg(F.min("path").alias("bucket"))


def _largest(buckets: DataFrame) -> DataFrame:
    """(bucket, node) without the buckets whose members all have one other as
    their largest bucket, which compares their pairs too."""
    own = buckets.groupBy("nodes").agg(F.min("bucket").alias("bucket")).select("bucket", F.size("nodes").alias("n"), F.explode("nodes").alias("node"))
    own = written(own, "members")
    top = own.groupBy("node").agg(F.max(F.struct("n", "bucket")).alias("top")).select("node", F.col("top.bucket").alias("top"))
    covered = own.join(top, "node").groupBy("bucket").agg(F.min("top").alias("a"), F.max("top").alias("b")).filter("a = b and a <> bucket")
    return own.join(covered.select("bucket"), "bucket", "left_anti").select("bucket", "node")


# ------------------------------------------------------------- brute force


def _incidence(sets: list[np.ndarray]):
    """Chunks of the 0/1 matrix members x tokens, over tokens that several hold."""
    sizes = [len(s) for s in sets]
    tokens, at, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rows = np.repeat(np.arange(len(sets)), sizes)
    shared = counts > 1
    column = np.cumsum(shared) - 1
    keep = shared[at]
    rows, columns = rows[keep], column[at[keep]]
    width, step = int(shared.sum()), max(1, CELLS // len(sets))
    order = np.argsort(columns, kind="stable")
    rows, columns = rows[order], columns[order]
    for s in range(0, width, step):
        a, b = np.searchsorted(columns, [s, s + step])
        x = np.zeros((len(sets), min(step, width - s)), np.float32)
        x[rows[a:b], columns[a:b] - s] = 1
        yield x


def _products(sets: list[np.ndarray], split: int | None) -> np.ndarray:
    """Sizes of intersections: of all pairs, or of the first ``split`` sets with the others."""
    n = len(sets)
    out = np.zeros((n, n) if split is None else (split, n - split), np.float32)
    for x in _incidence(sets):
        out += x @ x.T if split is None else x[:split] @ x[split:].T
    return out


def _roots(linked: np.ndarray) -> np.ndarray:
    """The smallest index that each index is connected with."""
    label = np.arange(len(linked), dtype=np.int32)
    while True:
        new = label.copy()
        for s in range(0, len(label), ROWS):
            least = np.where(linked[s : s + ROWS], label[None, :], np.int32(len(label))).min(1)
            new[s : s + ROWS] = np.minimum(label[s : s + ROWS], least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def compare(bucket: int, sides: list[int], nodes: list[int], copies: list[int], sets: list[np.ndarray], met: list[list[int]], similarity: float):
    """(node, connected node, links) per member of a cell: all its pairs, or
    those between its two sides."""
    cross = len(set(sides)) > 1
    order = sorted({n: i for i, n in enumerate(nodes)}.values(), key=lambda i: (sides[i], nodes[i]))  # each node once
    sides, nodes, copies, sets, met = ([x[i] for i in order] for x in (sides, nodes, copies, sets, met))
    n = len(nodes)
    split = sides.index(1) if cross else None
    sizes = np.array([len(s) for s in sets], np.float64)
    rows, columns = (slice(0, n), slice(0, n)) if split is None else (slice(0, split), slice(split, n))
    linked = np.zeros((n, n), bool)
    _fill(linked[rows, columns], _products(sets, split), lambda x, s: x >= similarity * (sizes[rows][s, None] + sizes[columns][None, :] - x) - 1e-9)
    if split is None:
        np.fill_diagonal(linked, False)
    else:
        linked[columns, rows] = linked[rows, columns].T
    roots = _roots(linked)
    earlier = [np.array([p for p in m if p < bucket], np.int64).view(np.uint64) for m in met]
    if linked.any() and any(len(e) for e in earlier):  # pairs that met in an earlier bucket were counted there
        first = linked[rows, columns]
        _fill(first, _products(earlier, split), lambda x, s: first[s] & (x == 0))
        if split is not None:
            linked[columns, rows] = first.T
    weights = np.array(copies, np.float64)
    links = np.concatenate([linked[s : s + ROWS] @ weights for s in range(0, n, ROWS)])
    return [(nodes[i], nodes[r], int(k)) for i, (r, k) in enumerate(zip(roots.tolist(), links.tolist())) if k or r != i]


def _fill(out: np.ndarray, values: np.ndarray, test) -> None:
    """``out`` from a test of ``values``, some rows at a time."""
    for s in range(0, len(values), ROWS):
        part = slice(s, s + ROWS)
        out[part] = test(values[part].astype(np.float64), part)


def _verified(cells: DataFrame, similarity: float) -> DataFrame:
    """(node, root, links) of all cells: rows of one cell come one after another."""
    names = ["bucket", "bi", "bj", "side", "node", "copies", "tokens", "met"]

    def run(rows):
        cell, held = None, []

        def done():
            sides = {h[0] for h in held}
            if len(held) > 1 and (cell[1] == cell[2] or len(sides) == 2):  # a pair of blocks needs rows of both
                side, node, copies, tokens, met = (list(x) for x in zip(*held))
                return compare(cell[0], side, node, copies, [np.frombuffer(t, np.uint64) for t in tokens], met, similarity)
            return []

        for cols in batches(rows, *names):
            out = []
            for bucket, bi, bj, *member in zip(*cols):
                if (bucket, bi, bj) != cell:
                    out += done()
                    cell, held = (bucket, bi, bj), []
                held.append(member)
            yield _found(out)
        yield _found(done())

    return cells.select(*names).mapInArrow(run, "node long, root long, links long")


def _found(out):
    cols = list(zip(*out)) or [()] * 3
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["node", "root", "links"])


def near_duplicates(
    documents: DataFrame, similarity: float = SIMILARITY, recall: float = TARGET_RECALL, words: int = WORDS, limit: int = LIMIT,
    block: int = BLOCK, depth: int = DEPTH, id_col: str = "doc_id",
) -> DataFrame:
    """doc_id, class_id, n_links of every document row."""
    if similarity < 0.8:
        raise ValueError("sets of fewer than four shingles are joined by equality, which needs a similarity of at least 0.8")
    factor = similarity * 0.97  # a little more than one expected common pick at the threshold
    # equal sizes at the threshold share 2 s / (1 + s) of a set; the worst case, a subset, shares s
    runs = runs_for(recall, depth, factor / similarity, DEEPER)
    spark = documents.sparkSession
    seed, members, members_path, reps, reps_path = _sets_of(documents, runs, factor, words, id_col)
    rows = written(members.select("doc_id", "key"), "rows")
    discard(spark, members_path)
    met = _met(reps.select(F.explode("paths").alias("path"), "node", F.col("size").cast("long").alias("size")))
    parted = lambda met: written(_largest(_buckets(met.filter(F.col("n") <= limit), similarity)), "parted")
    small = lambda pairs, own: written(_hopeful(pairs, own.select("node", "size", "sketch"), similarity), "small")
    pairs = parted(met)
    one, big = small(pairs, Sieve(pairs, "node").passing(reps.select("node", "size", "sketch"), "node")), met.filter(F.col("n") > limit)
    asked = one.select("node").unionByName(big.select("node")).distinct()
    wanted = written(reps.select("node", "doc_id", "key", "copies").join(asked, "node", "left_semi"), "wanted")
    nodes = written(reps.select("key", "node", "smallest", "copies"), "nodes")
    discard(spark, reps_path)
    sets, sets_path = bucketed(_candidate_sets(documents, wanted, words, id_col, seed), "sets", "node")
    whole = []
    for _ in range(depth - 1):
        if big.isEmpty():
            break
        stays, children = _split(big, sets, factor / DEEPER)
        whole.append(stays)
        met = _met(children)
        one, big = one.unionByName(small(parted(met), sets)), met.filter(F.col("n") > limit)
    one = one.select("bucket", F.lit(1).cast("long").alias("blocks"), "node")
    for stays in whole:
        big = big.select("path", "n", "node").unionByName(stays)
    large = big.select(F.col("path").alias("bucket"), F.ceil(F.col("n") / block).cast("long").alias("blocks"), "node")
    assigned = written(one.unionByName(large), "assigned")
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    each = assigned.groupBy("node").agg(F.collect_set("bucket").alias("met"))
    cells = (
        assigned.withColumn("own", own).withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)")))
        .select("bucket", F.least("own", "other").alias("bi"), F.greatest("own", "other").alias("bj"), (F.col("own") > F.col("other")).cast("int").alias("side"), "node")
    )
    cells = cells.join(sets.select("node", "copies", "tokens").join(each, "node"), "node").repartition("bucket", "bi", "bj").sortWithinPartitions("bucket", "bi", "bj", "side", "node")
    found = written(_verified(cells, similarity), "found")
    discard(spark, sets_path)
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    classes = nodes.join(roots, "node", "left").join(links, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = classes.groupBy("root").agg(F.min("smallest").alias("class_id"))
    info = written(
        classes.join(smallest, "root").select("key", "class_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links")).filter("links > 0"), "classes"
    )
    return rows.join(info, "key", "left").select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("links", F.lit(0)).cast("long").alias("n_links")
    )
