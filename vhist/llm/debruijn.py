"""Removal of long repeated word spans by De Bruijn compaction.

Windows of 50 words are the edges of a De Bruijn graph over all documents; two
windows are joined where one follows the other.  Only edges that documents of
different ids hold are kept, and nonbranching paths of them are compacted: all
windows of such a path are always met together, so they share one first
document.

Edges are dealt by anchors: the anchor of a window is its word gram with the
smallest hash, so equal windows have equal anchors, and about twenty windows in
a row share one and travel as a bundle.  An anchor held by one id only is
dropped first.  A task joins the windows of an anchor into segments; Spark
joins link segments whose ends follow each other without a branch, and doubling
joins give each its path's head.  Windows of anchors with over ``HOT`` different
bundles are dealt one by one instead, a row per block.

Hashes only propose.  Each path's occurrences are read again at their source
coordinates, by a 128-bit digest of their words: words go if the same digest
was met in a document of a smaller id.  A path with different digests (a
collision of hashes) is verified window by window.

Texts are written once, as blocks in buckets, and meet small tables only.

Defined cases: null and empty texts have no words, and the hash of the empty
text.  Rows that share an id are one document: none is earlier than another.
Rows without id come after all ids.  Windows never cross rows.  A text of any
length is held whole by one task (about twelve bytes a byte).  An empty table
gives no rows.  Other columns are left behind.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vhist.llm.common import batches, bucketed, discard, text_rows, written

WINDOW = 50
ANCHOR = 8  # words of an anchor
BLOCK_BYTES = 4 << 20
HOT = 20_000
TASK_WINDOWS = 2 << 20  # windows joined at once in a task
_CHUNK = 1 << 20
_LAST = (1 << 63) - 1  # rows without id
_NONE, _MANY = 0, 1  # no window before or after, several ones

_U = np.uint64
_BYTE = np.random.default_rng(29).integers(1, 1 << 63, 256, dtype=np.int64).astype(_U) * _U(2) + _U(1)
_BASE, _WORD_BASE = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95


def _powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1), modulo 2^64."""
    out = np.full(n, base, _U)
    out[:1] = 1
    return np.cumprod(out, dtype=_U)


def _mix(x: np.ndarray) -> np.ndarray:
    """A fixed one-to-one scrambling of 64-bit numbers."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Words:
    """The words of some documents: each word and a space, documents after each other."""

    def __init__(self, body: bytes, n_words, ids, window: int, anchor: int, bits: int = 64):
        self.body, self.window, self.anchor, self.bits = body, window, anchor, bits
        self.array = np.frombuffer(body, np.uint8)
        self.ends = np.flatnonzero(self.array == 32)
        self.starts = np.append(0, self.ends[:-1] + 1)[: len(self.ends)]
        self.at = np.cumsum([0, *n_words])  # first word of each document
        self.ids = np.array([_LAST if i is None else i for i in ids], np.int64)
        self.doc = np.repeat(np.arange(len(self.ids)), np.diff(self.at))
        # windows start at words from which the document has enough of them
        self.valid = np.arange(len(self.ends)) + window <= self.at[1:][self.doc]

    def _hashes(self) -> np.ndarray:
        """A hash of each word, some words at once."""
        out, i, n = np.empty(len(self.ends), _U), 0, len(self.ends)
        up = down = np.zeros(0, _U)
        while i < n:
            j = max(i + 1, int(np.searchsorted(self.ends, self.starts[i] + _CHUNK)))
            s, e = int(self.starts[i]), int(self.ends[j - 1]) + 1
            if e - s > len(up):
                up, down = _powers(_BASE, e - s), _powers(pow(_BASE, -1, 1 << 64), e - s)
            at = self.starts[i:j] - s
            out[i:j] = _mix(np.add.reduceat(_BYTE[self.array[s:e]] * up[: e - s], at) * down[at])
            i = j
        return out

    def hashed(self):
        """(hash of the window, anchor's place, anchor's hash) at each word; only
        those at ``valid`` words mean anything."""
        n = len(self.ends)
        sums = np.append(_U(0), np.cumsum(self._hashes() * _powers(_WORD_BASE, n), dtype=_U))
        down = _powers(pow(_WORD_BASE, -1, 1 << 64), n)

        def grams(size: int) -> np.ndarray:
            out = np.zeros(n, _U)
            if n >= size:
                out[: n - size + 1] = (sums[size:] - sums[: n - size + 1]) * down[: n - size + 1]
            return out

        w = _mix(grams(self.window)) >> _U(64 - self.bits)
        w = np.where(w < 2, w + _U(2), w).view(np.int64)
        g = _mix(grams(self.anchor) ^ _U(0x5851F42D4C957F2D))
        best, size, span = np.arange(n), 1, self.window - self.anchor + 1
        while size < span:  # smallest of twice as many places, the leftmost of equal ones
            step = min(size, span - size)
            if n > step:
                left, right = best[: n - step], best[step:]
                best = np.append(np.where(g[left] <= g[right], left, right), best[n - step :])
            size += step
        return w, best, g[best].view(np.int64)

    def bundles(self):
        """Runs of windows with one anchor: (windows' hashes at each word, anchor,
        first word, windows, hash before, hash after, id)."""
        w, place, anchor = self.hashed()
        at = np.flatnonzero(self.valid)
        fresh = np.append(True, (np.diff(at) > 1) | (np.diff(place[at]) != 0) | (np.diff(self.doc[at]) != 0))[: len(at)]
        start = at[fresh]
        size = np.diff(np.append(np.flatnonzero(fresh), len(at)))
        before, after = np.full(len(start), _NONE, np.int64), np.full(len(start), _NONE, np.int64)
        inner = start > self.at[self.doc[start]]
        before[inner] = w[start[inner] - 1]
        end = start + size
        more = np.zeros(len(start), bool)
        more[end < len(w)] = self.valid[end[end < len(w)]] & (self.doc[end[end < len(w)]] == self.doc[start[end < len(w)]])
        after[more] = w[end[more]]
        return w, anchor[start], start, size, before, after, self.ids[self.doc[start]]

    def occurrences(self, first: np.ndarray, size: np.ndarray):
        """(number of the path, first word) wherever a path's first window is met."""
        w = self.hashed()[0]
        at = np.flatnonzero(self.valid)
        order = np.argsort(w[at], kind="stable")
        found = w[at][order]
        low, high = np.searchsorted(found, first, "left"), np.searchsorted(found, first, "right")
        n = high - low
        path = np.repeat(np.arange(len(first)), n)
        return path, at[order[np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())]]

    def fits(self, word: int, windows: int) -> bool:
        return word + windows + self.window - 1 <= self.at[self.doc[word] + 1]

    def digest(self, word: int, windows: int) -> bytes:
        """Of the words that so many windows from a word on cover."""
        last = word + windows + self.window - 2
        return hashlib.blake2b(self.body[self.starts[word] : self.ends[last] + 1], digest_size=16).digest()

    def kept(self, doc: int, gone: np.ndarray) -> bytes:
        """A document's words that do not go, joined by one space."""
        s, e = int(self.at[doc]), int(self.at[doc + 1])
        stays = ~gone[s:e]
        edge = np.flatnonzero(np.diff(np.concatenate(([0], stays.view(np.int8), [0])))) + s
        return b"".join([self.body[self.starts[a] : self.ends[b - 1] + 1] for a, b in edge.reshape(-1, 2)])[:-1]


def text_blocks(documents: DataFrame, id_col: str, text_col: str, block_bytes: int) -> tuple[DataFrame, str]:
    """Documents in blocks, written in buckets: (block, doc_id, n_words, body)."""

    def run(rows):
        base, n = TaskContext.get().partitionId() << 33, 0
        ids, words, bodies, size = [], [], [], 0

        def row():
            body = zstandard.ZstdCompressor(level=1).compress(b"".join(bodies))
            columns = [pa.array([base + n]), pa.array([ids], pa.list_(pa.int64())), pa.array([words], pa.list_(pa.int64())), pa.array([body])]
            return pa.RecordBatch.from_arrays(columns, names=["block", "doc_id", "n_words", "body"])

        for keys, raws in batches(rows, "doc_id", "raw"):
            for key, raw in zip(keys, raws, strict=True):
                split = raw.split()  # at \x20 and \x09-\x0D
                ids.append(key)
                words.append(len(split))
                if split:
                    bodies.append(b" ".join(split) + b" ")
                    size += len(bodies[-1])
                if size >= block_bytes:
                    yield row()
                    n += 1
                    ids, words, bodies, size = [], [], [], 0
        if ids:
            yield row()

    schema = "block long, doc_id array<long>, n_words array<long>, body binary"
    return bucketed(text_rows(documents, id_col, text_col).mapInArrow(run, schema), "word-blocks", "block")


def _read(block: dict, settings) -> Words:
    return Words(zstandard.ZstdDecompressor().decompress(block["body"]) if block["body"] else b"", block["n_words"], block["doc_id"], *settings)


def _distinct(*columns: np.ndarray):
    """Order of rows by the columns, and where each different row starts in it."""
    order = np.lexsort(columns[::-1])
    fresh = np.zeros(len(order), bool)
    fresh[:1] = True
    for c in columns:
        c = c[order]
        fresh[1:] |= c[1:] != c[:-1]
    return order, np.flatnonzero(fresh)


def _reduced(f, values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return f.reduceat(values, starts) if len(starts) else values[:0]


def _anchors(blocks: DataFrame, settings) -> DataFrame:
    """(anchor, block, n, low, high): different bundles and ids of each block's anchors."""

    def run(rows):
        for batch in rows:
            for block in batch.to_pylist():
                w, anchor, start, size, before, after, ids = _read(block, settings).bundles()
                order, first = _distinct(anchor, w[start], size, before, after)
                new = np.zeros(len(order), np.int64)
                new[first] = 1
                key = anchor[order]
                at = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else first
                columns = [key[at], np.full(len(at), block["block"]), _reduced(np.add, new, at)]
                columns += [_reduced(np.minimum, ids[order], at), _reduced(np.maximum, ids[order], at)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["anchor", "block", "n", "low", "high"])

    return blocks.mapInArrow(run, "anchor long, block long, n long, low long, high long")


_BUNDLE = "key long, block long, windows binary, before long, after long, low long, high long"


def _bundles(blocks: DataFrame, wanted: DataFrame, settings) -> DataFrame:
    """The different bundles of each block with a wanted anchor; windows of hot
    anchors one by one, keyed by themselves."""

    def run(block: pa.Table, wanted: pa.Table) -> pa.Table:
        number = block["block"][0].as_py()
        w, anchor, start, size, before, after, ids = _read(block.to_pylist()[0], settings).bundles()
        keys, hot = wanted["anchor"].to_numpy(), wanted["hot"].to_numpy(zero_copy_only=False)
        some, single = np.isin(anchor, keys[~hot]), np.isin(anchor, keys[hot])
        a, s, n, b, f, d = (x[some] for x in (anchor, start, size, before, after, ids))
        order, first = _distinct(a, w[s], n, b, f)
        at = order[first]
        rows = [a[at], [w[i : i + k].tobytes() for i, k in zip(s[at].tolist(), n[at].tolist(), strict=True)], b[at], f[at]]
        rows += [_reduced(np.minimum, d[order], first), _reduced(np.maximum, d[order], first)]
        # single windows: one row each, with what is before and after it in the block
        n = size[single]
        place = np.repeat(start[single] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        run_of = np.repeat(np.flatnonzero(single), n)
        x = w[place]
        b = np.where(place > start[run_of], w[place - 1], before[run_of])
        f = np.where(place + 1 < (start + size)[run_of], w[np.minimum(place + 1, len(w) - 1)], after[run_of]) if len(place) else x
        order, first = _distinct(x)
        x, b, f, d = x[order], b[order], f[order], ids[run_of][order]
        more = [x[first], [v.tobytes() for v in x[first]], _only(b, first), _only(f, first), _reduced(np.minimum, d, first), _reduced(np.maximum, d, first)]
        types = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        columns = [pa.concat_arrays([pa.array(p, t), pa.array(q, t)]) for p, q, t in zip(rows, more, types, strict=True)]
        columns.insert(1, pa.array(np.full(len(columns[0]), number), pa.int64()))
        return pa.table(columns, names=["key", "block", "windows", "before", "after", "low", "high"])

    return blocks.groupBy("block").cogroup(wanted.groupBy("block")).applyInArrow(run, _BUNDLE)


def _only(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Each group's only value, or _MANY."""
    low, high = _reduced(np.minimum, values, starts), _reduced(np.maximum, values, starts)
    return np.where(low == high, low, _MANY)


def _joined(block, windows, before, after, low, high):
    """Segments of complete keys: (first, last, n, before, after, block) per segment and block that holds it."""
    n = np.array([len(x) >> 3 for x in windows])
    w = np.frombuffer(b"".join(windows), np.int64)
    row, top = np.repeat(np.arange(len(n)), n), np.cumsum(n)
    b, f = np.append(0, w[:-1]), np.append(w[1:], 0)
    b[top - n], f[top - 1] = before, after
    order, first = _distinct(w)  # equal windows in order of place
    kept = _reduced(np.minimum, low[row][order], first) < _reduced(np.maximum, high[row][order], first)
    b, f = _only(b[order], first), _only(f[order], first)
    place = order[first]
    by = np.argsort(place[kept], kind="stable")
    place, x, b, f = (v[kept][by] for v in (place, w[order][first], b, f))
    if not len(x):
        return [np.zeros(0, np.int64)] * 6
    linked = (np.diff(place) == 1) & (np.diff(row[place]) == 0) & (f[:-1] == x[1:]) & (b[1:] == x[:-1])
    start = np.flatnonzero(np.append(True, ~linked))
    end = np.append(start[1:], len(x))
    # blocks: of all rows that hold a segment's first window
    by_first = np.argsort(x[start])
    firsts = x[start][by_first]
    spot = np.searchsorted(firsts, w)
    held = np.flatnonzero(firsts[np.minimum(spot, len(firsts) - 1)] == w)
    segment, owner = by_first[spot[held]], block[row[held]]
    order, first = _distinct(segment, owner)
    segment, owner = segment[order][first], owner[order][first]
    columns = x[start], x[end - 1], end - start, b[start], f[end - 1]
    return [*(c[segment] for c in columns), owner]


_SEGMENT = ["first", "last", "n", "before", "after", "block"]


def _segments(bundles: DataFrame, task_windows: int) -> DataFrame:
    """Nonbranching runs of repeated windows under each key."""

    def run(rows):
        held, n = [], 0

        def out(table: pa.Table):
            columns = [table[c].to_numpy() for c in ("block", "before", "after", "low", "high")]
            found = _joined(columns[0], table["windows"].to_pylist(), *columns[1:])
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], names=_SEGMENT)

        for batch in rows:
            if not batch.num_rows:
                continue
            held.append(batch)
            n += batch.column("windows").nbytes >> 3
            if n < task_windows:
                continue
            table = pa.Table.from_batches(held)
            key = table["key"].to_numpy()
            cut = int(np.searchsorted(key, key[-1]))  # the last key may go on
            if cut:
                yield out(table.slice(0, cut))
                rest = table.slice(cut).combine_chunks()
                held, n = rest.to_batches(), sum(b.column("windows").nbytes for b in rest.to_batches()) >> 3
        if held:
            yield out(pa.Table.from_batches(held))

    parts = bundles.repartition("key").sortWithinPartitions("key")
    return parts.mapInArrow(run, ", ".join(f"{c} long" for c in _SEGMENT))


def compacted(segments: DataFrame, most_rounds: int = 40) -> DataFrame:
    """(head's first window, windows) of each nonbranching path of segments
    (first, last, n, before, after): linked by a join, then doubling joins."""
    nodes = segments.groupBy("first", "last", "n").agg(*(F.when(F.min(c) == F.max(c), F.min(c)).otherwise(_MANY).alias(c) for c in ("before", "after")))
    nodes = written(nodes.withColumn("id", F.monotonically_increasing_id()), "segments")
    left = nodes.filter(~F.col("after").isin(_NONE, _MANY)).select(F.col("id").alias("up"), F.col("n").alias("d"), F.col("last").alias("before"), F.col("after").alias("first"))
    links = nodes.filter(~F.col("before").isin(_NONE, _MANY)).join(left, ["first", "before"]).select("id", "up", "d")
    alone = [F.count("*").over(Window.partitionBy(c)) for c in ("id", "up")]  # collisions of hashes link nothing
    links = links.withColumn("x", alone[0]).withColumn("y", alone[1]).filter("x = 1 and y = 1 and id <> up").select("id", "up", "d")
    links = written(links, "links")
    for _ in range(most_rounds):
        above = links.select(F.col("id").alias("up"), F.col("up").alias("up2"), F.col("d").alias("d2"))
        step = links.join(above, "up", "left")
        step = step.select("id", F.coalesce("up2", "up").alias("up"), (F.col("d") + F.coalesce("d2", F.lit(0))).alias("d"), F.col("up2").isNotNull().alias("moved"))
        links = written(step, "links")
        if not links.filter("moved").limit(1).count():
            break
    else:  # a ring of colliding hashes has no head: its segments stay apart
        links = links.filter("not moved")
    paths = nodes.join(links.select("id", "up", "d"), "id", "left")
    paths = paths.groupBy(F.coalesce("up", "id").alias("id")).agg(F.max(F.coalesce("d", F.lit(0)) + F.col("n")).alias("n"))
    return paths.join(nodes.select("id", "first", "last", F.col("n").alias("own")), "id").select("id", "first", "last", "own", "n")


def _met(blocks: DataFrame, spans: DataFrame, settings, by_window: bool = False) -> DataFrame:
    """(path, first, n, digest, low, high, at) of each block's occurrences: the
    words' digest, the ids that hold them, and where the smallest has them."""

    def run(block: pa.Table, spans: pa.Table) -> pa.Table:
        found: dict = {}
        if spans.num_rows and block.num_rows:
            words = _read(block.to_pylist()[0], settings)
            path, first, size = (spans[c].to_numpy() for c in ("path", "first", "n"))
            w = words.hashed()[0] if by_window else None
            for p, word in zip(*(x.tolist() for x in words.occurrences(first, size)), strict=True):
                doc = int(words.doc[word])
                here = (int(words.ids[doc]), word - int(words.at[doc]))
                n = int(size[p])
                if by_window:
                    seen = [((int(path[p]), int(w[k]), 1, words.digest(k, 1)), (here[0], here[1] + k - word)) for k in range(word, word + n) if words.fits(k, 1)]
                else:
                    seen = [((int(path[p]), int(first[p]), n, words.digest(word, n) if words.fits(word, n) else b""), here)]
                for key, place in seen:
                    least, most = found.get(key, (place, place))
                    found[key] = min(least, place), max(most, place)
        rows = [(*key, least[0], most[0], least[1]) for key, (least, most) in found.items()]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 7, types, strict=True)], names=names)

    names = ["path", "first", "n", "digest", "low", "high", "at"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    schema = "path long, first long, n long, digest binary, low long, high long, at long"
    met = blocks.groupBy("block").cogroup(spans.groupBy("block")).applyInArrow(run, schema)
    least = F.min(F.struct("low", "at")).alias("least")
    return met.groupBy("path", "first", "n", "digest").agg(least, F.max("high").alias("high")).select("path", "first", "n", "digest", "least.*", "high")


def _verified(documents: DataFrame, id_col, text_col, window, anchor, hot, block_bytes, task_windows, bits):
    """(blocks, paths verified at their source coordinates, (block, path) rows, scratch paths)."""
    settings = (window, anchor, bits)
    blocks, path = text_blocks(documents, id_col, text_col, block_bytes)
    anchors = _anchors(blocks, settings)
    wanted = anchors.groupBy("anchor").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n")).filter("low < high")
    wanted = anchors.select("anchor", "block").join(wanted.select("anchor", (F.col("n") > hot).alias("hot")), "anchor")
    segments = written(_segments(_bundles(blocks, wanted, settings), task_windows), "block-segments")
    paths = compacted(segments)
    holds = segments.select("first", "last", F.col("n").alias("own"), "block").distinct()
    spans = written(paths.join(holds, ["first", "last", "own"]).select("block", F.col("id").alias("path"), "first", "n"), "paths")
    met = written(_met(blocks, spans, settings), "met")
    several = met.groupBy("path").agg(F.count("*").alias("k")).filter("k > 1").select("path")
    several = written(several, "collisions")
    good = met.join(F.broadcast(several) if several.limit(100_000).count() < 100_000 else several, "path", "left_anti")
    if several.limit(1).count():
        good = good.unionByName(_met(blocks, spans.join(several, "path", "left_semi"), settings, by_window=True))
    return blocks, written(good.filter("low < high"), "verified"), spans.select("block", "path"), settings, path


def repeated_spans(documents: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, hot: int = HOT, block_bytes: int = BLOCK_BYTES,
                   task_windows: int = TASK_WINDOWS, id_col: str = "doc_id", text_col: str = "text", bits: int = 64) -> DataFrame:
    """Paths of windows that documents of several ids hold, with their source:
    doc_id (null: a row without id), first word (from 0) and number of words."""
    _, good, _, _, path = _verified(documents, id_col, text_col, window, anchor, hot, block_bytes, task_windows, bits)
    discard(good.sparkSession, path)
    return good.select(F.when(F.col("low") < _LAST, F.col("low")).alias("doc_id"), F.col("at").alias("first_word"), (F.col("n") + window - 1).alias("n_words"))


def remove_repeated_words(documents: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, hot: int = HOT, block_bytes: int = BLOCK_BYTES,
                          task_windows: int = TASK_WINDOWS, id_col: str = "doc_id", text_col: str = "text", bits: int = 64, with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and, if asked for, the kept words as text."""
    blocks, good, held, settings, path = _verified(documents, id_col, text_col, window, anchor, hot, block_bytes, task_windows, bits)
    todo = good.select("path", "first", "n", "digest", "low").join(held, "path").drop("path").distinct()

    def run(block: pa.Table, todo: pa.Table) -> pa.Table:
        if not block.num_rows:
            return pa.Table.from_arrays([pa.array([], t) for t in types], names=names)
        row = block.to_pylist()[0]
        words = _read(row, settings)
        gone = np.zeros(len(words.ends) + 1, np.int32)
        if todo.num_rows:
            first, size, low = (todo[c].to_numpy() for c in ("first", "n", "low"))
            digest = todo["digest"].to_pylist()
            for p, word in zip(*(x.tolist() for x in words.occurrences(first, size)), strict=True):
                n = int(size[p])
                if words.ids[words.doc[word]] > low[p] and words.fits(word, n) and words.digest(word, n) == digest[p]:
                    gone[word] += 1
                    gone[word + n + words.window - 1] -= 1
        gone = np.cumsum(gone[:-1]) > 0
        removed = np.diff(np.append(0, np.cumsum(gone))[words.at])
        kept = [words.kept(d, gone) for d in range(len(row["doc_id"]))]
        columns = [row["doc_id"], row["n_words"], removed, [hashlib.sha256(k).hexdigest() for k in kept]]
        if with_text:
            columns.append([k.decode("utf-8", errors="replace") for k in kept])
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    names = ["doc_id", "n_words", "n_removed", "kept_sha256"] + ["kept"] * with_text
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string()] + [pa.string()] * with_text
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * with_text
    out = written(blocks.groupBy("block").cogroup(todo.groupBy("block")).applyInArrow(run, schema), "kept-words")
    discard(out.sparkSession, path)
    return out
