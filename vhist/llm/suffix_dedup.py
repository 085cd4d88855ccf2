"""Removal of repeated 200-byte strings by a distributed merge sort of suffixes.

A byte goes if a ``length``-byte string that covers it also starts anywhere
else in the corpus.  Suffixes are sorted at anchors only: every window of
``length`` bytes has one, the place of its smallest ``gram``-byte hash
(leftmost on ties), which depends on the window's content alone.  Equal windows
therefore have equal anchors at equal offsets, and the windows of one anchor
form a run whose common context is a stretch of left and right text.

1. Sieve: anchors whose gram occurs once in the corpus cannot lie in a repeated
   window.  A task knows what repeats among its own rows, so it sends one row
   per gram that does, and a gram that a third of all documents share costs one
   row per batch, not one per document.
2. Runs: tasks sort the right contexts of the remaining anchors, front-code
   them (common prefix with the one before, and the rest) and send one run per
   range; equal contexts of a task are decided there and sent once.
3. Merge: a loser tree combines the runs of a range.  It keeps each contender's
   common prefix with the last winner, so known prefixes are never compared
   again, and yields the sorted contexts with their common prefixes.  Contexts
   that share ``length - o`` bytes to the right of the anchor form an interval;
   those of it that share ``o`` bytes to the left hold the same window.
4. Grams of more than ``large`` contexts do not go to one task: each of their
   windows is looked up by itself, by two 64-bit hashes, through the sieve.

Defined cases: null and empty texts, and texts shorter than ``length``, lose
nothing; rows repeated under one id are texts of their own, so both lose what
they share; matches never cross documents; an empty table gives no row.
"""

from __future__ import annotations

import hashlib
import struct
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vhist.llm.common import batches, text_rows

LENGTH = 200
GRAM = 64  # a power of two
LARGE = 50_000
CHUNK = 2 << 20  # bytes of text looked at together
HELD = 100_000  # merged contexts decided together

_U = np.uint64
_BYTE = np.random.default_rng(31).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BYTE_2 = np.random.default_rng(32).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BASE = 0xD1342543DE82EF95
_MIX = _U(0x9E3779B97F4A7C15)
_PLACE = _U((1 << 24) - 1)

_SIEVE = "k long, g long, id0 long, w int"
_STEP = "part int, kind int, k long, k2 long, id0 long, th long, s int, e int, run binary"
_SPAN, _RUN, _WINDOW = 0, 1, 2


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(32))) * _MIX
    h = (h ^ (h >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    return h ^ (h >> _U(32))


def _window_hashes(b: np.ndarray, size: int, table: np.ndarray = _BYTE) -> np.ndarray:
    """Polynomial hashes of all ``size``-byte windows, by doubling."""
    parts, span, h, out, done = size, 1, table[b], None, 0
    while parts:
        if parts & 1:  # append a stretch of ``span`` bytes to what is hashed so far
            if out is None:
                out = h
            else:
                n = len(b) - done - span + 1
                out = out[:n] * _U(pow(_BASE, span, 1 << 64)) + h[done : done + n]
            done += span
        parts >>= 1
        if parts:
            h = h[: len(h) - span] * _U(pow(_BASE, span, 1 << 64)) + h[span:]
            span *= 2
    return out


def _sliding_min(x: np.ndarray, m: int) -> np.ndarray:
    """Minimum of every m consecutive values."""
    n = len(x)
    rows = -(-n // m)
    padded = np.full(rows * m, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = x
    grid = padded.reshape(rows, m)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - m + 1], ahead[m - 1 : n])


def anchors(texts: list[bytes], length: int = LENGTH, gram: int = GRAM):
    """(joined bytes, offsets of the texts, and per anchor: text number, place,
    first and last window start, gram hash).  Places are in the joined bytes."""
    joined = b"".join(texts)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    none = np.zeros(0, np.int64)
    if len(joined) < length:
        return joined, offsets, none, none, none, none, none.view(np.uint64)
    b = np.frombuffer(joined, np.uint8)
    g = _mixed(_window_hashes(b, gram))
    if len(joined) > int(_PLACE):  # one very long text: places need more bits than a packed key has
        place = _long_minima(g, length - gram + 1)
    else:
        packed = (g & ~_PLACE) | np.arange(len(g), dtype=np.uint64)
        place = (_sliding_min(packed, length - gram + 1) & _PLACE).astype(np.int64)
    inside = np.zeros(len(joined) + 1, np.int8)
    long_enough = np.flatnonzero(np.diff(offsets) >= length)
    inside[offsets[long_enough]] += 1
    np.add.at(inside, offsets[long_enough + 1] - length + 1, -1)
    starts = np.flatnonzero(np.cumsum(inside[: len(place)], dtype=np.int8))
    if not len(starts):
        return joined, offsets, none, none, none, none, none.view(np.uint64)
    at = place[starts]
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    last = np.r_[first[1:] - 1, len(at) - 1]
    p = at[first]
    return joined, offsets, np.searchsorted(offsets, p, "right") - 1, p, starts[first], starts[last], g[p]


def _long_minima(g: np.ndarray, m: int) -> np.ndarray:
    """Leftmost minimum's place per window, over overlapping pieces."""
    step, out = int(_PLACE) // 2, []
    for s in range(0, len(g) - m + 1, step):
        piece = g[s : s + step + m - 1]
        packed = (piece & ~_PLACE) | np.arange(len(piece), dtype=np.uint64)
        out.append((_sliding_min(packed, m) & _PLACE).astype(np.int64) + s)
    return np.concatenate(out)


def _chunks(raws: list[bytes]):
    """Ranges of rows of about CHUNK bytes."""
    start, size = 0, 0
    for i, r in enumerate(raws):
        size += len(r)
        if size >= CHUNK:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(raws):
        yield start, len(raws)


def _singles(keys: np.ndarray):
    """Which keys occur once here, and the distinct keys that occur more often."""
    if not len(keys):
        return np.zeros(0, bool), keys
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    same = np.r_[False, k[1:] == k[:-1]]
    repeated = same | np.r_[same[1:], False]
    once = np.empty(len(keys), bool)
    once[order] = ~repeated
    return once, k[repeated & ~same]


# ------------------------------------------------------------------- 1 sieve


def _gram_rows(length: int, gram: int):
    def run(rows):
        for ids, raws in batches(rows, "id0", "raw", at_once=None):
            g, owner = [], []
            for a, b in _chunks(raws):
                _, _, text, _, _, _, h = anchors(raws[a:b], length, gram)
                g.append(h.view(np.int64))
                owner.append(np.array(ids[a:b], np.int64)[text])
            g, owner = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (g, owner))
            once, repeated = _singles(g)
            # singles ask for others; a repeated gram answers for all of this batch; its owners know already
            known, known_owner = g[~once], owner[~once]
            spread = _mixed(known_owner.view(np.uint64) + known.view(np.uint64)).view(np.int64)
            n1, n2, n3 = int(once.sum()), len(repeated), len(known)
            counts = np.searchsorted(np.sort(known), repeated, "right") - np.searchsorted(np.sort(known), repeated, "left")
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([g[once], repeated, spread])),
                    pa.array(np.concatenate([np.zeros(n1 + n2, np.int64), known])),
                    pa.array(np.concatenate([owner[once], np.zeros(n2, np.int64), known_owner])),
                    pa.array(np.concatenate([np.ones(n1), -counts, np.zeros(n3)]).astype(np.int32)),
                ],
                names=["k", "g", "id0", "w"],
            )

    return run


def _groups(rows, names, key_names):
    """Batches of whole key groups, from rows sorted by the key."""
    held = None
    for batch in rows:
        t = {n: batch.column(batch.schema.get_field_index(n)).to_numpy(zero_copy_only=False) for n in names}
        if held is not None:
            t = {n: np.concatenate([held[n], t[n]]) for n in names}
        n = len(t[names[0]])
        if not n:
            continue
        last = np.ones(n, bool)
        for k in key_names:
            last &= t[k] == t[k][-1]
        cut = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0
        if cut:
            yield {n: x[:cut] for n, x in t.items()}
        held = {n: x[cut:] for n, x in t.items()}
    if held is not None and len(held[names[0]]):
        yield held


def _group_sums(keys: list[np.ndarray], w: np.ndarray) -> np.ndarray:
    """Per row, the sum of |w| of its group; rows are sorted by key."""
    new = np.zeros(len(w), bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    group = np.cumsum(new) - 1
    return np.bincount(group, weights=np.abs(w))[group]


def _repeated_grams(rows):
    """(id0, g): documents and those of their grams that are repeated."""
    for t in _groups(rows, ["k", "g", "id0", "w"], ["k"]):
        ask = (t["w"] == 1) & (_group_sums([t["k"]], t["w"]) > 1)
        known = t["w"] == 0
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([t["id0"][ask], t["id0"][known]])), pa.array(np.concatenate([t["k"][ask], t["g"][known]]))], names=["id0", "g"]
        )


def _large_grams(large: int):
    """Grams with more than ``large`` anchors: too many contexts for one task."""

    def run(rows):
        for t in _groups(rows, ["k", "w"], ["k"]):
            g = np.unique(t["k"][_group_sums([t["k"]], t["w"]) > large])
            yield pa.RecordBatch.from_arrays([pa.array(g), pa.array(np.ones(len(g), bool))], names=["g", "large"])

    return run


# -------------------------------------------------------------------- 2 runs

_HEAD = struct.Struct("<HHHqqiHHB")


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which ``known`` bytes are known."""
    n = min(len(a), len(b))
    if a[known:n] == b[known:n]:
        return n
    lo, hi = known, n
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


def front_coded(entries) -> bytes:
    """A run of (right, left, id0, th, place, least, most, decided), sorted by right."""
    out, before = [], b""
    for right, left, id0, th, place, least, most, decided in entries:
        shared = common_prefix(before, right)
        out += (_HEAD.pack(shared, len(right) - shared, len(left), id0, th, place, least, most, decided), right[shared:], left)
        before = right
    return b"".join(out)


def decoded(run: bytes):
    """(common prefix with the entry before, right, rest of the entry) of a run."""
    at, right = 0, b""
    while at < len(run):
        shared, tail, left, *rest = _HEAD.unpack_from(run, at)
        at += _HEAD.size
        right = right[:shared] + run[at : at + tail]
        at += tail
        yield shared, right, (run[at : at + left], *rest)
        at += left


class LoserTree:
    """Merge of front-coded runs.

    Every contender keeps the length of its common prefix with the last
    winner.  Of two contenders the one with the longer common prefix is the
    smaller, without any comparison; at equal lengths comparison starts there.
    """

    def __init__(self, runs: list[bytes]):
        self.runs = [decoded(r) for r in runs]
        self.heads = [next(r, None) for r in self.runs]
        self.shared = [0] * len(runs)
        self.size = 1
        while self.size < len(runs):
            self.size *= 2
        self.losers = [None] * self.size
        self.winner = self._build(1)

    def _build(self, node: int):
        if node >= self.size:
            i = node - self.size
            return i if i < len(self.heads) and self.heads[i] is not None else None
        w, self.losers[node] = self._play(self._build(2 * node), self._build(2 * node + 1))
        return w

    def _play(self, a, b):
        """(winner, loser) of two contenders; sets the loser's common prefix with the winner."""
        if a is None or b is None:
            return (b, a) if a is None else (a, b)
        x, y = self.shared[a], self.shared[b]
        if x != y:
            return (a, b) if x > y else (b, a)
        r, s = self.heads[a][1], self.heads[b][1]
        n = common_prefix(r, s, x)
        if n == len(r) or (n < len(s) and r[n] < s[n]):
            self.shared[b] = n
            return a, b
        self.shared[a] = n
        return b, a

    def __iter__(self):
        """(common prefix with the one before, right, rest) in order."""
        while self.winner is not None:
            i = self.winner
            yield self.shared[i], self.heads[i][1], self.heads[i][2]
            self.heads[i] = next(self.runs[i], None)
            if self.heads[i] is not None:
                self.shared[i] = self.heads[i][0]
            w = i if self.heads[i] is not None else None
            node = (i + self.size) // 2
            while node:
                w, self.losers[node] = self._play(w, self.losers[node])
                node //= 2
            self.winner = w


def _run_rows(length: int, gram: int, parts: int):
    def run(rows):
        for ids, ths, raws, lists in batches(rows, "id0", "th", "raw", "found", at_once=None):
            spans, windows, contexts = [], [], {}
            for a, b in _chunks(raws):
                listed = [(x["g"], x["large"]) for found in lists[a:b] for x in found]
                asked = np.array(sorted({g for g, _ in listed}), np.int64)
                big = np.array(sorted({g for g, is_large in listed if is_large}), np.int64)
                joined, offsets, text, place, s1, s2, g = anchors(raws[a:b], length, gram)
                g = g.view(np.int64)
                keep = np.flatnonzero(np.isin(g, asked))
                is_big = np.isin(g[keep], big).tolist()
                for i, large in zip(keep.tolist(), is_big):
                    p, s, e, n = int(place[i]), int(s1[i]), int(s2[i]) + length, int(text[i])
                    origin = (a + n, p - int(offsets[n]))
                    if large:
                        windows.append((origin, joined[s:e], p - s))
                    else:
                        contexts.setdefault((joined[s:e], p - s), (int(g[i]), []))[1].append(origin)
            by_part = defaultdict(list)
            for (text, o), (g, origins) in contexts.items():
                decided = len(origins) > 1
                if decided:
                    spans += [(n, p - o, p - o + len(text)) for n, p in origins]
                n, p = origins[0]
                entry = (text[o:], text[:o], ids[n], ths[n], p, max(0, length - (len(text) - o)), o, decided)
                by_part[g % parts].append(entry)
            yield _step([(part, _RUN, 0, 0, 0, 0, 0, 0, front_coded(sorted(x))) for part, x in by_part.items()])
            spans += yield from _window_rows(windows, ids, ths, length, parts)
            per = defaultdict(list)
            for n, s, e in spans:
                per[n].append((s, e))
            yield _step([(ids[n] % parts, _SPAN, 0, 0, ids[n], ths[n], s, e, None) for n, x in per.items() for s, e in merged(x)])

    return run


def _window_rows(windows, ids, ths, length: int, parts: int):
    """Rows of the single windows of large grams; returns the spans decided here."""
    spans, held, size = [], [], 0

    def flush():
        k = np.concatenate([h for h, _, _ in held])
        k2 = np.concatenate([h for _, h, _ in held])
        places = [x for _, _, x in held for x in x]
        once, _ = _singles(_mixed(k + _MIX * k2))
        sent, out = set(), []
        for i, ((n, s), single) in enumerate(zip(places, once.tolist())):
            key = (int(k[i]), int(k2[i]))
            if not single:
                spans.append((n, s, s + length))
                if key in sent:
                    continue
                sent.add(key)
            signed = [x - (1 << 64) if x >> 63 else x for x in key]
            out.append((key[0] % parts, _WINDOW, *signed, ids[n], ths[n], s, s + length if single else -1, None))
        return _step(out)

    for (n, p), text, o in windows:
        b = np.frombuffer(text, np.uint8)
        h, h2 = _mixed(_window_hashes(b, length)), _mixed(_window_hashes(b, length, _BYTE_2))
        held.append((h, h2, [(n, p - o + j) for j in range(len(h))]))
        size += len(h)
        if size > 1 << 20:
            yield flush()
            held, size = [], 0
    if held:
        yield flush()
    return spans


def _step(out):
    types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    cols = list(zip(*out)) or [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["part", "kind", "k", "k2", "id0", "th", "s", "e", "run"])


# ------------------------------------------------------------------- 3 merge


def repeated_spans(merged_entries, length: int = LENGTH):
    """(id0, th, start, end) of the undecided ones among sorted contexts
    (common prefix with the one before, right, (left, id0, th, place, least, most, decided))."""
    entries = list(merged_entries)
    if len(entries) < 2:
        return []
    shared = np.array([e[0] for e in entries], np.int64)
    lefts, ids, ths, places, least, most, decided = zip(*[e[2] for e in entries])
    least, most = np.array(least), np.array(most)
    width = int(most.max())
    reversed_left = np.frombuffer(b"".join([x[::-1].ljust(width, b"\0") for x in lefts]), np.uint8).reshape(len(entries), width)
    low, high = np.full(len(entries), length + 1), np.full(len(entries), -1)
    h = np.zeros(len(entries), np.uint64)
    for o in range(width + 1):
        active = np.flatnonzero((least <= o) & (o <= most))
        if len(active) > 1:
            interval = np.cumsum(shared < length - o).astype(np.uint64)
            key = _mixed(h[active] + interval[active] * _MIX)
            once, _ = _singles(key)
            twice = active[~once]
            low[twice] = np.minimum(low[twice], o)
            high[twice] = o
        if o < width:
            h = h * _U(_BASE) + _BYTE[reversed_left[:, o]]
    found = np.flatnonzero((high >= 0) & ~np.array(decided, bool))
    return [(ids[i], ths[i], places[i] - int(high[i]), places[i] - int(low[i]) + length) for i in found.tolist()]


def _merge_rows(length: int, gram: int):
    def merge(runs):
        held = []
        for entry in LoserTree(runs):
            if entry[0] < gram and len(held) >= HELD:  # another gram
                yield repeated_spans(held, length)
                held = []
            held.append(entry)
        yield repeated_spans(held, length)

    def out(spans):
        cols = list(zip(*spans)) or [()] * 4
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int32()))], names=["id0", "th", "s", "e"]
        )

    def run(rows):
        part, runs, key, held = None, [], None, []

        def window_spans():
            return [x for x in held if x[3] >= 0] if len(held) > 1 or any(x[3] < 0 for x in held) else []

        for cols in batches(rows, "part", "kind", "k", "k2", "id0", "th", "s", "e", "run"):
            spans = []
            for p, kind, k, k2, id0, th, s, e, data in zip(*cols):
                if kind == _SPAN:
                    spans.append((id0, th, s, e))
                elif kind == _RUN:
                    if p != part:
                        for x in merge(runs) if runs else ():
                            yield out(x)
                        part, runs = p, []
                    runs.append(data)
                else:
                    if (k, k2) != key:
                        spans += window_spans()
                        key, held = (k, k2), []
                    held.append((id0, th, s, e))
            yield out(spans)
        for x in merge(runs) if runs else ():
            yield out(x)
        yield out(window_spans())

    return run


# -------------------------------------------------------------------- result


def merged(spans):
    """Overlapping or touching (start, end) spans joined."""
    out = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


def _cut(raw: bytes, spans) -> bytes:
    out, at = [], 0
    for s, e in spans:
        out.append(raw[at:s])
        at = e
    return b"".join([*out, raw[at:]])


def remove_repeated(
    documents: DataFrame, length: int = LENGTH, gram: int = GRAM, large: int = LARGE, id_col: str = "doc_id", with_text: bool = False
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, and, if asked for, the
    kept bytes (a removed run may end inside a character)."""
    spark = documents.sparkSession
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    th = F.xxhash64("raw")
    docs = text_rows(documents, id_col).withColumn("id0", F.coalesce("doc_id", th)).withColumn("th", th)
    grams = docs.select("id0", "raw").mapInArrow(_gram_rows(length, gram), _SIEVE).repartition("k").sortWithinPartitions("k")
    many = grams.mapInArrow(_large_grams(large), "g long, large boolean")
    asked = (
        grams.mapInArrow(_repeated_grams, "id0 long, g long").join(many, "g", "left")
        .groupBy("id0").agg(F.collect_list(F.struct("g", F.coalesce("large", F.lit(False)).alias("large"))).alias("found"))
    )
    # texts are exchanged once: both joins below use this exchange
    placed = docs.select("id0", "doc_id", "th", "raw").repartition("id0")
    steps = placed.join(asked, "id0").mapInArrow(_run_rows(length, gram, parts), _STEP)
    spans = (
        steps.repartition("part").sortWithinPartitions("part", "kind", "k", "k2").mapInArrow(_merge_rows(length, gram), "id0 long, th long, s int, e int")
        .groupBy("id0").agg(F.collect_list(F.struct("th", "s", "e")).alias("spans"))
    )

    def finish(rows):
        for ids, ths, raws, lists in batches(rows, "doc_id", "th", "raw", "spans"):
            per = [merged([(x["s"], x["e"]) for x in found or () if x["th"] == th]) for th, found in zip(ths, lists)]
            kept = [_cut(r, p) for r, p in zip(raws, per)]
            cols = [
                pa.array(ids, pa.int64()), pa.array([len(r) for r in raws], pa.int64()),
                pa.array([len(r) - len(k) for r, k in zip(raws, kept)], pa.int64()), pa.array([len(p) for p in per], pa.int64()),
                pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(
                cols + [pa.array(kept, pa.binary())] * with_text, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_text
            )

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
    return placed.join(spans, "id0", "left").mapInArrow(finish, schema)
