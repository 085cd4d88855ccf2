"""Alignment of two tokenizers' tokens by merge-path partitioning.

A text is encoded twice: by a byte-level BPE (A, with a space put before) and
by a sentencepiece model (B, which adds that space itself).  Tokens cover byte
ranges; where an A and a B token both end, a group closes.  Two tokens are
linked if their byte ranges overlap.

The sorted token ends of a block of texts (A's and B's, all texts after each
other) are merged along the merge path: binary searches on equally spaced
diagonals cut both lists into pieces of equal work, whatever the texts' sizes
are.  A piece is merged on its own and emits its overlaps; a piece whose first
end equals the last A end before it is stitched to the group that this closes.

Both encoders split at a single space between other characters (the byte-level
pattern always does, and no piece has an inner space mark; a model with such
pieces is refused), so texts are encoded by such units, each unit once while
it is in a worker's store.  Long texts are cut at units into parts of
``part_bytes``.

Blocks are written once, in buckets.  Each block counts in how many of its
documents a pair is linked; the counts are added over all blocks with Spark
aggregates, and a block gets back the counts of its own pairs, so rows grow
with blocks times pairs, not with links.

Defined cases: null and empty texts, texts that are no UTF-8, and texts whose
tokens do not spell space + text have no tokens: zeros and an empty
groups_sha256.  Every row is a document, also where ids repeat or are null.
An empty table gives no rows.  Other columns are left behind.
"""

from __future__ import annotations

import functools
import hashlib
import re
from array import array

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vhist.llm import bpe
from vhist.llm.common import batches, bucketed, discard, written

PART_BYTES = 3 << 20
WORK = 1 << 16  # token ends merged by a piece
STORE_BYTES = 32 << 20

_UNIT = re.compile(r"(?<=\S) (?=\S)")
_MARK = "▁"


def default_pieces() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def merge_path(a: np.ndarray, b: np.ndarray, work: int = WORK) -> list[tuple[int, int]]:
    """Where diagonals ``work`` apart cross the merge path of two sorted lists
    (equal values: a first): (taken from a, taken from b), from (0, 0) to the ends."""
    n, m = len(a), len(b)
    d = np.append(np.arange(0, n + m, work), n + m)
    low, high = np.maximum(0, d - m), np.minimum(d, n)
    while (low < high).any():
        mid = (low + high) // 2
        open_ = low < high
        first = np.zeros(len(d), bool)
        first[open_] = a[mid[open_]] <= b[d[open_] - 1 - mid[open_]]
        low, high = np.where(open_ & first, mid + 1, low), np.where(open_ & ~first, mid, high)
    return list(zip(low.tolist(), (d - low).tolist(), strict=True))


def overlaps(a: np.ndarray, b: np.ndarray, start: tuple[int, int], end: tuple[int, int]):
    """One piece: (A token, B token) of its overlaps in order, and the A and B
    tokens at whose common end a group closes in this piece."""
    (i, i_end), (j, j_end) = (start[0], end[0]), (start[1], end[1])
    x, y = a[i:i_end], b[j:j_end]
    before_x, before_y = np.searchsorted(y, x, "left"), np.searchsorted(x, y, "right")
    token_a = np.empty(len(x) + len(y), np.int64)
    token_b = np.empty(len(x) + len(y), np.int64)
    at_x, at_y = np.arange(len(x)) + before_x, np.arange(len(y)) + before_y
    token_a[at_x], token_b[at_x] = np.arange(i, i_end), j + before_x
    token_a[at_y], token_b[at_y] = i + before_y, np.arange(j, j_end)
    last = i + before_y - 1  # the A end before each B end, maybe of the piece before
    common = np.zeros(len(y), bool)
    known = last >= 0
    common[known] = a[last[known]] == y[known]
    some = np.ones(len(token_a), bool)
    some[at_y[common]] = False  # no bytes between equal ends
    return token_a[some], token_b[some], last[common], np.flatnonzero(common) + j


def merged(a: np.ndarray, b: np.ndarray, work: int = WORK):
    """Overlaps and group ends of all pieces, stitched."""
    cuts = merge_path(a, b, work)
    pieces = [overlaps(a, b, s, e) for s, e in zip(cuts[:-1], cuts[1:], strict=True)]
    if not pieces:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(x) for x in zip(*pieces, strict=True))


class Encoders:
    """Both tokenizers, and a store of the units encoded so far."""

    def __init__(self, path_a: str, path_b: str, pattern: re.Pattern = _UNIT):
        import sentencepiece

        self.a = bpe.codec(path_a, True)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(re.search(f"[^{_MARK}]{_MARK}", p) for p in pieces):
            raise ValueError(f"{path_b}: pieces with an inner space are not handled")
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_MARK, " ").encode() for i, p in enumerate(pieces)]
        self.a_len, self.b_len = self.a.lengths.astype(np.int64), np.array([len(p) for p in self.b_bytes], np.int64)
        self.pattern = pattern
        # what stands for a token in a text of groups: the last A of a group is followed by |, the last B by ;
        self.parts = [f"{i}{s}" for i in range(self.a.size) for s in ",|"] + [f"{i}{s}" for i in range(len(pieces)) for s in ",;"]
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.start = (array("i"), array("i")), (array("q", [0]), array("q", [0]))
        self.good, self.held = bytearray(), 0

    def learn(self, units: list[str]) -> None:
        """Encode the units that are not known yet, in one text."""
        new = [u for u in dict.fromkeys(units) if u not in self.known]
        for u in new:
            if u[0].isspace() or u[-1].isspace():  # spaces would run into those between units
                self._learn([u])
        new = [u for u in new if u not in self.known]
        if new:
            self._learn(new)

    def _learn(self, new: list[str]) -> None:
        text = " ".join(new)
        raw = b" " + text.encode()
        size = np.array([len(u.encode()) + 1 for u in new])
        lots = [" ".join(new[i : i + 256]) for i in range(0, len(new), 256)]  # the library slows down on long texts
        ids = self.a.encode(raw), [i for x in self.b.encode(lots, num_threads=1) for i in x]
        spelled = [b"".join([t[i] for i in x]) == raw for t, x in zip((self.a.token_bytes, self.b_bytes), ids, strict=True)]
        if not all(spelled) and len(new) > 1:
            for u in new:  # one by one, to tell which
                self._learn([u])
            return
        for side, x, sizes in ((0, ids[0], self.a_len), (1, ids[1], self.b_len)):
            at = np.searchsorted(np.cumsum(sizes[x]), np.cumsum(size), "left") + 1 if all(spelled) else np.array([0])
            self.start[side].frombytes((len(self.flat[side]) + at.astype(np.int64)).tobytes())
            self.flat[side].extend(x if all(spelled) else ())
        self.good += bytes([all(spelled)]) * len(new)
        self.held += 5 * len(raw) + 180 * len(new)
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))

    def numbers(self, units: list[str]) -> list[int] | None:
        """The units' numbers, or None if their tokens do not spell them."""
        out = list(map(self.known.__getitem__, units))
        return out if all(map(self.good.__getitem__, out)) else None

    def spells(self, text: str) -> bool:
        units = self.pattern.split(text)
        self.learn(units)
        return self.numbers(units) is not None

    def sizes(self, side: int) -> np.ndarray:
        return np.diff(np.frombuffer(self.start[side], np.int64))

    def tokens(self, units: np.ndarray, side: int) -> np.ndarray:
        """The ids of the units, after each other."""
        if not len(units):
            return np.zeros(0, np.int64)
        flat, start = np.frombuffer(self.flat[side], np.int32), np.frombuffer(self.start[side], np.int64)
        n = self.sizes(side)[units]
        return flat[np.repeat(start[units] - (np.cumsum(n) - n), n) + np.arange(n.sum())].astype(np.int64)


@functools.cache
def encoders(path_a: str, path_b: str) -> Encoders:
    return Encoders(path_a, path_b)


def text_parts(text: str, part: int, pattern: re.Pattern = _UNIT) -> list[str]:
    """A text cut at units after at least ``part`` characters each."""
    out, at = [], 0
    while len(text) - at > part:
        cut = pattern.search(text, at + part)
        if not cut:
            break
        out.append(text[at : cut.start()])
        at = cut.end()
    return [*out, text[at:]]


class Block:
    """Parts of documents that are merged together."""

    def __init__(self, e: Encoders):
        self.e, self.rows, self.chars = e, [], 0

    def add(self, rid: int, doc_id, text: str | None) -> None:
        self.rows.append((rid, doc_id, self.e.pattern.split(text) if text else []))
        self.chars += len(text or " ")

    def units(self) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all units, and where each row's begin and end."""
        self.e.learn([u for _, _, units in self.rows for u in units])
        numbers = [self.e.numbers(units) or [] for _, _, units in self.rows]
        flat = np.array([n for x in numbers for n in x], np.int64)
        return flat, np.cumsum([0, *map(len, numbers)])


def _text(raw) -> str | None:
    try:
        return raw.decode("utf-8") if raw else None
    except UnicodeDecodeError:
        return None


def _blocks(rows, e: Encoders, part_bytes: int, work: int):
    """Blocks of a partition's documents: one dictionary of arrays each."""
    long_hash, long_seen, block = None, None, Block(e)

    def close(last: bool = True):
        nonlocal long_hash, long_seen, block
        done, (long_hash, long_seen) = _aligned(block, work, long_hash, long_seen, last)
        block = Block(e)
        if e.held > STORE_BYTES:
            e.clear()
        return done

    for rids, ids, raws in batches(rows, "rid", "doc_id", "raw"):
        for rid, doc_id, raw in zip(rids, ids, raws, strict=True):
            text = _text(raw)
            parts = text_parts(text, part_bytes, e.pattern) if text else [None]
            if len(parts) == 1:
                block.add(rid, doc_id, text)
            elif not all(map(e.spells, parts)):
                block.add(rid, doc_id, None)
            else:
                if block.rows:
                    yield close()
                for n, p in enumerate(parts):
                    block.add(rid, doc_id, p)
                    yield close(n + 1 == len(parts))
            if block.chars >= part_bytes:
                yield close()
    if block.rows:
        yield close()


def _aligned(block: Block, work: int, long_hash, long_seen, last: bool):
    """Links of a block, counted.  A document of several parts has blocks of its
    own; ``long_hash`` and ``long_seen`` go from one to the next."""
    e, (units, unit_at) = block.e, block.units()
    ids_a, ids_b = e.tokens(units, 0), e.tokens(units, 1)
    a, b = np.cumsum(e.a_len[ids_a]), np.cumsum(e.b_len[ids_b])
    link_a, link_b, close_a, close_b = merged(a, b, work)
    token_at = [np.append(0, np.cumsum(e.sizes(side)[units]))[unit_at] if len(units) else np.zeros(len(unit_at), np.int64) for side in (0, 1)]
    n_a, n_b = np.diff(token_at[0]), np.diff(token_at[1])
    n_groups = np.diff(np.searchsorted(close_a, token_at[0], "left"))
    link_at = np.searchsorted(link_a, token_at[0], "left")
    n_links = np.diff(link_at)
    # the texts of groups: A tokens of a group, then its B tokens
    flag_a, flag_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
    flag_a[close_a], flag_b[close_b] = 1, 1
    group_a, group_b = np.cumsum(flag_a) - flag_a, np.cumsum(flag_b) - flag_b
    codes = np.empty(len(ids_a) + len(ids_b), np.int64)
    codes[np.arange(len(ids_a)) + np.append(0, close_b + 1)[group_a]] = 2 * ids_a + flag_a
    codes[np.arange(len(ids_b)) + (close_a + 1)[group_b]] = 2 * (e.a.size + ids_b) + flag_b
    code_at, sha, part = token_at[0] + token_at[1], [], e.parts.__getitem__
    for s, t in zip(code_at[:-1].tolist(), code_at[1:].tolist(), strict=True):
        if s == t:
            sha.append("")
            continue
        text = "".join(map(part, codes[s:t].tolist())).encode()
        h, long_hash = long_hash or hashlib.sha256(), None
        h.update(text[:-1] if last else text)
        if last:
            sha.append(h.hexdigest())
        else:
            sha.append("")
            long_hash = h
    # pairs: the block's different ones, and each document's with their links
    key = ids_a[link_a] * len(e.b_bytes) + ids_b[link_b]
    pairs = np.unique(key)
    doc = np.repeat(np.arange(len(n_links)), n_links)
    cell = np.sort(doc * np.int64(max(1, len(pairs))) + np.searchsorted(pairs, key))
    first = np.flatnonzero(np.append(True, cell[1:] != cell[:-1])) if len(cell) else np.zeros(0, np.int64)
    links, cell = np.diff(np.append(first, len(cell))), cell[first]
    at, of = cell % max(1, len(pairs)), cell // max(1, len(pairs))
    docs = np.bincount(at, minlength=len(pairs)) if len(pairs) else np.zeros(0, np.int64)
    if not last or long_seen is not None:  # a pair counts once in a document of several parts
        seen = long_seen if long_seen is not None else np.zeros(0, np.int64)
        docs = (~np.isin(pairs, seen)).astype(np.int64)
        long_seen = None if last else np.union1d(seen, pairs)
    out = {
        "rid": [r for r, _, _ in block.rows],
        "doc_id": [d for _, d, _ in block.rows],
        "n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links, "sha": sha,
        "n_pairs": np.bincount(of, minlength=len(n_links)) if len(of) else np.zeros(len(n_links), np.int64),
        "at": _packed(np.diff(at, prepend=0)), "links": _packed(links), "pairs": _packed(np.diff(pairs, prepend=0)), "docs": _packed(docs),
        "a": (ids_a, token_at[0]), "b": (ids_b, token_at[1]), "closes": (close_a, close_b),
    }
    return out, (long_hash, long_seen)


def _packed(x: np.ndarray) -> bytes:
    """Whole numbers as compressed bytes."""
    x = x.astype(np.int64)
    if len(x) and -(1 << 31) <= x.min() and x.max() < 1 << 31:
        x = x.astype(np.int32)
    body = x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes()  # first bytes together, and so on
    return bytes([x.itemsize]) + zstandard.ZstdCompressor(level=1).compress(body)


def _unpacked(raw: bytes) -> np.ndarray:
    body = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw[1:]), np.uint8)
    return np.ascontiguousarray(body.reshape(raw[0], -1).T).view(f"<i{raw[0]}").ravel().astype(np.int64)


_LISTS = ("rid", "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_pairs")
_BINARY = ("at", "links", "pairs", "docs")


def _rows(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    raw = documents[text_col].cast("string").cast("binary")
    return documents.select(F.monotonically_increasing_id().alias("rid"), documents[id_col].cast("long").alias("doc_id"), raw.alias("raw"))


def block_table(documents: DataFrame, tokenizer: str, pieces: str, id_col: str, text_col: str, part_bytes: int, work: int) -> tuple[DataFrame, str]:
    """The blocks of all documents, written in buckets, and their path."""

    def run(rows):
        base = TaskContext.get().partitionId() << 33
        for n, x in enumerate(_blocks(rows, encoders(tokenizer, pieces), part_bytes, work)):
            columns = [pa.array([base + n], pa.int64()), *(pa.array([x[c]], pa.list_(pa.int64())) for c in _LISTS)]
            columns += [pa.array([x["sha"]], pa.list_(pa.string())), *(pa.array([x[c]], pa.binary()) for c in _BINARY)]
            yield pa.RecordBatch.from_arrays(columns, names=["block", *_LISTS, "sha", *_BINARY])

    schema = "block long, " + ", ".join(f"{c} array<long>" for c in _LISTS) + ", sha array<string>, " + ", ".join(f"{c} binary" for c in _BINARY)
    return bucketed(_rows(documents, id_col, text_col).mapInArrow(run, schema), "alignment", "block")


def _block_pairs(blocks: DataFrame, n_b: int) -> DataFrame:
    """(block, a, b, docs) of each block's linked pairs."""

    def run(rows):
        for ids, pairs, docs in batches(rows, "block", "pairs", "docs", at_once=1):
            for block, p, d in zip(ids, pairs, docs, strict=True):
                key, d = np.cumsum(_unpacked(p)), _unpacked(d)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(key), block)), pa.array(key // n_b, pa.int32()), pa.array(key % n_b, pa.int32()), pa.array(d)],
                    names=["block", "a", "b", "docs"],
                )

    return blocks.select("block", "pairs", "docs").mapInArrow(run, "block long, a int, b int, docs long")


def _counted(pairs: DataFrame) -> DataFrame:
    """(a, b, n, best): documents that hold the pair, and whether that is a's highest."""
    counts = pairs.groupBy("a", "b").agg(F.sum("docs").alias("n"))
    highest = counts.groupBy("a").agg(F.max("n").alias("highest"))
    return counts.join(highest, "a").select("a", "b", "n", (F.col("n") == F.col("highest")).alias("best"))


def _pieces_in(path: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path).get_piece_size()


def pair_counts(documents: DataFrame, tokenizer: str | None = None, pieces: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                part_bytes: int = PART_BYTES, work: int = WORK) -> DataFrame:
    """a, b, n, best of every linked pair of ids in the corpus."""
    tokenizer, pieces = tokenizer or bpe.default_tokenizer(), pieces or default_pieces()
    blocks, path = block_table(documents, tokenizer, pieces, id_col, text_col, part_bytes, work)
    out = written(_counted(_block_pairs(blocks, _pieces_in(pieces))), "pair-counts")
    discard(out.sparkSession, path)
    return out


def token_groups(documents: DataFrame, tokenizer: str | None = None, pieces: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                 part_bytes: int = PART_BYTES, work: int = WORK) -> DataFrame:
    """doc_id, part, a_ids, b_ids and, for each group, where it ends in them
    (a_ends, b_ends).  Texts above ``part_bytes`` have several parts."""
    tokenizer, pieces = tokenizer or bpe.default_tokenizer(), pieces or default_pieces()
    lists = ("a_ids", "b_ids", "a_ends", "b_ends")

    def run(rows):
        part, before = 0, None
        for x in _blocks(rows, encoders(tokenizer, pieces), part_bytes, work):
            (ids_a, at_a), (ids_b, at_b), (close_a, close_b) = x["a"], x["b"], x["closes"]
            out: dict = {c: [] for c in lists}
            parts = []
            for i, rid in enumerate(x["rid"]):
                part, before = (part + 1 if rid == before else 0), rid
                parts.append(part)
                out["a_ids"].append(ids_a[at_a[i] : at_a[i + 1]])
                out["b_ids"].append(ids_b[at_b[i] : at_b[i + 1]])
                g = slice(*np.searchsorted(close_a, at_a[i : i + 2]))
                out["a_ends"].append(close_a[g] + 1 - at_a[i])
                out["b_ends"].append(close_b[g] + 1 - at_b[i])
            columns = [pa.array(x["doc_id"], pa.int64()), pa.array(parts, pa.int32()), *(pa.array(out[c], pa.list_(pa.int64())) for c in lists)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "part", *lists])

    return _rows(documents, id_col, text_col).mapInArrow(run, "doc_id long, part int, " + ", ".join(f"{c} array<long>" for c in lists))


def aligned_tokens(documents: DataFrame, tokenizer: str | None = None, pieces: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                   part_bytes: int = PART_BYTES, work: int = WORK) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document."""
    tokenizer, pieces = tokenizer or bpe.default_tokenizer(), pieces or default_pieces()
    n_b = _pieces_in(pieces)
    blocks, path = block_table(documents, tokenizer, pieces, id_col, text_col, part_bytes, work)
    pairs = _block_pairs(blocks, n_b)
    found = pairs.drop("docs").join(_counted(pairs), ["a", "b"]).select("block", (F.col("a").cast("long") * n_b + F.col("b")).alias("pair"), "n", "best")
    counts = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")

    def score(block: pa.Table, looked_up: pa.Table) -> pa.Table:
        order = np.argsort(looked_up["pair"].to_numpy())
        n, best = looked_up["n"].to_numpy()[order], looked_up["best"].to_numpy()[order]
        x = block.to_pylist()[0]
        at, links, starts = np.cumsum(_unpacked(x["at"])), _unpacked(x["links"]), np.cumsum([0, *x["n_pairs"]])
        sums = [np.append(0, np.cumsum(v))[starts] for v in (links * best[at], links * n[at])]
        columns = {c: x[c] for c in ("rid", "doc_id", "n_a", "n_b", "n_groups", "n_links")}
        columns |= {"n_best": np.diff(sums[0]), "count_sum": np.diff(sums[1]), "sha": x["sha"]}
        return pa.table([pa.array(v, pa.string() if c == "sha" else pa.int64()) for c, v in columns.items()], names=list(columns))

    schema = "rid long, doc_id long, " + ", ".join(f"{c} long" for c in counts) + ", sha string"
    parts = blocks.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(score, schema)
    out = parts.groupBy("rid").agg(F.first("doc_id").alias("doc_id"), *(F.sum(c).alias(c) for c in counts), F.max("sha").alias("groups_sha256"))
    out = written(out.drop("rid"), "aligned")
    discard(out.sparkSession, path)
    return out
