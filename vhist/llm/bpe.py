"""BPE encoding and decoding with content-defined chunk reuse.

A text is cut where a rolling hash of its last bytes meets a mask, so texts
that share a passage share chunks.  Each chunk is encoded once per worker (a
cache of bounded bytes that outlives tasks); where two chunks meet, the text
between the last safe place of the left and the first safe place of the right
is encoded again, and the stretch grows until both sides agree.  A place is
safe where an ASCII letter is followed by a space: the pre-tokenizer always
splits there, whatever stands around it, so tokens on either side of it do not
depend on each other.

Chunks are reused within a worker, not across the cluster: sending chunk texts
and ids through a shuffle would write more than the input (see README).

Defined cases: a null text is the empty text; the end-of-text string in a text
becomes its id, as in the library; any length of text is encoded whole, and so
are long runs of white space.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections import OrderedDict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from vhist.llm.common import batches, text_rows

MIN_CHUNK = 256
CHUNK_MASK = 0x3FF  # one cut per 1,024 bytes on average
CACHE_BYTES = 32 << 20

# Fixed value: the byte-level pre-tokenizer's pattern.
SPLIT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# The pattern's backtracking stack overflows on about a million white spaces
# (White_Space of Unicode), so longer runs than this are split by hand.
LONG_RUN = 100_000
_LONG_RUN = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % LONG_RUN)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Codec:
    """Encoder and decoder of one tokenizer file."""

    def __init__(self, path: str, as_text: bool = False):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if (spec.get("normalizer"), spec["pre_tokenizer"]) != (
            None,
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True},
        ):
            raise ValueError(f"{path}: only byte-level BPE without normalizer is handled")
        symbols = _byte_symbols()
        special = {a["content"]: a["id"] for a in spec["added_tokens"] if a["special"]}
        ranks = {bytes(symbols[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        self.special = special
        self.allowed = set() if as_text else set(special)
        self.inner = tiktoken.Encoding("own", pat_str=SPLIT_PATTERN, mergeable_ranks=ranks, special_tokens=special)
        names = {i: t for t, i in ranks.items()} | {i: t.encode() for t, i in special.items()}
        self.size = max(names) + 1
        self.dtype = np.uint16 if self.size <= 1 << 16 else np.uint32
        self.token_bytes = [names.get(i, b"") for i in range(self.size)]
        self.lengths = np.array([len(t) for t in self.token_bytes])
        self.decimal = [str(i) for i in range(self.size)]
        self.cache: OrderedDict = OrderedDict()
        self.cached = 0

    def encode(self, raw: bytes) -> list[int]:
        text = raw.decode("utf-8")
        out, at = [], 0
        for run in _LONG_RUN.finditer(text) if len(text) >= LONG_RUN else ():
            end = run.end()
            # a run is one piece without its last character, or whole at the end of a text
            if end < len(text) and not any(text.startswith(x, end) for x in self.allowed):
                end -= 1
            out += self._encode(text[at : run.start()])
            out += self.inner._encode_single_piece(text[run.start() : end].encode())
            at = end
        return out + self._encode(text[at:]) if at else self._encode(text)

    def _encode(self, text: str) -> list[int]:
        if self.allowed:
            return self.inner.encode(text, allowed_special=self.allowed, disallowed_special=())
        return self.inner.encode_ordinary(text)

    def _chunk(self, raw: bytes):
        """(ids, safe places as (byte, id) pairs: first and last, or None) of a chunk, from the cache if it is there."""
        hit = self.cache.get(raw)
        if hit is not None:
            self.cache.move_to_end(raw)
            return hit
        ids = self.encode(raw)
        first = last = None
        ends = np.cumsum(self.lengths[ids]) if ids else np.zeros(0, int)
        for find in (_first_safe, _last_safe):
            at = find(raw)
            if at > 0:
                k = int(np.searchsorted(ends, at))
                if k < len(ends) and ends[k] == at:  # the two splits agree here
                    if find is _first_safe:
                        first = (at, k + 1)
                    else:
                        last = (at, k + 1)
        if first is None or last is None:
            first = last = None
        hit = (np.array(ids, self.dtype), first, last)  # a list would hold an object per id
        self.cache[raw] = hit
        self.cached += _held(raw, hit[0])
        while self.cached > CACHE_BYTES:
            old, (old_ids, _, _) = self.cache.popitem(last=False)
            self.cached -= _held(old, old_ids)
        return hit

    def encode_chunked(self, raw: bytes) -> list[int]:
        """The ids of a whole text, by chunks and repaired joins."""
        cuts = chunk_cuts(raw)
        if not cuts:
            return self.encode(raw)
        out: list[int] = []
        pending = b""  # text since the last safe place
        for s, e in zip([0, *cuts], [*cuts, len(raw)]):
            piece = raw[s:e]
            ids, first, last = self._chunk(piece)
            if first is None:
                pending += piece  # no safe place: the stretch grows
                continue
            if s == 0:
                out += ids[: last[1]].tolist()
            else:
                out += self.encode(pending + piece[: first[0]])
                out += ids[first[1] : last[1]].tolist()
            pending = piece[last[0] :]
        out += self.encode(pending)
        return out

    def decode(self, ids: list[int]) -> bytes:
        raw = b"".join([self.token_bytes[i] for i in ids])
        return raw.decode("utf-8", errors="replace").encode("utf-8")

    def ids_text(self, ids: list[int]) -> str:
        return ",".join([self.decimal[i] for i in ids])


def _held(raw: bytes, ids: np.ndarray) -> int:
    """Bytes that a cached chunk takes, its objects' heads included."""
    return len(raw) + ids.nbytes + 600


_SAFE_BEFORE = frozenset(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")


def _first_safe(raw: bytes) -> int:
    at = raw.find(b" ", 1)
    while at > 0 and raw[at - 1] not in _SAFE_BEFORE:
        at = raw.find(b" ", at + 1)
    return at


def _last_safe(raw: bytes) -> int:
    at = raw.rfind(b" ")
    while at > 0 and raw[at - 1] not in _SAFE_BEFORE:
        at = raw.rfind(b" ", 0, at)
    return at


_GEAR = np.random.default_rng(17).integers(0, 1 << 32, 256, dtype=np.uint32)


def chunk_cuts(raw: bytes, min_chunk: int = MIN_CHUNK, mask: int = CHUNK_MASK) -> list[int]:
    """Cut places by a rolling hash over the last 16 bytes, at character bounds."""
    if len(raw) < 2 * min_chunk:
        return []
    b = np.frombuffer(raw, np.uint8)
    h = _GEAR[b]
    for shift in (1, 2, 4, 8):  # h(i) = sum of gear(b[i-k]) << k, k = 0..15, by doubling
        h[shift:] = h[shift:] + (h[:-shift] << np.uint32(shift))
    at = np.flatnonzero(((h >> np.uint32(16)) & np.uint32(mask)) == 0) + 1
    cuts, last = [], 0
    for p in at.tolist():
        while p < len(raw) and raw[p] & 0xC0 == 0x80:
            p += 1
        if p - last >= min_chunk and p < len(raw):
            cuts.append(p)
            last = p
    return cuts


@functools.cache
def codec(path: str, as_text: bool = False) -> Codec:
    """One codec per worker and file; its cache lives as long as the worker."""
    return Codec(path, as_text)


def encode_documents(documents: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id", with_ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, the ids."""
    path = tokenizer or default_tokenizer()

    def run(rows):
        c = codec(path)
        for keys, raws in batches(rows, "doc_id", "raw"):
            n, ids_sha, decoded_sha, all_ids = [], [], [], []
            for raw in raws:
                ids = c.encode_chunked(raw)
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(c.ids_text(ids).encode()).hexdigest())
                decoded_sha.append(hashlib.sha256(c.decode(ids)).hexdigest())
                if with_ids:
                    all_ids.append(np.array(ids, np.int32))
            cols = [pa.array(keys, pa.int64()), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(decoded_sha, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                cols.append(pa.array(all_ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return text_rows(documents, id_col).mapInArrow(run, schema)


def decode_ids(encoded: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and the text of each row's ids (null ids: the empty text)."""
    path = tokenizer or default_tokenizer()

    def run(rows):
        c = codec(path)
        for keys, ids in batches(rows, "doc_id", "ids"):
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array([c.decode(x or []).decode() for x in ids], pa.string())], names=["doc_id", "text"]
            )

    rows = encoded.select(encoded[id_col].cast("long").alias("doc_id"), encoded[ids_col].alias("ids"))
    return rows.mapInArrow(run, "doc_id long, text string")
