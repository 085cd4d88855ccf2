"""Benchmark decontamination as a prefix-filtered containment join.

An item's windows are its runs of ``window`` consecutive words (the whole item
if it has fewer words, none if it has no word).  A document holds a window if
all the window's words stand in it in order, so for exact containment one
prefix token suffices: the window's rarest word in the corpus.  Documents look
up only words that are some window's prefix token; length and position bounds
place the one possible window around such a word, and the words there are
compared with the window.

The windows go to the executors in blocks of at most ``block_windows``
distinct windows, so what is broadcast is bounded however large the benchmark;
all documents meet every block.

Defined cases: null texts have no words; an item without words has no window;
items repeated under one id count once; windows of an item without id hit
words but name no item; every document row gives one row, repeated ids too.
"""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vhist.llm.common import batches, filtered, text_rows, words_of, written

WINDOW = 10
BLOCK_WINDOWS = 100_000

_WINDOWS = "words binary, items array<string>"
_SCAN = "row_id long, doc_id long, n_words long, starts array<int>, ends array<int>, items array<string>"
_RESULT = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def item_windows(items: DataFrame, window: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct windows with the ids (as strings) of the items that hold them."""

    def cut(rows):
        for ids, raws in batches(rows, "doc_id", "raw"):
            out = []
            for i, raw in zip(ids, raws):
                w = words_of(raw)
                out += [(b" ".join(w[k : k + window]), i) for k in range(max(1, len(w) - window + 1)) if w]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in out], pa.binary()), pa.array([None if i is None else str(i) for _, i in out], pa.string())],
                names=["words", "item"],
            )

    cuts = text_rows(items, id_col, text_col).mapInArrow(cut, "words binary, item string")
    return cuts.groupBy("words").agg(F.array_sort(F.collect_set("item")).alias("items"))


def _corpus_counts(docs: DataFrame, vocabulary: set) -> dict[bytes, int]:
    """How often each word of the vocabulary stands in the corpus (all documents)."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(rows):
        total = Counter()
        for (raws,) in batches(rows, "raw"):
            for raw in raws:
                total.update(filter(known.value.__contains__, words_of(raw)))  # at most the block's words
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())], names=["word", "n"]
        )

    sums = docs.select("raw").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {bytes(r.word): r.n for r in sums.collect()}  # at most one row per word of the block


def _index(windows: dict, counts: dict):
    """Prefix token -> {(its position in the window, window length)}."""
    prefix = defaultdict(set)
    for w in windows:
        k = min(range(len(w)), key=lambda i: (counts.get(w[i], 0), w[i], i))
        if counts.get(w[k], 0):  # else no document can hold the window
            prefix[w[k]].add((k, len(w)))
    return {t: sorted(places) for t, places in prefix.items()}


def _occurrences(words: list[bytes], prefix: dict, windows: dict):
    """(start, end, items) of every window occurrence."""
    n = len(words)
    for i in [i for i, w in enumerate(words) if w in prefix]:
        for k, length in prefix[words[i]]:
            if k <= i and i - k + length <= n:  # positional and length bounds
                items = windows.get(tuple(words[i - k : i - k + length]))
                if items is not None:
                    yield i - k, i - k + length, items


def _merged(spans):
    """Overlapping or touching (start, end) spans joined."""
    out = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


def _scan(docs: DataFrame, windows: dict, prefix: dict) -> DataFrame:
    index = docs.sparkSession.sparkContext.broadcast((prefix, windows))

    def find(rows):
        prefix, windows = index.value
        for rids, ids, raws in batches(rows, "row_id", "doc_id", "raw"):
            out = []
            for rid, i, raw in zip(rids, ids, raws):
                words, spans, items = words_of(raw), [], set()
                for s, e, found in _occurrences(words, prefix, windows):
                    spans.append((s, e))
                    items.update(found)
                spans = _merged(spans)
                out.append((rid, i, len(words), [s for s, _ in spans], [e for _, e in spans], list(items)))
            cols = list(zip(*out)) or [()] * 6
            types = [pa.int64()] * 3 + [pa.list_(pa.int32())] * 2 + [pa.list_(pa.string())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, types)], names=["row_id", "doc_id", "n_words", "starts", "ends", "items"]
            )

    return docs.mapInArrow(find, _SCAN)


def _blocks(docs: DataFrame, cuts: DataFrame, block_windows: int):
    """(windows, index of prefix tokens) of each block of windows, counted over all documents."""
    blocks = max(1, -(-cuts.count() // block_windows))
    for b in range(blocks):
        # hash blocks: about block_windows windows of at most `window` words each
        rows = cuts.filter(F.pmod(F.xxhash64("words"), F.lit(blocks)) == b).collect()
        windows = {tuple(bytes(r["words"]).split()): list(r["items"]) for r in rows}
        counts = _corpus_counts(docs, {w for x in windows for w in x})
        yield windows, _index(windows, counts)


def clean_documents(documents: DataFrame, items: DataFrame, columns: list[str], window: int = WINDOW, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """The named columns of the documents that hold no window of any item, left
    where they are: block after block of windows filters what is left."""
    docs, out = text_rows(documents), documents
    for windows, prefix in _blocks(docs, item_windows(items, window), block_windows):
        index = documents.sparkSession.sparkContext.broadcast((prefix, windows))

        def clean(raws, index=index):
            prefix, windows = index.value
            return [next(_occurrences(words_of(r), prefix, windows), None) is None for r in raws]

        out = filtered(out, columns, clean)
    return out


def contamination(
    documents: DataFrame, items: DataFrame, window: int = WINDOW, block_windows: int = BLOCK_WINDOWS, id_col: str = "doc_id"
) -> DataFrame:
    """One row per document: words, words inside a window occurrence, items found."""
    docs = text_rows(documents, id_col).withColumn("row_id", F.monotonically_increasing_id())
    cuts = item_windows(items, window)
    indexes = list(_blocks(docs, cuts, block_windows))
    blocks = len(indexes)
    if blocks > 1:
        docs = written(docs, "texts")  # each pass must see the same row ids
    scans = [_scan(docs, windows, prefix) for windows, prefix in indexes]
    found = scans[0]
    for s in scans[1:]:
        found = found.unionByName(s)
    if blocks > 1:
        found = found.groupBy("row_id").agg(
            F.first("doc_id").alias("doc_id"),
            F.first("n_words").alias("n_words"),
            *(F.flatten(F.collect_list(c)).alias(c) for c in ("starts", "ends", "items")),
        )

    def finish(rows):
        for ids, n_words, starts, ends, names in batches(rows, "doc_id", "n_words", "starts", "ends", "items"):
            spans = [_merged(zip(s, e)) for s, e in zip(starts, ends)]
            hit = [sum(e - s for s, e in x) for x in spans]
            names = [sorted(set(x)) for x in names]
            sha = [hashlib.sha256(",".join(x).encode()).hexdigest() for x in names]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(n_words, pa.int64()),
                    pa.array(hit, pa.int64()),
                    pa.array([len(x) for x in names], pa.int64()),
                    pa.array(sha, pa.string()),
                    pa.array([h > 0 for h in hit], pa.bool_()),
                ],
                names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
            )

    return found.mapInArrow(finish, _RESULT)
