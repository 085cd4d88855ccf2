"""Repeated word spans against a plain dictionary of windows."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vhist.llm import debruijn

LAST = 1 << 63


def plain(rows, window):
    split = [(LAST if i is None else i, (t or "").encode().split()) for i, t in rows]
    first: dict = {}
    for i, w in split:
        for s in range(len(w) - window + 1):
            key = tuple(w[s : s + window])
            first[key] = min(first.get(key, LAST), i)
    out = []
    for (i, w), (doc_id, _) in zip(split, rows, strict=True):
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if first[tuple(w[s : s + window])] < i:
                gone[s : s + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((doc_id, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def frame(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for clash in ("raw", "block", "body", "path", "first", "n"):
        df = df.withColumn(clash, F.lit("clash"))
    return df


def some_rows(seed, window):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdeé日", k=rng.randint(1, 4))) for _ in range(60)]
    new = lambda n: [rng.choice(words) + str(rng.randint(0, 99)) for _ in range(n)]
    passage, other = new(4 * window), new(window)
    space = lambda w: "".join(x + rng.choice([" ", " ", "  ", "\n", "\t", "\r\n", "\x0b"]) for x in w)
    texts = [new(rng.randint(0, 3 * window)) for _ in range(15)]
    for _ in range(20):  # parts of one passage among other words
        a = rng.randint(0, len(passage) - 1)
        texts.append(new(rng.randint(0, 8)) + passage[a : a + rng.randint(1, 4 * window)] + new(rng.randint(0, 8)))
    texts += [passage, passage, other, other[:-1], new(3) + other, other + other + new(2) + other]
    for _ in range(8):  # near copies
        t = list(passage)
        t[rng.randrange(len(t))] = "#"
        texts.append(t)
    texts += [["x"] * 5 * window, ["x"] * (window - 1), ["x"] * window, ["a", "b"] * window, ["b", "a"] * window, []]
    rows = [(i, space(t)) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    rows += [(None, rows[3][1]), (None, space(passage)), (4, space(passage)), (4, space(passage)), (900, None), (901, ""), (902, " \n "), (None, None)]
    return rows + [(1000 + i, space(passage[:-1])) for i in range(5)] + [(2000, "\xa0".join(passage))]


@pytest.mark.parametrize(
    "seed,window,anchor,hot,block,task,bits",
    [
        (1, 10, 3, 20_000, 4 << 20, 2 << 20, 64),
        (2, 10, 3, 2, 2_000, 50, 64),  # hot anchors window by window, small blocks and tasks
        (3, 10, 3, 20_000, 3_000, 100, 6),  # colliding hashes
        (4, 10, 3, 3, 3_000, 10, 3),
        (5, 6, 6, 1, 500, 1, 64),
        (6, 50, 8, 20_000, 30_000, 5_000, 64),
    ],
)
def test_removed_equals_plain(spark, seed, window, anchor, hot, block, task, bits):
    rows = some_rows(seed, window)
    got = debruijn.remove_repeated_words(
        frame(spark, rows).repartition(3), window=window, anchor=anchor, hot=hot, block_bytes=block, task_windows=task, bits=bits
    )
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain(rows, window)


def test_kept_text_and_spans(spark):
    words = [f"w{i}" for i in range(120)]
    rows = [(5, " ".join(words)), (3, "a b " + " ".join(words[20:100]) + " c"), (9, "d\n" + "  ".join(words[40:])), (None, "x " + " ".join(words[:60]))]
    got = {r.doc_id: r for r in debruijn.remove_repeated_words(frame(spark, rows), with_text=True).collect()}
    assert got[3].kept == rows[1][1] and got[5].kept == " ".join(words[:20] + words[100:])
    assert got[9].kept == "d" and got[None].kept == "x"
    spans = debruijn.repeated_spans(frame(spark, rows)).collect()
    split = {i: t.split() for i, t in rows}
    where = {(r.doc_id, tuple(split[r.doc_id][r.first_word : r.first_word + r.n_words])) for r in spans}
    assert all(len(t) == r.n_words for r, (_, t) in zip(spans, [(0, split[r.doc_id][r.first_word : r.first_word + r.n_words]) for r in spans], strict=True))
    assert (3, tuple(words[40:100])) not in where or len(where) == len(spans)
    covered = {w for i, t in where for w in t}
    assert covered == set(words)  # every word stands in a span of two documents


def test_empty_tables(spark):
    assert debruijn.remove_repeated_words(frame(spark, [])).count() == 0
    assert [tuple(r)[:3] for r in debruijn.remove_repeated_words(frame(spark, [(1, None)])).collect()] == [(1, 0, 0)]


def test_paths_are_compacted(spark):
    """Segments of one long passage become one path; a branch ends it."""
    passage = [f"w{i}" for i in range(400)]
    rows = [(1, " ".join(passage)), (2, " ".join(passage)), (3, " ".join(passage[:200]) + " z")]
    spans = sorted((r.doc_id, r.first_word, r.n_words) for r in debruijn.repeated_spans(frame(spark, rows)).collect())
    assert spans == [(1, 0, 200), (1, 151, 249)]


def test_many_rows_of_one_id_and_a_common_passage(spark):
    rng = np.random.default_rng(8)
    passage = " ".join(f"p{i}" for i in range(70))
    rows = [(7 if i % 3 == 0 else i, f"u{rng.integers(1 << 40)} {passage} v{i}") for i in range(3000)]
    got = debruijn.remove_repeated_words(frame(spark, rows).repartition(8), hot=50, block_bytes=20_000)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain(rows, 50)
