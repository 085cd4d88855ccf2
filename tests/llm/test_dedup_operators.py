"""Suffix merge and Jaccard join against brute force."""

import hashlib
import itertools
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from vhist.llm import jaccard, suffix_dedup
from vhist.llm.common import words_of
from vhist.llm.components import components


def frame(spark, texts, ids=None):
    rows = [(i if ids is None else ids[i], t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for clash in ("raw", "id0", "th", "part", "node", "key", "size", "path"):
        df = df.withColumn(clash, F.lit("clash"))
    return df


# ------------------------------------------------------------ suffix merge


def plain_repeats(texts, length):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = np.zeros(len(r) + 1, bool)
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = True
        runs = int((gone[1:] & ~gone[:-1]).sum() + gone[0]) if len(r) else 0
        kept = bytes(b for b, g in zip(r, gone) if not g)
        out.append((len(r), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def some_texts(seed, length):
    rng = random.Random(seed)
    word = lambda a="abcdé": "".join(rng.choices(a, k=rng.randint(1, 5)))
    new = lambda n: " ".join(word() for _ in range(n))
    passage, other = new(3 * length // 4), new(length // 2)
    texts = [new(rng.randint(0, length)) for _ in range(20)]
    texts += [new(5) + passage[rng.randint(0, 9) : rng.randint(length, len(passage))] + new(5) for _ in range(15)]
    texts += [other, other, other[: length - 1], other[:length], new(30) + other + new(3) + other]
    for _ in range(10):  # near copies
        t = list(passage)
        for _ in range(rng.randint(0, 4)):
            t[rng.randrange(len(t))] = "#"
        texts.append("".join(t))
    return texts + ["x" * (3 * length), "ab" * length, "é" * length, None, "", None, "x" * (length - 1)]


@pytest.mark.parametrize("seed,length,gram,large", [(1, 40, 16, 50_000), (2, 40, 8, 1), (3, 64, 32, 4), (4, 200, 64, 50_000)])
def test_removed_equals_plain(spark, seed, length, gram, large):
    texts = some_texts(seed, length)
    df = frame(spark, texts).repartition(5)
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.remove_repeated(df, length, gram, large).collect()}
    assert got == dict(enumerate(plain_repeats(texts, length)))


def test_repeated_ids_and_rows_without_id(spark):
    a, b = "".join(map(chr, range(97, 123))) * 10, "0123456789" * 30
    rng = random.Random(9)
    c = "".join(rng.choices("qwertz ", k=400))
    texts, ids = [a + c, b, c, a[:250], None], [1, 1, None, None, 1]
    got = sorted((tuple(r)[1:] for r in suffix_dedup.remove_repeated(frame(spark, texts, ids)).collect()), key=repr)
    assert got == sorted(plain_repeats(texts, 200), key=repr)
    assert suffix_dedup.remove_repeated(frame(spark, texts).limit(0)).count() == 0


def test_very_long_text_takes_the_wide_path(monkeypatch):
    rng = np.random.default_rng(3)
    raw = rng.integers(97, 101, 5_000, dtype=np.uint8).tobytes()
    plain = [x.tolist() for x in suffix_dedup.anchors([raw], 40, 16)[2:]]
    monkeypatch.setattr(suffix_dedup, "_PLACE", np.uint64((1 << 10) - 1))
    wide = [x.tolist() for x in suffix_dedup.anchors([raw], 40, 16)[2:]]
    assert plain[1:4] == wide[1:4]


@pytest.mark.parametrize("runs", [1, 2, 3, 7, 8])
def test_loser_tree_merges_and_never_compares_known_prefixes(runs, monkeypatch):
    rng = random.Random(runs)
    items = [bytes(rng.choices(b"ab", k=rng.randint(0, 30))) for _ in range(300)]
    coded = [suffix_dedup.front_coded(sorted((x, b"", 1, 2, 3, 0, 0, 0) for x in items[i::runs])) for i in range(runs)]
    known = []
    plain = suffix_dedup.common_prefix
    monkeypatch.setattr(suffix_dedup, "common_prefix", lambda a, b, k=0: (known.append(a[:k] == b[:k]), plain(a, b, k))[1])
    out = list(suffix_dedup.LoserTree(coded))
    assert [r for _, r, _ in out] == sorted(items)
    assert all(s == plain(x, r) for (_, x, _), (s, r, _) in zip(out, out[1:]))
    assert all(known)


# ------------------------------------------------------------- Jaccard join


def plain_classes(texts, ids, similarity=0.8):
    sets = []
    for t in texts:
        w = words_of((t or "").encode())
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else None)
    root, links = list(range(len(texts))), Counter()

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(texts)), 2):
        if sets[i] and sets[j] and len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j]) - 1e-12:
            links[i] += 1
            links[j] += 1
            root[find(j)] = find(i)
    groups = defaultdict(list)
    for i in range(len(texts)):
        groups[find(i)].append(ids[i])
    name = {g: min((x for x in m if x is not None), default=None) for g, m in groups.items()}
    return sorted(((ids[i], name[find(i)], links[i]) for i in range(len(texts))), key=repr)


def near_texts(seed, groups=6):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefghij", k=4))
    texts = [" ".join(word() for _ in range(rng.randint(0, 80))) for _ in range(30)]
    common = " ".join(word() for _ in range(9))
    texts += [common + " " + " ".join(word() for _ in range(60)) for _ in range(30)]
    for _ in range(groups):
        base = [word() for _ in range(rng.randint(60, 400))]
        for _ in range(rng.randint(2, 25)):
            t = list(base)
            for _ in range(rng.randint(0, 3)):
                t[rng.randrange(len(t))] = word()
            texts.append(" ".join(t))
    return texts + ["one two", "ONE, two!", "one two three four five six seven eight", "one two three four five six seven eight nine", "", None, "", "...", "a b c d"] * 2


@pytest.mark.parametrize("seed,limit,block", [(1, 256, 1024), (2, 6, 5), (3, 2, 3)])
def test_links_equal_brute_force(spark, seed, limit, block):
    texts = near_texts(seed)
    ids = list(range(len(texts)))
    got = jaccard.near_duplicates(frame(spark, texts).repartition(4), recall=0.9999, limit=limit, block=block)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_classes(texts, ids)


def test_repeated_and_null_ids(spark):
    texts = ["a b c d e f", "a b c d e f", "a b c d e f", "x y z u v w", "x y z u v w", "lone words only here now"]
    ids = [7, 7, None, None, None, 3]
    got = jaccard.near_duplicates(frame(spark, texts, ids))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_classes(texts, ids)
    assert jaccard.near_duplicates(frame(spark, texts).limit(0)).count() == 0
    with pytest.raises(ValueError):
        jaccard.near_duplicates(frame(spark, texts), similarity=0.5)


def test_recall_at_the_threshold():
    rng = np.random.default_rng(11)
    factor = jaccard.SIMILARITY * 0.97
    runs, found, n = jaccard.runs_for(0.99, jaccard.DEPTH, factor / jaccard.SIMILARITY), 0, 300
    for _ in range(n):
        x = np.unique(rng.integers(0, 1 << 63, 200, dtype=np.uint64))
        y = np.concatenate([x[20:], rng.integers(0, 1 << 63, 25, dtype=np.uint64)])  # 180 of 225 shared: 0.8
        found += bool(np.intersect1d(jaccard._first_paths(x, runs, factor), jaccard._first_paths(y, runs, factor)).size)
    assert found / n >= 0.99


def test_defaults_find_all_links_of_a_large_group(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefghij", k=5))
    base, texts = [word() for _ in range(240)], []
    for _ in range(600):  # unequal cuts of one text, some words replaced
        t = base[rng.randint(0, 8) : rng.randint(215, 240)]
        for _ in range(rng.randint(0, 4)):
            t[rng.randrange(len(t))] = word()
        texts.append(" ".join(t))
    assert len(set(texts)) > 2 * jaccard.LIMIT
    ids = list(range(len(texts)))
    got = {r.doc_id: r.n_links for r in jaccard.near_duplicates(frame(spark, texts).repartition(4)).collect()}
    assert got == {i: n for i, _, n in plain_classes(texts, ids)}


def near_copies(seed, n):
    """Distinct cuts of one text, some words replaced."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefghij", k=5))
    base, texts = [word() for _ in range(240)], []
    for _ in range(n):
        t = base[rng.randint(0, 4) : rng.randint(230, 240)]
        t[rng.randrange(len(t))] = word()
        texts.append(" ".join(t))
    return texts


def test_a_large_group_is_tried_once_and_not_once_per_bucket(spark, monkeypatch):
    texts, asked = near_copies(8, 400), []
    plain = jaccard._children
    monkeypatch.setattr(jaccard, "_children", lambda big, sets, factor: (asked.append(big.count()), plain(big, sets, factor))[1])
    got = {r.doc_id: r.n_links for r in jaccard.near_duplicates(frame(spark, texts).repartition(4)).collect()}
    assert asked and sum(asked) <= 2 * len(set(texts))  # once for each of some ten buckets before
    assert got == {i: n for i, _, n in plain_classes(texts, list(range(len(texts))))}


def test_buckets_of_one_unit_that_breaks_up_have_children_of_their_own(spark):
    rows = [(p, n, 50, 10 - (p == 2)) for p in (1, 2) for n in range(10 - (p == 2))] + [(3, 20 + n, 50, 4) for n in range(4)]
    big = spark.createDataFrame(rows, "path long, node long, size long, n long")
    assert {(r.path, r.unit) for r in jaccard._united(big).select("path", "unit").distinct().collect()} == {(1, 1), (2, 1), (3, 3)}
    rng = np.random.default_rng(3)
    sets = {n: np.unique(rng.integers(0, 1 << 63, 50, dtype=np.uint64)) for n in [*range(10), *range(20, 24)]}
    own = spark.createDataFrame([(n, bytearray(t.tobytes())) for n, t in sets.items()], "node long, tokens binary")
    stays, children = jaccard._split(big, own, 0.25)
    assert stays.count() == 0
    want = {(c, n) for p, n, _, _ in rows for c in jaccard._picks(sets[n], p, 0.25).tolist()}
    assert {(r.path, r.node) for r in children.collect()} == want


def test_each_bucket_of_sets_is_one_file(spark, monkeypatch):
    files, plain = [], jaccard.bucketed

    def counted(df, name, key):
        out, path = plain(df, name, key)
        files.append((len(out.inputFiles()), out.select(key).distinct().count()))
        return out, path

    monkeypatch.setattr(jaccard, "bucketed", counted)
    texts = near_copies(9, 200)
    jaccard.near_duplicates(frame(spark, texts).repartition(12)).count()
    assert files == [(min(n, int(spark.conf.get("spark.sql.shuffle.partitions"))), n) for _, n in files] and files[0][1] > 100


def test_texts_with_equal_hashes_stay_apart(spark, monkeypatch):
    seeds, plain = [], jaccard._named

    def named(documents, id_col, seed):
        seeds.append(seed)
        out = plain(documents, id_col, seed)
        return out.withColumn("node", F.pmod("node", F.lit(7))) if seed == 0 else out

    monkeypatch.setattr(jaccard, "_named", named)
    texts = near_texts(4, groups=2)
    ids = [i if i % 5 else None for i in range(len(texts))]
    got = jaccard.near_duplicates(frame(spark, texts, ids).repartition(3))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_classes(texts, ids)
    assert set(seeds) == {0, 1}


def test_target_recall_holds_through_all_levels():
    rng = np.random.default_rng(5)
    factor = jaccard.SIMILARITY * 0.97
    runs, found, n = jaccard.runs_for(jaccard.TARGET_RECALL, jaccard.DEPTH, factor / jaccard.SIMILARITY), 0, 2000
    for _ in range(n):
        x = np.unique(rng.integers(0, 1 << 63, 200, dtype=np.uint64))
        y = x[np.sort(rng.permutation(len(x))[:160])]  # a subset at the threshold: the worst case
        paths = np.intersect1d(jaccard._first_paths(x, runs, factor), jaccard._first_paths(y, runs, factor))
        for _ in range(jaccard.DEPTH - 1):
            paths = np.concatenate([np.zeros(0, np.int64), *[np.intersect1d(jaccard._picks(x, p, factor), jaccard._picks(y, p, factor)) for p in paths.tolist()]])
        found += bool(len(paths))
    assert found / n >= 0.999


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(200)] + [(7, 7), (500, 500), (300, 301), (301, 300)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 0 for i in range(51)} | {100 + i: 100 for i in range(200)} | {500: 500, 300: 300, 301: 300}
    want |= {300: 100, 301: 100} if 300 in range(100, 300) else {}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# ------------------------------------------------------------- sketches


@pytest.mark.parametrize("seed", range(4))
def test_sketches_lose_no_pair(seed):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 63, 4000).astype(np.uint64)
    sets = []
    for _ in range(60):
        n = int(rng.choice([4, 9, 20, 60, 200, 1500]))
        start = int(rng.integers(0, 3)) * n
        own = rng.integers(0, 1 << 63, int(rng.integers(0, 1 + n // 3))).astype(np.uint64)
        sets.append(np.unique(np.concatenate([base[start : start + n], own])))
    sizes = np.array([len(s) for s in sets], np.float64)
    may = jaccard.possible([jaccard.sketch(s) for s in sets], sizes, 0.8)
    linked = set()
    for i, j in itertools.combinations(range(len(sets)), 2):
        both = len(np.intersect1d(sets[i], sets[j]))
        if both >= 0.8 * (len(sets[i]) + len(sets[j]) - both):
            linked |= {i, j}
    assert linked and all(may[i] for i in linked)
    alone = [np.unique(rng.integers(0, 1 << 63, 300).astype(np.uint64)) for _ in range(20)]
    assert not jaccard.possible([jaccard.sketch(s) for s in alone], np.full(20, 300.0), 0.8).any()
