"""Token alignment against whole-text encoding by the libraries and plain loops."""

import functools
import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from vhist.llm import align, bpe


@functools.cache
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(bpe.default_tokenizer())
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=align.default_pieces())


def plain_tokens(text):
    """(A ids, B ids, A bytes, B bytes), or None."""
    a_lib, b_lib = libraries()
    if not text:
        return None
    a, b = a_lib.encode(" " + text, add_special_tokens=False).ids, b_lib.encode(text)
    table = bpe.codec(bpe.default_tokenizer(), True).token_bytes
    pieces = [b_lib.id_to_piece(i) for i in b]
    b_bytes = [bytes([int(p[3:5], 16)]) if b_lib.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces, strict=True)]
    a_bytes, raw = [table[i] for i in a], (" " + text).encode()
    return (a, b, a_bytes, b_bytes) if b"".join(a_bytes) == raw == b"".join(b_bytes) else None


def plain(texts):
    docs, count = [], defaultdict(int)
    for t in texts:
        found = plain_tokens(t)
        if not found:
            docs.append(None)
            continue
        a, b, a_bytes, b_bytes = found
        a_end, b_end = np.cumsum([len(x) for x in a_bytes]).tolist(), np.cumsum([len(x) for x in b_bytes]).tolist()
        links, i, j = [], 0, 0
        while i < len(a) and j < len(b):
            links.append((a[i], b[j]))
            x, y = a_end[i], b_end[j]
            i, j = i + (x <= y), j + (y <= x)
        groups, s, t2 = [], 0, 0
        for e in sorted(set(a_end) & set(b_end)):
            x, y = a_end.index(e) + 1, b_end.index(e) + 1
            groups.append(",".join(map(str, a[s:x])) + "|" + ",".join(map(str, b[t2:y])))
            s, t2 = x, y
        docs.append((len(a), len(b), groups, links))
        for p in set(links):
            count[p] += 1
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for d in docs:
        if not d:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = d
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest()
        out.append((n_a, n_b, len(groups), len(links), sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links), sha))
    return out, count


def some_texts(seed, n=40):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdeioüß日本é1234'.,-", k=rng.randint(1, 9)))
    space = lambda: rng.choice([" "] * 12 + ["  ", "\n", "\t", " \n ", "　", "\x1c", "\x85", "\xa0", "   "])
    texts = ["".join(x for _ in range(rng.randint(0, 60)) for x in (word(), space())) for _ in range(n)]
    texts += [None, "", " ", "  ", "\n", "a", " a", "a ", "▁", "a ▁ b", "a▁b c", "<|endoftext|> x", "</s> <s> <unk> <0x41>", "🙂 é́ ﬁ", "\x00 a\x00b"]
    return texts + ["the cat sat"] * 5 + ["x y " * 400, "I'll 've 's 're it's"]


def frame(spark, texts, ids=None):
    df = spark.createDataFrame([(i if ids is None else ids[i], t) for i, t in enumerate(texts)], "doc_id long, text string")
    for clash in ("rid", "raw", "block", "a", "n", "sha"):
        df = df.withColumn(clash, F.lit("clash"))
    return df


@pytest.mark.parametrize("seed,part,work", [(1, 6 << 20, 1 << 16), (2, 64, 7), (3, 300, 1)])
def test_equals_plain(spark, seed, part, work):
    texts = some_texts(seed)
    want, count = plain(texts)
    got = align.aligned_tokens(frame(spark, texts).repartition(3), part_bytes=part, work=work).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == dict(enumerate(want))
    assert len(got) == len(texts)
    if seed == 2:
        pairs = align.pair_counts(frame(spark, texts), part_bytes=part, work=work).collect()
        assert {(r.a, r.b): r.n for r in pairs} == dict(count)
        top = defaultdict(int)
        for (a, _), n in count.items():
            top[a] = max(top[a], n)
        assert all(r.best == (r.n == top[r.a]) for r in pairs)


def test_ids_and_empty_tables(spark):
    texts = ["a b", "a b", None, "c d e"]
    got = align.aligned_tokens(frame(spark, texts, [7, 7, None, None])).collect()
    want, _ = plain(texts)
    assert sorted((tuple(r) for r in got), key=repr) == sorted([(i, *w) for i, w in zip([7, 7, None, None], want, strict=True)], key=repr)
    assert align.aligned_tokens(frame(spark, [])).count() == 0


def test_groups_of_a_long_text(spark):
    text = "some words, and other words. " * 500
    rows = align.token_groups(frame(spark, [text]), part_bytes=1000).orderBy("part").collect()
    assert len(rows) > 5
    a, b, _, _ = plain_tokens(text)
    assert [i for r in rows for i in r.a_ids] == a and [i for r in rows for i in r.b_ids] == b
    groups = [(r.a_ids[s:e], r.b_ids[t:f]) for r in rows for s, e, t, f in zip([0, *r.a_ends], r.a_ends, [0, *r.b_ends], r.b_ends, strict=False)]
    spelled = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
    assert hashlib.sha256(spelled.encode()).hexdigest() == plain([text])[0][0][6]


@pytest.mark.parametrize("work", [1, 2, 5, 64])
def test_merge_path_pieces_have_equal_work(work):
    rng = np.random.default_rng(work)
    for n, m in ((0, 0), (5, 0), (0, 5), (40, 60), (100, 3)):
        a, b = np.unique(rng.integers(1, 150, n)), np.unique(rng.integers(1, 150, m))
        cuts = align.merge_path(a, b, work)
        assert cuts[0] == (0, 0) and cuts[-1] == (len(a), len(b))
        assert all((i2 - i1) + (j2 - j1) <= work and i1 <= i2 and j1 <= j2 for (i1, j1), (i2, j2) in zip(cuts, cuts[1:], strict=False))
        order = sorted([(x, 0, i) for i, x in enumerate(a)] + [(x, 1, j) for j, x in enumerate(b)])
        for (i, j), d in zip(cuts[:-1], range(0, len(order), work), strict=False):
            assert sum(side == 0 for _, side, _ in order[:d]) == i and i + j == d


def test_pieces_with_inner_space_are_refused(monkeypatch):
    import sentencepiece

    monkeypatch.setattr(sentencepiece.SentencePieceProcessor, "id_to_piece", lambda self, i: "a▁b")
    with pytest.raises(ValueError):
        align.Encoders(bpe.default_tokenizer(), align.default_pieces())
