"""BPE, token files, decontamination and URL filter against plain versions."""

import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vhist.llm import bpe, decontam, token_files, url_filter
from vhist.llm.literals import forced_tokens
from vhist.llm.common import scratch_path

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")
PIECES = ["a", "b", "é", " ", "  ", "\n", "\t", "'s", "'ll", "'", "1", "²", "٣", "中", "😀", "e\u0301", "<|endoftext|>", "<|", "***", "ß", "\x00", "\x85", "\u200b", "the ", " word"]
TEXTS = [None, "", " ", "one", "x" * 30_000, "é" * 5_000, "<|endoftext|>", "a <|endoftext|> b", "The cat sat on the mat. " * 400, "\x00\x01", "A\u2028B"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def docs(spark, texts, extra=False):
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.withColumn("raw", F.lit("clash")).withColumn("row_id", F.lit(1)).withColumn("n_tokens", F.lit("x")) if extra else df


@settings(max_examples=300, deadline=None, derandomize=True)
@given(st.lists(st.sampled_from(PIECES), max_size=200), st.sampled_from([(3, 7), (8, 31)]))
def test_chunked_encoding_equals_the_library(library, pieces, cut):
    text = "".join(pieces)
    c = bpe.codec(PATH)
    plain = bpe.chunk_cuts
    bpe.chunk_cuts = lambda raw: plain(raw, *cut)
    try:
        ids = c.encode_chunked(text.encode())
    finally:
        bpe.chunk_cuts = plain
    assert ids == library.encode(text, add_special_tokens=False).ids
    assert c.decode(ids).decode() == library.decode(ids, skip_special_tokens=False)


def test_every_single_token_equals_the_library(library):
    c = bpe.codec(PATH)
    for raw in c.token_bytes:
        try:
            text = raw.decode()
        except UnicodeDecodeError:
            continue
        assert c.encode(raw) == library.encode(text, add_special_tokens=False).ids


def test_cache_stays_within_its_bound(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_BYTES", 20_000)
    c = bpe.Codec(PATH)
    rng = random.Random(1)
    for _ in range(20):
        text = " ".join("".join(rng.choices("abcdefgh", k=7)) for _ in range(2_000)).encode()
        assert c.decode(c.encode_chunked(text)) == text
        assert c.cached <= 20_000


def test_bpe_rows(spark, library):
    got = {r.doc_id: r for r in bpe.encode_documents(docs(spark, TEXTS, extra=True)).collect()}
    assert len(got) == len(TEXTS)
    for i, t in enumerate(TEXTS):
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert got[i].ids == ids and got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    back = bpe.decode_ids(bpe.encode_documents(docs(spark, TEXTS)))
    assert {r.doc_id: r.text for r in back.collect()} == {i: t or "" for i, t in enumerate(TEXTS)}
    assert bpe.encode_documents(docs(spark, TEXTS).limit(0)).count() == 0


def test_repeated_and_null_ids_keep_their_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (None, None)], "doc_id long, text string")
    assert bpe.encode_documents(df).count() == 4
    assert token_files.document_token_counts(df).count() == 4


# ------------------------------------------------------------- token files


@pytest.mark.parametrize("block", [2, 6, 64, 1 << 20])
def test_token_counts_over_blocks(spark, library, block):
    library.encode_special_tokens = True
    try:
        want = {i: len(library.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(TEXTS)}
    finally:
        library.encode_special_tokens = False
    folder = scratch_path(spark, "tokens")
    texts = [t if t is None or len(t) < 1_000 or block > 60 else "long " * 30 for t in TEXTS]
    if texts != TEXTS:
        want = {i: len(library.encode(t or "", add_special_tokens=False).ids) if t != "<|endoftext|>" and t != "a <|endoftext|> b" else want[i] for i, t in enumerate(texts)}
    manifest = token_files.write_token_files(docs(spark, texts, extra=True).repartition(3), folder)
    counts = token_files.token_counts(spark, manifest, folder, 2, block_bytes=block)
    got = {r.doc_id: r.n_tokens for r in manifest.join(counts, ["file", "place"], "left").collect()}
    assert got == want
    assert counts.count() == len(texts)


def test_unfinished_last_document(spark):
    import numpy as np
    from pyarrow import fs

    folder = scratch_path(spark, "flat")
    store, base = fs.FileSystem.from_uri(f"{folder}/tokens")
    store.create_dir(base, recursive=True)
    with store.open_output_stream(f"{base}/x.bin") as f:
        f.write(np.array([1, 2, 9, 9, 3, 4, 5], "<u2").tobytes())
    files = spark.createDataFrame([("x.bin",)], "file string")
    for block in (2, 4, 8, 100):
        got = sorted((r.place, r.first_token, r.n_tokens) for r in token_files.token_counts(spark, files, folder, 2, separator=9, block_bytes=block).collect())
        assert got == [(0, 0, 2), (1, 3, 0), (2, 4, 3)]


def test_token_counts_of_nothing(spark):
    assert token_files.document_token_counts(docs(spark, TEXTS).limit(0)).count() == 0


# ---------------------------------------------------------- decontamination


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def plain_contamination(texts, items, window):
    windows = {}
    for i, t in items:
        w = plain_words(t)
        for k in range(max(1, len(w) - window + 1)):
            if w:
                windows.setdefault(tuple(w[k : k + window]), set()).add(i)
    out = []
    for t in texts:
        w, hit, found = plain_words(t), set(), set()
        for x, ids in windows.items():
            for k in range(len(w) - len(x) + 1):
                if tuple(w[k : k + len(x)]) == x:
                    hit.update(range(k, k + len(x)))
                    found |= ids
        names = sorted(str(i) for i in found if i is not None)
        out.append((len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return out


@pytest.mark.parametrize("block", [100_000, 3])
def test_contamination_equals_plain(spark, block):
    rng = random.Random(4)
    word = lambda: rng.choice(["a", "b", "B", "c1", "é", "zz"])
    texts = [" ".join(word() for _ in range(rng.randint(0, 60))) for _ in range(40)] + [None, "", "...", "a " * 500, "rare10 rare2"]
    items = [(i, " ".join(word() for _ in range(rng.randint(0, 7)))) for i in range(12)] + [(100, "rare10 RARE2"), (2, None), (None, "zz zz"), (3, ""), (100, "rare10 RARE2")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("raw", F.lit(0)).withColumn("words", F.lit(0))
    got = decontam.contamination(docs(spark, texts, extra=True), bench, window=4, block_windows=block).collect()
    want = plain_contamination(texts, items, 4)
    assert {r.doc_id: tuple(r)[1:] for r in got} == dict(enumerate(want))


def test_contamination_of_nothing(spark):
    some, none = docs(spark, ["a b", None]), docs(spark, ["a"]).limit(0)
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontam.contamination(none, bench).count() == 0
    assert [r.contaminated for r in decontam.contamination(some, bench.limit(0)).collect()] == [False, False]


# --------------------------------------------------------------- URL filter


def plain_verdict(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host) :]).group()
        host = host.translate({c: c + 32 for c in range(65, 91)})
    best = None
    for h, p, v in url_filter.LIST_RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, v)
    if best:
        return host, path, *best
    hit = any(re.search(p, host + path) for p, _ in url_filter.PATTERN_RULES)
    return host, path, None, "block" if hit else "allow"


URLS = [
    None, "", "no scheme", "http://", "http://a.net", "http://a.net/", "HTTP://A.NET/x", "http://example.net/en/", "http://x.example.net/en/1?q=/de/",
    "http://example.net/en", "http://example.com/de/", "http://myexample.com/de/", "http://b.org/fr/é", "http://org/fr/", "http://borg/fr/", "x://http://a.net/",
    "http://spam-farm.example.org/", "http://www.cheap-pills.example.com/", "http://casino.com", "http://ok.com/casinos", "http://ok.com/Casino/", "http://free-casino.de/a\nb",
    "http://a.com?x=://b.net/", "http://" + "a/" * 20_000, "http://É.net/", "http://u:p@h.net:80/x", "http://a.net\n/x", "http://download.com/free-download",
]


def test_urls_equal_plain(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(5, URLS[5])]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumn("token", F.lit(1)).withColumn("host", F.lit("clash")).withColumn("pattern", F.lit(2))
    got = sorted((tuple(r) for r in url_filter.judge_urls(df).collect()), key=repr)
    assert got == sorted(((i, *plain_verdict(u)) for i, u in rows), key=repr)
    assert url_filter.judge_urls(df.limit(0)).count() == 0


def test_rules_are_indexed_by_their_rarest_token(spark):
    df = spark.createDataFrame([(1, "http://a.example.net/en/"), (2, "http://b.net/"), (3, "http://c.net/en/")], "page_id long, url string")
    host, path = url_filter.host_and_path(F.col("url"))
    pages = df.select(url_filter._tokens(host, path).alias("tokens"))
    rules = url_filter._rules(spark, [("example.net", "/en/", "allow")], [])
    assert [r.token for r in url_filter.rule_index(pages, rules).collect()] == ["example"]


def test_more_rules_than_are_broadcast(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "MAX_RULES", 1)
    rows = list(enumerate(URLS * 3))
    df = spark.createDataFrame(rows, "page_id long, url string")
    got = sorted((tuple(r) for r in url_filter.judge_urls(df).collect()), key=repr)
    assert got == sorted(((i, *plain_verdict(u)) for i, u in rows), key=repr)
    loose = url_filter.judge_urls(df, [], [(r"[\[\]]|x$", None)]).filter("verdict = 'block'").collect()
    assert sorted(r.page_id for r in loose) == [i for i, u in rows if re.search(r"[\[\]]|x$", "".join(plain_verdict(u)[:2]))]


def test_literals_of_patterns():
    for pattern, tokens in url_filter.PATTERN_RULES:
        assert forced_tokens(pattern) == tokens
    forced = {
        r"/ad/(Banner|x)/": ["ad"], r"ads": [], r"/ads": [], r"/ads\b": [], r"(?i)/ADS/+top$": ["ads", "top"], r"/a?ds/": [], r"/(?:ads)/": ["ads"], r"/ads[^a]": [],
        r"/ads(x|/)": [], r"^(www\.)?ads\.": ["ads"], r"^(www)?ads\.": [], r"/ads/|/x/": [], r"/ads(?=/)": [], r"/[.[a]]ads/": [], r"/\p{L}/ads/": [], r"(?iu)/ads/": [], r"/é/ads/": ["ads"], "": [],
    }
    for pattern, tokens in forced.items():
        assert forced_tokens(pattern) == tokens, pattern
    with pytest.raises(ValueError):
        url_filter._rules(None, [], [(r"casino", ["casino"])])


def test_line_ends_before_the_end_of_a_url(spark):
    rows = [(1, "http://a.com/casino\u2028"), (2, "http://a.com/casino\u0085"), (3, "http://a.com/casino\u2028x"), (4, "http://a.com/casino\n")]
    got = url_filter.judge_urls(spark.createDataFrame(rows, "page_id long, url string")).collect()
    assert {r.page_id: r.verdict for r in got} == {1: "block", 2: "block", 3: "allow", 4: "block"}


@pytest.mark.parametrize("space", [" ", "\n"])
def test_long_whitespace_runs_equal_the_library(library, space):
    n = 1_100_000
    for text in (space * n, "one two" + space * n + "b c", "a" + space * n + "<|endoftext|>", "a" + space * n + "\n !x" + space * 100_001):
        assert bpe.codec(PATH).encode_chunked(text.encode()) == library.encode(text, add_special_tokens=False).ids


def test_rules_without_a_literal_token_are_tried(spark):
    from vhist.llm import url_filter

    pages = spark.createDataFrame([(1, "http://a.example/x"), (2, "http://b.test/[y"), (3, None), (4, "http://b.test/")], "page_id long, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge_urls(pages, [("b.test", "/", "allow")], [(r"[\[\]]|x$", [])]).collect()}
    assert got == {1: (None, "block"), 2: ("b.test/", "allow"), 3: (None, "allow"), 4: ("b.test/", "allow")}
    plain = {r.page_id: r.verdict for r in url_filter.judge_urls(pages, [], [(r"\[", [])]).collect()}
    assert plain == {1: "allow", 2: "block", 3: "allow", 4: "allow"}
