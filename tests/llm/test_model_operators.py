"""Quality classifier, top inner products, personal data, WARC and the pipeline."""

import hashlib
import io
import random
import re
import zlib

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from vhist.llm import boosting, pii, quality, topk, warc
from vhist.llm.common import scratch_path, table

SF = "/root/testdata/sf0.01"


# ------------------------------------------------------------------ quality


def test_held_out_accuracy_and_fold(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    scored = quality.quality_scores(docs, labels)
    rows = scored.join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    tested = [r for r in rows if r.held_out]
    assert {r.quality for r in tested} == {0, 1}
    right = sum(r.predicted == r.quality for r in tested) / len(tested)
    bad = [r for r in tested if r.quality == 0]
    assert right >= 0.95 and sum(r.predicted == 0 for r in bad) / len(bad) >= 0.9
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)


def test_held_out_labels_and_other_columns_are_not_read(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    turned = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    other = docs.withColumn("lang", F.lit(None).cast("string")).withColumn("source", F.lit("x")).withColumn("raw", F.lit(3)).withColumn("kind", F.lit(1))
    score = lambda d, l: {r.doc_id: round(r.score, 9) for r in quality.quality_scores(d, l).collect()}
    assert score(docs, labels) == score(other, turned.withColumn("doc_text", F.lit(1)))


def test_quality_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (2, ""), (None, "a b"), (5, "x" * 200_000)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, None), (None, 1), (2, 1), (2, 0)], "doc_id long, quality int")
    got = quality.quality_scores(docs, labels).collect()
    assert len(got) == 5 and all(r.score == 0.5 and r.predicted == 1 for r in got)  # no trusted positive
    labels = spark.createDataFrame([(1, 1), (2, 1), (5, 0)], "doc_id long, quality int")
    got = quality.quality_scores(docs, labels).collect()
    assert len(got) == 5 and all(np.isfinite(r.score) for r in got) and [r.held_out for r in got if r.doc_id is None] == [False]
    assert quality.quality_scores(docs.limit(0), labels).count() == 0
    assert quality.quality_scores(docs, labels.limit(0)).count() == 5


def test_negative_part_of_the_risk_stays_positive():
    rng = np.random.default_rng(2)
    pos, neg = rng.normal(1.5, 1, (4000, 3)), rng.normal(-1.5, 1, (4000, 3))
    unl = np.vstack([rng.normal(1.5, 1, (2400, 3)), neg[:1600]])
    w, b = quality.nn_pu(pos.astype(np.float32), unl.astype(np.float32), 0.6)
    assert ((pos @ w + b) > 0).mean() > 0.95 and ((neg @ w + b) < 0).mean() > 0.95


# --------------------------------------------------------------- top-k search


def plain_top(rows, k, mod):
    vectors, top = [], (1 << 63) - 1
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        ints = [int(np.floor(1024 * float(np.float32(x)))) for x in v]
        vectors.append((i, ints))
    out = []
    for n, (q, x) in enumerate(vectors):
        if q % mod == 0:
            scored = sorted((-max(-top, min(top, sum(a * b for a, b in zip(x, v)))), i) for m, (i, v) in enumerate(vectors) if m != n)
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("seeds,block", [(4096, 4096), (3, 4), (0, 1)])
def test_top_k_equals_plain(spark, seeds, block):
    rng = np.random.default_rng(5)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, rng.choice([0.1, 1, 5]), 20)]) for i in range(300)]
    rows += [(300, rows[0][1]), (301, rows[0][1]), (302, [0.0] * 20), (310, None), (320, [1.0, None]), (330, [float("nan")] * 20), (340, [float("inf")] * 20)]
    rows += [(None, rows[1][1]), (10, rows[5][1]), (20, rows[20][1]), (350, [3.0] * 4), (360, []), (370, [1e30, -1e30]), (-10, [-2.0] * 20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("v", F.lit(1)).withColumn("norm", F.lit("x"))
    got = topk.top_inner_products(df.repartition(4), k=5, query_mod=10, query_block=block, seeds=seeds).collect()
    assert sorted(tuple(r) for r in got) == plain_top(rows, 5, 10)
    assert topk.top_inner_products(df.limit(0)).count() == 0


def test_top_k_with_fewer_candidates(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in topk.top_inner_products(df).collect()] == [(0, 1, 1, 1024 * 2048)]


def test_top_k_counts_repeated_ids_as_rows(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (1, [3.0]), (0, [1.0])], "vec_id long, embedding array<float>")
    got = sorted(tuple(r) for r in topk.top_inner_products(df, k=3).collect())
    one = [(0, 1, 1, 3 << 20), (0, 2, 1, 2 << 20), (0, 3, 0, 1 << 20)]
    assert got == sorted(one + one)


# -------------------------------------------------------------- personal data

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def plain_spans(text):
    out = []
    for n, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(len(x.lstrip("0")) > 3 or int(x.lstrip("0") or 0) > 255 for x in m.group().split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), n, m.end(), kind))
    return sorted(out)


def pii_texts():
    rng = random.Random(6)
    texts = [
        None, "", "a@b.com_x@c.org and x@y.z.", "1.2.3.4.5.6.7.8 999.1.1.1 0001.02.3.255", "4111 1111 1111 1111, 4111-1111-1111-1112, +1 (555) 123-4567 é😀 +49 30 123456",
        "é😀 a@b.co +1 2", "call 555-123-4567 or (555) 123-4567 joe [at] mail [dot] com", "9" * 30_000, "1 " * 20_000, "a.b" * 9_000 + "@" + "x." * 9_000 + "y", "1." * 20_000,
        "+1" + " 2" * 9_000, "@@@ a@ @b.c a@b a@b. a@b..c", "\x01a@b.c\x00", "+1 234 567 890 1234 5678", "1.2.3", "256.0.0.1 255.255.255.255", "0" * 16,
    ]
    for _ in range(200):
        texts.append("".join(rng.choice(["1", "23", ".", " ", "-", "+", "(", ")", "a", "b@c", "@", ".com", "4111111111111111", "é"]) for _ in range(rng.randint(0, 40))))
    return texts


def test_base_spans_equal_plain(spark):
    texts = pii_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("start", F.lit(1)).withColumn("kind_no", F.lit(0)).withColumn("x", F.lit("c"))
    got = {r.doc_id: r for r in pii.personal_data(df).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        spans = plain_spans(t)
        names = [f"{k}:{s}:{e}" for s, _, e, k in spans]
        assert got[i].base_sha256 == hashlib.sha256(",".join(names).encode()).hexdigest(), t
        assert [got[i][f"n_{k}"] for k in PLAIN] == [sum(x[3] == k for x in spans) for k in PLAIN]
        every = got[i].spans.split(",") if got[i].spans else []
        assert set(names) <= set(every)
        order = [(int(s), list(PLAIN).index(k)) for k, s, _ in (x.split(":") for x in every)]
        assert order == sorted(order)
    assert pii.personal_data(df.limit(0)).count() == 0


def test_repeated_rows_and_ids(spark):
    df = spark.createDataFrame([(1, "a@b.c"), (1, "a@b.c"), (1, "none"), (None, "x@y.z"), (None, None)], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.n_email) for r in pii.personal_data(df).collect()) == [(0, 0), (0, 1), (1, 0), (1, 1), (1, 1)]
    got = sorted((r.doc_id or 0, r.text or "") for r in pii.redact(df.withColumn("runs", F.lit(1))).drop("runs").collect())
    assert got == [(0, ""), (0, "[EMAIL]"), (1, "[EMAIL]"), (1, "[EMAIL]"), (1, "none")]


def test_redaction_replaces_all_spans(spark):
    texts = pii_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spans = {r.doc_id: [x.split(":") for x in r.spans.split(",") if x] for r in pii.personal_data(df).collect()}
    got = {r.doc_id: r.text for r in pii.redact(df).collect()}
    for i, t in enumerate(texts):
        runs = []
        for kind, s, e in spans[i]:
            if runs and int(s) < runs[-1][1]:
                runs[-1][1] = max(runs[-1][1], int(e))
            else:
                runs.append([int(s), int(e), kind])
        for s, e, kind in reversed(runs):
            t = t[:s] + f"[{kind.upper()}]" + t[e:]
        assert got[i] == t


def test_main_path_has_no_python(spark):
    df = table(spark, SF, "documents")
    for plan in (pii.candidates(df), pii.personal_data(df), pii.redact(df)):
        text = plan._jdf.queryExecution().toString()
        assert not re.search("Python|Arrow|Pandas|ExternalRDD", text)


def test_trees_learn_and_calibrate():
    cells = [((a, b), 90 if a > 2 and b < 2 else 1, 10 if a > 2 and b < 2 else 50) for a in range(5) for b in range(4)]
    model = boosting.fit(cells)
    assert boosting.predict(model, (4, 0)) > 1 > -1 > boosting.predict(model, (0, 0))
    least = boosting.threshold(model, cells, 0.85)
    assert {x for x, _, _ in cells if boosting.predict(model, x) >= least} == {(a, b) for a in (3, 4) for b in (0, 1)}
    assert boosting.threshold(model, cells, 0.99) == float("inf")
    assert boosting.fit([]) == (0.0, [])


# ----------------------------------------------------------------------- WARC


def pages(spark):
    same = "<p>same</p>" * 50
    rows = [(i, f"http://x/{i}", same if i % 3 == 0 else f"<p>{i}</p>é" * i) for i in range(60)]
    rows += [(100, None, None), (101, "http://x/é b\n", ""), (None, "u", same), (None, "u", "only"), (0, "again", same), (102, "http://x", "x" * 3_000_000), (103, "%41", "\r\n\r\nWARC/1.1\r\n")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return rows, df.withColumn("size", F.lit(1)).withColumn("salt", F.lit("c")).withColumn("digest", F.lit("c")).withColumn("first_id", F.lit(9))


def plain_records(rows):
    first = {}
    for i, _, html in rows:
        if i is not None:
            first[html or ""] = min(first.get(html or "", i), i)
    out = []
    for i, url, html in rows:
        raw, to = (html or "").encode(), first.get(html or "")
        again = to is not None and i != to
        out.append((i, len(raw), warc.digest_text(hashlib.sha1(raw).digest()), "revisit" if again else "response", to if again else None))
    return out


def test_round_trip(spark):
    rows, df = pages(spark)
    got = [tuple(r) for r in warc.archive_round_trip(df).collect()]
    assert sorted(got, key=repr) == sorted(plain_records(rows), key=repr)
    assert warc.archive_round_trip(df.limit(0)).count() == 0


@pytest.mark.parametrize("dictionary", [b"", b"<p>same</p>" * 40])
def test_archives_hold_payloads_and_urls(spark, dictionary):
    rows, df = pages(spark)
    folder = scratch_path(spark, "warc")
    manifest = warc.write_archives(warc.with_record_types(df), folder, dictionary, per_archive=7)
    got = warc.read_archives(spark, manifest, folder, with_payload=True).collect()
    kept = sorted((repr(r.page_id), r.url, bytes(r.payload)) if r.url is not None else (repr(r.page_id), "", bytes(r.payload)) for r in got if r.record_type == "response")
    kinds = plain_records(rows)
    assert kept == sorted((repr(i), u or "", (h or "").encode()) for (i, u, h), k in zip(rows, kinds) if k[3] == "response")


def _archive(*records, head=None, cut=0):
    raw = (head if head is not None else warc.struct.pack("<II", warc.DICTIONARY_MAGIC, 0)) + b"".join(zstandard.compress(r) for r in records)
    return io.BytesIO(raw[: len(raw) - cut])


def test_reader_rejects_broken_archives():
    good = warc.record_bytes(1, "u", b"abc", hashlib.sha1(b"abc").digest(), "response", None)
    again = warc.record_bytes(2, "u", b"abc", hashlib.sha1(b"abc").digest(), "revisit", 1)
    assert [warc.parse_record(r)["record_type"] for r in warc.frames(_archive(good, again))] == ["response", "revisit"]
    for broken in (_archive(good, head=b""), _archive(good, head=b"xx"), _archive(good, head=warc.struct.pack("<II", 1, 0)), _archive(good, cut=3), _archive(good, head=warc.struct.pack("<II", warc.DICTIONARY_MAGIC, 10**6))):
        with pytest.raises(warc.WarcError):
            list(warc.frames(broken))
    for a, b in ((b"WARC/1.1", b"WARC/9"), (b"abc\r\n", b"abd\r\n"), (b"Content-Length: 3", b"Content-Length: 4"), (b"sha1:", b"md5:"), (b"WARC-Type: response", b"WARC-Type"), (b"abc\r\n\r\n", b"abc"), (b"WARC-Date", b"X-Date"), (b"<urn:page:1>", b"<urn:x>")):
        assert a in good
        with pytest.raises(warc.WarcError):
            warc.parse_record(good.replace(a, b))


def test_compressed_dictionary_frame():
    raw = b"<html><body>" * 20
    packed = zstandard.compress(raw)
    head = warc.struct.pack("<II", warc.DICTIONARY_MAGIC, len(packed)) + packed
    packer = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(raw))
    good = warc.record_bytes(1, "u", raw, hashlib.sha1(raw).digest(), "response", None)
    (record,) = warc.frames(io.BytesIO(head + packer.compress(good)))
    assert warc.parse_record(record)["payload"] == raw


# ------------------------------------------------------------------- pipeline


def test_pipeline_keeps_what_its_stages_keep(spark):
    import corpus_pipeline as cp

    from tests.llm.test_dedup_operators import plain_classes
    from tests.llm.test_text_operators import plain_words

    assert [n for n, _ in cp.STAGES] == ["quality", "near_duplicates", "decontamination", "personal_data", "encoding"]
    docs, labels, bench = (table(spark, SF, t) for t in ("documents", "labels", "benchmark"))
    rows = {r.doc_id: r.text for r in docs.collect()}
    good = {r.doc_id for r in quality.quality_scores(docs, labels).collect() if r.predicted == 1}
    ids = sorted(good)
    kept = {c for _, c, _ in plain_classes([rows[i] for i in ids], ids)}
    windows = set()
    for r in bench.collect():
        w = plain_words(r.text)
        windows |= {tuple(w[k : k + 10]) for k in range(max(1, len(w) - 9)) if w}
    sizes = {len(w) for w in windows}

    def clean(text):
        w = plain_words(text)
        return not any(tuple(w[k : k + n]) in windows for n in sizes for k in range(len(w) - n + 1))

    kept = {i for i in kept if clean(rows[i])}
    out = cp.run(spark, SF).collect()
    assert {r.doc_id for r in out} == kept and len(out) == len(kept)
    from vhist.llm.bpe import codec, default_tokenizer

    c = codec(default_tokenizer())
    for r in out:
        text = c.decode(r.ids).decode()
        assert hashlib.sha256(text.encode()).hexdigest() == r.decoded_sha256 and len(r.ids) == r.n_tokens
        assert not plain_spans(text) and (text == rows[r.doc_id] or plain_spans(rows[r.doc_id]) or "[" in text)


def test_stages_take_odd_rows(spark):
    import corpus_pipeline as cp

    odd = spark.createDataFrame(
        [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "x" * 100_000, None, "s", None), (3, "a b", "en", None, 3)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    for name, stage in cp.STAGES:
        for docs in (odd, odd.limit(0), odd.withColumn("raw", F.lit("c")).withColumn("runs", F.lit(1))):
            got = stage(spark, docs, SF)
            assert name == "encoding" or got.columns == cp.COLUMNS
            got.count()


def test_stages_decide_by_row(spark, monkeypatch):
    import corpus_pipeline as cp

    def stay(stage, rows):
        docs = spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
        return sorted(((r.doc_id, r.text) for r in stage(spark, docs, SF).collect()), key=repr)

    base = [f"w{i}" for i in range(80)]
    near = [" ".join([*base[:-1], x]) for x in ("one", "two", "three")]
    alone = "some other words that nobody repeats here"
    # rows without id go where a row with an id stays; copies with different texts under the smallest id, too
    got = stay(cp.near_duplicate_stage, [(None, near[0]), (None, near[1]), (4, near[2]), (None, alone), (None, None)])
    assert got == sorted([(4, near[2]), (None, alone), (None, None)], key=repr)
    assert len(stay(cp.near_duplicate_stage, [(None, near[0]), (None, near[0]), (None, near[1])])) == 1
    got = stay(cp.near_duplicate_stage, [(1, near[0]), (1, near[1]), (1, alone), (2, near[2])])
    assert len(got) == 2 and (1, alone) in got and all(i == 1 for i, _ in got)
    item = max((r.text for r in table(spark, SF, "benchmark").collect()), key=len)
    got = stay(cp.decontamination_stage, [(None, item), (None, alone), (5, item), (5, alone), (None, None)])
    assert got == sorted([(None, alone), (5, alone), (None, None)], key=repr)
    monkeypatch.setattr(quality, "fit", lambda *a: (-quality.features(b"#" * 50).astype(float), 2.5, 0.5))  # rejects what is all "#"
    got = stay(cp.quality_stage, [(None, "#" * 50), (None, alone), (6, "#" * 50), (6, alone)])
    assert got == sorted([(None, alone), (6, alone)], key=repr)


def test_one_text_per_sampled_id(spark):
    from vhist.llm import quality

    rows = [(i, f"good words of document {i} " * 20) for i in range(0, 60)] + [(9, "junk " * 5)] * 3000
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(i, i % 2) for i in range(0, 60)], "doc_id long, quality int")
    weights, _, _ = quality.fit(docs, marks, sample=40)  # the repeated id does not push the others out
    assert weights is not None
