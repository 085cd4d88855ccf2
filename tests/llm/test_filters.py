"""Documents filtered in place by the quality classifier and the decontamination."""

import numpy as np

from vhist.llm import decontam, quality

WORDS = "one two three four five six seven eight nine ten eleven twelve".split()


def _documents(spark):
    rows = [(1, " ".join(WORDS), 1), (1, "other text", 2), (None, None, 3), (2, "", 4), (3, "x " + " ".join(WORDS[1:11]) + " y", 5), (None, "x " * 5000, 6)]
    return spark.createDataFrame(rows, "doc_id long, text string, own long")


def test_clean_documents_agree_with_contamination(spark):
    items = spark.createDataFrame([("a", " ".join(WORDS[1:])), ("b", "other"), ("c", None), ("d", "five")], "item_id string, text string")
    docs = _documents(spark)
    for block in (100_000, 1):  # one block of windows, and a block a window
        kept = decontam.clean_documents(docs, items.selectExpr("cast(null as long) as item_id", "text"), docs.columns, block_windows=block)
        assert kept.columns == docs.columns
        assert sorted(r.own for r in kept.collect()) == [3, 4, 6]
    found = decontam.contamination(docs, items.selectExpr("cast(null as long) as item_id", "text"), id_col="own")
    assert sorted(r.doc_id for r in found.filter("not contaminated").collect()) == [3, 4, 6]


def test_clean_documents_without_items_or_documents(spark):
    docs, none = _documents(spark), spark.createDataFrame([], "item_id long, text string")
    assert decontam.clean_documents(docs, none, docs.columns).count() == 6
    assert decontam.clean_documents(docs.filter("false"), none, docs.columns).count() == 0


def test_good_documents_agree_with_scores(spark):
    docs = _documents(spark)
    weights = np.random.default_rng(1).normal(size=quality.N_FEATURES)
    for b in (-1.0, 0.0, 1.0):
        good = {r.doc_id for r in quality.score(docs.selectExpr("own as doc_id", "text"), weights, b).filter("predicted = 1").collect()}
        kept = quality.good_documents(docs, docs.columns, weights, b)
        assert {r.own for r in kept.collect()} == good
    assert quality.good_documents(docs, docs.columns, None, 0.0).count() == 6
