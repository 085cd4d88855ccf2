"""The Bloom filter that parts rows before a join."""

import numpy as np
from pyspark.sql import functions as F

from vhist.llm import sieve


def test_every_key_passes_and_few_others(spark):
    keys = spark.range(0, 30_000).select(F.xxhash64("id").alias("k"))
    rows = spark.range(0, 90_000).select("id", F.xxhash64("id").alias("key"))
    s = sieve.Sieve(keys, "k")
    passing = {r.id for r in s.passing(rows, "key").select("id").collect()}
    assert passing >= set(range(30_000))
    assert len(passing) < 30_000 + 600  # under 1 % of the others
    rest = {r.id for r in s.rest(rows, "key").select("id").collect()}
    assert not rest & passing and len(rest) + len(passing) == 90_000


def test_nulls_repeats_and_no_keys(spark):
    rows = spark.createDataFrame([(1, "a"), (None, "b"), (1, "c"), (2, None)], "key long, text string")
    none = sieve.Sieve(rows.filter("false"), "key")
    assert [r.text for r in none.passing(rows, "key").collect()] == ["b"]
    some = sieve.Sieve(spark.createDataFrame([(1,), (1,), (None,)], "key long"), "key")
    assert sorted(r.text for r in some.passing(rows, "key").collect() if r.text) == ["a", "b", "c"]


def test_bits_are_bounded_and_a_full_filter_passes_all(spark, monkeypatch):
    monkeypatch.setattr(sieve, "MOST_BITS", sieve.SEGMENT)
    keys = spark.range(0, 300_000).select(F.xxhash64("id").alias("k"))
    s = sieve.Sieve(keys, "k")
    assert s.bits == sieve.SEGMENT
    assert s.passing(keys, "k").count() == 300_000


def test_places_are_spread():
    at = sieve.places(np.arange(50_000), 1 << 20)
    assert at.shape == (sieve.HASHES, 50_000) and at.min() >= 0 and at.max() < 1 << 20
    assert len(np.unique(at)) > 0.9 * (1 << 20) * (1 - np.exp(-200_000 / (1 << 20)))
