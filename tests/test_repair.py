"""Repairs equal the full build, and touch only what they must."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.fixtures import D0, RANDOM_SCHEMA, random_snapshots
from vhist.config import HistoryConfig
from vhist.operators import repair
from vhist.operators.history import build_history, build_history_forgetting

CFG = HistoryConfig(key_cols="k")
STRICT = HistoryConfig(key_cols="k", hash_mode="strict")
INC = HistoryConfig(key_cols="k", mode="incremental")
FORGET = HistoryConfig(key_cols="k", hash_cols=("k", "a", "b"), sensitive_cols=("a",), signal_col="b", signal_pattern="^7$")


def _other_reading(snaps, seed):
    """A second reading: some rows lost, some with another value."""
    pick = F.pmod(F.xxhash64(F.lit(seed), "k", "snapshot_date"), F.lit(9))
    return snaps.filter((pick != 0) | (F.col("k") > 5)).withColumn("a", F.when((pick == 1) & (F.col("k") < 4), "z").otherwise(F.col("a")))


@pytest.mark.parametrize("cfg", [CFG, INC], ids=["full", "incremental"])
@pytest.mark.parametrize("seed", [1, 2])
def test_changed_keys_equal_the_full_build(spark, cfg, seed):
    old, _ = random_snapshots(spark, seed)
    new = _other_reading(old, seed)
    got = repair.reload_changed_keys(build_history(old, cfg), old, new, cfg)
    assert rows(got) == rows(build_history(new, cfg).select(*got.columns))


def test_changed_keys_with_a_date_more_or_less(spark):
    old, days = random_snapshots(spark, 3)
    for gone in (days[0], days[4], days[-1]):
        new = old.filter(F.col("snapshot_date") != F.lit(gone))
        for a, b in ((old, new), (new, old)):
            got = repair.reload_changed_keys(build_history(a, CFG), a, b, CFG)
            assert rows(got) == rows(build_history(b, CFG).select(*got.columns))


def test_only_differing_keys_are_rebuilt(spark):
    old, _ = random_snapshots(spark, 4)
    new = old.withColumn("a", F.when(F.col("k") == 3, "changed").otherwise(F.col("a")))
    hist = build_history(old, CFG)
    changed = repair.differing_keys(hist, old, new, CFG)
    assert rows(changed) == [(3,)]
    odd = hist.withColumn("BusinessKey", F.concat(F.lit("stored "), "BusinessKey"))  # tells what passes through
    got = repair.reload_changed_keys(odd, old, new, CFG, changed)
    assert {r.k for r in got.filter(~F.col("BusinessKey").startswith("stored ")).collect()} == {3}
    assert repair.differing_keys(hist, old, old.unionByName(old), CFG).isEmpty()  # repeated rows are no difference


def test_changed_keys_stay_masked(spark):
    days = [D0 + dt.timedelta(days=i) for i in range(4)]
    old = spark.createDataFrame([(1, "secret", 7, days[0]), (1, "secret", 1, days[1]), (2, "x", 1, days[0]), (2, "x", 1, days[1])], RANDOM_SCHEMA)
    # the signal is in the first reading only
    new = old.withColumn("b", F.when(F.col("b") == 7, 5).otherwise(F.col("b")).cast("long"))
    got = repair.reload_changed_keys(build_history_forgetting(old, FORGET), old, new, FORGET)
    assert rows(got.filter("k = 1"), "a", "ValidFrom") == [("ANONYMISED", days[0]), ("secret", days[1])]
    with pytest.raises(ValueError):
        repair.reload_changed_keys(build_history(old, CFG), old, new.drop("a"), CFG)


@pytest.mark.parametrize("seed,at", [(5, 0), (5, 3), (6, 1), (7, 5)])
def test_splice_equals_the_full_build(spark, seed, at):
    snaps, days = random_snapshots(spark, seed, keys=40, days=8, p_present=0.6)
    want = build_history(snaps, STRICT)
    others = snaps.filter(F.col("snapshot_date") != F.lit(days[at]))
    snap = snaps.filter(F.col("snapshot_date") == F.lit(days[at])).drop("snapshot_date")
    got = repair.splice_snapshot(build_history(others, STRICT), snap, days[at], others.select("snapshot_date").distinct(), STRICT)
    assert rows(got.select(*want.columns)) == rows(want)


def test_splice_takes_the_values_of_a_run_that_now_begins_earlier(spark):
    days = [D0 + dt.timedelta(days=i) for i in range(3)]
    # NULL and '' have one hash here
    snaps = spark.createDataFrame([(1, "x", 1, days[0]), (1, None, 2, days[1]), (1, "", 2, days[2]), (2, "", 1, days[2])], RANDOM_SCHEMA)
    others, snap = snaps.filter(F.col("snapshot_date") != F.lit(days[1])), snaps.filter(F.col("snapshot_date") == F.lit(days[1])).drop("snapshot_date")
    got = repair.splice_snapshot(build_history(others, CFG), snap, days[1], others.select("snapshot_date"), CFG)
    assert rows(got) == rows(build_history(snaps, CFG).select(*got.columns))


def test_splice_of_an_empty_snapshot(spark):
    snaps, days = random_snapshots(spark, 8)
    others = snaps.filter(F.col("snapshot_date") != F.lit(days[3]))
    cal = snaps.select("snapshot_date").distinct()
    want = build_history(others, CFG, calendar_dates=cal)
    got = repair.splice_snapshot(build_history(others, CFG), snaps.drop("snapshot_date").limit(0), days[3], others.select("snapshot_date"), CFG)
    assert rows(got.select(*want.columns)) == rows(want)


def test_splice_with_forget_signals(spark):
    days = [D0 + dt.timedelta(days=2 * i) for i in range(4)]
    late = days[1]
    data = []
    for i, d in enumerate(days):
        data += [(1, "p", 7 if d == late else 1, d)]  # the late snapshot signals
        data += [(2, f"q{i}", 7 if i == 3 else 1, d)]  # a later one signals
        data += [(3, f"r{i}", 7 if i == 0 else 1, d)]  # an earlier one signals
    snaps = spark.createDataFrame(data, RANDOM_SCHEMA)
    want = build_history_forgetting(snaps, FORGET)
    others = snaps.filter(F.col("snapshot_date") != F.lit(late))
    snap = snaps.filter(F.col("snapshot_date") == F.lit(late)).drop("snapshot_date")
    got = repair.splice_snapshot(build_history_forgetting(others, FORGET), snap, late, others.select("snapshot_date").distinct(), FORGET)
    assert rows(got.select(*want.columns)) == rows(want)


def test_splice_refuses_what_it_cannot_know(spark):
    snaps, days = random_snapshots(spark, 9)
    cal, snap = snaps.select("snapshot_date").distinct(), snaps.drop("snapshot_date").limit(1)
    hist = build_history(snaps, CFG)
    for cfg, day in ((INC, days[2]), (CFG, days[2]), (CFG, days[-1] + dt.timedelta(days=9))):
        with pytest.raises(ValueError):
            repair.splice_snapshot(hist, snap, day, cal, cfg)
    with pytest.raises(ValueError):
        repair.splice_snapshot(hist, snap.drop("a"), days[0] - dt.timedelta(days=1), cal, CFG)


def test_splice_reads_no_version_beyond_the_neighbours_for_its_join(spark):
    """The join's history sides carry the date ranges into the scan."""
    import tempfile

    snaps, days = random_snapshots(spark, 10)
    others = snaps.filter(F.col("snapshot_date") != F.lit(days[4]))
    path = tempfile.mkdtemp(prefix="vhist-splice-") + "/h"
    build_history(others, CFG).write.parquet(path)
    hist = spark.read.parquet(path)
    snap = snaps.filter(F.col("snapshot_date") == F.lit(days[4])).drop("snapshot_date")
    out = repair.splice_snapshot(hist, snap, days[4], others.select("snapshot_date").distinct(), CFG)
    length = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = out._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.maxMetadataStringLength", length)
    assert f"LessThanOrEqual(ValidFrom,{days[3]})" in plan and f"GreaterThanOrEqual(ValidTo,{days[3]})" in plan
    assert f"LessThanOrEqual(ValidFrom,{days[5]})" in plan and f"GreaterThanOrEqual(ValidTo,{days[5]})" in plan
