"""Stored history (daily merge, reload, erasure in the files) and the load-log stream."""

import datetime as dt
import pathlib
import tempfile

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.fixtures import random_snapshots
from vhist.config import HistoryConfig
from vhist.operators.classify import change_summary, classify
from vhist.operators.history import build_history, build_history_forgetting
from vhist.operators.merge import merge_open_rows, merge_snapshots, prepare_snapshot
from vhist.plans.process import process_snapshots, run_loads
from vhist.sources import store
from vhist.sources.snapshots import empty_history
from vhist.streaming.load_log_stream import LOG_SCHEMA, load_log_stream

D = "snapshot_date"


def _scratch():
    return tempfile.mkdtemp(prefix="vhist-store-")


def _same(got, want):
    return rows(got.select(*want.columns)) == rows(want)


def _reader(s):
    return lambda d: s.filter(F.col(D) == F.lit(d)).drop(D)


def _files(root):
    return {str(p.relative_to(root)): p.stat().st_mtime_ns for p in pathlib.Path(root).rglob("*.parquet")}


def test_loads_equal_single_pass_and_time_travel(spark):
    s, days = random_snapshots(spark, 7, days=6)
    cfg, root, read = HistoryConfig(key_cols=["k"]), _scratch(), _reader(s)
    counts = [store.merge_into(spark, root, read(d), d, cfg) for d in days]
    assert store.newest_date(spark, root) == days[-1]
    assert _same(store.read_state(spark, root), build_history(s, cfg))
    for d in days:  # the state after any load is a rollback of the stored rows
        assert _same(store.read_state(spark, root, d), build_history(s.filter(F.col(D) <= d), cfg))
    # what the last load changed, counted by its write, is the change summary
    before = build_history(s.filter(F.col(D) < days[-1]), cfg)
    summary = change_summary(classify(prepare_snapshot(read(days[-1]), days[-1], cfg), before, cfg.key_cols))
    assert {k: n for k, n in counts[-1].items() if n} == {r.HistoryStatus: r.n_keys for r in summary.collect()}


def test_dates_again(spark):
    s, days = random_snapshots(spark, 9, days=4)
    cfg, root, read = HistoryConfig(key_cols=["k"]), _scratch(), _reader(s)
    for d in (days[0], days[1], days[3]):
        store.merge_into(spark, root, read(d), d, cfg)
    with pytest.raises(Exception, match="not newer"):
        store.merge_into(spark, root, read(days[2]), days[2], cfg)
    want = build_history(s.filter(F.col(D) != days[2]), cfg)
    assert _same(store.read_state(spark, root), want)  # a load that failed leaves the old state
    # a late date, then a middle date loaded with other rows and put right again
    assert store.reload_from(spark, root, [days[3], days[2]], read, cfg) == [days[2], days[3]]
    assert _same(store.read_state(spark, root), build_history(s, cfg))
    store.reload_from(spark, root, days[1:], lambda d: read(d).filter("k > 6") if d == days[1] else read(d), cfg)
    assert not _same(store.read_state(spark, root), build_history(s, cfg))
    store.reload_from(spark, root, days[1:], read, cfg)
    store.reload_from(spark, root, days[-1:], read, cfg)  # the newest date once more
    for i in range(4):
        assert _same(store.read_state(spark, root, days[i]), build_history(s.filter(F.col(D) <= days[i]), cfg))


def test_all_keys_deleted_and_back(spark):
    cfg, root = HistoryConfig(key_cols=["k"]), _scratch()
    d = [dt.date(2024, 1, 30) + dt.timedelta(days=i) for i in range(4)]
    one, none = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string"), spark.createDataFrame([], "k long, v string")
    for day, snap in zip(d, (one, none, none, one), strict=True):
        store.merge_into(spark, root, snap, day, cfg)
    cols = ("k", "FirstSnapshot", "ValidFrom", "ValidTo", "IsDeleted")
    end = dt.date(2999, 12, 31)
    want = sorted([(k, d[0], d[0], d[0], True) for k in (1, 2)] + [(k, d[0], d[3], end, False) for k in (1, 2)])
    assert rows(store.read_state(spark, root), *cols) == want
    store.reload_from(spark, root, d[1:], lambda day: one, cfg)  # nothing was ever deleted
    assert rows(store.read_state(spark, root), *cols) == [(k, d[0], d[0], end, False) for k in (1, 2)]


def test_store_follows_new_columns(spark):
    cfg = HistoryConfig(key_cols=["k"], hash_cols=["k", "v"])
    root, d = _scratch(), [dt.date(2024, 1, i) for i in (1, 2, 3)]
    store.merge_into(spark, root, spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string"), d[0], cfg)
    store.merge_into(spark, root, spark.createDataFrame([(1, "a", 5), (2, "c", 6)], "k long, v string, x int"), d[1], cfg)
    store.merge_into(spark, root, spark.createDataFrame([(1, "z"), (2, "c")], "k long, v string"), d[2], cfg)
    got = store.read_state(spark, root)
    assert rows(got, "k", "v", "x", "ValidFrom") == [(1, "a", None, d[0]), (1, "z", None, d[2]), (2, "b", None, d[0]), (2, "c", 6, d[1])]


def test_a_load_exchanges_only_the_snapshot(spark):
    s, days = random_snapshots(spark, 13, days=3)
    cfg, root, read = HistoryConfig(key_cols=["k"]), _scratch(), _reader(s)
    for d in days[:2]:
        store.merge_into(spark, root, read(d), d, cfg, buckets=8)
    with store.StoredHistory(spark, root, cfg) as stored:
        assert stored.buckets == 8
        conf = {"spark.sql.legacy.bucketedTableScan.outputOrdering": "true", "spark.sql.adaptive.enabled": "false"}
        before = {c: spark.conf.get(c) for c in conf}
        plans = []

        def step(snapshot, current, deleted):  # as the load plans it
            for c, v in conf.items():
                spark.conf.set(c, v)
            try:
                out = merge_open_rows(current, snapshot, days[2], cfg, deleted_rows=deleted)
                plans.append(out._jdf.queryExecution().executedPlan().toString())
            finally:
                for c, v in before.items():
                    spark.conf.set(c, v)
            return out

        stored.load(read(days[2]), days[2], step=step)
    plan = plans[0]
    join = plan.index("SortMergeJoin", plan.index("FullOuter") - 200)
    stored_side = plan[join : plan.index("Bucketed: true", join)]
    assert "part#" in stored_side and "Exchange" not in stored_side and "Sort [" not in stored_side, plan
    assert _same(store.read_state(spark, root), build_history(s, cfg))


def test_one_merge_and_one_process_per_date(spark, monkeypatch):
    from vhist.operators import merge
    from vhist.plans import process

    s, days = random_snapshots(spark, 17, days=5, gaps=False)
    cfg = _forget_cfg("full")
    calls = {"merge": 0, "process": 0}

    def counted(name, f):
        def g(*a, **kw):
            calls[name] += 1
            return f(*a, **kw)

        return g

    monkeypatch.setattr(merge, "merge_open_rows", counted("merge", merge.merge_open_rows))
    monkeypatch.setattr(store, "merge_open_rows", merge.merge_open_rows)
    monkeypatch.setattr(process, "process_snapshot", counted("process", process.process_snapshot))
    empty = empty_history(spark, s.drop(D).schema)
    for every in (1, 3):
        calls.update(merge=0, process=0)
        assert _same(merge_snapshots(empty, s, cfg, checkpoint_every=every), build_history(s, cfg))
        assert calls["merge"] == len(days)
        assert _same(process_snapshots(empty, s, cfg, checkpoint_every=every), build_history_forgetting(s, cfg))
        assert calls["process"] == len(days)


def test_chain_computes_its_snapshots_once(spark):
    s, days = random_snapshots(spark, 33, days=4)
    cfg = HistoryConfig(key_cols=["k"], sensitive_cols=["a"], signal_col="a", signal_pattern="x")
    want_merged, want_processed = build_history(s, cfg), build_history_forgetting(s, cfg)
    n, empty = s.count(), empty_history(spark, s.drop(D).schema)
    for chain, want in ((merge_snapshots, want_merged), (process_snapshots, want_processed)):
        for every in (1, 3):
            seen = spark.sparkContext.accumulator(0)

            @F.udf("date")
            def derived(d):  # noqa: B023
                seen.add(1)
                return d

            folder = pathlib.Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
            before = set(folder.glob("vhist-chain-*-snapshots"))
            assert _same(chain(empty, s.withColumn(D, derived(D)), cfg, checkpoint_every=every), want)
            assert seen.value == n
            assert set(folder.glob("vhist-chain-*-snapshots")) == before  # the unmasked copies are gone
        # dates that are not asked for stay out
        some = build_history if chain is merge_snapshots else build_history_forgetting
        assert _same(chain(empty, s, cfg, dates=days[1:3], checkpoint_every=3), some(s.filter(F.col(D).isin(days[1:3])), cfg))



def test_run_loads_branches(spark):
    s, days = random_snapshots(spark, 5, days=3)
    cfg, root, read = HistoryConfig(key_cols=["k"]), _scratch(), _reader(s)
    log = lambda ds: spark.createDataFrame([(f"g{d}", "g", d, "Bronze") for d in ds], LOG_SCHEMA)
    ask = lambda ds: spark.createDataFrame([("g", d) for d in ds], "DataGroupName string, SnapshotDate date")
    assert run_loads(log(days[:1]), ask([]), "g", root, cfg, read) == ("skip", [])
    assert run_loads(log(days[:1]), ask([]), "other", root, cfg, read) == ("skip", [])
    assert store.newest_date(spark, root) is None
    assert run_loads(log(days[:1]), ask(days[:1]), "g", root, cfg, read) == ("restore", days[:1])
    assert run_loads(log(days), ask([]), "g", root, cfg, read) == ("force_restore", days)
    assert _same(store.read_state(spark, root), build_history(s, cfg))


def test_load_log_stream_follows_the_plan(spark):
    s, days = random_snapshots(spark, 11, days=5, gaps=False)
    cfg, root, logs, ckpt, snaps = HistoryConfig(key_cols=["k"]), _scratch(), _scratch() + "/log", _scratch() + "/ckpt", _scratch() + "/snaps"
    s.write.partitionBy(D).parquet(snaps)
    asked = []

    def requests():
        return spark.createDataFrame([("g", d) for d in asked], "DataGroupName string, SnapshotDate date")

    def read_snapshot(day):
        return spark.read.parquet(snaps).filter(F.col(D) == F.lit(day)).drop(D)

    def arrive(batch_days):
        recs = [(f"g_{x}", "g", x, "Bronze") for x in batch_days] + [("o", "other", batch_days[0], "Bronze")]
        spark.createDataFrame(recs, LOG_SCHEMA).coalesce(1).write.mode("append").parquet(logs)
        load_log_stream(spark, logs, "g", root, cfg, read_snapshot, ckpt, read_requests=requests).awaitTermination()

    arrive(days[:3])  # several loads: restored from the earliest
    assert store.newest_date(spark, root) == days[2]
    arrive(days[3:4])  # one load, not asked for: skipped
    assert store.newest_date(spark, root) == days[2]
    asked.append(days[4])
    arrive(days[4:])  # one load, asked for
    assert _same(store.read_state(spark, root), build_history(s.filter(F.col(D) != days[3]), cfg))
    asked.append(days[1])
    arrive(days[1:2])  # an older date: every logged load from it on, the skipped one too
    assert _same(store.read_state(spark, root), build_history(s, cfg))


def _forget_cfg(mode):
    return HistoryConfig(key_cols=["k"], mode=mode, sensitive_cols=["b"], signal_col="a", signal_pattern="^x$")


@pytest.mark.parametrize("mode", ["full", "incremental"])
def test_forgetting_loads_leave_no_raw_value_in_any_file(spark, mode):
    s, days = random_snapshots(spark, 21, keys=10, days=6)
    cfg, root, read = _forget_cfg(mode), _scratch(), _reader(s)
    for d in days:
        store.merge_into(spark, root, read(d), d, cfg, forget=True)
    want = build_history_forgetting(s, cfg)
    assert _same(store.read_state(spark, root), want)
    masked = {(r["k"], r["ValidFrom"]) for r in want.filter("GDPR_Compliant = 'Yes'").collect()}
    files = spark.read.option("recursiveFileLookup", "true").parquet(root)  # every file below the folder
    assert masked and not [r for r in files.collect() if (r["k"], r["ValidFrom"]) in masked and r["b"] is not None]
    # a load with plain settings cannot bring back what is not there
    store.merge_into(spark, root, read(days[-1]), days[-1] + dt.timedelta(days=1), HistoryConfig(key_cols=["k"], mode=mode))
    again = store.read_state(spark, root).filter("b is not null").select("k", "ValidFrom").collect()
    assert not {tuple(r) for r in again} & masked
    old = store.read_state(spark, root, days[2])
    assert not {tuple(r) for r in old.filter("b is not null").select("k", "ValidFrom").collect()} & masked


def test_erase_rewrites_only_what_holds_the_key(spark):
    cfg, root = HistoryConfig(key_cols=["k"], sensitive_cols=["name"]), _scratch()
    days = [dt.date(2024, m, 1) for m in (1, 2, 3, 4, 5)]
    snap = lambda i: spark.createDataFrame([(1, "alice", i if i in (0, 1) else 1), (2, "bob", i)], "k long, name string, v int")
    for i, d in enumerate(days):
        store.merge_into(spark, root, snap(i), d, cfg, buckets=2)
    before = _files(root)
    ids = spark.createDataFrame([(1,)], "k long")
    assert store.erase(spark, root, ids, cfg, rehash=True) == [("2024-01", False), ("open", False)]
    after = _files(root)
    kept = {f for f in before if "part=2024-01" not in f and "part=open" not in f}
    assert kept and all(after.get(f) == before[f] for f in kept)
    everything = spark.read.option("recursiveFileLookup", "true").parquet(root)
    assert {r.name for r in everything.filter("k = 1").collect()} == {"ANONYMISED"}
    assert {r.name for r in everything.filter("k = 2").collect()} == {"bob"}
    assert store.erase(spark, root, ids, cfg) == []  # nothing left to do
    # composite keys match on every column
    cfg2, root2 = HistoryConfig(key_cols=["k", "j"], sensitive_cols=["name"]), _scratch()
    two = spark.createDataFrame([(1, 1, "alice"), (1, 2, "carol")], "k long, j long, name string")
    store.merge_into(spark, root2, two, days[0], cfg2)
    store.erase(spark, root2, spark.createDataFrame([(1, 2)], "k long, j long"), cfg2)
    assert rows(store.read_state(spark, root2), "j", "name") == [(1, "alice"), (2, "ANONYMISED")]


def test_exposed_pushes_few_keys_to_the_files(spark):
    cfg, root = HistoryConfig(key_cols=["k"], sensitive_cols=["name"]), _scratch()
    store.merge_into(spark, root, spark.createDataFrame([(i, f"n{i}") for i in range(50)], "k long, name string"), dt.date(2024, 1, 1), cfg)
    with store.StoredHistory(spark, root, cfg) as stored:
        plan = stored.exposed(spark.createDataFrame([(3,), (7,)], "k long"))._jdf.queryExecution().toString()
    assert "In(k, [3,7])" in plan and "PushedFilters" in plan


def test_a_failed_load_leaves_the_old_state(spark):
    cfg, root = HistoryConfig(key_cols=["k"]), _scratch()
    store.merge_into(spark, root, spark.createDataFrame([(1, "a")], "k long, v string"), dt.date(2024, 1, 1), cfg)
    before = _files(root)
    bad = spark.createDataFrame([(1, "b"), (2, "c")], "k long, v string").withColumn("v", F.when(F.col("k") == 2, F.raise_error(F.lit("broken"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="broken"):
        store.merge_into(spark, root, bad, dt.date(2024, 1, 2), cfg)
    assert _files(root) == before


def test_load_log_stream_with_forget_requests(spark):
    s, days = random_snapshots(spark, 23, keys=8, days=5, gaps=False)
    cfg = _forget_cfg("full")
    root, logs, ckpt, snaps = _scratch(), _scratch() + "/log", _scratch() + "/ckpt", _scratch() + "/snaps"
    s.write.partitionBy(D).parquet(snaps)

    def read_snapshot(day):
        return spark.read.parquet(snaps).filter(F.col(D) == F.lit(day)).drop(D)

    recs = [(f"g_{x}", "g", x, "Bronze") for x in days]
    spark.createDataFrame(recs, LOG_SCHEMA).write.mode("append").parquet(logs)
    load_log_stream(spark, logs, "g", root, cfg, read_snapshot, ckpt, forget=True).awaitTermination()
    assert _same(store.read_state(spark, root), build_history_forgetting(s, cfg))
