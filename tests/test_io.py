"""Sources and sinks: dated folders, JSON, history bootstrap, versioned write, key files."""

import datetime as dt
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import rows
from vhist.config import HistoryConfig
from vhist.functions.hashing import with_hash_key
from vhist.operators.history import build_history
from vhist.operators.views import lag_change_flags, union_snapshots
from vhist.sources import sinks
from vhist.sources import snapshots as sn


def _scratch():
    return tempfile.mkdtemp(prefix="vhist-io-")


def test_read_dated_paths_one_read(spark):
    root = _scratch()
    for d, rows_ in (("20240101", [(1, "a", "x")]), ("20240201", [(1, "b", "x"), (2, "c", "y")])):
        spark.createDataFrame(rows_, "id string, field1 string, field2 string").write.parquet(f"{root}/{d}")
    df = sn.read_dated_paths(spark, root)
    assert rows(df, "id", "snapshot_date") == [
        ("1", dt.date(2024, 1, 1)),
        ("1", dt.date(2024, 2, 1)),
        ("2", dt.date(2024, 2, 1)),
    ]
    flags = lag_change_flags(df, ["id"], ["field1", "field2"])
    assert rows(flags, "id", "snapshot_date", "is_changed") == [
        ("1", dt.date(2024, 1, 1), True),
        ("1", dt.date(2024, 2, 1), True),
        ("2", dt.date(2024, 2, 1), True),
    ]


def test_read_dated_paths_lists_only_the_folders_in_range(spark):
    root = _scratch()
    for d in ("20240101", "20240201", "20240301", "20240401"):
        spark.createDataFrame([(d,)], "id string").write.parquet(f"{root}/{d}")
    with open(f"{root}/20240201/broken.parquet", "w") as f:
        f.write("not parquet")  # a folder out of range is not opened
    read = lambda **k: rows(sn.read_dated_paths(spark, root, schema="id string", **k), "id", "snapshot_date")
    assert read(first="20240301") == [("20240301", dt.date(2024, 3, 1)), ("20240401", dt.date(2024, 4, 1))]
    assert read(first="20240301", last="20240301") == [("20240301", dt.date(2024, 3, 1))]
    assert read(last="20240115") == [("20240101", dt.date(2024, 1, 1))]
    files = sn.read_dated_paths(spark, root, first="20240215", last="20240315").inputFiles()
    assert files and all("/20240301/" in f for f in files)
    none = sn.read_dated_paths(spark, root, first="20250101")
    assert none.columns == ["id", "snapshot_date"] and none.count() == 0
    with pytest.raises(ValueError):
        sn.read_dated_paths(spark, _scratch(), first="20250101")


def test_read_snapshots_from_first_date(spark):
    root = _scratch() + "/snapshots"
    df = spark.createDataFrame(
        [(1, "a", "20240101"), (1, "b", "20240102"), (2, "c", "20240103")], "id int, v string, FK_dimSnapshotID string"
    )
    df.write.partitionBy("FK_dimSnapshotID").parquet(root)
    got = sn.read_snapshots(spark, root, first="20240102")
    assert rows(got, "id", "v", "snapshot_date") == [(1, "b", dt.date(2024, 1, 2)), (2, "c", dt.date(2024, 1, 3))]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan


def test_read_json_projection(spark):
    root = _scratch()
    with open(os.path.join(root, "r.json"), "w") as f:
        for i in range(3):
            f.write(json.dumps({"country": "X", "points": i, "price": 1.5, "title": f"t{i}", "extra": 1}) + "\n")
    df = sn.read_json(spark, root, ["country", "points", "title"])
    assert df.columns == ["country", "points", "title"]
    assert df.count() == 3


def test_read_history_bootstraps_empty(spark):
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])
    h = sn.read_history(spark, os.path.join(_scratch(), "missing"), schema)
    assert h.count() == 0
    assert h.columns[:3] == ["BusinessKey", "RowHashKey", "SnapshotDate"] and h.columns[-2:] == ["k", "v"]


def test_write_history_new_version_and_read_back(spark):
    root = _scratch()
    df = spark.createDataFrame(
        [(1, "a", dt.date(2024, 1, 1)), (1, "b", dt.date(2024, 1, 2))], "k long, v string, snapshot_date date"
    )
    h = build_history(df, HistoryConfig(key_cols=["k"]))
    p1 = sinks.write_history(h, root, "20240102")
    assert os.path.isdir(os.path.join(p1, "is_open=true")) and os.path.isdir(os.path.join(p1, "is_open=false"))
    back = sn.read_history(spark, p1, df.drop("snapshot_date").schema)
    assert rows(back) == rows(h)
    # the next version is written while the previous one is read
    p2 = sinks.write_history(back.filter("v = 'b'"), root, "20240103")
    assert p2 != p1 and spark.read.parquet(p2).count() == 1


def test_key_files_written_per_destination(spark):
    root = _scratch()
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k long, v string")
    keys = sinks.key_file(with_hash_key(df, ["k"]), dt.date(2024, 1, 1))
    sinks.write_key_file(keys, f"{root}/bronze", f"{root}/silver")
    for p in ("bronze", "silver"):
        back = spark.read.parquet(f"{root}/{p}")
        assert back.columns == ["RowHashKey", "SnapshotDate"] and back.count() == 2


def test_union_snapshots_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "k long, v string")
    b = spark.createDataFrame([("y", 2, 5)], "v string, k long, extra int")
    u = union_snapshots([a, b])
    assert rows(u, "k", "v", "extra") == [(1, "x", None), (2, "y", 5)]


def test_history_over_bucketed_snapshots_needs_no_key_shuffle(spark):
    from vhist.sources import derived as dv

    snaps = dv.events_daily(spark, "/root/testdata/sf0.001", flag_only=True)
    sinks.write_snapshots_bucketed(snaps, "vhist_test_bucketed", ["user_id"], 4, path=_scratch() + "/t",
                                   mode="overwrite")
    h = build_history(spark.table("vhist_test_bucketed"), dv.EVENTS_CFG)
    want = build_history(snaps, dv.EVENTS_CFG, dedupe=False)
    assert rows(h) == rows(want)
    plan = h._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(user_id" not in plan
    assert "Window" in plan


def test_read_snapshots_between_dates(spark):
    root = _scratch() + "/snapshots"
    df = spark.createDataFrame([(i, f"2024010{i}") for i in range(1, 6)], "id int, FK_dimSnapshotID string")
    df.write.partitionBy("FK_dimSnapshotID").parquet(root)
    assert rows(sn.read_snapshots(spark, root, "20240102", "20240104"), "id") == [(2,), (3,), (4,)]
    assert sn.read_snapshots(spark, root, last="20240101").count() == 1


def test_read_history_keeps_lost_columns_and_adds_new_ones(spark):
    root = _scratch()
    df = spark.createDataFrame([(1, "a", dt.date(2024, 1, 1))], "k long, v string, snapshot_date date")
    path = sinks.write_history(build_history(df, HistoryConfig(key_cols=["k"])), root, "1")
    new = T.StructType([T.StructField("k", T.LongType()), T.StructField("w", T.IntegerType())])
    assert rows(sn.read_history(spark, path, new), "k", "v", "w") == [(1, "a", None)]


def test_damaged_history_raises(spark):
    import pytest

    new = T.StructType([T.StructField("k", T.LongType())])
    empty = _scratch()
    with pytest.raises(Exception):
        sn.read_history(spark, empty, new)
    spark.createDataFrame([(1,)], "k long").write.parquet(empty + "/other")
    with pytest.raises(ValueError, match="no history"):
        sn.read_history(spark, empty + "/other", new)
