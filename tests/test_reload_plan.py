"""R1 branches and the load-log lookup."""

import datetime as dt

from tests.conftest import rows
from vhist.operators.reload import load_range, log_lookup, reload_plan

LOG = "PK_DataGroupLoadLogID string, DataGroupName string, SnapshotDate date, Layer string"


def test_reload_plan_branches(spark):
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    log = spark.createDataFrame(
        [("a1", "A", d1, "Bronze"), ("b1", "B", d1, "Bronze"), ("c1", "C", d1, "Bronze"), ("c2", "C", d2, "Bronze")],
        LOG,
    )
    req = spark.createDataFrame([("A", d1), ("A", d1), ("C", d2)], "DataGroupName string, SnapshotDate date")
    got = rows(reload_plan(log, req), "DataGroupName", "n_loads", "action", "restore_from")
    assert got == [("A", 1, "restore", d1), ("B", 1, "skip", None), ("C", 2, "force_restore", d1)]
    assert rows(load_range(log), "DataGroupName", "first_snapshot", "last_snapshot")[-1] == ("C", d1, d2)


def test_log_lookup_joins_once(spark):
    d1 = dt.date(2024, 1, 1)
    log = spark.createDataFrame([("a1", "A", d1, "Bronze"), ("a1s", "A", d1, "Silver")], LOG)
    snaps = spark.createDataFrame([("A", d1, 1), ("A", dt.date(2024, 1, 2), 2)], "grp string, snapshot_date date, x int")
    got = rows(log_lookup(snaps, log, "grp"), "x", "PK_DataGroupLoadLogID")
    assert got == [(1, "a1"), (2, None)]
