"""Each registered query reads its input as few times as its plan needs.

Counted on the physical plan by ``tools.scan_audit.scan_counts`` (cached
relations once, reused exchanges not at all).  ``events[5c]`` is the full
read of the derived daily snapshots; ``events[1c]`` the calendar's ``ts``-only
read.  A merge reads the earlier days and the last day as two disjoint date
ranges, so two full-width scans there still read each row once.
"""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tools.scan_audit import scan_counts

SF = "/root/testdata/sf0.001"

EXPECTED = {
    # one full read, plus the ts-only calendar
    "history_full": {"events[5c]": 1, "events[1c]": 1},
    "rollback": {"events[5c]": 1, "events[1c]": 1},
    "versions_of_top_key": {"events[5c]": 1, "events[1c]": 1},
    "dedup_versions": {"events[5c]": 1, "events[1c]": 1},
    # seven weekday frames from one derivation
    "union_snapshots": {"events[5c]": 1},
    # earlier days and the last day: disjoint ranges
    "merge_step": {"events[5c]": 2, "events[1c]": 1},
    "schema_evolution": {"events[5c]": 2, "events[1c]": 1},
    "inserted_rows": {"events[5c]": 2, "events[1c]": 1},
    # the history, and the snapshots from the restore date on
    # (two columns: the reloaded dates, for the calendar and for the first of them)
    "reload": {"events[5c]": 2, "events[1c]": 1, "events[2c]": 2},
    # monthly orders with the customer's name: orders once in full, customer's two columns once
    "history_incremental": {"orders[5c]": 1, "orders[1c]": 1, "customer[2c]": 1},
    "rollback_incremental": {"orders[5c]": 1, "orders[1c]": 1, "customer[2c]": 1},
    # earlier months and the last month: disjoint ranges, each with its customer lookup
    "merge_step_incremental": {"orders[5c]": 2, "orders[1c]": 1, "customer[2c]": 2},
    # each key's last forget signal comes from the build's own window: no second read
    "history_forgetting": {"orders[5c]": 1, "orders[1c]": 1, "customer[2c]": 1},
    # the history once; the reloaded months, and their forget signals (two columns)
    "reload_forgetting": {"orders[5c]": 2, "orders[1c]": 1, "orders[2c]": 2, "customer[2c]": 3},
    # the earlier months and the processed month; its forget ids (two columns) are
    # joined, without a cache, with the snapshot and with open and closed versions
    "process_snapshot": {"orders[5c]": 2, "orders[1c]": 1, "orders[2c]": 3, "customer[2c]": 5},
    # the history, and the forget ids of one snapshot (two columns)
    "rtbf_history": {"orders[5c]": 1, "orders[1c]": 1, "orders[2c]": 1, "customer[2c]": 2},
}


@pytest.mark.parametrize("name", sorted(EXPECTED))
def test_full_reads_per_query(spark, name):
    counts = scan_counts(entry.queries()[name](spark, SF))
    spark.catalog.clearCache()
    assert dict(counts) == EXPECTED[name]
