"""vhist: validity history (slowly changing dimension, type 2) on Spark DataFrames.

Snapshots of a table go in; a history with one row per key and version, with
validity dates, comes out.  Every operator is a DataFrame -> DataFrame function
built from Spark's own expressions, joins, windows and aggregates:

* ``vhist.operators.history``  build the whole history in one window pass (H1)
* ``vhist.operators.merge``    merge one snapshot into a history (H2, H4)
* ``vhist.operators.classify`` new / updated / deleted / unchanged per key
* ``vhist.operators.privacy``  forget requests: detect, find, anonymise
* ``vhist.operators.reload``   reload plan, rollback, reload
* ``vhist.operators.report``   totals, multi-version keys, samples
* ``vhist.sources.store``      a history stored by load date (daily merges, time travel)
"""

from vhist.config import HistoryConfig
from vhist.functions.hashing import business_key, row_hash, with_hash_key
from vhist.operators.classify import change_summary, classify, classify_sql
from vhist.operators.history import build_history, build_history_forgetting, snapshot_calendar
from vhist.operators.merge import merge_open_rows, merge_snapshot, merge_snapshots, prepare_snapshot
from vhist.operators.privacy import anonymise_history, detect_and_anonymise, exposed_rows
from vhist.operators.reload import load_range, reload_history, reload_plan, rollback
from vhist.operators.views import half_open, lag_change_flags
from vhist.plans.process import process_snapshot, process_snapshots

__all__ = [
    "HistoryConfig",
    "business_key",
    "row_hash",
    "with_hash_key",
    "change_summary",
    "classify",
    "classify_sql",
    "build_history",
    "build_history_forgetting",
    "snapshot_calendar",
    "merge_open_rows",
    "merge_snapshot",
    "merge_snapshots",
    "prepare_snapshot",
    "anonymise_history",
    "detect_and_anonymise",
    "exposed_rows",
    "load_range",
    "reload_history",
    "reload_plan",
    "rollback",
    "half_open",
    "lag_change_flags",
    "process_snapshot",
    "process_snapshots",
]
