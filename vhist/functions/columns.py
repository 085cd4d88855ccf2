"""History system columns and canonical column order."""

from __future__ import annotations

import datetime as _dt
from typing import Iterable, List

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values shared with the snapshot-history convention being reproduced:
# system column names in their order, and the end date of an open version.
SYSTEM_COLUMNS = (
    "BusinessKey",
    "RowHashKey",
    "SnapshotDate",
    "FirstSnapshot",
    "ValidFrom",
    "ValidTo",
    "IsDeleted",
    "GDPR_Compliant",
)
OPEN_END = _dt.date(2999, 12, 31)
NOT_FORGOTTEN = "No"
FORGOTTEN = "Yes"


def open_end() -> Column:
    """``DATE '2999-12-31'``: ValidTo of a version that is still open."""
    return F.lit(OPEN_END)


def data_columns(df: DataFrame, date_col: str = "snapshot_date") -> List[str]:
    """Snapshot columns that are neither system columns nor the snapshot date."""
    skip = set(SYSTEM_COLUMNS) | {date_col, "FK_dimSnapshotID"}
    return [c for c in df.columns if c not in skip]


def history_columns(data_cols: Iterable[str]) -> List[str]:
    """Canonical order: system columns, then data columns in snapshot order."""
    return list(SYSTEM_COLUMNS) + [c for c in data_cols if c not in SYSTEM_COLUMNS]


def with_system_columns(df: DataFrame, snapshot_date, first_snapshot=None) -> DataFrame:
    """Columns of a freshly inserted version written by ``snapshot_date``.

    ``snapshot_date`` is a DATE column or a ``datetime.date``; ``first_snapshot``
    defaults to the same date (a key seen for the first time).  A frame already
    carrying ``GDPR_Compliant`` (from forget-request detection) keeps it.
    """
    d = snapshot_date if isinstance(snapshot_date, Column) else F.lit(snapshot_date).cast("date")
    first = d if first_snapshot is None else first_snapshot
    cols = {
        "SnapshotDate": d,
        "FirstSnapshot": first,
        "ValidFrom": d,
        "ValidTo": open_end(),
        "IsDeleted": F.lit(False),
    }
    if "GDPR_Compliant" not in df.columns:
        cols["GDPR_Compliant"] = F.lit(NOT_FORGOTTEN)
    return df.withColumns(cols)
