"""The parts of one merge as separate frames.

``merge_snapshot`` computes all of them in one join; these frames expose each
part on its own, for inspection, reporting and SQL parity.  ``classified``
comes from ``classify`` and carries the key columns; every join is on those.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vhist.functions.columns import data_columns
from vhist.functions.predicates import changed_by_columns, is_closed, is_open


def _d(d) -> Column:
    return d if isinstance(d, Column) else F.lit(d).cast("date")


def keys_with_status(classified: DataFrame, key_cols: Sequence[str], *statuses: str) -> DataFrame:
    """P10: key columns (and business key) of the keys in one of ``statuses``."""
    return classified.filter(F.col("HistoryStatus").isin(*statuses)).select(*key_cols, "BusinessKey")


def _of(rows: DataFrame, classified: DataFrame, key_cols: Sequence[str], how: str, *statuses: str) -> DataFrame:
    keys = keys_with_status(classified, key_cols, *statuses).select(*key_cols)
    return rows.join(keys, list(key_cols), how).select(*rows.columns)


def _ended(rows: DataFrame, snapshot_date, deleted: bool) -> DataFrame:
    """Versions closed on the day before the snapshot."""
    end = {"ValidTo": F.date_sub(_d(snapshot_date), 1)}
    return rows.withColumns(end | ({"IsDeleted": F.lit(True)} if deleted else {}))


def deleted_rows(history: DataFrame, classified: DataFrame, key_cols: Sequence[str], snapshot_date) -> DataFrame:
    """Open versions of deleted keys, closed the day before with IsDeleted."""
    return _ended(_of(history.filter(is_open()), classified, key_cols, "left_semi", "deleted"), snapshot_date, True)


def expired_rows(history: DataFrame, classified: DataFrame, key_cols: Sequence[str], snapshot_date) -> DataFrame:
    """Open versions of updated keys, closed the day before."""
    return _ended(_of(history.filter(is_open()), classified, key_cols, "left_semi", "updated"), snapshot_date, False)


def first_snapshot(history: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """A1: first appearance per key: key columns, BusinessKey, FirstSnapshot."""
    return history.groupBy(*key_cols, "BusinessKey").agg(F.min("FirstSnapshot").alias("FirstSnapshot"))


def inserted_rows(
    prepared: DataFrame, history: DataFrame, classified: DataFrame, key_cols: Sequence[str], snapshot_date
) -> DataFrame:
    """Snapshot rows of new and updated keys, FirstSnapshot from history or today."""
    keys = list(key_cols)
    seen = history.groupBy(*keys).agg(F.min("FirstSnapshot").alias("_seen"))
    opened = _of(prepared, classified, keys, "left_semi", "new", "updated").join(seen, keys, "left")
    return opened.withColumn("FirstSnapshot", F.coalesce("_seen", _d(snapshot_date))).select(*prepared.columns)


def insert_only(prepared: DataFrame, history: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """Snapshot rows whose key has no open version."""
    return prepared.join(history.filter(is_open()).select(*key_cols), list(key_cols), "left_anti").select(*prepared.columns)


def disappeared(history: DataFrame, snapshot: DataFrame, key_cols: Sequence[str], snapshot_date) -> DataFrame:
    """Open versions whose key is missing from the snapshot, closed as deleted."""
    missing = history.filter(is_open()).join(snapshot.select(*key_cols), list(key_cols), "left_anti")
    return _ended(missing, snapshot_date, True).select(*history.columns)


def carried_rows(history: DataFrame, classified: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """Versions carried over unchanged.

    Closed versions always pass through; of the open ones, those of keys that
    are neither deleted nor updated.
    """
    kept = _of(history.filter(is_open()), classified, key_cols, "left_anti", "deleted", "updated")
    return history.filter(is_closed()).unionByName(kept)


def _open_with_snapshot(history: DataFrame, prepared: DataFrame, key_cols: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Open versions (``h``) joined with their snapshot rows (``s``), and the compared columns."""
    compared = [c for c in data_columns(prepared) if c not in key_cols]
    h, s = history.filter(is_open()).alias("h"), prepared.alias("s")
    return h.join(s, [F.col(f"h.{k}") == F.col(f"s.{k}") for k in key_cols]), compared


def changed_by_columns_rows(history: DataFrame, prepared: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """J8 + P9: open versions whose non-key columns differ from the snapshot.

    Inner join on the key; each compared column appears as ``old_<c>`` and
    ``new_<c>``.
    """
    met, compared = _open_with_snapshot(history, prepared, key_cols)
    pairs = [F.col(f"{side}.{c}").alias(f"{name}_{c}") for c in compared for side, name in (("h", "old"), ("s", "new"))]
    return met.filter(changed_by_columns(compared, "h", "s")).select("h.BusinessKey", "h.ValidFrom", *pairs)


def unchanged_except_all(history: DataFrame, prepared: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """Open versions present in the snapshot minus the changed ones, as a
    multiset difference.

    One join carries the change test as a column; one aggregate per distinct
    row counts how many copies remain.
    """
    met, compared = _open_with_snapshot(history, prepared, key_cols)
    cols = history.columns
    rows = met.select("h.*", changed_by_columns(compared, "h", "s").alias("_changed"))
    left = rows.groupBy(*cols).agg((F.count(F.lit(1)) - F.count_if("_changed")).cast("int").alias("_n"))
    return left.filter("_n > 0").select(*cols, F.explode(F.array_repeat(F.lit(0), F.col("_n"))).alias("_copy")).select(*cols)
