"""Load log, reload plan, rollback and reload."""

from __future__ import annotations

from typing import Optional

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vhist.config import HistoryConfig
from vhist.functions.columns import data_columns, history_columns, open_end
from vhist.functions.predicates import is_closed, is_open
from vhist.operators.history import _DATE, _FS, _NEXT, _NO, _SD, _VF, prepare_snapshots, runs_to_history, snapshot_calendar


def _d(d) -> Column:
    return d if isinstance(d, Column) else F.lit(d).cast("date")


def load_range(log: DataFrame) -> DataFrame:
    """Per data group, the number of distinct loads and the first and
    last snapshot, in one aggregate over every group."""
    return log.groupBy("DataGroupName").agg(
        F.countDistinct("PK_DataGroupLoadLogID").cast("bigint").alias("n_loads"),
        F.min("SnapshotDate").alias("first_snapshot"),
        F.max("SnapshotDate").alias("last_snapshot"),
    )


def load_ids(log: DataFrame, group: Optional[str] = None) -> DataFrame:
    """Distinct load-log ids (of one data group if given); stays a frame."""
    if group is not None:
        log = log.filter(F.col("DataGroupName") == group)
    return log.select("PK_DataGroupLoadLogID").distinct()


def log_lookup(snapshots: DataFrame, log: DataFrame, group_col: str, layer: str = "Bronze",
               date_col: str = "snapshot_date") -> DataFrame:
    """Attach the load-log id of (group, date, layer) to snapshot rows, as one join
    rather than one lookup per date.  The log has one row per load (a group, a day
    and a layer), like the calendar, so it is broadcast and the rows stay where they are."""
    lg = log.filter(F.col("Layer") == layer).select(
        F.col("DataGroupName").alias(group_col), F.col("SnapshotDate").alias(date_col), "PK_DataGroupLoadLogID"
    )
    return snapshots.join(F.broadcast(lg), [group_col, date_col], "left")


def reload_plan(log: DataFrame, requests: DataFrame) -> DataFrame:
    """What to do per data group.

    * one load: ``restore`` from it if a reload was requested for that
      snapshot, else ``skip``;
    * several loads: ``force_restore`` from the earliest;
    * groups without loads do not appear (nothing to do).

    ``requests``: (DataGroupName, SnapshotDate).
    """
    ranges = load_range(log)
    req = requests.select(
        "DataGroupName", F.col("SnapshotDate").alias("first_snapshot"), F.lit(True).alias("_requested")
    ).distinct()
    j = ranges.join(req, ["DataGroupName", "first_snapshot"], "left")
    requested = F.coalesce(F.col("_requested"), F.lit(False))
    action = (
        F.when(F.col("n_loads") > 1, F.lit("force_restore"))
        .when(requested, F.lit("restore"))
        .otherwise(F.lit("skip"))
    )
    return j.select(
        "DataGroupName",
        "n_loads",
        "first_snapshot",
        "last_snapshot",
        requested.alias("reload_requested"),
        action.alias("action"),
        F.when(action != "skip", F.col("first_snapshot")).alias("restore_from"),
    )


def rollback(history: DataFrame, restore_from) -> DataFrame:
    """R2: history as it was before snapshot ``restore_from`` was loaded.

    Versions starting on or after that date go; a version whose ValidTo reaches
    the day before it was current then, so it is reopened (and not deleted).
    Anonymised rows stay anonymised.  Equals the history built from the
    earlier snapshots alone.
    """
    s = _d(restore_from)
    kept = history.filter(F.col("ValidFrom") < s)
    reopen = F.col("ValidTo") >= F.date_sub(s, 1)
    return kept.withColumns(
        {
            "ValidTo": F.when(reopen, open_end()).otherwise(F.col("ValidTo")),
            "IsDeleted": F.when(reopen, F.lit(False)).otherwise(F.col("IsDeleted")),
        }
    )


def extend_history(
    open_rows: DataFrame,
    ended_rows: DataFrame,
    snapshots: DataFrame,
    cfg: HistoryConfig,
    first_date,
    dedupe: bool = True,
    calendar_dates: Optional[DataFrame] = None,
) -> DataFrame:
    """The versions that replace ``open_rows`` after loading ``snapshots``, in
    one window pass that continues them.

    Open versions enter as a snapshot numbered 0 on the day before
    ``first_date``; keys that come back after deletion take FirstSnapshot from
    ``ended_rows`` (versions ended by deletion, or a superset).
    ``calendar_dates`` (one DATE column): the loaded dates, so that a loaded but
    empty snapshot deletes its keys; by default the dates found in the rows.
    """
    from vhist.operators.merge import _before

    s = _d(first_date)
    keys = list(cfg.key_cols)
    rows = prepare_snapshots(snapshots, cfg, dedupe)
    dcols = data_columns(snapshots, cfg.date_col)
    cal = F.broadcast(snapshot_calendar(rows, cfg.date_col, calendar_dates))  # one row per snapshot date
    rows = rows.join(cal, rows[cfg.date_col] == cal[_DATE]).drop(cfg.date_col)
    if not cfg.incremental:
        prior = ended_rows.filter(F.col("IsDeleted")).groupBy(*keys).agg(F.min("FirstSnapshot").alias(_FS))
        rows = rows.join(prior, keys, "left")
    seeds = open_rows.select(
        *dcols,
        "BusinessKey",
        "RowHashKey",
        "GDPR_Compliant",
        F.lit(0).alias(_NO),
        F.date_sub(s, 1).alias(_DATE),
        cal.select(F.min(_DATE)).scalar().alias(_NEXT),
        _before(F.col("ValidFrom"), s).alias(_VF),
        F.col("SnapshotDate").alias(_SD),
        F.col("FirstSnapshot").alias(_FS),
    )
    return runs_to_history(rows.unionByName(seeds, allowMissingColumns=True), cfg, dcols)


def reload_history(
    history: DataFrame,
    snapshots: DataFrame,
    restore_from,
    cfg: HistoryConfig,
    dedupe: bool = True,
    forget: bool = False,
    calendar_dates: Optional[DataFrame] = None,
) -> DataFrame:
    """Roll back to ``restore_from``, then rebuild from the snapshots on or
    after it in one pass, continuing the open versions of the rolled-back
    history (their start, first snapshot and anonymisation are kept).

    ``calendar_dates`` (one DATE column): the loaded dates, as for
    ``build_history``; those before ``restore_from`` are ignored.  With
    ``forget`` (and forget settings in ``cfg``), signals in the reloaded
    snapshots mask versions as processing them one by one would, the
    counterpart of ``build_history_forgetting``.  Rows that were masked before
    stay masked either way.
    """
    s = _d(restore_from)
    restored = rollback(history, s)
    tail = snapshots.filter(F.col(cfg.date_col) >= s)
    if calendar_dates is not None:
        calendar_dates = calendar_dates.filter(F.col(calendar_dates.columns[0]) >= s)
    rebuilt = extend_history(restored.filter(is_open()), restored, tail, cfg, s, dedupe, calendar_dates)
    out = restored.filter(is_closed()).select(*history_columns(data_columns(snapshots, cfg.date_col))).unionByName(rebuilt)
    if forget:
        from vhist.operators.privacy import anonymise_from_signals

        out = anonymise_from_signals(out, tail, cfg)
    return out
