"""H1: build the whole history from many snapshots in one window pass.

For a key with equal row hash over consecutive snapshots ``a..b`` (consecutive
in the calendar of processed snapshots):

* ValidFrom = date(a); ValidTo = date(b+1) - 1, or 2999-12-31 when b is last;
* IsDeleted when the key is absent from snapshot b+1 (full mode);
* in incremental mode absence does not end a run, and ValidTo is the next
  run's start - 1;
* FirstSnapshot is the key's first date; a key returning after deletion opens
  a new row and the old one stays deleted.

Plan: hash on the map side, join a broadcast calendar (one row per snapshot
date), then one exchange on the key columns.  Two window passes
over that partitioning mark each run's first and last row and read the next
run's start with ``lead``.  No aggregate or join back is needed: the first row
of a run carries the version's attributes.  Rows per key are bounded by the
number of snapshots, so a hot key cannot grow a task beyond that.
"""

from __future__ import annotations

from typing import List, Optional, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vhist.config import HistoryConfig
from vhist.functions.columns import NOT_FORGOTTEN, data_columns, history_columns, open_end
from vhist.functions.hashing import prehash_text, with_hash_key

# Internal column names used between the steps of the build.
_NO, _NEXT, _DATE, _VF, _SD, _FS = "_snap_no", "_next_date", "_snap_date", "_valid_from", "_snapshot_date", "_first_seen"
_FU = "_forget_upto"


def snapshot_calendar(snapshots: DataFrame, date_col: str = "snapshot_date", dates: Optional[DataFrame] = None) -> DataFrame:
    """Processed snapshot dates, numbered, each with the next date.

    ``dates`` (one DATE column) overrides the dates found in ``snapshots``; pass
    the load log's dates so that a loaded but empty snapshot still counts.
    The numbering window has no partition: it runs over distinct dates only.
    """
    src = dates if dates is not None else snapshots.select(F.col(date_col))
    d = src.select(F.col(src.columns[0]).cast("date").alias(_DATE)).distinct()
    w = Window.orderBy(_DATE)
    return d.select(_DATE, F.row_number().over(w).alias(_NO), F.lead(_DATE).over(w).alias(_NEXT))


def dedupe_order(data_cols: Sequence[str]) -> Column:
    """Order among rows of one key and date: the row hash, then the strict row
    text (NULL marked, delimiter escaped), so that rows whose hashes collide
    (NULL and '' in compat mode) are still told apart and the choice never
    depends on execution order."""
    return F.struct(F.col("RowHashKey"), prehash_text(list(data_cols), mode="strict"))


def dedupe_snapshots(
    rows: DataFrame, key_cols: Sequence[str], date_col: str, data_cols: Sequence[str]
) -> DataFrame:
    """One row per (key, snapshot date): exact copies collapse, and of
    conflicting rows the first by ``dedupe_order`` is kept.

    An aggregate rather than a window, so copies are combined map-side before
    the shuffle and a hot group of copies does not land whole in one task.
    """
    group = list(key_cols) + [date_col]
    rest = [c for c in rows.columns if c not in group]
    agg = rows.groupBy(*group).agg(F.min_by(F.struct(*rest), dedupe_order(data_cols)).alias("_r"))
    return agg.select(*group, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*rows.columns)


def prepare_snapshots(snapshots: DataFrame, cfg: HistoryConfig, dedupe: bool = True) -> DataFrame:
    """Hash and key the snapshot rows; add the forget flag column if absent.

    Rows with a NULL key part raise, or are dropped (``checks.with_keys``).
    """
    from vhist.operators.checks import with_keys

    rows = with_keys(snapshots, cfg)
    if "RowHashKey" not in rows.columns:  # a pre-hashed frame keeps its hash (taken before masking)
        rows = with_hash_key(rows, cfg.key_cols, cfg.hash_cols, cfg.hash_mode, cfg.salt, cfg.date_col)
    if "GDPR_Compliant" not in rows.columns:
        rows = rows.withColumn("GDPR_Compliant", F.lit(NOT_FORGOTTEN))
    if dedupe:
        rows = dedupe_snapshots(rows, cfg.key_cols, cfg.date_col, data_columns(snapshots, cfg.date_col))
    return rows


def build_history(
    snapshots: DataFrame,
    cfg: HistoryConfig,
    calendar_dates: Optional[DataFrame] = None,
    dedupe: bool = True,
) -> DataFrame:
    """History of all ``snapshots`` (one frame, a DATE column ``cfg.date_col``).

    ``dedupe=False`` skips the (key, date) aggregate when the input is already
    unique per key and date, e.g. when it comes out of such an aggregate.
    """
    rows, data_cols = _numbered_rows(snapshots, cfg, calendar_dates, dedupe)
    return runs_to_history(rows, cfg, data_cols)


def _numbered_rows(snapshots: DataFrame, cfg: HistoryConfig, calendar_dates: Optional[DataFrame], dedupe: bool):
    """Prepared snapshot rows with their snapshot number and the next date."""
    data_cols = data_columns(snapshots, cfg.date_col)
    rows = prepare_snapshots(snapshots, cfg, dedupe)
    cal = F.broadcast(snapshot_calendar(snapshots, cfg.date_col, calendar_dates))  # one row per snapshot date
    return rows.join(cal, rows[cfg.date_col] == cal[_DATE]).drop(cfg.date_col), data_cols


def runs_to_history(
    rows: DataFrame, cfg: HistoryConfig, data_cols: List[str], forget_date: Optional[Column] = None
) -> DataFrame:
    """Validity history from numbered snapshot rows.

    ``rows``: key and data columns, BusinessKey, RowHashKey, GDPR_Compliant,
    ``_snap_no``, ``_snap_date``, ``_next_date``; optionally ``_valid_from``,
    ``_snapshot_date`` and ``_first_seen`` to carry a version over from an
    earlier history (used by reload).

    ``forget_date`` (a date per row, NULL where the row signals nothing): its
    maximum over the key is kept as ``_forget_upto``, taken in the same window
    as FirstSnapshot.
    """
    keys = list(cfg.key_cols)
    full = not cfg.incremental
    for c, t in ((_VF, "date"), (_SD, "date"), (_FS, "date")):
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(None).cast(t))

    w = Window.partitionBy(*keys).orderBy(_NO)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    h, no = F.col("RowHashKey"), F.col(_NO)
    prev_h, prev_n = F.lag("RowHashKey").over(w), F.lag(_NO).over(w)
    next_h, next_n = F.lead("RowHashKey").over(w), F.lead(_NO).over(w)
    starts = prev_n.isNull() | ~prev_h.eqNullSafe(h)
    ends = next_n.isNull() | ~next_h.eqNullSafe(h)
    if full:
        starts = starts | (prev_n != no - 1)
        ends = ends | (next_n != no + 1)

    marked = rows.select(
        "*",
        starts.alias("_start"),
        ends.alias("_end"),
        F.min(F.coalesce(F.col(_FS), F.col(_VF), F.col(_DATE))).over(whole).alias("_first"),
        *([F.max(forget_date).over(whole).alias(_FU)] if forget_date is not None else []),
    ).filter(F.col("_start") | F.col("_end"))

    # After the filter each start row is followed by its run's end row (unless
    # it is its own end), and each end row by the next run's start row.
    is_end = F.col("_end")
    lead1 = lambda c: F.lead(c, 1).over(w)
    lead2 = lambda c: F.lead(c, 2).over(w)
    runs = marked.select(
        "*",
        F.when(is_end, F.col(_NO)).otherwise(lead1(_NO)).alias("_end_no"),
        F.when(is_end, F.col(_NEXT)).otherwise(lead1(_NEXT)).alias("_end_next"),
        F.when(is_end, lead1(_NO)).otherwise(lead2(_NO)).alias("_next_start_no"),
        F.when(is_end, lead1(_DATE)).otherwise(lead2(_DATE)).alias("_next_start_date"),
    ).filter(F.col("_start"))

    if full:
        still_open = F.col("_end_next").isNull()
        valid_to = F.when(still_open, open_end()).otherwise(F.date_sub(F.col("_end_next"), 1))
        deleted = ~still_open & (
            F.col("_next_start_no").isNull() | (F.col("_next_start_no") != F.col("_end_no") + 1)
        )
    else:
        nxt = F.col("_next_start_date")
        valid_to = F.when(nxt.isNull(), open_end()).otherwise(F.date_sub(nxt, 1))
        deleted = F.lit(False)

    out = runs.withColumns(
        {
            "SnapshotDate": F.coalesce(F.col(_SD), F.col(_DATE)),
            "FirstSnapshot": F.col("_first"),
            "ValidFrom": F.coalesce(F.col(_VF), F.col(_DATE)),
            "ValidTo": valid_to,
            "IsDeleted": deleted,
        }
    )
    return out.select(*history_columns(data_cols), *([_FU] if forget_date is not None else []))


def build_history_forgetting(
    snapshots: DataFrame,
    cfg: HistoryConfig,
    calendar_dates: Optional[DataFrame] = None,
    dedupe: bool = True,
) -> DataFrame:
    """H1 with forget requests: the history that processing every snapshot in
    order (detect, anonymise history, merge) produces, in one pass.

    The row hash is taken before masking, so versions are those of the plain
    build; masking follows ``anonymise_from_signals``: a version is masked when
    it started on or before its key's last signalled snapshot.  Rows unique per
    key and date (``dedupe=False``) give that date in the build's own window
    over the key, with no second read of the snapshots and no join.  With
    de-duplication a signal on a row that is dropped still counts, so the
    signals come from every snapshot row (an aggregate and a join on the key).
    """
    from vhist.operators.privacy import anonymise_from_signals, mask_where, masked_up_to, signal_flag

    if dedupe:
        hist = build_history(snapshots, cfg, calendar_dates, dedupe)
        return anonymise_from_signals(hist, snapshots, cfg)
    rows, data_cols = _numbered_rows(snapshots, cfg, calendar_dates, dedupe=False)
    hist = runs_to_history(rows, cfg, data_cols, forget_date=F.when(signal_flag(cfg), F.col(_DATE)))
    return mask_where(hist, masked_up_to(_FU), cfg).drop(_FU)
