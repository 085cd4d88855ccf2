"""Repairs of a history that touch only what changed.

``reload_changed_keys`` takes two readings of the same snapshots and rebuilds
the keys whose rows differ; ``splice_snapshot`` puts an older snapshot into a
history without reading the snapshots after it.
"""

from __future__ import annotations

from typing import Optional

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vhist.config import HistoryConfig
from vhist.functions.columns import FORGOTTEN, data_columns, history_columns
from vhist.functions.hashing import prehash_text
from vhist.operators.checks import with_keys
from vhist.operators.history import build_history
from vhist.operators.merge import prepare_snapshot
from vhist.operators.privacy import mask_versions_up_to, mask_where, signal_flag

_UPTO = "_forget_upto"


def _dates_of(snapshots: DataFrame, cfg: HistoryConfig, calendar_dates: Optional[DataFrame]) -> DataFrame:
    dates = snapshots.select(cfg.date_col) if calendar_dates is None else calendar_dates
    return dates.select(F.col(dates.columns[0]).cast("date").alias("_day")).distinct()


def differing_keys(
    history: DataFrame,
    old: DataFrame,
    new: DataFrame,
    cfg: HistoryConfig,
    old_calendar: Optional[DataFrame] = None,
    new_calendar: Optional[DataFrame] = None,
) -> DataFrame:
    """Keys whose versions a second reading may change.

    A key differs where the set of its rows on some date does: both readings go
    as (key, date, digest of the whole row) through one aggregate, combined
    map-side, so copies cost a row per task.  In full mode a date that only one
    reading loaded also touches the keys of the versions that reach or
    neighbour it, since their rows there, or the lack of them, count now.
    """
    keys = list(cfg.key_cols)

    def digests(snaps: DataFrame, side: int) -> DataFrame:
        rows = with_keys(snaps, cfg)
        cols = data_columns(snaps, cfg.date_col)
        text = prehash_text(sorted(cols), mode="strict")
        return rows.select(*keys, F.col(cfg.date_col).alias("_day"), F.md5(text).alias("_digest"), F.lit(side).alias("_side"))

    sides = digests(old, 0).unionByName(digests(new, 1)).groupBy(*keys, "_day", "_digest").agg(F.min("_side").alias("a"), F.max("_side").alias("b"))
    found = sides.filter("a = b").select(*keys)
    if not cfg.incremental:
        before, after = _dates_of(old, cfg, old_calendar), _dates_of(new, cfg, new_calendar)
        days = before.subtract(after).unionByName(after.subtract(before))  # at most one row per snapshot
        near = (F.col("ValidFrom") <= F.col("_day")) & (F.col("ValidTo") >= F.date_sub("_day", 1))
        found = found.unionByName(history.select(*keys, "ValidFrom", "ValidTo").join(F.broadcast(days), near, "left_semi").select(*keys))
    return found.distinct()


def reload_changed_keys(
    history: DataFrame,
    old: DataFrame,
    new: DataFrame,
    cfg: HistoryConfig,
    changed: Optional[DataFrame] = None,
    dedupe: bool = True,
    old_calendar: Optional[DataFrame] = None,
    new_calendar: Optional[DataFrame] = None,
) -> DataFrame:
    """R3 by difference: the history of the second reading ``new``, given the
    one built from the first, ``old``.

    Only differing keys go through the window pass; versions of the others
    pass through as they are.  ``changed``: the result of ``differing_keys``,
    best written first, as it is read three times.  Both readings hold the same
    columns.  Masks: a rebuilt version is masked if it started on or before the
    key's last forget signal in either reading, or the start of a version that
    was masked in ``history``, so masked rows stay masked.
    """
    if set(data_columns(old, cfg.date_col)) != set(data_columns(new, cfg.date_col)):
        raise ValueError("the two readings hold different columns: build the history anew")
    keys = list(cfg.key_cols)
    if changed is None:
        changed = differing_keys(history, old, new, cfg, old_calendar, new_calendar)
    rows = new.join(changed, keys, "left_semi")
    built = build_history(rows, cfg, calendar_dates=_dates_of(new, cfg, new_calendar), dedupe=dedupe)
    if cfg.sensitive_cols:
        marks = history.filter(F.col("GDPR_Compliant") == FORGOTTEN).select(*keys, F.col("ValidFrom").alias(_UPTO))
        if cfg.signal_col:
            for reading in (old, new):
                marks = marks.unionByName(reading.filter(signal_flag(cfg)).select(*keys, F.col(cfg.date_col).alias(_UPTO)))
        built = mask_versions_up_to(built, marks.groupBy(*keys).agg(F.max(_UPTO).alias(_UPTO)), cfg)
    cols = history_columns(data_columns(new, cfg.date_col))
    return history.join(changed, keys, "left_anti").select(*cols).unionByName(built.select(*cols))


def _neighbours(calendar_dates: DataFrame, day: Column):
    """The loaded dates before and after ``day``, and whether it is loaded."""
    c = F.col(calendar_dates.columns[0]).cast("date")
    return calendar_dates.agg(
        F.max(F.when(c < day, c)).alias("p"), F.min(F.when(c > day, c)).alias("n"), F.max(F.when(c == day, True)).alias("here")
    ).first()  # one row


def splice_snapshot(
    history: DataFrame, snapshot: DataFrame, snapshot_date, calendar_dates: DataFrame, cfg: HistoryConfig, dedupe: bool = True
) -> DataFrame:
    """R3/H2 for a snapshot that arrives late: the history with
    ``snapshot_date`` in its place, without reading the snapshots after it.

    ``calendar_dates`` (one DATE column): the dates loaded so far; the history
    alone does not tell a date on which nothing changed.  Between the loaded
    dates before and after, p and n, a key has at most the version valid on p
    and the one valid on n.  They and the snapshot's row meet in one full outer
    join on the key:

    * the row continues or anticipates one of them, or is a version of its own
      from the date to the day before n;
    * a version that spans p and n without an equal row is cut in two;
    * a version valid on p whose key is missing ends, deleted.

    All other versions pass through; those of keys first seen now at this date
    get it as FirstSnapshot.  The rows of a cut version's second half take the
    version's values, so what the hash does not tell apart (columns left out,
    NULL and '' in compat mode) may differ from the snapshot on n.

    Masks: the new version is masked if the key's masked versions span the date
    or start after it, or the row itself signals; a signal also masks the
    versions that started on or before it.

    Full mode only: an incremental history does not keep on which dates a key
    was seen again, so a late snapshot needs ``reload_changed_keys`` there.  A
    date after the last loaded one is a merge; a loaded one a reload.
    """
    if cfg.incremental:
        raise ValueError("an incremental history does not tell when a key was seen again: use reload_changed_keys")
    keys = list(cfg.key_cols)
    day = F.lit(snapshot_date).cast("date")
    at = _neighbours(calendar_dates, day)
    if at.here:
        raise ValueError(f"snapshot {snapshot_date} is loaded: reload instead")
    if at.n is None:
        raise ValueError(f"snapshot {snapshot_date} is newer than the history: merge instead")
    p, n = F.lit(at.p).cast("date"), F.lit(at.n).cast("date")
    cols = history_columns(data_columns(history, cfg.date_col))
    snap = prepare_snapshot(snapshot, day, cfg, dedupe)
    if set(data_columns(snap, cfg.date_col)) != set(data_columns(history, cfg.date_col)):
        raise ValueError("the snapshot's columns differ from the history's: align them first (merge.align_columns)")
    signals = cfg.sensitive_cols and cfg.signal_col
    signalled = signal_flag(cfg) if signals else F.lit(False)

    on = lambda d: (F.col("ValidFrom") <= d) & (F.col("ValidTo") >= d)
    on_p = on(p) if at.p is not None else F.lit(False)
    version = F.struct(*cols)
    before = history.filter(on_p).select(*keys, version.alias("P"))
    after = history.filter(on(n)).select(*keys, version.alias("N"))
    seen = snap.select(*keys, F.struct(*cols).alias("X"), signalled.alias("_signal"))
    masked = history.filter((F.col("GDPR_Compliant") == FORGOTTEN) & (F.col("ValidFrom") >= day)).select(*keys).distinct().withColumn("_masked_later", F.lit(True))
    # a key that was deleted before p keeps its FirstSnapshot
    gone = history.filter(F.col("IsDeleted") & (F.col("ValidTo") < day)).groupBy(*keys).agg(F.min("FirstSnapshot").alias("_gone"))
    seen = seen.join(gone, keys, "left").join(masked, keys, "left")
    met = before.join(after, keys, "full_outer").join(seen, keys, "full_outer")

    P, N, X = (F.col(c) for c in "PNX")
    has = lambda s: s["RowHashKey"].isNotNull()
    same = lambda a, b: F.coalesce(a["RowHashKey"] == b["RowHashKey"], F.lit(False))
    spans = has(P) & has(N) & (P["ValidFrom"] == N["ValidFrom"])
    eve, n_eve = F.date_sub(day, 1), F.date_sub(n, 1)
    fresh = F.when(has(X) & ~has(P) & F.col("_gone").isNull(), day)  # first seen at this date

    def row(s: Column, **changes) -> Column:
        first = {"FirstSnapshot": F.coalesce(fresh, s["FirstSnapshot"])}
        return F.struct(*[{**first, **changes}.get(c, s[c]).alias(c) for c in cols])

    # what a version masks beyond the date; the row's own signal is applied to all the key's versions below
    hide = F.coalesce(F.col("_masked_later"), F.lit(False)) | (spans & (P["GDPR_Compliant"] == FORGOTTEN))
    hide_early = same(X, N) & ~spans & (N["GDPR_Compliant"] == FORGOTTEN)
    kept_p = F.when(same(P, X), row(P)).when(has(X), row(P, ValidTo=eve, IsDeleted=F.lit(False))).otherwise(row(P, ValidTo=eve, IsDeleted=F.lit(True)))
    first = F.least(F.coalesce(P["FirstSnapshot"], F.col("_gone"), day), day)
    own = row(X, ValidFrom=day, SnapshotDate=day, ValidTo=n_eve, IsDeleted=~has(N), FirstSnapshot=first)
    # the run now begins with the late row, whose values a version takes
    early_n = row(X, ValidFrom=day, SnapshotDate=day, ValidTo=N["ValidTo"], IsDeleted=N["IsDeleted"], FirstSnapshot=F.coalesce(fresh, N["FirstSnapshot"]))
    second = row(N, ValidFrom=n, SnapshotDate=n)
    none = F.lit(None)
    out = F.array(
        F.when(has(P), kept_p),
        F.when(has(X) & ~same(X, P) & ~(same(X, N) & ~spans), own),
        F.when(has(N) & ~spans, F.when(same(X, N), early_n).otherwise(row(N))).when(spans & ~same(P, X), second).otherwise(none),
    )
    spliced = met.select(F.posexplode(out).alias("_place", "_v"), hide.alias("_own"), hide_early.alias("_early")).filter(F.col("_v").isNotNull())
    hidden = ((F.col("_place") == 1) & F.col("_own")) | ((F.col("_place") == 2) & F.col("_early"))
    spliced = spliced.select("_v.*", F.coalesce(hidden, F.lit(False)).alias("_hide"))
    if cfg.sensitive_cols:
        spliced = mask_where(spliced, F.col("_hide"), cfg)
    # versions on neither side of the date pass through; those of keys first seen later may be first seen now
    rest = history.filter(~on_p & ~on(n)).select(*cols)
    known, late = rest.filter(F.col("FirstSnapshot") <= day), rest.filter(F.col("FirstSnapshot") > day)
    late = late.join(snap.select(*keys).withColumn("_now", F.lit(True)), keys, "left")
    late = late.withColumn("FirstSnapshot", F.when(F.col("_now"), day).otherwise(F.col("FirstSnapshot")))
    result = known.unionByName(late.select(*cols)).unionByName(spliced.select(*cols))
    if signals:
        last = with_keys(snapshot, cfg).filter(signal_flag(cfg)).select(*keys).distinct().withColumn(_UPTO, day)
        result = mask_versions_up_to(result, last, cfg)
    return result
