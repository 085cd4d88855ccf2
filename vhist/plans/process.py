"""H5: process one snapshot end to end.

hash -> key files -> detect forget signals and anonymise -> anonymise the
history of the flagged keys -> system columns -> merge.
"""

from __future__ import annotations

import datetime as dt
from typing import Callable, Optional, Sequence, Tuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vhist.config import HistoryConfig
from vhist.functions.hashing import with_hash_key
from vhist.operators.merge import _chain, _in_steps, _linked, align_columns, by_date, merge_in_batches, merge_open_rows, merge_snapshot
from vhist.operators.privacy import anonymise_history, detect_and_anonymise, last_signals, mask_versions_up_to
from vhist.operators.reload import reload_plan
from vhist.sources import store
from vhist.sources.sinks import key_file, write_key_file


def process_snapshot(
    snapshot: Optional[DataFrame],
    history: DataFrame,
    snapshot_date,
    cfg: HistoryConfig,
    key_file_paths: Sequence[str] = (),
    deleted_rows: Optional[DataFrame] = None,
    dedupe: bool = True,
    through: bool = False,
) -> Tuple[str, DataFrame]:
    """Returns (status, new history).

    ``snapshot`` None means nothing was loaded for the date: status ``Skip``
    and the history unchanged.  The row hash is taken before masking, so a
    row that is only being forgotten opens no new version; the history of the
    flagged keys is anonymised first, so the versions it keeps are masked too.
    Key files are written when paths are given (one write per destination).
    With ``deleted_rows`` (versions ended by deletion) ``history`` is the open
    versions alone, and so the result the rows that replace them; with
    ``through`` closed versions pass through one join (``merge_open_rows``).
    """
    if snapshot is None:
        return "Skip", history
    snap = snapshot.drop(cfg.date_col) if cfg.date_col in snapshot.columns else snapshot
    hashed = with_hash_key(snap, cfg.key_cols, cfg.hash_cols, cfg.hash_mode, cfg.salt, cfg.date_col)
    if key_file_paths:
        write_key_file(key_file(hashed, snapshot_date), *key_file_paths)
    if cfg.signal_col and cfg.signal_pattern:
        hashed, ids = detect_and_anonymise(
            hashed, cfg.key_cols, cfg.signal_pattern, cfg.signal_col, cfg.sensitive_cols, cfg.mask
        )
        # forgetting is per key: every row of a flagged key, not only the flagged row
        hashed = anonymise_history(hashed, ids, cfg.key_cols, cfg.sensitive_cols, cfg.mask)
        history = anonymise_history(history, ids, cfg.key_cols, cfg.sensitive_cols, cfg.mask)
    if through:
        return "Successful", merge_open_rows(history, hashed, snapshot_date, cfg, dedupe=dedupe, through=True)
    if deleted_rows is not None:
        return "Successful", merge_open_rows(history, hashed, snapshot_date, cfg, deleted_rows=deleted_rows, dedupe=dedupe)
    return "Successful", merge_snapshot(history, hashed, snapshot_date, cfg, dedupe=dedupe)


def process_snapshots(
    history: DataFrame,
    snapshots: DataFrame,
    cfg: HistoryConfig,
    dates=None,
    checkpoint_every: int = 1,
    buckets: Optional[int] = None,
    dedupe: bool = True,
) -> DataFrame:
    """``process_snapshot`` for every date of ``snapshots`` in order, each on the
    state that the one before left, stored after every ``checkpoint_every`` dates
    in a new folder under the session's ``spark.checkpoint.dir``; the snapshots
    are computed once, and kept by date until the chain is done
    (``merge_snapshots``).

    Signals of a date mask the state when that date is processed.  On a stored
    history (``checkpoint_every=1``) closed versions are masked in the files that
    hold them; in longer steps, those of earlier steps when the result is read.
    """
    spark, root = _chain(snapshots)
    snapshots, dates = by_date(snapshots, cfg, f"{root}-snapshots", dates)
    on = lambda d: snapshots.filter(F.col(cfg.date_col) == F.lit(d))
    if checkpoint_every > 1:
        merge = lambda rows, d: process_snapshot(on(d), rows, d, cfg, dedupe=dedupe, through=True)[1]
        out = _in_steps(history, snapshots, cfg, root, dates, checkpoint_every, _linked(merge, cfg))
        if cfg.signal_col and cfg.signal_pattern:
            last_signals(snapshots, cfg).write.parquet(f"{root}/signals")
            out = mask_versions_up_to(out, spark.read.parquet(f"{root}/signals"), cfg)
        store.remove_folder(spark, f"{root}-snapshots")
        return out
    with store.StoredHistory(spark, root, cfg, buckets) as stored:
        stored.create(align_columns(history, snapshots, cfg.date_col)[0])
        for d in dates:
            stored.load(on(d), d, forget=True, dedupe=dedupe, step=_step(d, cfg, dedupe))
    store.remove_folder(spark, f"{root}-snapshots")
    return store.read_state(spark, root)


def _step(day, cfg: HistoryConfig, dedupe: bool):
    return lambda snapshot, open_rows, deleted: process_snapshot(snapshot, open_rows, day, cfg, deleted_rows=deleted, dedupe=dedupe)[1]


def process_in_batches(history: DataFrame, snapshots: DataFrame, cfg: HistoryConfig, dates=None, batch: int = 10) -> DataFrame:
    """The same result with fewer steps (``merge_in_batches``): the row hash is
    taken before masking, so forgetting never changes which versions there are,
    and what each date would have masked is masked once, at the end."""
    from vhist.operators.privacy import anonymise_from_signals

    if dates is not None:
        dates = sorted(dates)
        snapshots = snapshots.filter(F.col(cfg.date_col).isin(dates))
    merged = merge_in_batches(history, snapshots, cfg, dates=dates, batch=batch)
    if not (cfg.signal_col and cfg.signal_pattern):
        return merged
    return anonymise_from_signals(merged, snapshots, cfg)


def run_loads(
    log: DataFrame,
    requests: DataFrame,
    data_group: str,
    root: str,
    cfg: HistoryConfig,
    read_snapshot: Callable[[dt.date], DataFrame],
    layer: str = "Bronze",
    forget: bool = False,
    all_loads: Optional[DataFrame] = None,
) -> Tuple[str, list]:
    """A data group's loads from log to stored history: (action, dates loaded).

    The reload plan of the group's log rows decides: ``skip`` loads nothing;
    ``restore`` and ``force_restore`` go back to before the planned date and
    process every load from there on, in order.  ``all_loads`` is the log that
    names them, where ``log`` holds only the newest rows (a stream's batch).
    """
    mine = log.filter((F.col("DataGroupName") == data_group) & (F.col("Layer") == layer))
    plan = reload_plan(mine, requests).first()  # one group: at most one row
    if plan is None or plan.action == "skip":
        return "skip", []
    every = mine if all_loads is None else all_loads.filter((F.col("DataGroupName") == data_group) & (F.col("Layer") == layer))
    dates = every.filter(F.col("SnapshotDate") >= F.lit(plan.restore_from)).select("SnapshotDate").distinct()
    days = [r[0] for r in dates.collect()]  # one value per load
    return plan.action, store.reload_from(log.sparkSession, root, days, read_snapshot, cfg, forget=forget)
