"""H2 / H4: merge one snapshot into a history.

Only open versions take part in the join; closed versions pass through.  One
full outer join of open rows with the snapshot decides, per key:

* keep  - open row, same content (or, incremental mode, key absent): unchanged
* close - open row otherwise: ValidTo = snapshot - 1, IsDeleted if absent
* open  - snapshot row that is not kept: a new version from the snapshot date

``inline(array_compact(array(...)))`` emits the zero to two rows per key in
the same pass, instead of the semi/anti-join chain of separate frames.

A returning key (deleted earlier, no open row) takes its FirstSnapshot from its
deleted rows; that lookup is an aggregate on the key, co-partitioned with the
snapshot, so the three inputs meet on one key partitioning.
"""

from __future__ import annotations

import uuid
from typing import Iterable, List, Optional

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vhist.config import HistoryConfig
from vhist.functions.columns import data_columns, history_columns, open_end
from vhist.functions.hashing import with_hash_key
from vhist.functions.columns import FORGOTTEN
from vhist.functions.predicates import changed_by_columns, is_closed, is_open, transitions


def _as_date(d) -> Column:
    return d if isinstance(d, Column) else F.lit(d).cast("date")


def _before(valid: Column, d: Column) -> Column:
    """The date, which must lie before ``d``: snapshots are merged in date order,
    older ones by ``reload_history`` or the store's ``redo_from``."""
    late = F.raise_error(F.concat(F.lit("snapshot "), d.cast("string"), F.lit(" is not newer than the history: reload instead")))
    return F.when(valid < d, valid).otherwise(late.cast("date"))


def align_columns(history: DataFrame, snapshot: DataFrame, date_col: str) -> tuple[DataFrame, DataFrame, List[str]]:
    """Give history and snapshot the union of their data columns.

    A column new in the snapshot is back-filled in history as NULL of the
    snapshot's type; a column the snapshot lacks is NULL in the snapshot, so
    history keeps it.  Returns both frames and the data column order.
    """
    h_cols = data_columns(history, date_col)
    s_cols = data_columns(snapshot, date_col)
    order = h_cols + [c for c in s_cols if c not in h_cols]
    h_types = dict(history.dtypes)
    s_types = dict(snapshot.dtypes)
    history = history.withColumns({c: F.lit(None).cast(s_types[c]) for c in s_cols if c not in h_cols}) if any(
        c not in h_cols for c in s_cols) else history
    missing = [c for c in h_cols if c not in s_cols]
    if missing:
        snapshot = snapshot.withColumns({c: F.lit(None).cast(h_types[c]) for c in missing})
    return history, snapshot, order


def prepare_snapshot(snapshot: DataFrame, snapshot_date, cfg: HistoryConfig, dedupe: bool = True) -> DataFrame:
    """P5: hash, key and system columns of one snapshot, as fresh inserts."""
    from vhist.functions.columns import with_system_columns

    from vhist.operators.checks import with_keys

    snap = with_keys(snapshot.drop(cfg.date_col), cfg)
    if "RowHashKey" not in snap.columns:  # a pre-hashed snapshot keeps its hash (taken before masking)
        snap = with_hash_key(snap, cfg.key_cols, cfg.hash_cols, cfg.hash_mode, cfg.salt, cfg.date_col)
    if dedupe:
        from vhist.operators.history import dedupe_order

        rest = [c for c in snap.columns if c not in cfg.key_cols]
        snap = (
            snap.groupBy(*cfg.key_cols)
            .agg(F.min_by(F.struct(*rest), dedupe_order(data_columns(snap, cfg.date_col))).alias("_r"))
            .select(*cfg.key_cols, *[F.col(f"_r.{c}").alias(c) for c in rest])
        )
    return with_system_columns(snap, _as_date(snapshot_date))


def merge_open_rows(
    open_rows: DataFrame,
    snapshot: DataFrame,
    snapshot_date,
    cfg: HistoryConfig,
    deleted_rows: Optional[DataFrame] = None,
    compare: str = "hash",
    dedupe: bool = True,
    through: bool = False,
) -> DataFrame:
    """The rows that replace the open versions after loading ``snapshot``.

    Returns kept open versions, versions closed on ``snapshot_date - 1`` and
    versions opened on ``snapshot_date``; closed history is not touched, so a
    store can write just these rows (see ``vhist.sources.store``).
    ``deleted_rows``: versions ended by deletion (or any superset of them, such
    as all closed rows); returning keys take their FirstSnapshot from them.
    ``through``: ``open_rows`` may hold closed versions as well; they meet no
    snapshot row and pass through the same join (chains of merges in one plan).
    """
    if compare not in ("hash", "columns"):
        raise ValueError("compare must be 'hash' or 'columns'")
    keys = list(cfg.key_cols)
    d = _as_date(snapshot_date)
    snap = prepare_snapshot(snapshot, d, cfg, dedupe)
    open_rows, snap, dcols = align_columns(open_rows, snap, cfg.date_col)
    cols = history_columns(dcols)

    if cfg.incremental or deleted_rows is None:
        snap = snap.withColumn("_prior_first", F.lit(None).cast("date"))
    else:
        returning = (
            deleted_rows.filter(F.col("IsDeleted"))
            .groupBy(*keys)
            .agg(F.min("FirstSnapshot").alias("_prior_first"))
        )
        snap = snap.join(returning, keys, "left")

    h, s = open_rows.select(*cols).alias("h"), snap.alias("s")
    cond = [F.col(f"h.{k}") == F.col(f"s.{k}") for k in keys]
    current = F.col("h.ValidTo") == open_end()
    j = h.join(s, [*cond, current] if through else cond, "full_outer")

    has_h = F.col("h.RowHashKey").isNotNull()
    passed = has_h & ~current if through else F.lit(False)
    has_h = has_h & ~passed
    has_s = F.col("s.RowHashKey").isNotNull()
    if compare == "hash":
        same = F.col("h.RowHashKey") == F.col("s.RowHashKey")
    else:
        compared = [c for c in dcols if c not in keys]
        plain = changed_by_columns([c for c in compared if c not in cfg.sensitive_cols], "h", "s")
        sensitive = changed_by_columns([c for c in compared if c in cfg.sensitive_cols], "h", "s")
        # masked values differ from the snapshot's by design: they are not a change
        same = ~(plain | (sensitive & (F.col("h.GDPR_Compliant") != FORGOTTEN)))
    keep, close, opens = transitions(has_h, has_s, same, cfg.incremental)

    def h_row(valid_to: Column, deleted: Column) -> Column:
        vals = {c: F.col(f"h.{c}") for c in cols}
        vals["ValidFrom"] = _before(vals["ValidFrom"], d)
        vals["ValidTo"], vals["IsDeleted"] = valid_to, deleted
        return F.struct(*[vals[c].alias(c) for c in cols])

    s_vals = {c: F.col(f"s.{c}") for c in cols}
    s_vals["FirstSnapshot"] = F.coalesce(F.col("h.FirstSnapshot"), F.col("s._prior_first"), d)
    s_row = F.struct(*[s_vals[c].alias(c) for c in cols])

    as_is = F.struct(*[F.col(f"h.{c}").alias(c) for c in cols])
    old_version = F.when(passed, as_is).when(keep, h_row(F.col("h.ValidTo"), F.col("h.IsDeleted"))).when(
        close, h_row(F.date_sub(d, 1), ~has_s)
    )
    new_version = F.when(opens, s_row)
    return j.select(F.inline(F.array_compact(F.array(old_version, new_version))))


def conform(df: DataFrame, like: DataFrame) -> DataFrame:
    """``df`` with the columns of ``like`` in its order; missing ones as typed NULL."""
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else F.lit(None).cast(t).alias(c) for c, t in like.dtypes])


def merge_snapshot(
    history: DataFrame,
    snapshot: DataFrame,
    snapshot_date,
    cfg: HistoryConfig,
    compare: str = "hash",
    dedupe: bool = True,
) -> DataFrame:
    """New history after loading ``snapshot`` taken on ``snapshot_date``.

    ``compare="hash"`` tests RowHashKey; ``compare="columns"`` (H4) tests every
    non-key data column NULL-safely, which tells NULL from '' and is immune to
    delimiter collisions.  A history that ``snapshot_date`` is not newer than
    raises when the result is computed.  Closed versions pass through unchanged.
    """
    closed_rows = history.filter(is_closed())
    delta = merge_open_rows(
        history.filter(is_open()), snapshot, snapshot_date, cfg, deleted_rows=closed_rows, compare=compare,
        dedupe=dedupe,
    )
    closed_rows = closed_rows.withColumn("ValidTo", _before(F.col("ValidTo"), _as_date(snapshot_date)))
    return conform(closed_rows, delta).unionByName(delta)


def merge_snapshots(
    history: DataFrame,
    snapshots: DataFrame,
    cfg: HistoryConfig,
    dates: Optional[Iterable] = None,
    checkpoint_every: int = 1,
    compare: str = "hash",
    buckets: Optional[int] = None,
    dedupe: bool = True,
) -> DataFrame:
    """Chain of merges over the snapshots' dates in order, as a daily job would:
    one merge per date.

    The state is stored after every ``checkpoint_every`` dates, in a new folder
    under the session's ``spark.checkpoint.dir``.  With 1 that is a bucketed
    stored history (``vhist.sources.store``): a merge reads the open versions
    that the one before wrote and exchanges the snapshot only.  With more, so
    many merges form one plan between two states, which saves jobs where states
    are small.  ``dates`` (one value per snapshot) are read to the driver if not
    given.  The snapshots are computed once, and kept by date until the chain is
    done (``by_date``).
    """
    from vhist.sources.store import StoredHistory, read_state, remove_folder

    spark, root = _chain(snapshots)
    snapshots, dates = by_date(snapshots, cfg, f"{root}-snapshots", dates)
    on = lambda d: snapshots.filter(F.col(cfg.date_col) == F.lit(d))
    if checkpoint_every > 1:
        merge = lambda rows, d: merge_open_rows(rows, on(d).drop(cfg.date_col), d, cfg, compare=compare, dedupe=dedupe, through=True)
        out = _in_steps(history, snapshots, cfg, root, dates, checkpoint_every, _linked(merge, cfg))
        remove_folder(spark, f"{root}-snapshots")
        return out
    with StoredHistory(spark, root, cfg, buckets) as stored:
        stored.create(align_columns(history, snapshots, cfg.date_col)[0])
        for d in dates:
            stored.load(on(d), d, compare, dedupe=dedupe)
    remove_folder(spark, f"{root}-snapshots")
    return read_state(spark, root)


def _linked(merge, cfg: HistoryConfig):
    """A step of several merges: each on the rows of the one before, closed
    versions passing through.  A key's FirstSnapshot is the least of its
    versions', earlier deleted ones included; it is set once, at the end."""

    def step(current: DataFrame, ended: DataFrame, dates: list) -> DataFrame:
        rows = current
        for d in dates:
            rows = merge(rows, d)
        if cfg.incremental:
            return rows
        keys = list(cfg.key_cols)
        prior = ended.filter(F.col("IsDeleted")).groupBy(*keys).agg(F.min("FirstSnapshot").alias("_prior_first"))
        first = F.min(F.least("FirstSnapshot", "_prior_first")).over(Window.partitionBy(*keys))
        return rows.join(prior, keys, "left").withColumn("FirstSnapshot", first).select(*rows.columns)

    return step


def _chain(snapshots: DataFrame):
    """(session, new folder) of a chain."""
    from vhist.session import ensure_checkpoint_dir

    spark = snapshots.sparkSession
    return spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/vhist-chain-{uuid.uuid4().hex}"


def _in_order(snapshots: DataFrame, cfg: HistoryConfig, dates: Optional[Iterable]) -> list:
    """The dates of a chain."""
    return sorted([r[0] for r in snapshots.select(cfg.date_col).distinct().collect()] if dates is None else dates)


def by_date(snapshots: DataFrame, cfg: HistoryConfig, path: str, dates: Optional[Iterable] = None) -> tuple[DataFrame, list]:
    """(the snapshots, computed once and written as a folder per date; their
    dates in order).  A chain reads its input date by date, and a filter on a
    date derived from other columns does not reach the scan: without the folders
    every date would compute all snapshots again."""
    schema = snapshots.schema
    if dates is not None:
        dates = list(dates)
        snapshots = snapshots.filter(F.col(cfg.date_col).isin(dates))
    snapshots.hint("rebalance", cfg.date_col).write.partitionBy(cfg.date_col).parquet(path)
    kept = snapshots.sparkSession.read.schema(schema).parquet(path).select(*schema.names)
    return kept, _in_order(kept, cfg, dates)


def merge_in_batches(
    history: DataFrame,
    snapshots: DataFrame,
    cfg: HistoryConfig,
    dates: Optional[Iterable] = None,
    batch: int = 10,
) -> DataFrame:
    """The same result with fewer steps: each covers ``batch`` dates, in one
    window pass that continues the open versions (``extend_history``).

    The state is stored between steps: a step reads the open versions that the
    last one wrote (and of deleted versions the keys) and writes what it closed
    and what is open.
    """
    from vhist.operators.reload import extend_history

    spark, root = _chain(snapshots)
    dates, day = _in_order(snapshots, cfg, dates), F.col(cfg.date_col)

    def step(current: DataFrame, ended: DataFrame, some_dates: list) -> DataFrame:
        some = snapshots.filter((day >= F.lit(some_dates[0])) & (day <= F.lit(some_dates[-1])))
        calendar = spark.createDataFrame([(d,) for d in some_dates], f"`{cfg.date_col}` date")
        return extend_history(current, ended, some, cfg, some_dates[0], calendar_dates=calendar)

    return _in_steps(history, snapshots, cfg, root, dates, batch, step)


def _in_steps(history: DataFrame, snapshots: DataFrame, cfg: HistoryConfig, root: str, dates: list, every: int, step) -> DataFrame:
    """``step(open rows, closed rows, dates)`` for every so many dates, the state
    stored in between: closed versions are written once."""
    spark = snapshots.sparkSession
    history, _, order = align_columns(history, snapshots, cfg.date_col)
    history = history.select(*history_columns(order))
    schema, written = history.schema, []
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)

    def store(rows: DataFrame) -> None:
        written.append(f"{root}/step={len(written)}")
        rows.select(*schema.names).withColumn("open", is_open()).write.partitionBy("open").parquet(written[-1])

    def stored(paths, is_current: bool) -> DataFrame:
        rows = spark.read.schema(f"{ddl}, open boolean").option("basePath", root).parquet(*paths)
        return rows.filter(F.col("open") == is_current).select(*schema.names)

    store(history)
    for i in range(0, len(dates), every):
        store(step(stored(written[-1:], True), stored(written, False), dates[i : i + every]))
    return stored(written, False).unionByName(stored(written[-1:], True))
