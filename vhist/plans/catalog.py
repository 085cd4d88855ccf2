"""Queries over the driver tables, one per operator; each takes (spark, sf_dir).

Every query reads whole tables.  Merge-type operators work on "the last
snapshot against the history of all earlier snapshots", so they cover every
row of the table too.  Snapshot sets (see ``vhist.sources.derived``):

* EV  - events, last event per user and day: user_id, event_type, flag, value
* EVF - the same, flag only
* OR  - orders, last order per customer and month, with c_name (incremental)
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vhist.config import HistoryConfig
from vhist.functions.hashing import with_hash_key
from vhist.functions.predicates import is_closed, is_open
from vhist.operators import classify as cl
from vhist.operators import parts
from vhist.operators import privacy as pv
from vhist.operators import reload as rl
from vhist.operators import repair
from vhist.operators import report as rp
from vhist.operators import views as vw
from vhist.plans import process as pr
from vhist.operators.history import build_history
from vhist.operators.merge import merge_in_batches, merge_snapshot, merge_snapshots, prepare_snapshot
from vhist.sources import derived as dv
from vhist.sources import sinks
from vhist.sources import snapshots as sn

D = "snapshot_date"


def _snaps(spark, sf, which: str, since=None, until=None) -> tuple[DataFrame, HistoryConfig]:
    """A snapshot set, optionally only the dates in ``[since, until)`` (bounds
    applied to the raw timestamps, so they reach the scan)."""
    if which == "EV":
        return dv.events_daily(spark, sf, since=since, until=until), dv.EVENTS_CFG
    if which == "EVF":
        return dv.events_daily(spark, sf, flag_only=True, since=since, until=until), dv.EVENTS_CFG
    return dv.orders_monthly(spark, sf, since=since, until=until), dv.ORDERS_CFG


def _last_date(snaps: DataFrame):
    """The newest snapshot date, as a value: a merge runs for a given date, as a
    daily job would (one aggregate over the date column only)."""
    return snaps.agg(F.max(D)).first()[0]


def _kept(history: DataFrame) -> DataFrame:
    """A history built here from the driver tables and read several ways
    (rollback then reload reads its deleted, open and closed versions), persisted
    once; a production job reads these parts from the store, partition-pruned."""
    return history.persist(StorageLevel.MEMORY_AND_DISK)


def _split_last(spark, sf, which: str):
    """(history of all snapshots before the last, last snapshot prepared, last
    snapshot, last date, cfg).

    The earlier history is persisted: a merge reads it three ways (open rows,
    closed rows, deleted keys); a production job reads it from the store.
    """
    snaps, cfg = _snaps(spark, sf, which)
    last = _last_date(snaps)
    prior, _ = _snaps(spark, sf, which, until=last)
    today, _ = _snaps(spark, sf, which, since=last)  # the last date is the newest: no upper bound
    hist = build_history(prior, cfg, dedupe=False).persist(StorageLevel.MEMORY_AND_DISK)
    return hist, prepare_snapshot(today, last, cfg, dedupe=False), today, last, cfg


# ---------------------------------------------------------------- H1 / H2 / H4

def history_full(spark: SparkSession, sf: str) -> DataFrame:
    """H1 full mode over the per-user error/ok flag (flagship)."""
    return build_history(dv.events_daily(spark, sf, flag_only=True), dv.EVENTS_CFG, dedupe=False)


def history_full_wide(spark: SparkSession, sf: str) -> DataFrame:
    """H1 full mode over every event attribute (type, flag, decimal value)."""
    return build_history(dv.events_daily(spark, sf), dv.EVENTS_CFG, dedupe=False)


def history_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """H1 incremental mode over monthly orders."""
    return build_history(dv.orders_monthly(spark, sf), dv.ORDERS_CFG, dedupe=False)


def history_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    """H1 with the (key, date) de-duplication aggregate: one row per user and
    day from every event of the day, the smallest row hash winning (U4/D16)."""
    ev = dv.table(spark, sf, "events").select(
        "user_id", F.to_date("ts").alias(D), "event_type", F.col("value").cast("decimal(10,2)").alias("value")
    )
    return build_history(ev, dv.EVENTS_CFG, dedupe=True)


def check_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    """D16 check frame: users with several events in a day, and how many
    different rows (by hash) they had."""
    from vhist.operators.checks import duplicate_keys

    ev = dv.table(spark, sf, "events").select(
        "user_id", F.to_date("ts").alias(D), "event_type", F.col("value").cast("decimal(10,2)").alias("value")
    )
    return duplicate_keys(ev, dv.EVENTS_CFG)


def merge_step(spark: SparkSession, sf: str) -> DataFrame:
    """H2 + U2: last snapshot merged into the history of the earlier ones."""
    hist, _, today, last, cfg = _split_last(spark, sf, "EV")
    return merge_snapshot(hist, today, last, cfg, dedupe=False)


def merge_step_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """H2 incremental mode (orders)."""
    hist, _, today, last, cfg = _split_last(spark, sf, "OR")
    return merge_snapshot(hist, today, last, cfg, dedupe=False)


def merge_by_columns(spark: SparkSession, sf: str) -> DataFrame:
    """H4: merge comparing columns NULL-safely instead of the hash."""
    hist, _, today, last, cfg = _split_last(spark, sf, "EV")
    return merge_snapshot(hist, today, last, cfg, compare="columns", dedupe=False)


def history_chained(spark: SparkSession, sf: str) -> DataFrame:
    """H2 chained over all 30 days, one merge a day, the state stored every ten; equals ``history_full``."""
    from vhist.sources.snapshots import empty_history

    snaps = dv.events_daily(spark, sf, flag_only=True)
    return merge_snapshots(empty_history(spark, snaps.drop(D).schema), snaps, dv.EVENTS_CFG, checkpoint_every=10, dedupe=False)


def history_batched(spark: SparkSession, sf: str) -> DataFrame:
    """The same history in steps of ten days, a window pass each."""
    from vhist.sources.snapshots import empty_history

    snaps = dv.events_daily(spark, sf, flag_only=True)
    return merge_in_batches(empty_history(spark, snaps.drop(D).schema), snaps, dv.EVENTS_CFG, batch=10)


def _folder(spark, name: str) -> str:
    """A new folder under the session's ``spark.checkpoint.dir`` (shared on a cluster)."""
    import uuid

    from vhist.session import ensure_checkpoint_dir

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/vhist-{name}-{uuid.uuid4().hex}"


def _calendar(snaps: DataFrame) -> tuple[list, int]:
    """(dates in order, one value per snapshot; buckets for the snapshots' history,
    which has no more versions than they have rows)."""
    from vhist.sources import store

    rows = snaps.groupBy(D).count().orderBy(D).collect()
    return [r[0] for r in rows], store.buckets_for(sum(r[1] for r in rows))


def history_store(spark: SparkSession, sf: str) -> DataFrame:
    """H2 on stored folders: bulk-build the earlier days, store them, merge the
    last day (rewriting the open part and the month it ends), and read it back."""
    from vhist.sources import store

    root, last = _stored_days(spark, sf)[:2]
    return store.read_state(spark, root)


def _stored_days(spark: SparkSession, sf: str):
    """(folder, last day, what its load counted): every day but the last built in
    one pass and stored, the last one merged."""
    from vhist.sources import store

    root = _folder(spark, "store")
    snaps, cfg = _snaps(spark, sf, "EV")
    days, buckets = _calendar(snaps)
    last = days[-1]
    before, _ = _snaps(spark, sf, "EV", until=last)
    today, _ = _snaps(spark, sf, "EV", since=last)
    store.write_initial(build_history(before, cfg, dedupe=False), root, cfg, buckets)
    return root, last, store.merge_into(spark, root, today.drop(D), last, cfg)


def load_summary(spark: SparkSession, sf: str) -> DataFrame:
    """A3 without a pass of its own: what the last day's load changed, counted by
    its write job; equals ``change_summary``."""
    counted = _stored_days(spark, sf)[2]
    return spark.createDataFrame([(s, n) for s, n in counted.items() if n], "HistoryStatus string, n_keys long")


def _forgetting_store(spark: SparkSession, sf: str):
    """The earlier months built in one pass and stored, the last month loaded
    with forget handling: (root, months)."""
    from vhist.operators.history import build_history_forgetting
    from vhist.sources import store

    root = _folder(spark, "store")
    snaps, cfg = _snaps(spark, sf, "OR")
    months, buckets = _calendar(snaps)
    before, _ = _snaps(spark, sf, "OR", until=months[-1])
    today, _ = _snaps(spark, sf, "OR", since=months[-1])
    store.write_initial(build_history_forgetting(before, cfg, dedupe=False), root, cfg, buckets)
    store.merge_into(spark, root, today.drop(D), months[-1], cfg, forget=True)
    return root, months


def history_store_forgetting(spark: SparkSession, sf: str) -> DataFrame:
    """The store with forget requests, read back; equals ``history_forgetting``."""
    from vhist.sources import store

    return store.read_state(spark, _forgetting_store(spark, sf)[0])


def history_store_time_travel(spark: SparkSession, sf: str) -> DataFrame:
    """The state before the last month, read after that month's forget requests
    were loaded: they mask the earlier versions too."""
    from vhist.sources import store

    root, months = _forgetting_store(spark, sf)
    return store.read_state(spark, root, months[-2])


def history_store_files(spark: SparkSession, sf: str) -> DataFrame:
    """G3 in storage: all months stored raw, then the keys that any month flags
    are erased; every file below the folder, read as plain Parquet."""
    from vhist.sources import store

    root = _folder(spark, "store")
    buckets = _calendar(dv.orders_monthly(spark, sf))[1]
    store.write_initial(history_incremental(spark, sf), root, dv.ORDERS_CFG, buckets)
    store.erase(spark, root, _forget(spark, sf)[1], dv.ORDERS_CFG)
    files = spark.read.option("recursiveFileLookup", "true").parquet(root)
    return files.select("o_custkey", "ValidFrom", "RowHashKey", "o_orderstatus", "o_orderpriority", "c_name", "GDPR_Compliant")


def history_store_redo(spark: SparkSession, sf: str) -> DataFrame:
    """Dates loaded again: the last day but one is first loaded without its
    errors, then the last day, then both as they should be; equals
    ``history_full_wide``."""
    from vhist.sources import store

    root = _folder(spark, "store")
    snaps, cfg = _snaps(spark, sf, "EV")
    days, buckets = _calendar(snaps)
    read = lambda d: snaps.filter(F.col(D) == F.lit(d)).drop(D)
    before, _ = _snaps(spark, sf, "EV", until=days[-2])
    store.write_initial(build_history(before, cfg, dedupe=False), root, cfg, buckets)
    store.merge_into(spark, root, read(days[-2]).filter("flag = 'ok'"), days[-2], cfg)
    store.merge_into(spark, root, read(days[-1]), days[-1], cfg)
    store.reload_from(spark, root, days[-2:], read, cfg)
    return store.read_state(spark, root)


def run_loads(spark: SparkSession, sf: str) -> DataFrame:
    """Log to plan to restore to process: a log of three loads a month forces a
    restore from the earliest, and every load is processed into the store."""
    from vhist.sources import store

    root = _folder(spark, "store")
    snaps = dv.events_periods(spark, sf)
    log = snaps.select(D).distinct().select(
        F.date_format(D, "yyyyMMdd").alias("PK_DataGroupLoadLogID"), F.lit("events").alias("DataGroupName"),
        F.col(D).alias("SnapshotDate"), F.lit("Bronze").alias("Layer"),
    )
    pr.run_loads(
        log, dv.reload_requests(spark, sf), "events", root, dv.EVENTS_CFG,
        lambda d: snaps.filter(F.col(D) == F.lit(d)).drop(D),
    )
    return store.read_state(spark, root)


# ---------------------------------------------------------------- J1 / A3

def classify_full(spark, sf):
    hist, prepared, _, _, cfg = _split_last(spark, sf, "EV")
    return cl.classify(prepared, hist, cfg.key_cols).select(*cl.CLASSIFIED)


def classify_incremental(spark, sf):
    hist, prepared, _, _, cfg = _split_last(spark, sf, "OR")
    return cl.classify(prepared, hist, cfg.key_cols, incremental=True).select(*cl.CLASSIFIED)


def classify_sql(spark, sf):
    hist, prepared, _, _, cfg = _split_last(spark, sf, "EV")
    return cl.classify_sql(prepared, hist, cfg.key_cols).select(*cl.CLASSIFIED)


def change_summary(spark, sf):
    hist, prepared, _, _, cfg = _split_last(spark, sf, "EV")
    return cl.change_summary(cl.classify(prepared, hist, cfg.key_cols))


# ---------------------------------------------------------------- J2-J8, U3, A1, P10

def deleted_rows(spark, sf):
    hist, prepared, _, last, cfg = _split_last(spark, sf, "EV")
    return parts.deleted_rows(hist, cl.classify(prepared, hist, cfg.key_cols), cfg.key_cols, last)


def expired_rows(spark, sf):
    hist, prepared, _, last, cfg = _split_last(spark, sf, "EV")
    return parts.expired_rows(hist, cl.classify(prepared, hist, cfg.key_cols), cfg.key_cols, last)


def inserted_rows(spark, sf):
    hist, prepared, _, last, cfg = _split_last(spark, sf, "EV")
    prepared = prepared.persist(StorageLevel.MEMORY_AND_DISK)  # one day, read by classify and for the rows
    return parts.inserted_rows(prepared, hist, cl.classify(prepared, hist, cfg.key_cols), cfg.key_cols, last)


def new_and_updated(spark, sf):
    hist, prepared, _, _, cfg = _split_last(spark, sf, "EV")
    return parts.keys_with_status(cl.classify(prepared, hist, cfg.key_cols), cfg.key_cols, "new", "updated").select("BusinessKey")


def insert_only(spark, sf):
    hist, prepared, _, _, cfg = _split_last(spark, sf, "EV")
    return parts.insert_only(prepared, hist, cfg.key_cols)


def disappeared(spark, sf):
    hist, _, today, last, cfg = _split_last(spark, sf, "EV")
    return parts.disappeared(hist, today, cfg.key_cols, last)


def carried_rows(spark, sf):
    hist, prepared, _, _, cfg = _split_last(spark, sf, "EV")
    return parts.carried_rows(hist, cl.classify(prepared, hist, cfg.key_cols), cfg.key_cols)


def changed_by_columns(spark, sf):
    hist, prepared, _, _, cfg = _split_last(spark, sf, "EV")
    return parts.changed_by_columns_rows(hist, prepared, cfg.key_cols)


def unchanged_except_all(spark, sf):
    hist, prepared, _, _, cfg = _split_last(spark, sf, "EVF")
    return parts.unchanged_except_all(hist, prepared, cfg.key_cols)


def first_snapshot(spark, sf):
    return parts.first_snapshot(history_full_wide(spark, sf), dv.EVENTS_KEY).select("BusinessKey", "FirstSnapshot")


# ------------------------------------- composite text keys with the delimiter inside

def _text_keys_last(spark, sf):
    """(history of the earlier months, last month prepared, last month)."""
    snaps, cfg = dv.orders_text_keys(spark, sf), dv.TEXT_KEYS_CFG
    last = _last_date(snaps)
    hist = build_history(snaps.filter(F.col(D) < F.lit(last)), cfg, dedupe=False)
    return hist, prepare_snapshot(snaps.filter(F.col(D) == F.lit(last)), last, cfg, dedupe=False), last


def text_keys_classify(spark, sf):
    """Two keys of one joined text are classified apart."""
    hist, prepared, _ = _text_keys_last(spark, sf)
    return cl.classify(prepared, hist, ("p", "q"))


def text_keys_inserted(spark, sf):
    """J4 on text keys: FirstSnapshot is the key's own."""
    hist, prepared, last = _text_keys_last(spark, sf)
    return parts.inserted_rows(prepared, hist, cl.classify(prepared, hist, ("p", "q")), ("p", "q"), last)


def text_keys_multi_version(spark, sf):
    """A5 on text keys."""
    hist = build_history(dv.orders_text_keys(spark, sf), dv.TEXT_KEYS_CFG, dedupe=False)
    return rp.multi_version_keys(hist, ("p", "q"))


def text_keys_dedup(spark, sf):
    """U4 with conflicting copies: of every open version a masked copy, of every
    closed one a copy that ends a day earlier."""
    hist = build_history(dv.orders_text_keys(spark, sf), dv.TEXT_KEYS_CFG, dedupe=False)
    row = lambda **new: F.struct(*[new.get(c, F.col(c)).alias(c) for c in hist.columns])
    masked = row(GDPR_Compliant=F.lit("Yes"), o_orderpriority=F.lit("ANONYMISED"))
    copies = F.array(row(), F.when(is_open(), masked).otherwise(row(ValidTo=F.date_sub("ValidTo", 1))))
    return vw.dedup_versions(hist.select(F.inline(copies)), ("p", "q"))


# ---------------------------------------------------------------- P, S

def row_hash(spark, sf):
    """Row hash and business key of every daily snapshot row."""
    snaps, cfg = _snaps(spark, sf, "EV")
    return with_hash_key(snaps, cfg.key_cols).select("BusinessKey", "RowHashKey", D)


def row_hash_composite(spark, sf):
    """P4 composite key (customer, month) and strict-mode hash (NULL marked)."""
    snaps, _ = _snaps(spark, sf, "OR")
    cfg = HistoryConfig(key_cols=("o_custkey", D), hash_mode="strict")
    return with_hash_key(snaps, cfg.key_cols, hash_cols=("o_custkey", "o_orderstatus", "o_orderpriority", "c_name"),
                         mode="strict").select("BusinessKey", "RowHashKey")


def prepared_snapshot(spark, sf):
    """P5: the last snapshot with system columns, as fresh inserts."""
    return _split_last(spark, sf, "EV")[1]


def active_rows(spark, sf):
    """Open versions."""
    return history_full_wide(spark, sf).filter(is_open())


def closed_rows(spark, sf):
    """Closed versions."""
    return history_full_wide(spark, sf).filter(is_closed())


def deleted_versions(spark, sf):
    """Versions ended by disappearance."""
    return history_full_wide(spark, sf).filter(F.col("IsDeleted"))


def snapshot_on(spark, sf):
    """One snapshot by date equality (the last), date renamed."""
    snaps, _ = _snaps(spark, sf, "EV")
    return sn.snapshot_on(snaps, _last_date(snaps))


def scan_from(spark, sf):
    """Events stored as dated snapshots, read from the 15th day after the
    first one to the last; the bounds prune the dates' folders."""
    path = _folder(spark, "snapshots")
    ev = dv.table(spark, sf, "events").select(
        "event_id", "user_id", "event_type", F.date_format("ts", "yyyyMMdd").alias("FK_dimSnapshotID")
    )
    ev.repartition("FK_dimSnapshotID").write.partitionBy("FK_dimSnapshotID").parquet(path)
    ids = spark.read.parquet(path).select(F.to_date(F.col("FK_dimSnapshotID").cast("string"), sn.DATE_FORMAT).alias("d"))
    first, last = ids.agg(F.date_format(F.date_add(F.min("d"), 14), "yyyyMMdd"), F.date_format(F.max("d"), "yyyyMMdd")).first()
    return sn.read_snapshots(spark, path, first, last).select("event_id", "user_id", D, "event_type")


def dated_paths(spark, sf):
    """S3: monthly orders stored in a folder per date, dates taken from the paths."""
    path = _folder(spark, "dated")
    snaps, _ = _snaps(spark, sf, "OR")
    rows = snaps.select("o_custkey", "o_orderstatus", F.date_format(D, "yyyyMMdd").alias("day"))
    rows.repartition("day").write.partitionBy("day").parquet(path)
    return sn.read_dated_paths(spark, path, pattern="/day=([0-9]{8})/").select("o_custkey", "o_orderstatus", D)


def read_history_evolved(spark, sf):
    """A stored flag history read for snapshots that lost ``flag`` and gained
    ``event_type``: both columns are there."""
    root = _folder(spark, "history")
    sinks.write_history(history_full(spark, sf), root, "1")
    new = dv.events_daily(spark, sf).select("user_id", "event_type")
    return sn.read_history(spark, f"{root}/version=1", new.schema)


def check_null_keys(spark, sf):
    """D7 check frame: events whose user is unknown (errors, here)."""
    from vhist.operators.checks import null_key_rows

    ev = dv.table(spark, sf, "events").select(
        F.when(F.col("event_type") != "error", F.col("user_id")).alias("user_id"), F.to_date("ts").alias(D), "event_id", "event_type"
    )
    return null_key_rows(ev, dv.EVENTS_CFG)


def snapshot_distinct(spark, sf):
    """Business columns of the monthly order rows, exact duplicates removed."""
    o = dv.table(spark, sf, "orders").select(
        "o_custkey", F.trunc(F.to_date("o_orderdate"), "month").alias(D), "o_orderstatus", "o_orderpriority"
    )
    return sn.snapshot_distinct(o, ["o_custkey", D, "o_orderstatus", "o_orderpriority"])


def key_file(spark, sf):
    """Distinct (RowHashKey, SnapshotDate) of every daily snapshot."""
    snaps, cfg = _snaps(spark, sf, "EV")
    return sinks.key_file(with_hash_key(snaps, cfg.key_cols))


def json_project(spark, sf):
    """``events.props`` parsed with a given schema and projected."""
    ev = dv.table(spark, sf, "events")
    return sn.parse_json_column(ev, "props", "k INT", ["event_id", "user_id"])


# ---------------------------------------------------------------- G1-G3, J9, A7, H5

def _orders_hashed(spark, sf):
    snaps, cfg = _snaps(spark, sf, "OR")
    return with_hash_key(snaps, cfg.key_cols), cfg


def _forget(spark, sf):
    """Forget-request ids: keys flagged by the signal in any monthly snapshot."""
    hashed, cfg = _orders_hashed(spark, sf)
    return pv.detect_and_anonymise(hashed, cfg.key_cols, cfg.signal_pattern, cfg.signal_col, cfg.sensitive_cols)


def rtbf_snapshot(spark, sf):
    """G1: every monthly snapshot with flagged rows masked, hash taken before."""
    return _forget(spark, sf)[0]


def rtbf_ids(spark, sf):
    """Distinct forget-request keys."""
    return pv.forget_ids(_forget(spark, sf)[1], dv.ORDERS_KEY)


def rtbf_exposed(spark, sf):
    """History rows of those keys not anonymised yet."""
    return pv.exposed_rows(history_incremental(spark, sf), _forget(spark, sf)[1], dv.ORDERS_KEY)


def rtbf_history(spark, sf):
    """History with every version of those keys anonymised."""
    cfg = dv.ORDERS_CFG
    return pv.anonymise_history(history_incremental(spark, sf), _forget(spark, sf)[1], cfg.key_cols,
                                cfg.sensitive_cols)


def history_forgetting(spark, sf):
    """H1 + G1/G3 in one pass: every month processed with forget requests."""
    snaps, cfg = _snaps(spark, sf, "OR")
    from vhist.operators.history import build_history_forgetting

    return build_history_forgetting(snaps, cfg, dedupe=False)


def process_all(spark, sf):
    """H5 for every month in order, one ``process_snapshot`` a month, the state
    stored every eight; equals ``history_forgetting``."""
    from vhist.sources.snapshots import empty_history

    snaps, cfg = _snaps(spark, sf, "OR")
    return pr.process_snapshots(empty_history(spark, snaps.drop(D).schema), snaps, cfg, checkpoint_every=8, dedupe=False)


def process_batched(spark, sf):
    """The same in steps of fifteen months, masked at the end."""
    from vhist.sources.snapshots import empty_history

    snaps, cfg = _snaps(spark, sf, "OR")
    return pr.process_in_batches(empty_history(spark, snaps.drop(D).schema), snaps, cfg, batch=15)


def process_snapshot(spark, sf):
    """H5: the last month processed end to end into the history of the earlier ones."""
    hist, _, today, last, cfg = _split_last(spark, sf, "OR")
    return pr.process_snapshot(today, hist, last, cfg)[1]


# ---------------------------------------------------------------- H3, W1, U1, U4, P11

def history_half_open(spark, sf):
    return vw.half_open(history_full_wide(spark, sf))


def lag_change_flags(spark, sf):
    snaps, _ = _snaps(spark, sf, "EV")
    return vw.lag_change_flags(snaps, dv.EVENTS_KEY, ["event_type", "flag"])


def union_snapshots(spark, sf):
    """The daily snapshots as seven weekday frames, weekend frames without
    ``value``, put together by column name.

    The snapshots are derived once and persisted: a filter on the weekday of a
    grouping column is pushed below the per-day aggregate, so seven unpersisted
    frames would scan and aggregate ``events`` seven times."""
    snaps, _ = _snaps(spark, sf, "EV")
    snaps = snaps.persist(StorageLevel.MEMORY_AND_DISK)
    frames = []
    for dow in range(1, 8):
        f = snaps.filter(F.dayofweek(D) == dow)
        frames.append(f.drop("value") if dow in (1, 7) else f)
    return vw.union_snapshots(frames)


def dedup_versions(spark, sf):
    """U4: history with its open versions appended again, de-duplicated."""
    h = history_full_wide(spark, sf)
    # the open versions twice, made in the same pass (no second build, no cache)
    copies = F.explode(F.when(is_open(), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return vw.dedup_versions(h.select("*", copies.alias("_copy")).drop("_copy"), dv.EVENTS_KEY)


def schema_evolution(spark, sf):
    """Flag-only history, then a last snapshot with two more columns; the
    hash covers the configured columns, so only real changes open versions."""
    snaps, _ = _snaps(spark, sf, "EV")
    flags = snaps.select("user_id", D, "flag")
    last = _last_date(snaps)
    hist = build_history(flags.filter(F.col(D) < last), dv.EVENTS_FLAG_CFG, dedupe=False)
    hist = hist.persist(StorageLevel.MEMORY_AND_DISK)  # read three ways by the merge, as in _split_last
    today, _ = _snaps(spark, sf, "EV", since=last)
    return merge_snapshot(hist, today, last, dv.EVENTS_FLAG_CFG, dedupe=False)


# ---------------------------------------------------------------- A4, A5, O1-O3

def history_totals(spark, sf):
    return rp.history_totals(history_full_wide(spark, sf))


def multi_version_keys(spark, sf):
    return rp.multi_version_keys(history_full(spark, sf), dv.EVENTS_KEY).select("BusinessKey", "version_count")


def active_top10(spark, sf):
    return rp.active_top(history_full_wide(spark, sf), ["event_type", "flag", "value"], 10)


def most_changed_top10(spark, sf):
    return rp.most_changed(history_full(spark, sf), dv.EVENTS_KEY, 10).select("BusinessKey", "version_count")


def versions_of_top_key(spark, sf):
    # the history is read twice (top-1 key, then its versions)
    return rp.versions_of_top_key(_kept(history_full(spark, sf)), dv.EVENTS_KEY, ["flag"])


# ---------------------------------------------------------------- A2, A6, P8, R1-R3

def load_range(spark, sf):
    return rl.load_range(dv.load_log(spark, sf))


def load_ids(spark, sf):
    return rl.load_ids(dv.load_log(spark, sf))


def reload_plan(spark, sf):
    return rl.reload_plan(dv.load_log(spark, sf), dv.reload_requests(spark, sf))


def load_log_lookup(spark, sf):
    snaps, _ = _snaps(spark, sf, "EV")
    return rl.log_lookup(snaps, dv.load_log(spark, sf), "event_type")


def _restore_day(snaps):
    return snaps.agg(F.date_add(F.min(D), 15)).first()[0]


def _restore_month(snaps):
    return snaps.agg(F.add_months(F.min(D), 40)).first()[0]


def rollback(spark, sf):
    """R2: full history rolled back to before the 16th day."""
    snaps, _ = _snaps(spark, sf, "EV")
    return rl.rollback(history_full_wide(spark, sf), _restore_day(snaps))


def rollback_incremental(spark, sf):
    """R2 on the incremental history, to before the 41st month."""
    snaps, _ = _snaps(spark, sf, "OR")
    return rl.rollback(history_incremental(spark, sf), _restore_month(snaps))


def reload(spark, sf):
    """Roll back to the 16th day and reload the rest; equals the full build."""
    snaps, cfg = _snaps(spark, sf, "EV")
    return rl.reload_history(_kept(history_full_wide(spark, sf)), snaps, _restore_day(snaps), cfg, dedupe=False)


def reload_forgetting(spark, sf):
    """R3 with forget requests: the history built with signals, rolled back to
    the 41st month and reloaded; masked rows stay masked, equals the build."""
    from vhist.operators.history import build_history_forgetting

    snaps, cfg = _snaps(spark, sf, "OR")
    full = _kept(build_history_forgetting(snaps, cfg, dedupe=False))
    return rl.reload_history(full, snaps, _restore_month(snaps), cfg, dedupe=False, forget=True)


def reload_changed_keys(spark, sf):
    """R3 by difference: the first reading had lost the clicks of the 16th day;
    the keys whose rows differ in the second are rebuilt, equals the full build."""
    snaps, cfg = _snaps(spark, sf, "EV")
    lost = (F.col(D) == F.lit(_restore_day(snaps))) & (F.col("event_type") == "click")
    first = snaps.filter(~lost)
    days = snaps.select(D).distinct()
    hist = build_history(first, cfg, calendar_dates=days, dedupe=False)
    changed = repair.differing_keys(hist, first, snaps, cfg, days, days)
    path = _folder(spark, "changed-keys")
    changed.write.parquet(path)
    changed = spark.read.schema(changed.schema).parquet(path)
    return repair.reload_changed_keys(hist, first, snaps, cfg, changed, dedupe=False, old_calendar=days, new_calendar=days)


def history_splice(spark, sf):
    """The history of all days but the 16th, which is then put in its
    place without reading the days after it; equals the full build."""
    snaps, cfg = _snaps(spark, sf, "EV")
    day = _restore_day(snaps)
    others = snaps.filter(F.col(D) != F.lit(day))
    hist = build_history(others, cfg, dedupe=False)
    path = _folder(spark, "splice")
    hist.write.parquet(path)
    hist = spark.read.schema(hist.schema).parquet(path)
    snap = snaps.filter(F.col(D) == F.lit(day)).drop(D)
    return repair.splice_snapshot(hist, snap, day, others.select(D).distinct(), cfg, dedupe=False)


def _empty_day(spark, sf):
    """Daily flags without the rows of the 11th day, and the calendar of all days."""
    snaps, cfg = _snaps(spark, sf, "EVF")
    first = snaps.agg(F.min(D)).first()[0]
    return snaps.filter(F.col(D) != F.date_add(F.lit(first), 10)), snaps.select(D).distinct(), first, cfg


def history_empty_day(spark, sf):
    """H1 with a loaded but empty day: it deletes every key."""
    snaps, calendar, _, cfg = _empty_day(spark, sf)
    return build_history(snaps, cfg, calendar_dates=calendar, dedupe=False)


def reload_empty_day(spark, sf):
    """R3 from the 6th day over a loaded but empty day; equals ``history_empty_day``."""
    snaps, calendar, first, cfg = _empty_day(spark, sf)
    full = _kept(build_history(snaps, cfg, calendar_dates=calendar, dedupe=False))
    return rl.reload_history(full, snaps, F.date_add(F.lit(first), 5), cfg, dedupe=False, calendar_dates=calendar)


def reload_plan_customers(spark, sf):
    """R1 over a log where groups with one load and with several occur, asked
    for and not: skip, restore and force_restore."""
    log = dv.last_load_of_some(dv.customer_load_log(spark, sf))
    return rl.reload_plan(log, dv.customer_requests(spark, sf))


def reload_incremental(spark, sf):
    snaps, cfg = _snaps(spark, sf, "OR")
    return rl.reload_history(_kept(history_incremental(spark, sf)), snaps, _restore_month(snaps), cfg, dedupe=False)


QUERIES = {
    "history_full": history_full,
    "history_full_wide": history_full_wide,
    "history_incremental": history_incremental,
    "history_dedupe": history_dedupe,
    "check_duplicates": check_duplicates,
    "history_chained": history_chained,
    "history_batched": history_batched,
    "history_store": history_store,
    "load_summary": load_summary,
    "history_store_files": history_store_files,
    "history_store_forgetting": history_store_forgetting,
    "merge_step": merge_step,
    "merge_step_incremental": merge_step_incremental,
    "merge_by_columns": merge_by_columns,
    "classify_full": classify_full,
    "classify_incremental": classify_incremental,
    "classify_sql": classify_sql,
    "change_summary": change_summary,
    "deleted_rows": deleted_rows,
    "expired_rows": expired_rows,
    "inserted_rows": inserted_rows,
    "new_and_updated": new_and_updated,
    "insert_only": insert_only,
    "disappeared": disappeared,
    "carried_rows": carried_rows,
    "changed_by_columns": changed_by_columns,
    "unchanged_except_all": unchanged_except_all,
    "first_snapshot": first_snapshot,
    "row_hash": row_hash,
    "row_hash_composite": row_hash_composite,
    "prepared_snapshot": prepared_snapshot,
    "active_rows": active_rows,
    "closed_rows": closed_rows,
    "deleted_versions": deleted_versions,
    "snapshot_on": snapshot_on,
    "scan_from": scan_from,
    "snapshot_distinct": snapshot_distinct,
    "key_file": key_file,
    "json_project": json_project,
    "rtbf_snapshot": rtbf_snapshot,
    "rtbf_ids": rtbf_ids,
    "rtbf_exposed": rtbf_exposed,
    "rtbf_history": rtbf_history,
    "process_snapshot": process_snapshot,
    "history_forgetting": history_forgetting,
    "process_all": process_all,
    "process_batched": process_batched,
    "history_half_open": history_half_open,
    "lag_change_flags": lag_change_flags,
    "union_snapshots": union_snapshots,
    "dedup_versions": dedup_versions,
    "schema_evolution": schema_evolution,
    "history_totals": history_totals,
    "multi_version_keys": multi_version_keys,
    "active_top10": active_top10,
    "most_changed_top10": most_changed_top10,
    "versions_of_top_key": versions_of_top_key,
    "load_range": load_range,
    "load_ids": load_ids,
    "reload_plan": reload_plan,
    "load_log_lookup": load_log_lookup,
    "rollback": rollback,
    "rollback_incremental": rollback_incremental,
    "reload": reload,
    "reload_incremental": reload_incremental,
    "reload_forgetting": reload_forgetting,
    "history_store_time_travel": history_store_time_travel,
    "history_store_redo": history_store_redo,
    "run_loads": run_loads,
    "dated_paths": dated_paths,
    "read_history_evolved": read_history_evolved,
    "check_null_keys": check_null_keys,
    "text_keys_classify": text_keys_classify,
    "text_keys_inserted": text_keys_inserted,
    "text_keys_multi_version": text_keys_multi_version,
    "text_keys_dedup": text_keys_dedup,
    "history_empty_day": history_empty_day,
    "reload_empty_day": reload_empty_day,
    "reload_plan_customers": reload_plan_customers,
    "reload_changed_keys": reload_changed_keys,
    "history_splice": history_splice,
}
