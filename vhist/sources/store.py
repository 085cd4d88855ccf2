"""A history stored as plain Parquet folders, merged into day by day.

Layout under ``root``::

    buckets=<n>/part=open/IsDeleted=false/       open versions
    buckets=<n>/part=<yyyy-mm>/IsDeleted=<b>/    versions that ended in that month

Every folder holds the history's own columns and nothing else; there is no log
and no settings file.  Files are bucketed and sorted by the key (one file per
bucket of the open part), so a load's full outer join reads the stored side
without an exchange or a sort, and carry Bloom filters of the key columns.

A load writes once, by dynamic partition overwrite: the open part, and the part
of the month that ends the day before it.  Spark puts the new files in place
when all of them are written, so a load that fails leaves the old state.  A
load reads the open part, that month, and of deleted versions their keys: its
cost does not follow the closed history.  What it changed is counted while it
is written (``Observation``), not by another pass.

The state as of an earlier date is a rollback of the stored rows: versions are
identified by key and start, so nothing else is kept per date.  Loading a date
again, or one before the newest, is ``reload_from``: the rows are rolled back to
before it and the given dates loaded in order.  Which dates were loaded is the
load log's to know, an ordinary frame (``plans.process.run_loads``).

Forgetting changes the files: a load with ``forget`` masks the flagged rows, the
open versions of their keys, and by ``erase`` rewrites those parts of the closed
history that hold unmasked versions of them.  Other parts are not touched.
"""

from __future__ import annotations

import datetime as dt
import uuid
from typing import Callable, Iterable, Optional

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vhist.config import HistoryConfig
from vhist.functions.columns import FORGOTTEN, NOT_FORGOTTEN, OPEN_END, data_columns, history_columns
from vhist.functions.hashing import row_hash, with_hash_key
from vhist.functions.predicates import is_open
from vhist.operators.merge import align_columns, conform, merge_open_rows
from vhist.operators.privacy import anonymise_history, detect_and_anonymise, forget_ids

OPEN = "open"
FEW_KEYS = 1000  # forget requests up to this many are pushed down as values
ROWS_A_BUCKET = 1 << 20  # versions that one task sorts and writes when a history is stored in bulk
_SORTED = "spark.sql.legacy.bucketedTableScan.outputOrdering"


def _files(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, place = _files(spark, path)
    fs.delete(place, True)


def _folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder (none if it does not exist)."""
    fs, place = _files(spark, path)
    if not fs.exists(place):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(place) if s.isDirectory() and "=" in s.getPath().getName())


def _home(spark: SparkSession, root: str) -> Optional[str]:
    found = [n for n in _folders(spark, root) if n.startswith("buckets=")]
    return f"{root.rstrip('/')}/{found[0]}" if found else None


def buckets_for(rows: int) -> int:
    """Buckets for a history of at most so many versions: a task writes one
    bucket of all parts, so their number follows the history and a task's rows
    do not."""
    return max(2, -(-rows // ROWS_A_BUCKET))


def _month(d: dt.date) -> str:
    return d.strftime("%Y-%m")


def _part():
    return F.when(is_open(), F.lit(OPEN)).otherwise(F.date_format("ValidTo", "yyyy-MM"))


def stored_schema(spark: SparkSession, root: str) -> Optional[T.StructType]:
    """The history's columns, from the open part (of the newest one if nothing
    is open): every write carries all columns, so one file's footer tells them."""
    home = _home(spark, root)
    parts = _folders(spark, home) if home else []
    if not parts:
        return None
    newest = f"part={OPEN}" if f"part={OPEN}" in parts else parts[-1]
    found = spark.read.parquet(f"{home}/{newest}").schema
    fields = {f.name: f for f in found if f.name != "part"}
    fields["IsDeleted"] = T.StructField("IsDeleted", T.BooleanType())
    return T.StructType([fields[c] for c in history_columns([f.name for f in found if f.name in fields])])


def read_state(spark: SparkSession, root: str, as_of: Optional[dt.date] = None) -> DataFrame:
    """The stored history, or with ``as_of`` as it was after that date's load
    (time travel).  Masked rows are masked in the files, whatever date is asked."""
    from vhist.operators.reload import rollback

    schema = stored_schema(spark, root)
    if schema is None:
        raise ValueError(f"{root} holds no history")
    stored = T.StructType([*schema, T.StructField("part", T.StringType())])
    rows = spark.read.schema(stored).parquet(_home(spark, root)).select(*schema.names)
    return rows if as_of is None else rollback(rows, as_of + dt.timedelta(days=1))


def newest_date(spark: SparkSession, root: str) -> Optional[dt.date]:
    """The newest load that left a trace: a version started or ended by it."""
    if _home(spark, root) is None:
        return None
    ended = F.when(F.col("ValidTo") < F.lit(OPEN_END), F.date_add("ValidTo", 1))
    return read_state(spark, root).agg(F.max(F.greatest(F.col("ValidFrom"), F.coalesce(ended, F.col("ValidFrom"))))).first()[0]


class StoredHistory:
    """A stored history opened for loads: its folders as a table of the session.

    Use as a context manager; leaving it drops the table, not the files."""

    def __init__(self, spark: SparkSession, root: str, cfg: HistoryConfig, buckets: Optional[int] = None):
        self.spark, self.root, self.cfg = spark, root.rstrip("/"), cfg
        home = _home(spark, root)
        self.buckets = int(home.rsplit("=", 1)[1]) if home else int(buckets or spark.conf.get("spark.sql.shuffle.partitions"))
        self.home = home or f"{self.root}/buckets={self.buckets}"
        self.name = f"vhist_{uuid.uuid4().hex}"
        self.schema: Optional[T.StructType] = None
        found = stored_schema(spark, root)
        if found is not None:
            self._register(found)
            spark.sql(f"ALTER TABLE {self.name} RECOVER PARTITIONS")

    def __enter__(self) -> "StoredHistory":
        return self

    def __exit__(self, *_) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def _register(self, schema: T.StructType) -> None:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema if f.name != "IsDeleted")
        keys = ", ".join(f"`{k}`" for k in self.cfg.key_cols)
        # filters as large as each file's keys need, not one megabyte each
        blooms = ", `parquet.bloom.filter.adaptive.enabled` 'true'" + "".join(f", `parquet.bloom.filter.enabled#{k}` 'true'" for k in self.cfg.key_cols)
        self.spark.sql(
            f"CREATE TABLE {self.name} ({columns}, part STRING, IsDeleted BOOLEAN) USING parquet "
            f"OPTIONS (partitionOverwriteMode 'dynamic'{blooms}) PARTITIONED BY (part, IsDeleted) "
            f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {self.buckets} BUCKETS LOCATION '{self.home}'"
        )
        self.schema = schema

    def _widen(self, schema: T.StructType) -> None:
        """Take over columns that the stored rows lack (NULL there)."""
        new = [f for f in schema if f.name not in self.schema.names]
        if new:
            self.spark.sql(f"ALTER TABLE {self.name} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in new)})")
            self.schema = T.StructType([*self.schema, *new])

    def rows(self) -> DataFrame:
        """The stored rows, with ``part``."""
        return self.spark.table(self.name).select(*self.schema.names, "part")

    def open_rows(self) -> DataFrame:
        return self.rows().filter(F.col("part") == OPEN).filter(~F.col("IsDeleted")).drop("part")

    def _parts(self) -> list[tuple]:
        """(part, IsDeleted) of the stored folders."""
        found = [dict(x.split("=", 1) for x in r[0].split("/")) for r in self.spark.sql(f"SHOW PARTITIONS {self.name}").collect()]
        return [(p["part"], p["IsDeleted"] == "true") for p in found]

    def _write(self, rows: DataFrame) -> None:
        names = [n for n in self.schema.names if n != "IsDeleted"]
        rows.select(*names, _part().alias("part"), "IsDeleted").write.insertInto(self.name, overwrite=True)

    def _remove(self, parts: Iterable[tuple]) -> None:
        """Remove parts, (part, IsDeleted) each, that hold no rows any more."""
        for part, deleted in parts:
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION (part = '{part}', IsDeleted = {str(deleted).lower()})")
            for path in (f"{self.home}/part={part}/IsDeleted={str(deleted).lower()}", f"{self.home}/part={part}"):
                fs, place = _files(self.spark, path)
                if fs.exists(place) and (path.count("IsDeleted=") or not fs.listStatus(place)):
                    fs.delete(place, True)

    def create(self, history: DataFrame) -> None:
        """Store a history built in bulk: one exchange on the key."""
        if self.schema is not None:
            raise ValueError(f"{self.root} holds a history already")
        history = history.select(*history_columns(data_columns(history)))
        self._register(history.schema)
        self._write(history.repartition(self.buckets, *self.cfg.key_cols))

    def load(
        self, snapshot: DataFrame, day: dt.date, compare: str = "hash", forget: bool = False, again: bool = False, dedupe: bool = True,
        step: Optional[Callable[[DataFrame, DataFrame, DataFrame], DataFrame]] = None,
    ) -> dict:
        """Merge the snapshot of ``day`` into the stored history; returns how
        many keys were new, updated, deleted and unchanged.

        ``again``: the history may reach beyond ``day``; it is rolled back to
        before it first.  ``dedupe=False``: the snapshot has one row per key
        already.  ``step(snapshot, open rows, deleted rows)`` replaces
        the plain merge (``plans.process.process_snapshots``).
        """
        cfg, keys = self.cfg, list(self.cfg.key_cols)
        snapshot = snapshot.drop(cfg.date_col)
        ids = None
        if forget and cfg.signal_col and cfg.signal_pattern:
            hashed = snapshot
            if "RowHashKey" not in snapshot.columns:
                hashed = with_hash_key(snapshot, keys, cfg.hash_cols, cfg.hash_mode, cfg.salt, cfg.date_col)
            flagged, ids = detect_and_anonymise(hashed, keys, cfg.signal_pattern, cfg.signal_col, cfg.sensitive_cols, cfg.mask)
            ids = _Keys(ids, keys)
            if step is None or self.schema is None:
                snapshot = anonymise_history(flagged, ids.frame, keys, cfg.sensitive_cols, cfg.mask)
        if self.schema is None:
            from vhist.operators.history import build_history

            first = build_history(snapshot.withColumn(cfg.date_col, F.lit(day)), cfg, dedupe=dedupe)
            self._register(first.schema)
            return self._store(first.repartition(self.buckets, *keys), day, [], ids)
        eve = day - dt.timedelta(days=1)
        if again:
            gone = F.col("part") >= _month(eve)  # the open part too
            later = self.rows().filter(gone).drop("part")
            past = later.filter(F.col("ValidTo") < F.lit(eve))
            prior = later.filter((F.col("ValidTo") >= F.lit(eve)) & (F.col("ValidFrom") < F.lit(day)))
            prior = prior.dropDuplicates([*keys, "ValidFrom"]).withColumns({"ValidTo": F.lit(OPEN_END), "IsDeleted": F.lit(False)})
            stale = {p for p in self._parts() if p[0] >= _month(eve)}
        else:
            month = self.rows().filter(F.col("part") == _month(eve)).drop("part")
            late = F.raise_error(F.lit(f"snapshot {day} is not newer than the history: reload instead"))
            past = month.withColumn("ValidTo", F.when(F.col("ValidTo") < F.lit(eve), F.col("ValidTo")).otherwise(late.cast("date")))
            prior, stale = self.open_rows(), {(OPEN, False)}
        deleted = self.rows().filter(F.col("IsDeleted")).filter(F.col("ValidTo") < F.lit(eve))
        deleted = deleted.select(*keys, "FirstSnapshot", "IsDeleted")
        prior, snapshot, order = align_columns(prior, snapshot, cfg.date_col)
        self._widen(T.StructType([f for f in snapshot.schema if f.name in order]))
        if ids is not None and step is None:
            prior = anonymise_history(prior, ids.frame, keys, cfg.sensitive_cols, cfg.mask)
        merged = step(snapshot, prior, deleted) if step else merge_open_rows(prior, snapshot, day, cfg, deleted_rows=deleted, compare=compare, dedupe=dedupe)
        merged = merged.select(*self.schema.names)
        return self._store(merged.unionByName(conform(past, merged)), day, stale, ids)

    def _store(self, rows: DataFrame, day: dt.date, stale: Iterable[tuple], ids) -> dict:
        eve = F.lit(day - dt.timedelta(days=1))
        opened, closed = is_open() & (F.col("ValidFrom") == F.lit(day)), F.col("ValidTo") == eve
        counted = {
            "opened": opened, "updated": closed & ~F.col("IsDeleted"), "deleted": closed & F.col("IsDeleted"), "open": is_open(),
            "ended": ~is_open() & ~F.col("IsDeleted"), "gone": ~is_open() & F.col("IsDeleted"),
        }
        seen = Observation()
        before = self.spark.conf.get(_SORTED, "false")
        self.spark.conf.set(_SORTED, "true")  # one file per bucket: the join needs no sort
        try:
            self._write(rows.observe(seen, *(F.count_if(c).alias(n) for n, c in counted.items())))
        finally:
            self.spark.conf.set(_SORTED, before)
        n = seen.get
        month = _month(day - dt.timedelta(days=1))
        written = {k for k, c in {(OPEN, False): n["open"], (month, False): n["ended"], (month, True): n["gone"]}.items() if c}
        self._remove(set(stale) - written)  # an overwrite leaves parts without new rows as they were
        if ids is not None:
            self.erase(ids.frame)
            ids.release()
        return {"new": n["opened"] - n["updated"], "updated": n["updated"], "deleted": n["deleted"], "unchanged": n["open"] - n["opened"]}

    def exposed(self, ids: DataFrame) -> DataFrame:
        """Stored rows of the keys to be forgotten that are not masked yet.  Few
        keys are pushed down as values, which the files' Bloom filters answer."""
        keys = list(self.cfg.key_cols)
        rows = self.rows().filter(F.col("GDPR_Compliant") == NOT_FORGOTTEN)
        few = ids.limit(FEW_KEYS + 1).collect()
        if len(few) <= FEW_KEYS:
            rows = rows.filter(F.col(keys[0]).isin(sorted({r[keys[0]] for r in few})))
            if len(keys) == 1:
                return rows
        return rows.join(forget_ids(ids, keys), keys, "left_semi")

    def erase(self, ids: DataFrame, rehash: bool = False) -> list:
        """Mask every stored version of the keys, in the files: the parts that
        hold an unmasked one are rewritten, by one dynamic overwrite; returns them.

        ``rehash``: masked closed versions get the hash of their masked values,
        since an unsalted hash of personal data could be guessed and a closed
        version's hash is never compared again.
        """
        cfg = self.cfg
        parts = sorted(tuple(r) for r in self.exposed(ids).select("part", "IsDeleted").distinct().collect())
        if rehash:
            masked = self.rows().filter((F.col("GDPR_Compliant") == FORGOTTEN) & (F.col("part") != OPEN)).join(forget_ids(ids, cfg.key_cols), list(cfg.key_cols), "left_semi")
            parts = sorted({*parts, *(tuple(r) for r in masked.select("part", "IsDeleted").distinct().collect())})
        if not parts:
            return []
        some = [F.col("part").isin([p for p, d in parts if d == flag]) & (F.col("IsDeleted") == flag) for flag in sorted({d for _, d in parts})]
        hit = some[0] if len(some) == 1 else some[0] | some[1]
        rows = anonymise_history(self.rows().filter(hit).drop("part"), ids, cfg.key_cols, cfg.sensitive_cols, cfg.mask)
        if rehash:
            hidden = (F.col("GDPR_Compliant") == FORGOTTEN) & ~is_open()
            new = row_hash(list(cfg.hash_cols or data_columns(rows)), cfg.hash_mode, cfg.salt)
            rows = rows.withColumn("RowHashKey", F.when(hidden, new).otherwise(F.col("RowHashKey")))
        self._write(rows.repartition(self.buckets, *cfg.key_cols))
        return parts


class _Keys:
    """Keys of one load's forget requests, read several times: persisted, then released."""

    def __init__(self, ids: DataFrame, keys: list):
        self.frame = forget_ids(ids, keys).persist()

    def release(self) -> None:
        self.frame.unpersist()


# ------------------------------------------------------------- one call each


def write_initial(history: DataFrame, root: str, cfg: HistoryConfig, buckets: Optional[int] = None) -> None:
    """Store a history built in bulk (``build_history``)."""
    with StoredHistory(history.sparkSession, root, cfg, buckets) as stored:
        stored.create(history)


def merge_into(
    spark: SparkSession, root: str, snapshot: DataFrame, day: dt.date, cfg: HistoryConfig, compare: str = "hash", forget: bool = False,
    buckets: Optional[int] = None,
) -> dict:
    """Load ``snapshot`` (taken on ``day``) on top of the stored history, or
    begin it; returns the counts by status.  A date that is not newer than the
    history raises: ``reload_from`` loads it."""
    with StoredHistory(spark, root, cfg, buckets) as stored:
        return stored.load(snapshot, day, compare, forget)


def reload_from(
    spark: SparkSession, root: str, dates: Iterable[dt.date], read_snapshot: Callable[[dt.date], DataFrame], cfg: HistoryConfig,
    compare: str = "hash", forget: bool = False, buckets: Optional[int] = None,
) -> list:
    """Roll the stored history back to before the earliest of ``dates`` and load
    them in order; returns them.  The dates are all that the load log has from
    the earliest on: later ones that are left out are lost.  A run that ends
    early is repeated as a whole."""
    dates = sorted(set(dates))
    with StoredHistory(spark, root, cfg, buckets) as stored:
        for i, d in enumerate(dates):
            stored.load(read_snapshot(d), d, compare, forget, again=i == 0)
    return dates


def erase(spark: SparkSession, root: str, ids: DataFrame, cfg: HistoryConfig, rehash: bool = False) -> list:
    """Mask every stored version of the keys in the files (``StoredHistory.erase``)."""
    with StoredHistory(spark, root, cfg) as stored:
        ids = _Keys(ids, list(cfg.key_cols))
        try:
            return stored.erase(ids.frame, rehash)
        finally:
            ids.release()
