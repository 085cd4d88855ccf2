"""Writing history and key files."""

from __future__ import annotations

from typing import Optional

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vhist.functions.columns import history_columns, data_columns
from vhist.functions.predicates import is_open

# Rows per output file; keeps files near a few hundred MB at typical widths
# without collapsing the write into one task.
MAX_RECORDS_PER_FILE = 5_000_000


def write_history(
    history: DataFrame,
    root: str,
    version: str,
    max_records_per_file: int = MAX_RECORDS_PER_FILE,
) -> str:
    """Write ``history`` as a new version directory ``root/version=<version>``.

    A history is never written over the path it was read from: each write goes
    to a new version, so a failed write leaves the previous version intact and
    a job may read version n while writing n+1.  Rows are split by
    ``is_open`` so the next merge reads only the open part.  Returns the path.
    """
    path = f"{root.rstrip('/')}/version={version}"
    cols = history_columns(data_columns(history))
    (
        history.select(*cols)
        .withColumn("is_open", is_open())
        .write.mode("overwrite")
        .option("compression", "snappy")
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy("is_open")
        .parquet(path)
    )
    return path


def key_file(snapshot: DataFrame, snapshot_date=None, date_col: str = "snapshot_date") -> DataFrame:
    """(RowHashKey, SnapshotDate): distinct row hashes of a hashed snapshot.

    ``snapshot_date`` gives the date of a single snapshot; without it the
    frame's own ``date_col`` is used, so many snapshots are keyed in one pass.
    """
    if snapshot_date is None:
        d: Column = F.col(date_col)
    elif isinstance(snapshot_date, Column):
        d = snapshot_date
    else:
        d = F.lit(snapshot_date).cast("date")
    return snapshot.select("RowHashKey", d.alias("SnapshotDate")).distinct()


def write_key_file(keys: DataFrame, *paths: str) -> None:
    """Write the key file once per destination (bronze and silver)."""
    for p in paths:
        keys.write.mode("overwrite").parquet(p)


def write_snapshots_bucketed(
    snapshots: DataFrame,
    table: str,
    key_cols,
    buckets: int,
    path: Optional[str] = None,
    mode: str = "append",
) -> None:
    """Store snapshots as a table bucketed (and sorted) by the key columns.

    A history built from ``spark.table(table)`` then needs no shuffle: the
    bucketed scan already clusters rows by key, which is what the window pass
    of ``build_history`` (and the (key, date) de-duplication) require.  Pick
    ``buckets`` so that one bucket across all dates is about 1 GB.  Appending a
    new date writes one file per bucket and does not touch earlier dates.
    """
    w = snapshots.write.mode(mode).bucketBy(buckets, *key_cols).sortBy(*key_cols)
    if path is not None:
        w = w.option("path", path)
    w.saveAsTable(table)
