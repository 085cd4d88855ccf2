"""Check frames: input rows the history cannot take as they are.

* ``null_key_rows`` - a NULL key part cannot identify a version; such rows fail
  a load, or are left out and listed here (``HistoryConfig.null_keys``).
* ``duplicate_keys`` - keys with several rows in one snapshot; exact copies
  collapse and of different rows the smallest hash is kept, this lists them.

Both are single aggregates or filters, so they can run beside a load at any size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vhist.config import HistoryConfig
from vhist.functions.hashing import with_hash_key


def keys_present(key_cols) -> Column:
    """True when no key part is NULL."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key_cols])


def with_keys(rows: DataFrame, cfg: HistoryConfig) -> DataFrame:
    """Rows whose key is whole; others raise, or are dropped, as ``cfg`` says."""
    present = keys_present(cfg.key_cols)
    if cfg.null_keys == "drop":
        return rows.filter(present)
    error = F.raise_error(F.lit(f"NULL in key columns {', '.join(cfg.key_cols)}: see checks.null_key_rows"))
    return rows.filter(F.when(present, F.lit(True)).otherwise(error.cast("boolean")))


def null_key_rows(snapshots: DataFrame, cfg: HistoryConfig) -> DataFrame:
    """Snapshot rows with a NULL key part."""
    return snapshots.filter(~keys_present(cfg.key_cols))


def duplicate_keys(snapshots: DataFrame, cfg: HistoryConfig) -> DataFrame:
    """(key, date, n_rows, n_versions) for keys with more than one row in a snapshot.

    ``n_versions`` counts distinct row hashes: 1 means exact copies only.
    """
    rows = with_hash_key(snapshots, cfg.key_cols, cfg.hash_cols, cfg.hash_mode, cfg.salt, cfg.date_col)
    return (
        rows.filter(keys_present(cfg.key_cols))
        .groupBy(*cfg.key_cols, cfg.date_col)
        .agg(
            F.count(F.lit(1)).cast("bigint").alias("n_rows"),
            F.countDistinct("RowHashKey").cast("bigint").alias("n_versions"),
        )
        .filter(F.col("n_rows") > 1)
    )
