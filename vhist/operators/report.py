"""Report over a history (K1): totals, multi-version keys, samples (A4, A5, O1-O3)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vhist.functions.predicates import is_open


def history_totals(history: DataFrame) -> DataFrame:
    """A4: all, active, deleted and historical versions in one pass."""
    open_ = is_open()
    return history.agg(
        F.count(F.lit(1)).cast("bigint").alias("total_versions"),
        F.count_if(open_).cast("bigint").alias("active_versions"),
        F.count_if(F.col("IsDeleted")).cast("bigint").alias("deleted_versions"),
        F.count_if(~open_).cast("bigint").alias("historical_versions"),
    )


def multi_version_keys(history: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """A5: keys (key columns, BusinessKey) with more than one version, and how many."""
    counts = history.groupBy(*key_cols, "BusinessKey").agg(F.count(F.lit(1)).cast("bigint").alias("version_count"))
    return counts.filter(F.col("version_count") > 1)


def active_top(history: DataFrame, cols: Sequence[str], n: int = 10) -> DataFrame:
    """O1: the first ``n`` open versions by key (a top-k, one sort per task)."""
    return (
        history.filter(is_open())
        .select("BusinessKey", *cols, "ValidFrom", "ValidTo")
        .orderBy("BusinessKey")
        .limit(n)
    )


def most_changed(history: DataFrame, key_cols: Sequence[str], n: int = 10) -> DataFrame:
    """O2: keys with most versions, ties by business key, then by key columns."""
    keys = multi_version_keys(history, key_cols)
    return keys.orderBy(F.desc("version_count"), "BusinessKey", *key_cols).limit(n)


def versions_of_top_key(history: DataFrame, key_cols: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """O3: every version of the most-changed key, by ValidFrom.

    The key is picked by a semi join with a one-row top-1, not by reading it
    to the driver.
    """
    top = most_changed(history, key_cols, 1).select(*key_cols)
    return (
        history.join(top, list(key_cols), "left_semi")
        .select("BusinessKey", *cols, "ValidFrom", "ValidTo", "IsDeleted")
        .orderBy("ValidFrom")
    )
