"""Views over snapshots and history: H3 half-open form, W1 change flags,
U1 union of snapshots, U4 version de-duplication."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vhist.functions.columns import FORGOTTEN, SYSTEM_COLUMNS, open_end
from vhist.functions.hashing import prehash_text
from vhist.functions.predicates import is_open


def half_open(history: DataFrame) -> DataFrame:
    """H3: data columns with ``eff_start_date``, ``eff_end_date`` (the day after
    ValidTo, NULL while open) and ``is_current``."""
    data = [c for c in history.columns if c not in SYSTEM_COLUMNS]
    open_ = is_open()
    return history.select(
        *data,
        F.col("ValidFrom").alias("eff_start_date"),
        F.when(open_, F.lit(None).cast("date")).otherwise(F.date_add("ValidTo", 1)).alias("eff_end_date"),
        open_.alias("is_current"),
    )


def lag_change_flags(
    snapshots: DataFrame, key_cols: Sequence[str], tracked: Sequence[str], date_col: str = "snapshot_date"
) -> DataFrame:
    """Per key and snapshot, the previous values of ``tracked`` and a change flag.

    ``is_changed`` is true for a key's first row or when a tracked value differs
    from the previous row with plain ``!=`` (so a change to or from NULL is not
    a change, except in the first tracked column, whose NULL previous value
    marks the first row).  ``end_date`` is the snapshot date of unchanged rows.
    Rows per key are bounded by the number of snapshots.
    """
    w = Window.partitionBy(*key_cols).orderBy(date_col)
    prev = {f"prev_{c}": F.lag(c).over(w) for c in tracked}
    out = snapshots.withColumns(prev)
    diff = reduce(lambda a, b: a | b, [F.col(c) != F.col(f"prev_{c}") for c in tracked])
    changed = F.when(diff | F.col(f"prev_{tracked[0]}").isNull(), F.lit(True)).otherwise(F.lit(False))
    out = out.withColumn("is_changed", changed).withColumn("start_date", F.col(date_col))
    return out.withColumn("end_date", F.when(~F.col("is_changed"), F.col(date_col)))


def union_snapshots(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; a column missing from a frame is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def dedup_versions(history: DataFrame, key_cols: Sequence[str], start: str = "ValidFrom") -> DataFrame:
    """U4: one version per key and start, by one aggregate (combined map-side).

    Of several rows a masked one wins over a raw one, then the latest ValidTo,
    then the smallest row in strict text (hash first), so the choice never
    depends on the order of the input.
    """
    group = [*key_cols, start]
    rest = [c for c in history.columns if c not in group]
    order = F.struct(
        F.when(F.col("GDPR_Compliant") == FORGOTTEN, 0).otherwise(1),
        F.datediff(open_end(), "ValidTo"),
        "RowHashKey",
        prehash_text(history.columns, mode="strict"),
    )
    kept = history.groupBy(*group).agg(F.min_by(F.struct(*rest), order).alias("_r"))
    return kept.select(*[F.col(c) if c in group else F.col(f"_r.{c}").alias(c) for c in history.columns])
