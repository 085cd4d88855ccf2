"""Forget requests (right to be forgotten): G1 detect, G2 find, G3 anonymise.

The row hash is computed before anonymising, so a forgotten but otherwise
unchanged row opens no new version.  Key sets are joined on the key columns
without a hint: they grow with the data, and Spark measures them at run time.
Where a key column is sensitive, the business key made from it is masked too.
"""

from __future__ import annotations

from typing import Iterable, List, Sequence, Tuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vhist.functions.columns import FORGOTTEN, NOT_FORGOTTEN
from vhist.functions.hashing import DELIMITER


def split_sensitive(columns: Iterable[str], sensitive: Iterable[str]) -> Tuple[List[str], List[str]]:
    """(sensitive columns present, other columns), in frame order."""
    s = set(sensitive)
    cols = list(columns)
    return [c for c in cols if c in s], [c for c in cols if c not in s]


def _mask(df: DataFrame, c: str, mask: str) -> Column:
    """Replacement for a sensitive value: ``mask`` for text, NULL otherwise."""
    t = dict(df.dtypes)[c]
    return F.lit(mask) if t == "string" else F.lit(None).cast(t)


def _masked(df: DataFrame, hit: Column, key_cols: Sequence[str], sensitive_cols: Sequence[str], mask: str, otherwise: Column) -> DataFrame:
    """``df`` with sensitive columns (and a business key made from one) masked
    and marked where ``hit`` holds; ``otherwise`` is the mark of the other rows."""
    sens, _ = split_sensitive(df.columns, sensitive_cols)
    cols = {c: F.when(hit, _mask(df, c, mask)).otherwise(F.col(c)) for c in sens}
    cols["GDPR_Compliant"] = F.when(hit, F.lit(FORGOTTEN)).otherwise(otherwise)
    if "BusinessKey" in df.columns and set(key_cols) & set(sens):
        parts = [(_mask(df, k, mask) if k in sens else F.col(k)).cast("string") for k in key_cols]
        cols["BusinessKey"] = F.when(hit, F.concat_ws(DELIMITER, *parts)).otherwise(F.col("BusinessKey"))
    return df.withColumns(cols)


def detect_and_anonymise(
    df: DataFrame,
    key_cols: Sequence[str],
    pattern: str,
    signal_col: str,
    sensitive_cols: Sequence[str],
    mask: str = "ANONYMISED",
) -> Tuple[DataFrame, DataFrame]:
    """G1: rows whose ``signal_col`` matches ``pattern`` are to be forgotten.

    Returns the frame with their sensitive columns masked and
    ``GDPR_Compliant`` = 'Yes' ('No' for the others), and the distinct keys of
    the flagged rows.  The signal is read before masking, so it may itself be
    a sensitive column.
    """
    flagged = F.coalesce(F.col(signal_col).rlike(pattern), F.lit(False))
    ids = df.filter(flagged).select(*key_cols).distinct()
    return _masked(df, flagged, key_cols, sensitive_cols, mask, F.lit(NOT_FORGOTTEN)), ids


def forget_ids(ids: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """Distinct forget-request keys."""
    return ids.select(*key_cols).distinct()


def exposed_rows(history: DataFrame, ids: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """History rows of keys to be forgotten that are not anonymised yet."""
    keys = list(key_cols)
    return history.join(forget_ids(ids, keys), keys, "left_semi").filter(
        F.col("GDPR_Compliant") == NOT_FORGOTTEN
    )


def anonymise_history(
    history: DataFrame,
    ids: DataFrame,
    key_cols: Sequence[str],
    sensitive_cols: Sequence[str],
    mask: str = "ANONYMISED",
) -> DataFrame:
    """Mask the sensitive columns of every version of the given keys.

    One left join with the key set and a ``when`` per column; idempotent, and
    no branch on whether anything matched.
    """
    keys = list(key_cols)
    marks = forget_ids(ids, keys).withColumn("_forget", F.lit(True))
    hit = F.coalesce(F.col("_forget"), F.lit(False))
    joined = history.join(marks, keys, "left")
    return _masked(joined, hit, keys, sensitive_cols, mask, F.col("GDPR_Compliant")).select(*history.columns)


def signal_flag(cfg) -> Column:
    """True on a snapshot row whose signal column matches the forget pattern."""
    return F.coalesce(F.col(cfg.signal_col).rlike(cfg.signal_pattern), F.lit(False))


def mask_where(history: DataFrame, hit: Column, cfg) -> DataFrame:
    """Mask the sensitive columns of the rows where ``hit`` holds and mark them
    forgotten; other rows are unchanged."""
    return _masked(history, hit, cfg.key_cols, cfg.sensitive_cols, cfg.mask, F.col("GDPR_Compliant"))


def masked_up_to(upto: str = "_forget_upto") -> Column:
    """A version is masked when it started on or before the key's last signal."""
    return F.coalesce(F.col("ValidFrom") <= F.col(upto), F.lit(False))


def mask_versions_up_to(history: DataFrame, upto: DataFrame, cfg) -> DataFrame:
    """Mask the versions of each key in ``upto`` (key columns + ``_forget_upto``)
    that started on or before its ``_forget_upto`` date.  Idempotent."""
    keys = list(cfg.key_cols)
    j = history.join(upto.select(*keys, "_forget_upto"), keys, "left")
    return mask_where(j, masked_up_to(), cfg).select(*history.columns)


def last_signals(snapshots: DataFrame, cfg) -> DataFrame:
    """The date of each key's last signalled snapshot (``_forget_upto``)."""
    return snapshots.filter(signal_flag(cfg)).groupBy(*cfg.key_cols).agg(F.max(cfg.date_col).alias("_forget_upto"))


def anonymise_from_signals(history: DataFrame, snapshots: DataFrame, cfg) -> DataFrame:
    """Mask what processing the snapshots one by one would have masked.

    When a snapshot signals a key, every version of that key present then is
    masked, and so is the signalled row; versions opened later from rows
    without a signal are not.  So a version ends up masked exactly when it
    started on or before the key's last signalled snapshot.  One aggregate
    (combined map-side) and one join on the key; the history coming out of
    ``build_history`` is already partitioned by the key.
    """
    return mask_versions_up_to(history, last_signals(snapshots, cfg), cfg)
