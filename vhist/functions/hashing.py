"""Row hash and business key expressions."""

from __future__ import annotations

from typing import Optional, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the row-hash convention: parts are joined with "||" and hashed
# with md5; in strict mode NULL is written as \N and "\" and "|" are escaped.
DELIMITER = "||"
STRICT_NULL = "\\N"


def _part(c: str, mode: str) -> Column:
    s = F.col(c).cast("string")
    if mode == "compat":
        # NULL and '' hash alike; cast first so that a NULL number is '' too.
        return F.coalesce(s, F.lit(""))
    escaped = F.replace(F.replace(s, F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|"))
    return F.coalesce(escaped, F.lit(STRICT_NULL))


def prehash_text(cols: Sequence[str], mode: str = "compat", salt: Optional[str] = None) -> Column:
    """The text the row hash is taken over: the columns joined with ``||``."""
    parts = [_part(c, mode) for c in cols]
    if salt is not None:
        parts = [F.lit(salt)] + parts
    return F.concat_ws(DELIMITER, *parts)


def row_hash(cols: Sequence[str], mode: str = "compat", salt: Optional[str] = None) -> Column:
    """md5 over the columns as text, joined with ``||``."""
    return F.md5(prehash_text(cols, mode, salt))


def business_key(cols: Sequence[str], mode: str = "compat") -> Column:
    """Key columns as one string joined with ``||`` (one column: that column as
    text).  In strict mode the delimiter is escaped, so different composite
    keys never give the same text; joins use the key columns in either mode."""
    if mode == "strict" and len(cols) > 1:
        return F.concat_ws(DELIMITER, *[_part(c, mode) for c in cols])
    return F.concat_ws(DELIMITER, *[F.col(c).cast("string") for c in cols])


def with_hash_key(
    df: DataFrame,
    key_cols: Sequence[str],
    hash_cols: Optional[Sequence[str]] = None,
    mode: str = "compat",
    salt: Optional[str] = None,
    date_col: str = "snapshot_date",
) -> DataFrame:
    """Add ``RowHashKey`` and ``BusinessKey``.

    The hash covers ``hash_cols``, by default every non-system column other than
    the snapshot date (so system columns are never hashed).
    """
    from vhist.functions.columns import data_columns

    cols = list(hash_cols) if hash_cols is not None else data_columns(df, date_col)
    return df.withColumns({"RowHashKey": row_hash(cols, mode, salt), "BusinessKey": business_key(key_cols, mode)})
