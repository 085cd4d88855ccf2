"""Predicates over history rows and change tests."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from vhist.functions.columns import open_end


def is_open(valid_to: str = "ValidTo") -> Column:
    return F.col(valid_to) == open_end()


def is_closed(valid_to: str = "ValidTo") -> Column:
    return F.col(valid_to) != open_end()


def is_deleted() -> Column:
    return F.col("IsDeleted")


def changed_by_columns(cols: Sequence[str], left: str = "h", right: str = "s") -> Column:
    """True when any of ``cols`` differs between the two sides, NULL-safely.

    NULL against a value is a change, NULL against NULL is not.
    """
    diffs = [~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in cols]
    if not diffs:
        return F.lit(False)
    return reduce(lambda a, b: a | b, diffs)


def transitions(in_history: Column, in_snapshot: Column, same: Column, incremental: bool) -> tuple[Column, Column, Column]:
    """What a snapshot does to a key's open version: (keep, close, open).

    The one rule of merges and of classification.  ``same`` (equal content)
    only counts where both sides are present; a key that an incremental
    snapshot lacks is kept.
    """
    both_same = in_history & in_snapshot & same
    keep = both_same | (in_history & ~in_snapshot) if incremental else both_same
    return keep, in_history & ~keep, in_snapshot & ~both_same


def key_status(in_history: Column, in_snapshot: Column, same: Column, incremental: bool) -> Column:
    """The transition by name: nothing opened nor closed is ``unchanged``, only
    opened ``new``, only closed ``deleted``, both ``updated``."""
    _, close, opens = transitions(in_history, in_snapshot, same, incremental)
    name = F.when(close & opens, "updated").when(close, "deleted").when(opens, "new")
    return name.otherwise("unchanged")
