"""Column expressions: system columns, row hash, business key, predicates."""

from vhist.functions.columns import (
    OPEN_END,
    SYSTEM_COLUMNS,
    data_columns,
    history_columns,
    open_end,
    with_system_columns,
)
from vhist.functions.hashing import business_key, row_hash, with_hash_key
from vhist.functions.predicates import (
    changed_by_columns,
    key_status,
    is_closed,
    is_deleted,
    is_open,
)

__all__ = [
    "OPEN_END",
    "SYSTEM_COLUMNS",
    "data_columns",
    "history_columns",
    "open_end",
    "with_system_columns",
    "business_key",
    "row_hash",
    "with_hash_key",
    "changed_by_columns",
    "key_status",
    "is_closed",
    "is_deleted",
    "is_open",
]
