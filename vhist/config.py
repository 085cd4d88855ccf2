"""Parameters of a history: which columns are the key, which are hashed, and how."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Optional, Sequence


@dataclass(frozen=True)
class HistoryConfig:
    """What a snapshot looks like and how its history is kept.

    key_cols     business key; several columns make a composite key.
    hash_cols    columns whose change opens a new version.  ``None`` hashes every
                 non-system column of the snapshot in its own order (key included),
                 which gives the same digest as the plain ``md5`` row hash.  Name them
                 when the schema may grow, or a new all-NULL column changes every hash.
    mode         ``"full"``: a key missing from a snapshot is deleted;
                 ``"incremental"``: a missing key is unchanged.
    hash_mode    ``"compat"``: NULL hashes like ``''`` and ``||`` is not escaped;
                 ``"strict"``: NULL is marked and the delimiter escaped.
    salt         optional secret mixed into the row hash, so that a digest of
                 personal data cannot be guessed by hashing candidates.
    date_col     snapshot date column (DATE) in snapshot frames.
    sensitive_cols, signal_col, signal_pattern, mask
                 forget-request handling: rows whose ``signal_col`` matches
                 ``signal_pattern`` (a regular expression) are to be forgotten and
                 their sensitive columns replaced by ``mask`` (strings) or NULL.
    null_keys    ``"raise"``: a snapshot row with a NULL key part fails the load;
                 ``"drop"``: such rows are left out, ``checks.null_key_rows`` hands
                 them over.
    """

    key_cols: Sequence[str]
    hash_cols: Optional[Sequence[str]] = None
    mode: str = "full"
    hash_mode: str = "compat"
    salt: Optional[str] = None
    date_col: str = "snapshot_date"
    sensitive_cols: Sequence[str] = field(default_factory=tuple)
    signal_col: Optional[str] = None
    signal_pattern: Optional[str] = None
    mask: str = "ANONYMISED"
    null_keys: str = "raise"

    def __post_init__(self):
        if isinstance(self.key_cols, str):
            object.__setattr__(self, "key_cols", (self.key_cols,))
        object.__setattr__(self, "key_cols", tuple(self.key_cols))
        if self.hash_cols is not None:
            object.__setattr__(self, "hash_cols", tuple(self.hash_cols))
        object.__setattr__(self, "sensitive_cols", tuple(self.sensitive_cols))
        if self.mode not in ("full", "incremental"):
            raise ValueError(f"mode must be 'full' or 'incremental', not {self.mode!r}")
        if self.hash_mode not in ("compat", "strict"):
            raise ValueError(f"hash_mode must be 'compat' or 'strict', not {self.hash_mode!r}")

        if self.null_keys not in ("raise", "drop"):
            raise ValueError(f"null_keys must be 'raise' or 'drop', not {self.null_keys!r}")

    @property
    def incremental(self) -> bool:
        return self.mode == "incremental"

    @classmethod
    def from_helper_data(
        cls,
        helper: dict,
        sensitive_cols: Sequence[str] = (),
        mode: str = "full",
        **kw,
    ) -> "HistoryConfig":
        """Settings given as a helper-data mapping.

        Keys read: ``BusinessKey`` (a column name, or a list of names written as
        a Python list literal in text), ``anonymisationPattern``,
        ``anonymisationSignalColumn``.  Every business-key column is used.
        """
        import ast

        raw = helper["BusinessKey"]
        keys = raw
        if isinstance(raw, str):
            try:
                parsed = ast.literal_eval(raw)
                keys = list(parsed) if isinstance(parsed, (list, tuple)) else raw
            except (ValueError, SyntaxError):
                keys = raw
        return cls(
            key_cols=keys,
            mode=mode,
            sensitive_cols=sensitive_cols,
            signal_col=helper.get("anonymisationSignalColumn"),
            signal_pattern=helper.get("anonymisationPattern"),
            **kw,
        )
