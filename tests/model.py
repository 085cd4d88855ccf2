"""A brute-force model of snapshot history, in plain Python, for tests.

Snapshots are processed one date at a time, the way a daily job would, with
the rules in README "History semantics".  Rows are (k, a, b); the key is k.
"""

from __future__ import annotations

import datetime as dt
import hashlib

OPEN_END = dt.date(2999, 12, 31)


def row_hash(k, a, b) -> str:
    """md5 over the compat text: parts joined with '||', NULL as ''."""
    parts = [str(k), "" if a is None else a, "" if b is None else str(b)]
    return hashlib.md5("||".join(parts).encode()).hexdigest()


def strict_text(k, a, b) -> str:
    """The strict row text: NULL as \\N, backslash and '|' escaped, '||' between."""

    def part(v):
        if v is None:
            return "\\N"
        return str(v).replace("\\", "\\\\").replace("|", "\\|")

    return "||".join(part(v) for v in (k, a, b))


def model_history(rows, mode: str = "full"):
    """rows: iterable of (k, a, b, date).  Returns sorted tuples
    (k, a, b, ValidFrom, ValidTo, IsDeleted, FirstSnapshot)."""
    by_date: dict = {}
    for k, a, b, d in rows:
        # one row per key and date: the smallest (row hash, strict text) wins
        cur = by_date.setdefault(d, {})
        h = row_hash(k, a, b)
        order = (h, strict_text(k, a, b))
        if k not in cur or order < cur[k][3]:
            cur[k] = (h, a, b, order)
    open_: dict = {}
    first: dict = {}
    out = []
    for d in sorted(by_date):
        snap = by_date[d]
        end = d - dt.timedelta(days=1)
        for k in list(open_):
            h, a, b, vf = open_[k]
            if k not in snap:
                if mode == "full":
                    out.append((k, a, b, vf, end, True, first[k]))
                    del open_[k]
            elif snap[k][0] != h:
                out.append((k, a, b, vf, end, False, first[k]))
                del open_[k]
        for k, (h, a, b, _) in snap.items():
            first.setdefault(k, d)
            if k not in open_:
                open_[k] = (h, a, b, d)
    for k, (h, a, b, vf) in open_.items():
        out.append((k, a, b, vf, OPEN_END, False, first[k]))
    return sorted(out, key=lambda t: tuple((v is not None, v) for v in t))


def model_history_forgetting(rows, mode: str = "full", signal: str = "x"):
    """The same, processing forget requests at each date: a key with a row
    whose ``a`` equals ``signal`` has ``b`` masked in every version it has then,
    and in the version opened from that date's row.  The row hash is taken
    before masking.  Returns tuples with GDPR_Compliant appended."""
    by_date: dict = {}
    flagged: dict = {}
    for k, a, b, d in rows:
        cur = by_date.setdefault(d, {})
        h = row_hash(k, a, b)
        order = (h, strict_text(k, a, b))
        if k not in cur or order < cur[k][3]:
            cur[k] = (h, a, b, order)
        if a == signal:
            flagged.setdefault(d, set()).add(k)
    versions = []  # [k, a, b, vf, vt, deleted, gdpr, h]
    open_: dict = {}
    first: dict = {}
    for d in sorted(by_date):
        snap = by_date[d]
        forget = flagged.get(d, set())
        for v in versions:
            if v[0] in forget:
                v[2], v[6] = None, "Yes"
        end = d - dt.timedelta(days=1)
        for k in list(open_):
            v = open_[k]
            if k not in snap:
                if mode == "full":
                    v[4], v[5] = end, True
                    del open_[k]
            elif snap[k][0] != v[7]:
                v[4] = end
                del open_[k]
        for k, (h, a, b, _) in snap.items():
            first.setdefault(k, d)
            if k not in open_:
                masked = k in forget
                v = [k, a, None if masked else b, d, OPEN_END, False, "Yes" if masked else "No", h]
                versions.append(v)
                open_[k] = v
    out = [(v[0], v[1], v[2], v[3], v[4], v[5], first[v[0]], v[6]) for v in versions]
    return sorted(out, key=lambda t: tuple((x is not None, x) for x in t))
