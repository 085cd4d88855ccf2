"""DuckDB SQL text equivalent to the registered queries (the correctness oracle).

The history here is built the textbook way, independent of the Spark plan:
run ids by a running sum over change flags, GROUP BY (key, run), then LEAD over
runs.  The Spark side marks run starts and ends in two window passes instead.
"""

from __future__ import annotations

from typing import Sequence

OPEN = "DATE '2999-12-31'"

# ---------------------------------------------------------------- snapshots

EV_SNAP = """
  SELECT user_id, snapshot_date, event_type,
         CASE WHEN event_type = 'error' THEN 'error' ELSE 'ok' END AS flag,
         CAST(value AS DECIMAL(10,2)) AS value
  FROM (SELECT *, CAST(ts AS DATE) AS snapshot_date,
               row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE)
                                  ORDER BY ts DESC, event_id DESC) AS _rn
        FROM events) t
  WHERE _rn = 1"""

EVF_SNAP = f"SELECT user_id, snapshot_date, flag FROM ({EV_SNAP}) ev"

OR_SNAP = """
  SELECT o.o_custkey, o.snapshot_date, o.o_orderstatus, o.o_orderpriority, c.c_name
  FROM (SELECT *, CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot_date,
               row_number() OVER (PARTITION BY o_custkey, date_trunc('month', o_orderdate)
                                  ORDER BY o_orderdate DESC, o_orderkey DESC) AS _rn
        FROM orders) o
  LEFT JOIN customer c ON c.c_custkey = o.o_custkey
  WHERE o._rn = 1"""

PERIOD_SNAP = """
  SELECT user_id, snapshot_date, CASE WHEN event_type = 'error' THEN 'error' ELSE 'ok' END AS flag
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id, snapshot_date ORDER BY ts DESC, event_id DESC) AS _rn
        FROM (SELECT *, CAST(date_trunc('month', ts) AS DATE) + CAST(10 * least((day(ts) - 1) // 10, 2) AS INTEGER) AS snapshot_date
              FROM events) e) t
  WHERE _rn = 1"""

TEXT_SNAP = f"""
  SELECT CASE WHEN o_orderstatus = 'F' THEN 'c' || o_custkey || '||x' ELSE 'c' || o_custkey END AS p,
         CASE WHEN o_orderstatus = 'F' THEN 'y' ELSE 'x||y' END AS q, snapshot_date, o_orderpriority
  FROM ({OR_SNAP}) o"""

EV_COLS = ("user_id", "event_type", "flag", "value")
EVF_COLS = ("user_id", "flag")
OR_COLS = ("o_custkey", "o_orderstatus", "o_orderpriority", "c_name")


def row_hash_sql(cols: Sequence[str], alias: str = "") -> str:
    p = f"{alias}." if alias else ""
    parts = ", ".join(f"coalesce(CAST({p}{c} AS VARCHAR), '')" for c in cols)
    return f"md5(concat_ws('||', {parts}))"


def business_key_sql(keys: Sequence[str], alias: str = "") -> str:
    p = f"{alias}." if alias else ""
    return "concat_ws('||', " + ", ".join(f"CAST({p}{k} AS VARCHAR)" for k in keys) + ")"


def hashed_sql(snap_sql: str, keys: Sequence[str], cols: Sequence[str], hash_cols=None) -> str:
    hc = hash_cols or cols
    return (
        f"SELECT {business_key_sql(keys)} AS BusinessKey, {row_hash_sql(hc)} AS RowHashKey, "
        f"snapshot_date, {', '.join(cols)} FROM ({snap_sql}) s"
    )


def prepared_sql(snap_sql: str, keys, cols, hash_cols=None) -> str:
    """Hashed snapshot rows with the system columns of a fresh insert."""
    return (
        f"SELECT BusinessKey, RowHashKey, snapshot_date AS SnapshotDate, snapshot_date AS FirstSnapshot, "
        f"snapshot_date AS ValidFrom, {OPEN} AS ValidTo, false AS IsDeleted, 'No' AS GDPR_Compliant, "
        f"{', '.join(cols)} FROM ({hashed_sql(snap_sql, keys, cols, hash_cols)}) p"
    )


def history_sql(snap_sql: str, keys: Sequence[str], cols: Sequence[str], mode: str, hash_cols=None,
                gdpr: str = "'No'", calendar: str = "") -> str:
    """Whole history of the snapshots in ``snap_sql`` (columns: cols + snapshot_date)."""
    k = ", ".join(keys)
    on_k = " AND ".join(f"r.{c} = g.{c}" for c in keys)
    on_f = " AND ".join(f"f.{c} = r.{c}" for c in keys)
    gap = "OR lag(_no) OVER w <> _no - 1" if mode == "full" else ""
    if mode == "full":
        valid_to = (f"CASE WHEN r._last_no = (SELECT max(_no) FROM cal) THEN {OPEN} "
                    f"ELSE CAST((SELECT _d FROM cal WHERE cal._no = r._last_no + 1) - INTERVAL 1 DAY AS DATE) END")
        deleted = ("(r._last_no < (SELECT max(_no) FROM cal) AND "
                   "(r._ns_no IS NULL OR r._ns_no <> r._last_no + 1))")
    else:
        valid_to = (f"CASE WHEN r._ns_no IS NULL THEN {OPEN} "
                    f"ELSE CAST((SELECT _d FROM cal WHERE cal._no = r._ns_no) - INTERVAL 1 DAY AS DATE) END")
        deleted = "false"
    gcols = ", ".join(f"g.{c}" for c in cols)
    return f"""
WITH hashed AS ({hashed_sql(snap_sql, keys, cols, hash_cols)}),
cal AS (SELECT snapshot_date AS _d, row_number() OVER (ORDER BY snapshot_date) AS _no
        FROM (SELECT DISTINCT snapshot_date FROM {f"({calendar}) c" if calendar else "hashed"}) d),
numbered AS (SELECT h.*, cal._no FROM hashed h JOIN cal ON h.snapshot_date = cal._d),
flagged AS (SELECT *, CASE WHEN lag(_no) OVER w IS NULL OR lag(RowHashKey) OVER w <> RowHashKey {gap}
                      THEN 1 ELSE 0 END AS _new
            FROM numbered WINDOW w AS (PARTITION BY {k} ORDER BY _no)),
grouped AS (SELECT *, sum(_new) OVER (PARTITION BY {k} ORDER BY _no ROWS UNBOUNDED PRECEDING) AS _run
            FROM flagged),
runs0 AS (SELECT {k}, _run, min(_no) AS _first_no, max(_no) AS _last_no FROM grouped GROUP BY {k}, _run),
runs AS (SELECT *, lead(_first_no) OVER (PARTITION BY {k} ORDER BY _first_no) AS _ns_no FROM runs0),
firsts AS (SELECT {k}, min(snapshot_date) AS _fs FROM hashed GROUP BY {k})
SELECT g.BusinessKey, g.RowHashKey, g.snapshot_date AS SnapshotDate, f._fs AS FirstSnapshot,
       g.snapshot_date AS ValidFrom, {valid_to} AS ValidTo, {deleted} AS IsDeleted,
       {gdpr} AS GDPR_Compliant, {gcols}
FROM runs r
JOIN grouped g ON {on_k} AND g._no = r._first_no
JOIN firsts f ON {on_f}
"""


def before_last(snap_sql: str) -> str:
    return f"SELECT * FROM ({snap_sql}) b WHERE snapshot_date < (SELECT max(snapshot_date) FROM ({snap_sql}) m)"


def on_last(snap_sql: str) -> str:
    return f"SELECT * FROM ({snap_sql}) b WHERE snapshot_date = (SELECT max(snapshot_date) FROM ({snap_sql}) m)"
