"""Oracle SQL per registered query name (see ``vhist.plans.oracle``)."""

from vhist.plans import oracle as o

OPEN = o.OPEN
K_EV, K_OR = ["user_id"], ["o_custkey"]

H_EV = o.history_sql(o.EV_SNAP, K_EV, o.EV_COLS, "full")
H_EVF = o.history_sql(o.EVF_SNAP, K_EV, o.EVF_COLS, "full")
H_OR = o.history_sql(o.OR_SNAP, K_OR, o.OR_COLS, "incremental")
HP_EV = o.history_sql(o.before_last(o.EV_SNAP), K_EV, o.EV_COLS, "full")
HP_OR = o.history_sql(o.before_last(o.OR_SNAP), K_OR, o.OR_COLS, "incremental")
HP_EVF = o.history_sql(o.before_last(o.EVF_SNAP), K_EV, o.EVF_COLS, "full")
PL_EVF = o.prepared_sql(o.on_last(o.EVF_SNAP), K_EV, o.EVF_COLS)
PL_EV = o.prepared_sql(o.on_last(o.EV_SNAP), K_EV, o.EV_COLS)
PL_OR = o.prepared_sql(o.on_last(o.OR_SNAP), K_OR, o.OR_COLS)
LAST_EV = f"(SELECT max(snapshot_date) FROM ({o.EV_SNAP}) m)"
SYS = "BusinessKey, RowHashKey, SnapshotDate, FirstSnapshot, ValidFrom, ValidTo, IsDeleted, GDPR_Compliant"
EVC = ", ".join(o.EV_COLS)
HIST_EV_COLS = f"{SYS}, {EVC}"


def _classify(hp: str, pl: str, absent: str) -> str:
    return f"""
SELECT coalesce(h.BusinessKey, c.BusinessKey) AS BusinessKey,
       h.RowHashKey AS hist_RowHashKey, c.RowHashKey AS curr_RowHashKey,
       CASE WHEN h.RowHashKey IS NULL THEN 'new'
            WHEN c.RowHashKey IS NULL THEN '{absent}'
            WHEN c.RowHashKey = h.RowHashKey THEN 'unchanged'
            ELSE 'updated' END AS HistoryStatus
FROM (SELECT * FROM ({hp}) x WHERE ValidTo = {OPEN}) h
FULL OUTER JOIN ({pl}) c ON h.BusinessKey = c.BusinessKey"""


CLASSIFY_EV = _classify(HP_EV, PL_EV, "deleted")
OPEN_PREV = f"(SELECT * FROM ({HP_EV}) x WHERE ValidTo = {OPEN})"
DIFF = " OR ".join(f"h.{c} IS DISTINCT FROM s.{c}" for c in ("event_type", "flag", "value"))

def _strict(c: str) -> str:
    return f"coalesce(replace(replace(CAST({c} AS VARCHAR), '\\', '\\\\'), '|', '\\|'), '\\N')"


DEDUP_EV = f"""
SELECT user_id, snapshot_date, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, snapshot_date
                               ORDER BY {o.row_hash_sql(['user_id', 'event_type', 'value'])},
                                        concat_ws('||', {', '.join(_strict(c) for c in ('user_id', 'event_type', 'value'))})) AS _rn
  FROM (SELECT user_id, CAST(ts AS DATE) AS snapshot_date, event_type,
               CAST(value AS DECIMAL(10,2)) AS value FROM events) e) t
WHERE _rn = 1"""


HASHED_OR = o.hashed_sql(o.OR_SNAP, K_OR, o.OR_COLS)
FLAG = "coalesce(regexp_matches(c_name, '7$'), false)"
IDS = f"(SELECT DISTINCT o_custkey FROM ({o.OR_SNAP}) s WHERE {FLAG})"
LAST_IDS = f"(SELECT DISTINCT o_custkey FROM ({o.on_last(o.OR_SNAP)}) s WHERE {FLAG})"
ORC = ", ".join(o.OR_COLS)


def _masked_history(ids: str) -> str:
    return f"""
SELECT BusinessKey, RowHashKey, SnapshotDate, FirstSnapshot, ValidFrom, ValidTo, IsDeleted,
       CASE WHEN o_custkey IN {ids} THEN 'Yes' ELSE GDPR_Compliant END AS GDPR_Compliant,
       o_custkey, o_orderstatus, o_orderpriority,
       CASE WHEN o_custkey IN {ids} THEN 'ANONYMISED' ELSE c_name END AS c_name
FROM ({H_OR}) h"""


LOG = """
SELECT concat_ws('_', DataGroupName, strftime(SnapshotDate, '%Y%m%d')) AS PK_DataGroupLoadLogID,
       DataGroupName, SnapshotDate, 'Bronze' AS Layer
FROM (SELECT DISTINCT event_type AS DataGroupName, CAST(ts AS DATE) AS SnapshotDate FROM events) d"""
RANGES = f"""
SELECT DataGroupName, count(DISTINCT PK_DataGroupLoadLogID) AS n_loads,
       min(SnapshotDate) AS first_snapshot, max(SnapshotDate) AS last_snapshot
FROM ({LOG}) l GROUP BY DataGroupName"""
REQUESTS = """
SELECT DataGroupName, SnapshotDate FROM (
  SELECT event_type AS DataGroupName, CAST(ts AS DATE) AS SnapshotDate,
         row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id ASC) AS _rn
  FROM events) r WHERE _rn = 1"""
RESTORE_DAY = f"(SELECT min(snapshot_date) + 15 FROM ({o.EV_SNAP}) m)"
RESTORE_MONTH = f"(SELECT CAST(min(snapshot_date) + INTERVAL 40 MONTH AS DATE) FROM ({o.OR_SNAP}) m)"

ORACLES = {}
ORACLES_BASE = {
    "history_full": H_EVF,
    "history_full_wide": H_EV,
    "history_incremental": H_OR,
    "history_dedupe": o.history_sql(DEDUP_EV, K_EV, ("user_id", "event_type", "value"), "full"),
    "history_chained": H_EVF,
    "check_duplicates": f"""
SELECT user_id, snapshot_date, count(*) AS n_rows,
       count(DISTINCT {o.row_hash_sql(['user_id', 'event_type', 'value'])}) AS n_versions
FROM (SELECT user_id, CAST(ts AS DATE) AS snapshot_date, event_type, CAST(value AS DECIMAL(10,2)) AS value
      FROM events) e
GROUP BY user_id, snapshot_date HAVING count(*) > 1""",
    "history_store": H_EV,
    "merge_step": H_EV,
    "merge_step_incremental": H_OR,
    "merge_by_columns": H_EV,
    "classify_full": CLASSIFY_EV,
    "classify_incremental": _classify(HP_OR, PL_OR, "unchanged"),
    "classify_sql": CLASSIFY_EV,
    "change_summary": f"SELECT HistoryStatus, count(*) AS n_keys FROM ({CLASSIFY_EV}) c GROUP BY HistoryStatus",
    "deleted_rows": f"""
SELECT BusinessKey, RowHashKey, SnapshotDate, FirstSnapshot, ValidFrom,
       CAST({LAST_EV} - INTERVAL 1 DAY AS DATE) AS ValidTo, true AS IsDeleted, GDPR_Compliant, {EVC}
FROM {OPEN_PREV} h WHERE NOT EXISTS (SELECT 1 FROM ({PL_EV}) c WHERE c.BusinessKey = h.BusinessKey)""",
    "expired_rows": f"""
SELECT BusinessKey, RowHashKey, SnapshotDate, FirstSnapshot, ValidFrom,
       CAST({LAST_EV} - INTERVAL 1 DAY AS DATE) AS ValidTo, IsDeleted, GDPR_Compliant, {EVC}
FROM {OPEN_PREV} h
WHERE EXISTS (SELECT 1 FROM ({PL_EV}) c WHERE c.BusinessKey = h.BusinessKey AND c.RowHashKey <> h.RowHashKey)""",
    "inserted_rows": f"""
SELECT c.BusinessKey, c.RowHashKey, c.SnapshotDate,
       coalesce((SELECT min(FirstSnapshot) FROM ({HP_EV}) a WHERE a.BusinessKey = c.BusinessKey), c.SnapshotDate)
         AS FirstSnapshot,
       c.ValidFrom, c.ValidTo, c.IsDeleted, c.GDPR_Compliant, c.user_id, c.event_type, c.flag, c.value
FROM ({PL_EV}) c
WHERE NOT EXISTS (SELECT 1 FROM {OPEN_PREV} h WHERE h.BusinessKey = c.BusinessKey AND h.RowHashKey = c.RowHashKey)""",
    "new_and_updated": f"SELECT BusinessKey FROM ({CLASSIFY_EV}) c WHERE HistoryStatus IN ('new', 'updated')",
    "insert_only": f"SELECT * FROM ({PL_EV}) c WHERE user_id NOT IN (SELECT user_id FROM {OPEN_PREV} h)",
    "disappeared": f"""
SELECT BusinessKey, RowHashKey, SnapshotDate, FirstSnapshot, ValidFrom,
       CAST({LAST_EV} - INTERVAL 1 DAY AS DATE) AS ValidTo, true AS IsDeleted, GDPR_Compliant, {EVC}
FROM {OPEN_PREV} h WHERE user_id NOT IN (SELECT user_id FROM ({o.on_last(o.EV_SNAP)}) c)""",
    "carried_rows": f"""
SELECT * FROM ({HP_EV}) x WHERE ValidTo <> {OPEN}
UNION ALL
SELECT h.* FROM {OPEN_PREV} h
WHERE EXISTS (SELECT 1 FROM ({PL_EV}) c WHERE c.BusinessKey = h.BusinessKey AND c.RowHashKey = h.RowHashKey)""",
    "changed_by_columns": f"""
SELECT h.BusinessKey, h.ValidFrom, h.event_type AS old_event_type, s.event_type AS new_event_type,
       h.flag AS old_flag, s.flag AS new_flag, h.value AS old_value, s.value AS new_value
FROM {OPEN_PREV} h JOIN ({PL_EV}) s ON h.user_id = s.user_id WHERE {DIFF}""",
    "unchanged_except_all": f"""
SELECT h.* FROM (SELECT * FROM ({HP_EVF}) x WHERE ValidTo = {OPEN}) h
JOIN ({PL_EVF}) s ON h.user_id = s.user_id WHERE NOT (h.flag IS DISTINCT FROM s.flag)""",
    "first_snapshot": f"SELECT BusinessKey, min(FirstSnapshot) AS FirstSnapshot FROM ({H_EV}) h GROUP BY BusinessKey",
    "row_hash": f"SELECT BusinessKey, RowHashKey, snapshot_date FROM ({o.hashed_sql(o.EV_SNAP, K_EV, o.EV_COLS)}) x",
    "row_hash_composite": f"""
SELECT concat_ws('||', CAST(o_custkey AS VARCHAR), CAST(snapshot_date AS VARCHAR)) AS BusinessKey,
       md5(concat_ws('||', {', '.join(_strict(c) for c in o.OR_COLS)})) AS RowHashKey
FROM ({o.OR_SNAP}) s""",
    "prepared_snapshot": PL_EV,
    "active_rows": f"SELECT * FROM ({H_EV}) h WHERE ValidTo = {OPEN}",
    "closed_rows": f"SELECT * FROM ({H_EV}) h WHERE ValidTo <> {OPEN}",
    "deleted_versions": f"SELECT * FROM ({H_EV}) h WHERE IsDeleted",
    "snapshot_on": f"SELECT user_id, snapshot_date AS SnapshotDate, event_type, flag, value FROM ({o.on_last(o.EV_SNAP)}) s",
    "scan_from": """
SELECT event_id, user_id, CAST(ts AS DATE) AS snapshot_date, event_type FROM events
WHERE ts >= (SELECT min(CAST(ts AS DATE)) + 14 FROM events)""",
    "snapshot_distinct": """
SELECT DISTINCT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot_date,
       o_orderstatus, o_orderpriority FROM orders""",
    "key_file": f"SELECT DISTINCT RowHashKey, snapshot_date AS SnapshotDate FROM ({o.hashed_sql(o.EV_SNAP, K_EV, o.EV_COLS)}) x",
    "json_project": "SELECT event_id, user_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events",
    "rtbf_snapshot": f"""
SELECT o_custkey, snapshot_date, o_orderstatus, o_orderpriority,
       CASE WHEN {FLAG} THEN 'ANONYMISED' ELSE c_name END AS c_name, RowHashKey, BusinessKey,
       CASE WHEN {FLAG} THEN 'Yes' ELSE 'No' END AS GDPR_Compliant
FROM ({HASHED_OR}) x""",
    "rtbf_ids": f"SELECT * FROM {IDS} i",
    "rtbf_exposed": f"SELECT * FROM ({H_OR}) h WHERE o_custkey IN {IDS} AND GDPR_Compliant = 'No'",
    "rtbf_history": _masked_history(IDS),
    "process_snapshot": _masked_history(LAST_IDS),
    "history_forgetting": f"""
SELECT BusinessKey, RowHashKey, SnapshotDate, FirstSnapshot, ValidFrom, ValidTo, IsDeleted,
       CASE WHEN ValidFrom <= f.upto THEN 'Yes' ELSE GDPR_Compliant END AS GDPR_Compliant,
       h.o_custkey, o_orderstatus, o_orderpriority,
       CASE WHEN ValidFrom <= f.upto THEN 'ANONYMISED' ELSE c_name END AS c_name
FROM ({H_OR}) h
LEFT JOIN (SELECT o_custkey, max(snapshot_date) AS upto FROM ({o.OR_SNAP}) s WHERE {FLAG} GROUP BY o_custkey) f
  ON f.o_custkey = h.o_custkey""",
    "history_half_open": f"""
SELECT {EVC}, ValidFrom AS eff_start_date,
       CASE WHEN ValidTo = {OPEN} THEN NULL ELSE CAST(ValidTo + INTERVAL 1 DAY AS DATE) END AS eff_end_date,
       ValidTo = {OPEN} AS is_current
FROM ({H_EV}) h""",
    "lag_change_flags": f"""
SELECT *, CASE WHEN NOT is_changed THEN snapshot_date END AS end_date FROM (
  SELECT *, CASE WHEN event_type <> prev_event_type OR flag <> prev_flag OR prev_event_type IS NULL
                 THEN true ELSE false END AS is_changed,
            snapshot_date AS start_date
  FROM (SELECT *, lag(event_type) OVER w AS prev_event_type, lag(flag) OVER w AS prev_flag
        FROM ({o.EV_SNAP}) s WINDOW w AS (PARTITION BY user_id ORDER BY snapshot_date)) a) b""",
    "union_snapshots": f"""
SELECT user_id, snapshot_date, event_type, flag,
       CASE WHEN dayofweek(snapshot_date) IN (0, 6) THEN NULL ELSE value END AS value
FROM ({o.EV_SNAP}) s""",
    "dedup_versions": H_EV,
    "schema_evolution": f"""
SELECT h.*, e.event_type, e.value
FROM ({H_EVF}) h
LEFT JOIN ({o.on_last(o.EV_SNAP)}) e ON h.user_id = e.user_id AND h.ValidFrom = e.snapshot_date""",
    "history_totals": f"""
SELECT count(*) AS total_versions,
       count(*) FILTER (WHERE ValidTo = {OPEN}) AS active_versions,
       count(*) FILTER (WHERE IsDeleted) AS deleted_versions,
       count(*) FILTER (WHERE ValidTo <> {OPEN}) AS historical_versions
FROM ({H_EV}) h""",
    "multi_version_keys": f"""
SELECT BusinessKey, count(*) AS version_count FROM ({H_EVF}) h GROUP BY BusinessKey HAVING count(*) > 1""",
    "active_top10": f"""
SELECT BusinessKey, event_type, flag, value, ValidFrom, ValidTo FROM ({H_EV}) h
WHERE ValidTo = {OPEN} ORDER BY BusinessKey LIMIT 10""",
    "most_changed_top10": f"""
SELECT BusinessKey, count(*) AS version_count FROM ({H_EVF}) h GROUP BY BusinessKey HAVING count(*) > 1
ORDER BY version_count DESC, BusinessKey LIMIT 10""",
    "versions_of_top_key": f"""
SELECT BusinessKey, flag, ValidFrom, ValidTo, IsDeleted FROM ({H_EVF}) h
WHERE BusinessKey = (SELECT BusinessKey FROM ({H_EVF}) x GROUP BY BusinessKey HAVING count(*) > 1
                     ORDER BY count(*) DESC, BusinessKey LIMIT 1)
ORDER BY ValidFrom""",
    "load_range": RANGES,
    "load_ids": f"SELECT DISTINCT PK_DataGroupLoadLogID FROM ({LOG}) l",
    "reload_plan": f"""
SELECT r.DataGroupName, r.n_loads, r.first_snapshot, r.last_snapshot,
       coalesce(q.req, false) AS reload_requested,
       CASE WHEN r.n_loads > 1 THEN 'force_restore' WHEN coalesce(q.req, false) THEN 'restore' ELSE 'skip' END
         AS action,
       CASE WHEN r.n_loads > 1 OR coalesce(q.req, false) THEN r.first_snapshot END AS restore_from
FROM ({RANGES}) r
LEFT JOIN (SELECT DISTINCT DataGroupName, SnapshotDate, true AS req FROM ({REQUESTS}) x) q
  ON q.DataGroupName = r.DataGroupName AND q.SnapshotDate = r.first_snapshot""",
    "load_log_lookup": f"""
SELECT s.*, l.PK_DataGroupLoadLogID FROM ({o.EV_SNAP}) s
LEFT JOIN (SELECT * FROM ({LOG}) x WHERE Layer = 'Bronze') l
  ON l.DataGroupName = s.event_type AND l.SnapshotDate = s.snapshot_date""",
    "rollback": o.history_sql(f"SELECT * FROM ({o.EV_SNAP}) s WHERE snapshot_date < {RESTORE_DAY}",
                              K_EV, o.EV_COLS, "full"),
    "rollback_incremental": o.history_sql(f"SELECT * FROM ({o.OR_SNAP}) s WHERE snapshot_date < {RESTORE_MONTH}",
                                          K_OR, o.OR_COLS, "incremental"),
    "reload": H_EV,
    "reload_changed_keys": H_EV,
    "history_splice": H_EV,
    "reload_incremental": H_OR,
}

ORACLES.update(ORACLES_BASE)
ORACLES["process_all"] = ORACLES["history_forgetting"]
ORACLES["history_batched"] = ORACLES["history_chained"]
ORACLES["load_summary"] = ORACLES["change_summary"]
ORACLES["process_batched"] = ORACLES["history_forgetting"]
ORACLES["reload_forgetting"] = ORACLES["history_forgetting"]
ORACLES["history_store_forgetting"] = ORACLES["history_forgetting"]

K_TXT, TXT_COLS = ["p", "q"], ("p", "q", "o_orderpriority")
H_TXT = o.history_sql(o.TEXT_SNAP, K_TXT, TXT_COLS, "full")
HP_TXT = o.history_sql(o.before_last(o.TEXT_SNAP), K_TXT, TXT_COLS, "full")
PL_TXT = o.prepared_sql(o.on_last(o.TEXT_SNAP), K_TXT, TXT_COLS)
EMPTY_DAY = o.history_sql(
    f"SELECT * FROM ({o.EVF_SNAP}) e WHERE snapshot_date <> (SELECT min(snapshot_date) + 10 FROM ({o.EVF_SNAP}) m)",
    K_EV, o.EVF_COLS, "full", calendar=o.EVF_SNAP,
)
CUST_LOG = """
SELECT DataGroupName, SnapshotDate FROM (
  SELECT *, max(SnapshotDate) OVER (PARTITION BY DataGroupName) AS _last
  FROM (SELECT DISTINCT 'customer_' || o_custkey AS DataGroupName, CAST(o_orderdate AS DATE) AS SnapshotDate FROM orders) d) l
WHERE SnapshotDate = _last OR NOT regexp_matches(DataGroupName, '[02468]$')"""

ORACLES.update({
    "history_store_time_travel": f"""
SELECT BusinessKey, RowHashKey, SnapshotDate, FirstSnapshot, ValidFrom, ValidTo, IsDeleted,
       CASE WHEN ValidFrom <= f.upto THEN 'Yes' ELSE GDPR_Compliant END AS GDPR_Compliant,
       h.o_custkey, o_orderstatus, o_orderpriority,
       CASE WHEN ValidFrom <= f.upto THEN 'ANONYMISED' ELSE c_name END AS c_name
FROM ({HP_OR}) h
LEFT JOIN (SELECT o_custkey, max(snapshot_date) AS upto FROM ({o.OR_SNAP}) s WHERE {FLAG} GROUP BY o_custkey) f
  ON f.o_custkey = h.o_custkey""",
    "history_store_redo": H_EV,
    "history_store_files": f"""
SELECT h.o_custkey, ValidFrom, RowHashKey, o_orderstatus, o_orderpriority,
       CASE WHEN f.o_custkey IS NOT NULL THEN 'ANONYMISED' ELSE c_name END AS c_name,
       CASE WHEN f.o_custkey IS NOT NULL THEN 'Yes' ELSE GDPR_Compliant END AS GDPR_Compliant
FROM ({H_OR}) h LEFT JOIN (SELECT DISTINCT o_custkey FROM ({o.OR_SNAP}) s WHERE {FLAG}) f ON f.o_custkey = h.o_custkey""",
    "run_loads": o.history_sql(o.PERIOD_SNAP, K_EV, o.EVF_COLS, "full"),
    "dated_paths": f"SELECT o_custkey, o_orderstatus, snapshot_date FROM ({o.OR_SNAP}) s",
    "read_history_evolved": f"SELECT {SYS}, user_id, CAST(NULL AS VARCHAR) AS event_type, flag FROM ({H_EVF}) h",
    "check_null_keys": """
SELECT CAST(NULL AS BIGINT) AS user_id, CAST(ts AS DATE) AS snapshot_date, event_id, event_type
FROM events WHERE event_type = 'error' OR user_id IS NULL OR event_type IS NULL""",
    "text_keys_classify": f"""
SELECT coalesce(h.p, c.p) AS p, coalesce(h.q, c.q) AS q, coalesce(h.BusinessKey, c.BusinessKey) AS BusinessKey,
       h.RowHashKey AS hist_RowHashKey, c.RowHashKey AS curr_RowHashKey,
       CASE WHEN h.p IS NULL THEN 'new' WHEN c.p IS NULL THEN 'deleted'
            WHEN h.RowHashKey = c.RowHashKey THEN 'unchanged' ELSE 'updated' END AS HistoryStatus
FROM (SELECT * FROM ({HP_TXT}) x WHERE ValidTo = {OPEN}) h
FULL OUTER JOIN ({PL_TXT}) c ON h.p = c.p AND h.q = c.q""",
    "text_keys_inserted": f"""
SELECT c.* REPLACE (coalesce(f.first, c.FirstSnapshot) AS FirstSnapshot)
FROM ({PL_TXT}) c
LEFT JOIN (SELECT p, q, min(FirstSnapshot) AS first FROM ({HP_TXT}) a GROUP BY p, q) f ON f.p = c.p AND f.q = c.q
WHERE NOT EXISTS (SELECT 1 FROM ({HP_TXT}) h
                  WHERE h.ValidTo = {OPEN} AND h.p = c.p AND h.q = c.q AND h.RowHashKey = c.RowHashKey)""",
    "text_keys_multi_version": f"""
SELECT p, q, BusinessKey, count(*) AS version_count FROM ({H_TXT}) h GROUP BY p, q, BusinessKey HAVING count(*) > 1""",
    "text_keys_dedup": f"""
SELECT * REPLACE (CASE WHEN ValidTo = {OPEN} THEN 'Yes' ELSE GDPR_Compliant END AS GDPR_Compliant,
                  CASE WHEN ValidTo = {OPEN} THEN 'ANONYMISED' ELSE o_orderpriority END AS o_orderpriority)
FROM ({H_TXT}) h""",
    "history_empty_day": EMPTY_DAY,
    "reload_empty_day": EMPTY_DAY,
    "reload_plan_customers": f"""
SELECT r.DataGroupName, n_loads, first_snapshot, last_snapshot, req.DataGroupName IS NOT NULL AS reload_requested,
       CASE WHEN n_loads > 1 THEN 'force_restore' WHEN req.DataGroupName IS NOT NULL THEN 'restore' ELSE 'skip' END AS action,
       CASE WHEN n_loads > 1 OR req.DataGroupName IS NOT NULL THEN first_snapshot END AS restore_from
FROM (SELECT DataGroupName, count(DISTINCT SnapshotDate) AS n_loads, min(SnapshotDate) AS first_snapshot,
             max(SnapshotDate) AS last_snapshot FROM ({CUST_LOG}) l GROUP BY DataGroupName) r
LEFT JOIN (SELECT DISTINCT 'customer_' || o_custkey AS DataGroupName, CAST(o_orderdate AS DATE) AS SnapshotDate
           FROM orders WHERE starts_with(o_orderpriority, '1')) req
  ON req.DataGroupName = r.DataGroupName AND req.SnapshotDate = r.first_snapshot""",
})
