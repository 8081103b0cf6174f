"""DuckDB oracle SQL for every registered query.

The oracle re-derives the envelope from ``events`` column by column (no
Spark code path is shared): it builds each record's attribute values as
JSON text and applies the coercion rules with DuckDB's JSON functions and
textual guards of its own. It shares the probe inputs with the fixture. Views ``events`` etc. are registered by the
checker.
"""

from __future__ import annotations

from larkspur.plans.lake import EPOCH, GROUP_RECORDS, OFFSETS_PER_BATCH
from tools.event_log import PROBES


# The texts that the rules accept, written here for DuckDB alone.
INTEGER = "[-+]?\\d+"
NUMBER = "[\\x00-\\x20]*[-+]?(?:NaN|Infinity|(?:\\d+\\.?\\d*|\\.\\d+)(?:[eE][-+]?\\d+)?[fFdD]?)[\\x00-\\x20]*"
DAY = "\\d{4}-\\d\\d-\\d\\d"
MOMENT = DAY + "T\\d\\d:\\d\\d(?::\\d\\d(?:\\.\\d{1,9})?)?"


def _java_double(d: str) -> str:
    """A double as Java prints it: plain from 0.001 to 10 million, else one
    digit, a point, the other digits and the exponent."""
    digits = f"trim(regexp_replace(regexp_replace(CAST(abs({d}) AS VARCHAR), 'e.*$', ''), '[.]', ''), '0')"
    return (f"CASE WHEN {d} = 0 OR (abs({d}) >= 1e-3 AND abs({d}) < 1e7) THEN CAST({d} AS VARCHAR) "
            f"ELSE (CASE WHEN {d} < 0 THEN '-' ELSE '' END) || substr({digits}, 1, 1) || '.' || "
            f"(CASE WHEN length({digits}) > 1 THEN substr({digits}, 2) ELSE '0' END) || 'E' || "
            f"CAST(CAST(floor(log10(abs({d}))) AS INTEGER) AS VARCHAR) END")


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _probes_values() -> str:
    return ", ".join(f"({i}, {_sql_str(p)})" for i, p in enumerate(PROBES))


# Declared columns of the two fixture tables (namespace, table, name, type).
API_FIELDS = [
    ("visitor", "STRING"), ("action", "STRING"), ("outcome", "STRING"), ("fault", "STRING"),
    ("k", "INT"), ("amount", "LONG"), ("count", "INT"), ("total", "LONG"), ("ratio", "FLOAT"),
    ("score", "DOUBLE"), ("active", "BOOLEAN"), ("day", "DATE"), ("seen_at", "TIMESTAMP"),
]
INCIDENT_FIELDS = [
    ("visitor", "STRING"), ("channel", "STRING"), ("address", "STRING"), ("outcome", "STRING"),
    ("k", "LONG"), ("amount", "DOUBLE"), ("count", "INT"), ("day", "DATE"), ("seen_at", "TIMESTAMP"),
]
ALL_KEYS = ["visitor", "action", "outcome", "k", "amount", "channel", "address",
            "count", "total", "ratio", "score", "active", "day", "seen_at", "fault", "session"]
DUCK_TYPES = {"STRING": "VARCHAR", "INT": "INTEGER", "LONG": "BIGINT", "FLOAT": "FLOAT",
              "DOUBLE": "DOUBLE", "BOOLEAN": "BOOLEAN", "DATE": "DATE", "TIMESTAMP": "TIMESTAMP"}


def _raw_json(key: str) -> str:
    """JSON text of attribute ``key`` (NULL when the key is absent)."""
    natural = {
        "visitor": "'\"V-' || user_id || '\"'",
        "action": "'\"' || event_type || '\"'",
        "outcome": "CASE WHEN event_type = 'error' THEN '\"refused\"' ELSE '\"done\"' END",
        "k": "json_extract_string(props, '$.k')",
        "amount": "CAST(value AS VARCHAR)",
        "channel": "'\"web\"'",
        "address": "'\"10.0.0.' || (user_id % 256) || '\"'",
        "session": "'\"S-' || (event_id % 7) || '\"'",
        "count": "json_extract_string(props, '$.k')",
        "total": "CAST(user_id AS VARCHAR)",
        "ratio": "CAST(value AS VARCHAR)",
        "score": "CAST(value AS VARCHAR)",
        "active": "CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END",
        "day": "'\"' || strftime(ts, '%Y-%m-%d') || '\"'",
        "seen_at": "'\"' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || '\"'",
        "fault": "NULL",
    }[key]
    if key in ("count", "total", "ratio", "score", "active", "day", "seen_at", "fault"):
        return f"CASE WHEN is_probe THEN probe_json ELSE {natural} END"
    return natural


def _coerce(key: str, dt: str) -> tuple[str, str]:
    """(value SQL, failed SQL) over columns j_<key> (JSON) of the row."""
    j = f"j_{key}"
    kind = (f"CASE WHEN {j} IS NULL OR json_type({j}) = 'NULL' THEN 'null' "
            f"WHEN json_type({j}) = 'VARCHAR' THEN 'string' WHEN json_type({j}) = 'BOOLEAN' THEN 'boolean' "
            f"WHEN json_type({j}) IN ('BIGINT','UBIGINT','DOUBLE','HUGEINT') THEN 'number' ELSE 'nested' END")
    txt = f"json_extract_string({j}, '$')"
    if dt in ("INT", "LONG"):
        t = DUCK_TYPES[dt]
        lo, hi = ("-2147483648", "2147483647") if dt == "INT" else ("-9223372036854775808", "9223372036854775807")
        v = (f"CASE WHEN ({kind}) = 'number' AND json_type({j}) = 'DOUBLE' THEN "
             f"(CASE WHEN trunc(CAST({txt} AS DOUBLE)) BETWEEN {lo} AND {hi} "
             f"THEN CAST(trunc(CAST({txt} AS DOUBLE)) AS {t}) END) "
             f"WHEN ({kind}) = 'number' THEN TRY_CAST({txt} AS {t}) "
             f"WHEN ({kind}) = 'string' AND regexp_full_match({txt}, {_sql_str(INTEGER)}) "
             f"THEN TRY_CAST({txt} AS {t}) END")
    elif dt in ("FLOAT", "DOUBLE"):
        t = DUCK_TYPES[dt]
        v = (f"CASE WHEN ({kind}) = 'number' THEN TRY_CAST({txt} AS {t}) "
             f"WHEN ({kind}) = 'string' AND regexp_full_match({txt}, {_sql_str(NUMBER)}) "
             f"THEN TRY_CAST(regexp_replace(trim({txt}), '[fFdD]$', '') AS {t}) END")
    elif dt == "BOOLEAN":
        v = f"CASE WHEN ({kind}) <> 'null' THEN lower({txt}) = 'true' END"
    elif dt == "DATE":
        v = f"CASE WHEN regexp_full_match({txt}, {_sql_str(DAY)}) THEN TRY_CAST({txt} AS DATE) END"
    elif dt == "TIMESTAMP":
        v = (f"CASE WHEN regexp_full_match({txt}, {_sql_str(MOMENT)}) "
             f"THEN TRY_CAST({txt} AS TIMESTAMP) END")
    else:
        v = (f"CASE WHEN json_type({j}) = 'DOUBLE' AND regexp_matches(CAST({j} AS VARCHAR), '[.eE]') "
             f"THEN {_java_double(f'CAST({txt} AS DOUBLE)')} WHEN ({kind}) <> 'null' THEN {txt} END")
    failed = f"(({kind}) <> 'null' AND ({v}) IS NULL)"
    return v, failed


def base() -> str:
    """CTEs: src (derived envelope), routed (status), typed_api / typed_inc."""
    js = ",\n    ".join(f"json({_raw_json(k)}) AS j_{k}" for k in ALL_KEYS)

    def typed(fields, ns, tbl, name):
        vals, fails = [], []
        for key, dt in fields:
            v, f = _coerce(key, dt)
            vals.append(f"({v}) AS \"{key}\"")
            fails.append(f"CASE WHEN {f} THEN '{key}' END")
        return f"""{name} AS (
  SELECT namespace, type, event_time, tenant_id, source_offset, batch_id, batch_idx, is_probe, probe_idx,
    {', '.join(vals)},
    concat_ws(',', {', '.join(fails)}) AS failed_cols
  FROM routed WHERE status = 'accepted' AND namespace = '{ns}' AND type = '{tbl}'
)"""

    return f"""
WITH probes AS (SELECT * FROM (VALUES {_probes_values()}) t(probe_idx, probe_json)),
s0 AS (
  SELECT e.*, CAST(event_id % 3 AS INTEGER) AS source_partition, event_id AS source_offset,
    event_id % 4 = 0 AS is_probe, CAST((event_id // 4) % {len(PROBES)} AS INTEGER) AS probe_idx,
    CAST(event_id // {OFFSETS_PER_BATCH} AS BIGINT) AS batch_idx,
    '{EPOCH}-' || lpad(CAST(event_id // {OFFSETS_PER_BATCH} AS VARCHAR), 10, '0') AS batch_id,
    CASE WHEN event_type = 'error' THEN 'security' ELSE 'site' END AS ns0,
    CASE WHEN event_type = 'error' THEN 'alarms' WHEN event_type = 'purchase' THEN 'cart_events'
         WHEN event_type = 'signup' AND event_id % 50 = 0 THEN ''
         WHEN event_type = 'signup' AND event_id % 50 = 25 THEN ' ' ELSE 'page_actions' END AS type0,
    CASE WHEN user_id % 37 = 0 THEN NULL WHEN user_id % 41 = 0 THEN ''
         ELSE 'acct-' || (user_id % 5 + 1) END AS tenant0,
    CASE WHEN event_id % 997 <> 0 AND (event_id % 499 = 0 OR event_id % 1499 = 0) THEN 'null_event'
         WHEN event_id % 997 = 0 THEN 'undecodable_envelope' END AS wire_reason
  FROM events e
),
s1 AS (
  SELECT s0.*, p.probe_json FROM s0 LEFT JOIN probes p USING (probe_idx)
),
src AS (
  SELECT s1.*,
    CASE WHEN wire_reason IS NULL THEN (CASE WHEN event_id % 89 = 0 THEN NULL ELSE ns0 END) END AS namespace,
    CASE WHEN wire_reason IS NULL THEN type0 END AS type,
    CASE WHEN wire_reason IS NULL THEN tenant0 END AS tenant_id,
    CASE WHEN wire_reason IS NOT NULL THEN NULL
         WHEN event_id % 211 = 0 THEN ts
         WHEN event_id % 101 = 0 THEN NULL
         WHEN event_id % 173 = 0 THEN date_trunc('second', ts - INTERVAL 7 DAY)
         ELSE date_trunc('second', ts) END AS event_time,
    wire_reason IS NULL AND event_id % 211 = 0 AS event_time_defaulted,
    COALESCE(wire_reason,
      CASE WHEN event_id % 211 <> 0 AND event_id % 101 = 0 THEN 'bad_event_time'
           WHEN type0 = '' THEN 'empty_type'
           WHEN event_id % 89 = 0 THEN 'null_namespace' END) AS decode_reason,
    {js}
  FROM s1
),
routed AS (
  SELECT src.*,
    COALESCE(decode_reason,
      CASE WHEN NOT ((namespace = 'site' AND type = 'page_actions')
                  OR (namespace = 'security' AND type = 'alarms')) THEN 'unregistered_type'
           WHEN tenant_id IS NULL THEN 'null_tenant' END, 'accepted') AS status
  FROM src
),
{typed(API_FIELDS, 'site', 'page_actions', 'typed_api')},
{typed(INCIDENT_FIELDS, 'security', 'alarms', 'typed_inc')},
ok_api AS (SELECT * FROM typed_api WHERE failed_cols = ''),
ok_inc AS (SELECT * FROM typed_inc WHERE failed_cols = ''),
ok_all AS (
  SELECT namespace, type, event_time, tenant_id, source_offset, batch_id, batch_idx,
         CAST(k AS BIGINT) AS k, CAST(amount AS BIGINT) AS amount, CAST("count" AS BIGINT) AS "count",
         day, seen_at FROM ok_api
  UNION ALL
  SELECT namespace, type, event_time, tenant_id, source_offset, batch_id, batch_idx,
         CAST(k AS BIGINT), CAST(trunc(amount) AS BIGINT), CAST("count" AS BIGINT), day, seen_at FROM ok_inc
),
lake AS (SELECT CAST(max(event_id) // {OFFSETS_PER_BATCH} + 1 AS BIGINT) AS n_batches,
                CAST((max(event_id) // {OFFSETS_PER_BATCH} + 1) // 2 AS BIGINT) AS half FROM events)
"""


def _fmt(col: str, dt: str) -> str:
    if dt in ("FLOAT", "DOUBLE"):
        return f"CASE WHEN isnan({col}) THEN 'NaN' ELSE printf('%.6e', CAST({col} AS DOUBLE)) END"
    if dt == "TIMESTAMP":
        return f"CAST({col} AS VARCHAR)"
    return f"CAST({col} AS VARCHAR)"


def _coerce_values() -> str:
    """Each declared attribute of each accepted row of both tables."""
    parts = []
    for ns, tbl, fields in (("site", "page_actions", API_FIELDS), ("security", "alarms", INCIDENT_FIELDS)):
        for key, dt in fields:
            v, f = _coerce(key, dt)
            raw = _raw_json(key)
            raw = (f"CASE WHEN regexp_full_match({raw}, '-?[0-9.]+([eE][-+]?[0-9]+)?') AND regexp_matches({raw}, '[.eE]') "
                   f"THEN {_java_double(f'TRY_CAST(({raw}) AS DOUBLE)')} ELSE {raw} END")
            number = f"CAST(({v}) AS DOUBLE)"
            text = (f"CASE WHEN isnan({number}) THEN 'NaN' ELSE printf('{'%.8e' if dt == 'FLOAT' else '%.14e'}', {number}) END"
                    if dt in ("FLOAT", "DOUBLE") else _fmt(f"({v})", dt))
            parts.append(
                f"SELECT namespace, type, '{key}' AS column_name, '{dt}' AS data_type, {raw} AS raw_text, "
                f"{text} AS value_text, {f} AS failed "
                f"FROM routed WHERE status = 'accepted' AND namespace = '{ns}' AND type = '{tbl}'"
            )
    return " UNION ALL ".join(parts)


def _schema_changes() -> str:
    return """
SELECT 'site' AS namespace, 'page_actions' AS table_name, name, change, data_type,
       CAST(n_events AS BIGINT) AS n_events, 2 AS live_version
FROM (
  SELECT 'session' AS name, 'add' AS change, 'STRING' AS data_type,
         (SELECT count(*) FROM routed WHERE status = 'accepted' AND type = 'page_actions') AS n_events
  UNION ALL
  SELECT 'fault', 'drop', 'STRING',
         (SELECT count(*) FROM routed WHERE status = 'accepted' AND type = 'page_actions' AND is_probe)
  UNION ALL
  SELECT 'k', 'ignored', 'INT',
         (SELECT count(*) FROM routed WHERE status = 'accepted' AND type = 'page_actions')
)"""


def _evolved_read() -> str:
    # rows of the first half were coerced under v1 (fault checked), the rest
    # under v2 (fault dropped, session added): recompute acceptance per half
    v1_fail = _coerce("fault", "STRING")[1]
    return f"""
, ev AS (
  SELECT t.event_time, t.batch_idx, t.failed_cols, r.j_session
  FROM typed_api t JOIN routed r USING (source_offset)
)
SELECT CAST(event_time AS DATE) AS event_date, count(*) AS n,
       count(CASE WHEN batch_idx >= (SELECT half FROM lake) THEN 1 END) AS n_session,
       false AS has_error_column
FROM ev
WHERE (batch_idx < (SELECT half FROM lake) AND failed_cols = '')
   OR (batch_idx >= (SELECT half FROM lake) AND
       regexp_replace(regexp_replace(failed_cols, '(^|,)fault(,|$)', ','), '^,|,$', '') = '')
GROUP BY 1"""


def oracle_sql() -> dict[str, str]:
    b = base()
    half = "(SELECT half FROM lake)"
    q = {
        "rejected_events": "SELECT status, count(*) AS n FROM routed GROUP BY 1",
        "valid_events": """SELECT namespace, type, CAST(event_time AS DATE) AS event_date, count(*) AS n,
            CAST(sum(CAST(event_time_defaulted AS INTEGER)) AS BIGINT) AS n_defaulted_time,
            CAST(sum(CASE WHEN tenant_id = '' THEN 1 ELSE 0 END) AS BIGINT) AS n_empty_tenant
            FROM routed WHERE status = 'accepted' GROUP BY 1, 2, 3""",
        "event_time_parse": """SELECT CAST(event_time AS DATE) AS event_date, count(*) AS n,
            CAST(sum(CAST(event_time_defaulted AS INTEGER)) AS BIGINT) AS n_defaulted,
            min(event_time) AS first_time, max(event_time) AS last_time
            FROM src WHERE event_time IS NOT NULL GROUP BY 1""",
        "unregistered_types": """SELECT namespace, type, count(*) AS n FROM routed
            WHERE status = 'unregistered_type' GROUP BY 1, 2""",
        "envelope_roundtrip": """SELECT 'same' AS outcome, count(*) AS n FROM src
            WHERE decode_reason IS NULL OR decode_reason IN ('empty_type', 'null_namespace')""",
        "typed_projection": """SELECT namespace, type, CAST(event_time AS DATE) AS event_date, count(*) AS n,
            CAST(COALESCE(sum(k), 0) AS BIGINT) AS sum_k, CAST(COALESCE(sum(amount), 0) AS BIGINT) AS sum_amount,
            CAST(COALESCE(sum("count"), 0) AS BIGINT) AS sum_count, count(day) AS n_day,
            count(seen_at) AS n_seen_at, count(DISTINCT tenant_id) AS n_tenants
            FROM ok_all GROUP BY 1, 2, 3""",
        "coerce_matrix": f"""SELECT namespace, type, column_name, data_type, count(*) AS n,
            count(CASE WHEN failed THEN 1 END) AS n_failed, count(value_text) AS n_values, count(DISTINCT value_text) AS n_distinct
            FROM ({_coerce_values()}) GROUP BY 1, 2, 3, 4""",
        "buffer_groups": f"""SELECT namespace, type, source_partition, group_seq,
            CASE WHEN group_seq < n // {GROUP_RECORDS} THEN 'count' ELSE 'waiting' END AS closed_by,
            count(*) AS n_events, min(source_offset) AS first_offset, max(source_offset) AS last_offset FROM (
              SELECT namespace, type, source_partition, source_offset, count(*) OVER (PARTITION BY namespace, type, source_partition) AS n,
                CAST((row_number() OVER (PARTITION BY namespace, type, source_partition ORDER BY source_offset) - 1) // {GROUP_RECORDS} AS BIGINT) AS group_seq
              FROM src WHERE decode_reason IS NULL) GROUP BY namespace, type, source_partition, group_seq, n""",
        "manifest_stream": f"""SELECT namespace, type, count(DISTINCT CASE WHEN batch_idx < {half} THEN 1 ELSE 2 END) AS n_merges,
            count(*) AS total_records, count(DISTINCT batch_id) AS n_child_batches FROM ok_all GROUP BY 1, 2""",
        "catalog_read": """SELECT CAST(event_time AS DATE) AS event_date, count(*) AS n, CAST(COALESCE(sum(k), 0) AS BIGINT) AS sum_k,
            count(*) AS n_ids FROM ok_api GROUP BY 1""",
        "sql_between": """SELECT 'page_actions' AS type, CAST(event_time AS DATE) AS event_date, count(*) AS n, CAST(COALESCE(sum(k), 0) AS BIGINT) AS sum_k
            FROM ok_api WHERE event_time >= TIMESTAMP '2024-01-10 00:00:00' AND event_time < TIMESTAMP '2024-01-17 00:00:00' GROUP BY 2
            UNION ALL SELECT 'alarms', CAST(event_time AS DATE), count(*), CAST(COALESCE(sum(k), 0) AS BIGINT)
            FROM ok_inc WHERE event_time >= TIMESTAMP '2024-01-10 06:00:00' AND event_time < TIMESTAMP '2024-01-12 18:30:00' GROUP BY 2""",
        "packed_units": """SELECT namespace, type, batch_id, total_records, CAST(floor(COALESCE(sum(total_records) OVER (
              PARTITION BY namespace, type ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / 3000.0) AS BIGINT) AS pack
            FROM (SELECT namespace, type, batch_id, count(*) AS total_records FROM ok_all GROUP BY 1, 2, 3)""",
        "unknown_kinds": f"""SELECT namespace, type, attribute, kind, count(*) AS n FROM (
            {" UNION ALL ".join(
                f"SELECT namespace, type, '{k}' AS attribute, CASE json_type(j_{k}) WHEN 'VARCHAR' THEN 'text' WHEN 'BOOLEAN' THEN 'boolean' "
                f"WHEN 'OBJECT' THEN 'nested' WHEN 'ARRAY' THEN 'nested' WHEN 'NULL' THEN 'null' ELSE 'number' END AS kind "
                f"FROM routed WHERE status = 'accepted' AND j_{k} IS NOT NULL "
                f"AND NOT (type = 'page_actions' AND {k in [n for n, _ in API_FIELDS]}) AND NOT (type = 'alarms' AND {k in [n for n, _ in INCIDENT_FIELDS]})"
                for k in ALL_KEYS)}) GROUP BY 1, 2, 3, 4""",
        "quarantine_retry": """, q AS (
              SELECT namespace, type, status AS reason, CASE WHEN status = 'unregistered_type' AND namespace = 'site' AND type = 'cart_events'
                THEN (CASE WHEN tenant_id IS NULL THEN 'null_tenant' ELSE 'accepted' END) ELSE status END AS later FROM routed WHERE status <> 'accepted'
              UNION ALL SELECT namespace, type, 'coercion_failed', 'coercion_failed' FROM typed_api WHERE failed_cols <> ''
              UNION ALL SELECT namespace, type, 'coercion_failed', 'coercion_failed' FROM typed_inc WHERE failed_cols <> ''
            ) SELECT namespace, type, reason, CAST(sum(b) AS BIGINT) AS n_before, CAST(sum(a) AS BIGINT) AS n_after FROM (
              SELECT namespace, type, reason, 1 AS b, 0 AS a FROM q UNION ALL SELECT namespace, type, later, 0, 1 FROM q) GROUP BY 1, 2, 3""",
        "log_order": f"""SELECT namespace, type, source_partition, group_seq, count(*) AS n_events,
            min(source_offset) AS first_offset, max(source_offset) AS last_offset FROM (
              SELECT namespace, type, CAST(source_offset % 3 AS INTEGER) AS source_partition, source_offset,
                CAST((row_number() OVER (PARTITION BY namespace, type, source_offset % 3 ORDER BY source_offset) - 1) // {GROUP_RECORDS} AS BIGINT) AS group_seq
              FROM ok_all) GROUP BY 1, 2, 3, 4""",
        "coerce_values": f"""SELECT namespace, type, column_name, data_type, raw_text, value_text, failed, count(*) AS n
            FROM ({_coerce_values()}) GROUP BY 1, 2, 3, 4, 5, 6, 7""",
        "coercion_quarantine": """SELECT namespace, type, column_name, count(*) AS n FROM (
            SELECT namespace, type, unnest(string_split(failed_cols, ',')) AS column_name FROM typed_api WHERE failed_cols <> ''
            UNION ALL
            SELECT namespace, type, unnest(string_split(failed_cols, ',')) FROM typed_inc WHERE failed_cols <> ''
            ) GROUP BY 1, 2, 3""",
        "unknown_attributes": f"""SELECT namespace, type, attribute, count(*) AS n FROM (
            SELECT namespace, type, unnest(json_keys(json_object({', '.join(f"'{k}', j_{k}" for k in ALL_KEYS)}))) AS attribute,
            {', '.join(f"j_{k} IS NULL AS miss_{k}" for k in ALL_KEYS)}
            FROM routed WHERE status = 'accepted') x
            WHERE NOT (({' OR '.join(f"(attribute = '{k}' AND miss_{k})" for k in ALL_KEYS)}))
              AND NOT (type = 'page_actions' AND attribute IN ({', '.join(repr(k) for k, _ in API_FIELDS)}))
              AND NOT (type = 'alarms' AND attribute IN ({', '.join(repr(k) for k, _ in INCIDENT_FIELDS)}))
            GROUP BY 1, 2, 3""",
        "group_sizes": f"""SELECT namespace, type, source_partition, group_seq, count(*) AS n_events,
            min(source_offset) AS first_offset, max(source_offset) AS last_offset FROM (
              SELECT namespace, type, source_partition, source_offset,
                CAST((row_number() OVER (PARTITION BY namespace, type, source_partition ORDER BY source_offset) - 1)
                     // {GROUP_RECORDS} AS BIGINT) AS group_seq
              FROM src WHERE decode_reason IS NULL) GROUP BY 1, 2, 3, 4""",
        "group_batches": f"""SELECT namespace, type, source_partition, source_offset,
            CAST((row_number() OVER (PARTITION BY namespace, type, source_partition ORDER BY source_offset) - 1)
                 // {GROUP_RECORDS} AS BIGINT) AS group_seq
            FROM src WHERE decode_reason IS NULL""",
        "commit_guard": f"""SELECT namespace, type, outcome, count(*) AS n_groups, CAST(sum(total_records) AS BIGINT) AS total_records
            FROM (
              SELECT namespace, type,
                CASE WHEN trim(type) = '' THEN 'blank_type' WHEN sum(CASE WHEN status = 'accepted' THEN 1 ELSE 0 END) <= 0 THEN 'no_records'
                     ELSE 'commit' END AS outcome,
                sum(CASE WHEN status = 'accepted' THEN 1 ELSE 0 END) AS total_records
              FROM (SELECT *, (row_number() OVER (PARTITION BY namespace, type, source_partition ORDER BY source_offset) - 1)
                     // {GROUP_RECORDS} AS group_seq FROM routed WHERE decode_reason IS NULL) g
              GROUP BY namespace, type, source_partition, group_seq) GROUP BY 1, 2, 3""",
        "staged_manifest": """SELECT namespace, type, batch_id, count(*) AS total_records, true AS has_bytes
            FROM ok_all GROUP BY 1, 2, 3""",
        "replay_idempotent": """SELECT namespace, type, batch_id, count(*) AS n_rows, count(*) AS n_ids
            FROM ok_all GROUP BY 1, 2, 3""",
        "merge_totals": f"""SELECT namespace, type,
            count(DISTINCT CASE WHEN batch_idx < {half} THEN 1 ELSE 2 END) AS n_merges,
            count(*) AS total_records, count(DISTINCT batch_id) AS n_child_batches,
            count(DISTINCT CASE WHEN batch_idx < {half} THEN 1 ELSE 2 END) AS n_with_bytes
            FROM ok_all GROUP BY 1, 2""",
        "merge_roundtrip": """SELECT namespace, type, CAST(event_time AS DATE) AS event_date, count(*) AS n,
            CAST(COALESCE(sum(k), 0) AS BIGINT) AS sum_k FROM ok_all GROUP BY 1, 2, 3""",
        "pending_files": f"""SELECT namespace, type, count(DISTINCT batch_id) AS n_batches, count(*) AS total_records
            FROM ok_all WHERE batch_idx >= {half} GROUP BY 1, 2""",
        "cleanup_candidates": """SELECT namespace, type, count(DISTINCT batch_id) AS n_batches, count(*) AS total_records
            FROM ok_all GROUP BY 1, 2""",
        "partition_day": """SELECT CAST(event_time AS DATE) AS event_date, count(*) AS n FROM ok_api GROUP BY 1""",
        "partition_hour": """SELECT CAST(event_time AS DATE) AS event_date, CAST(hour(event_time) AS INTEGER) AS event_hour,
            count(*) AS n FROM ok_inc GROUP BY 1, 2""",
        "time_range_read": """SELECT CAST(event_time AS DATE) AS event_date, count(*) AS n,
            CAST(COALESCE(sum(k), 0) AS BIGINT) AS sum_k FROM ok_api
            WHERE event_time >= TIMESTAMP '2024-01-10 00:00:00' AND event_time < TIMESTAMP '2024-01-17 00:00:00'
            GROUP BY 1""",
        "as_of_read": f"""SELECT CAST(event_time AS DATE) AS event_date, count(*) AS n FROM ok_api
            WHERE batch_idx < {half} GROUP BY 1""",
        "late_events": """SELECT type, CAST(event_time AS DATE) AS event_date, count(*) AS n FROM ok_all
            WHERE event_time < TIMESTAMP '2024-01-01 00:00:00' GROUP BY 1, 2""",
        "ulid_shape": """SELECT type, count(*) AS n, count(*) AS n_distinct, count(*) AS n_valid,
            count(DISTINCT date_trunc('millisecond', event_time)) AS n_times, true AS first_is_least, true AS last_is_greatest
            FROM ok_all GROUP BY 1""",
        "distinct_locations": """SELECT CASE WHEN type = 'page_actions' THEN 'site-page-actions'
            ELSE 'security-alarms' END AS bucket_name, count(*) AS total_records
            FROM ok_all GROUP BY 1""",
        "evolved_read": _evolved_read(),
        "schema_add_columns": f"SELECT * FROM ({_schema_changes()}) WHERE change = 'add'",
        "schema_drop_columns": f"SELECT * FROM ({_schema_changes()}) WHERE change = 'drop'",
        "schema_ignored_changes": f"SELECT * FROM ({_schema_changes()}) WHERE change = 'ignored'",
        "schema_changes": _schema_changes(),
        "quarantine_report": """SELECT reason, namespace, type, count(*) AS n, count(detail) AS n_detail FROM (
            SELECT status AS reason, namespace, type, CAST(NULL AS VARCHAR) AS detail FROM routed WHERE status <> 'accepted'
            UNION ALL SELECT 'coercion_failed', namespace, type, failed_cols FROM typed_api WHERE failed_cols <> ''
            UNION ALL SELECT 'coercion_failed', namespace, type, failed_cols FROM typed_inc WHERE failed_cols <> ''
            ) GROUP BY 1, 2, 3""",
        "sql_view_read": """SELECT tenant_id, count(*) AS n, CAST(COALESCE(sum(k), 0) AS BIGINT) AS sum_k,
            count(DISTINCT CAST(event_time AS DATE)) AS n_days FROM ok_api
            WHERE event_time >= TIMESTAMP '2024-01-05 00:00:00' AND event_time < TIMESTAMP '2024-01-20 00:00:00'
            GROUP BY 1""",
        "shared_location": """SELECT type, 'shared' AS bucket_name, CAST(event_time AS DATE) AS event_date, count(*) AS n,
            CAST(COALESCE(sum(k), 0) AS BIGINT) AS sum_k, count(DISTINCT tenant_id) AS n_tenants FROM ok_all GROUP BY 1, 2, 3""",
        "readd_column": """SELECT CAST(event_time AS DATE) AS event_date, count(*) AS n,
            count(CASE WHEN batch_idx >= (SELECT 2 * n_batches // 3 FROM lake) THEN fault END) AS n_fault
            FROM ok_api GROUP BY 1""",
        "manifest_validity": """SELECT namespace, type, count(*) AS total_records FROM ok_all GROUP BY 1, 2""",
        "two_sources_ingest": """SELECT type, CAST(event_time AS DATE) AS event_date, count(*) AS n, count(*) AS n_ids
            FROM ok_all GROUP BY 1, 2""",
        "freshness": """SELECT namespace, type,
            count(DISTINCT CASE WHEN batch_idx < (SELECT half FROM lake) THEN 1 ELSE 2 END) AS n_merges, true AS lag_is_sound
            FROM ok_all GROUP BY 1, 2""",
        "stream_equals_batch": """SELECT type, CAST(event_time AS DATE) AS event_date, count(*) AS n FROM ok_all GROUP BY 1, 2""",
    }
    return {k: b + (v if v.lstrip().startswith(",") else "\n" + v) for k, v in q.items()}
