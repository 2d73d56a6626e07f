"""The catalog's queries as plain SQL over the same tables, written independently of them."""

from __future__ import annotations

from tocsin.plans.catalog import MIDWAY_MS

_REQUESTS = """
requests AS (
  SELECT CAST(user_id AS VARCHAR) AS id, event_id AS seq, epoch_us(ts) // 1000 AS arrival_ms,
         CASE event_id % 5
           WHEN 0 THEN NULL
           WHEN 1 THEN epoch_us(ts) // 1000 - 60000
           ELSE epoch_us(ts) // 1000 + CAST(floor(value * 600) AS BIGINT) * 1000
         END AS scheduled_at,
         event_type AS status
  FROM events)"""

_HOT = """
requests AS (
  SELECT * REPLACE (CASE WHEN seq % 3 = 0 THEN 'hot' ELSE id END AS id) FROM plain)"""

_TASKS = """
requests AS (
  SELECT * REPLACE ('00000000-0000-4000-8abc-' || lpad(id, 12, '0') AS id) FROM plain)"""

_REQUESTED_TIME = "CASE WHEN scheduled_at > arrival_ms THEN scheduled_at ELSE arrival_ms + 30000 END"
_FIXED_TIME = "arrival_ms + 300000"


def _with(log: str = _REQUESTS, exec_ms: str = _REQUESTED_TIME, as_of: str | None = None) -> str:
    """Common tables: requests, horizon, scheduled, resolved and timers."""
    if log is not _REQUESTS:
        log = _REQUESTS.replace("requests AS", "plain AS") + "," + log
    horizon = as_of or "(SELECT max(arrival_ms) FROM requests)"
    return f"""
WITH {log},
horizon AS (SELECT {horizon} AS as_of),
scheduled AS (
  SELECT r.*, {exec_ms} AS exec_ms,
         CASE WHEN scheduled_at > arrival_ms THEN 'provided' ELSE 'fallback' END AS schedule_source
  FROM requests r WHERE arrival_ms <= (SELECT as_of FROM horizon)),
followed AS (
  SELECT *, lead(arrival_ms) OVER (PARTITION BY id ORDER BY arrival_ms, seq) AS next_arrival_ms
  FROM scheduled),
resolved AS (
  SELECT *, next_arrival_ms IS NULL OR next_arrival_ms > exec_ms AS live,
         exec_ms <= (SELECT as_of FROM horizon) AS due
  FROM followed),
fired AS (SELECT id, exec_ms FROM resolved WHERE live AND due),
pending AS (SELECT id, exec_ms FROM resolved WHERE live AND NOT due),
stale AS (
  SELECT DISTINCT id, exec_ms FROM resolved WHERE due EXCEPT SELECT id, exec_ms FROM fired),
armed AS (
  SELECT DISTINCT id, exec_ms FROM resolved WHERE NOT due EXCEPT SELECT id, exec_ms FROM pending),
latest AS (
  SELECT id, arrival_ms, arg_max(exec_ms, seq) AS held FROM scheduled GROUP BY id, arrival_ms),
mismatch AS (
  SELECT s.id, s.exec_ms AS timer_ms, CASE WHEN l.held > s.exec_ms THEN l.held END AS expected_ms
  FROM stale s ASOF JOIN latest l ON s.id = l.id AND s.exec_ms >= l.arrival_ms)
"""


_READY = """
SELECT CAST(NULL AS BIGINT) AS bucket_id, id, CAST(NULL AS VARCHAR) AS tenant,
       exec_ms AS scheduled_at, 'READY_FOR_EXECUTION' AS status FROM fired"""

_READY_TASK = """
SELECT id, CAST(NULL AS VARCHAR) AS name, CAST(NULL AS VARCHAR) AS description,
       'READY_FOR_EXECUTION' AS status, CAST(NULL AS VARCHAR) AS cron_expression,
       CAST(NULL AS BIGINT) AS next_execution_time, CAST(NULL AS BIGINT) AS created_at,
       exec_ms * 1000 AS updated_at, CAST(NULL AS VARCHAR) AS parameters,
       CAST(NULL AS VARCHAR) AS created_by, CAST(NULL AS VARCHAR) AS assigned_to,
       CAST(0 AS INTEGER) AS retry_count, CAST(0 AS INTEGER) AS current_retries,
       CAST(0 AS INTEGER) AS max_retries, CAST(0 AS BIGINT) AS retry_delay_ms,
       CAST(NULL AS VARCHAR) AS execution_result, CAST(NULL AS VARCHAR) AS error_message
FROM fired"""

_READY_JSON = (
    """'{"bucketId":null,"id":"' || id || '","tenant":null,"scheduledAt":' || exec_ms"""
    """ || ',"status":"READY_FOR_EXECUTION"}'"""
)

_ISO = "strftime(make_timestamp({us}), '%Y-%m-%dT%H:%M:%S.%fZ')"

# Instants of the full-task logs are in microseconds.
_CREATED = "arrival_ms * 1000 + seq % 1000"

_READY_TASK_JSON = (
    """'{"id":"' || id || '","name":null,"description":null,"status":"READY_FOR_EXECUTION",'
    || '"cronExpression":null,"nextExecutionTime":null,"createdAt":null,"updatedAt":"'
    || """
    + _ISO.format(us="exec_ms * 1000")
    + """ || '","parameters":null,"createdBy":null,"assignedTo":null,"retryCount":0,'
    || '"currentRetries":0,"maxRetries":0,"retryDelayMs":0,"executionResult":null,'
    || '"errorMessage":null}'"""
)

# The records that can be read out of the mixed payloads.
_ACCEPTED = """
accepted AS (
  SELECT CASE WHEN seq % 20 IN (11, 12, 14, 15) THEN NULL ELSE CAST(id AS BIGINT) END AS bucket_id,
         id,
         CASE WHEN seq % 20 IN (11, 12, 14, 15, 16) THEN NULL ELSE status END AS tenant,
         CASE WHEN seq % 20 IN (11, 12, 14, 15) THEN arrival_ms
              WHEN seq % 20 = 16 THEN NULL ELSE scheduled_at END AS scheduled_at,
         CASE WHEN seq % 20 IN (11, 12, 14, 15, 16) THEN NULL ELSE 'NEW' END AS status,
         arrival_ms, seq
  FROM plain WHERE seq % 20 > 10)"""

_REASON = """CASE seq % 20
         WHEN 0 THEN 'empty' WHEN 1 THEN 'empty' WHEN 2 THEN 'malformed' WHEN 3 THEN 'malformed'
         WHEN 4 THEN 'bad_type' WHEN 5 THEN 'bad_type' WHEN 6 THEN 'overflow' WHEN 7 THEN 'bad_type'
         WHEN 8 THEN 'missing_id' WHEN 9 THEN 'missing_id' WHEN 10 THEN 'malformed' END"""

_PLAIN_LENGTH = """length('{"bucketId":' || id || ',"id":"' || id || '","tenant":"' || status
                || '","scheduledAt":' || coalesce(CAST(scheduled_at AS VARCHAR), 'null') || ',"status":"NEW"}')"""

_TASK_REASON = """CASE seq % 12
         WHEN 0 THEN 'bad_uuid' WHEN 1 THEN 'overflow' WHEN 2 THEN 'bad_type'
         WHEN 3 THEN 'bad_type' WHEN 4 THEN 'missing_id'
         WHEN 9 THEN 'overflow' WHEN 10 THEN 'overflow' END"""


def _counts(reason: str) -> str:
    return f"""
WITH {_REQUESTS}, judged AS (SELECT {reason} AS reason FROM requests)
SELECT CASE WHEN reason IS NULL THEN 'DESERIALIZE' ELSE 'DESERIALIZE-ERROR' END AS phase,
       reason, count(*) AS n
FROM judged GROUP BY 1, 2"""


_AUDIT = f"""
audit AS (
  SELECT 'INBOUND' AS phase, id, arrival_ms AS at_ms, NULL AS exec_ms, NULL AS expected_ms,
         NULL AS bytes, status AS detail FROM scheduled
  UNION ALL
  SELECT 'PROCESSING', id, arrival_ms, exec_ms, NULL, NULL, schedule_source FROM scheduled
  UNION ALL
  SELECT 'TIMER-REGISTERED', id, arrival_ms, exec_ms, NULL, NULL, NULL FROM scheduled
  UNION ALL
  SELECT 'TIMER-FIRED', id, exec_ms, NULL, NULL, NULL, NULL
  FROM (SELECT id, exec_ms FROM fired UNION ALL SELECT id, exec_ms FROM stale)
  UNION ALL
  SELECT 'SERIALIZE', id, exec_ms, NULL, NULL, length({_READY_JSON}), NULL FROM fired
  UNION ALL
  SELECT 'TIMER-COMPLETED', id, exec_ms, NULL, NULL, NULL, NULL FROM fired
  UNION ALL
  SELECT 'TIMER-MISMATCH', id, timer_ms, NULL, expected_ms, NULL, NULL FROM mismatch)"""

_TASK_AUDIT = _AUDIT.replace(_READY_JSON, _READY_TASK_JSON).replace(
    "schedule_source FROM scheduled", "'fixed_delay' FROM scheduled"
)

_OUTCOMES = """
SELECT 'fired' AS outcome, * FROM fired
UNION ALL SELECT 'pending', * FROM pending
UNION ALL SELECT 'stale', * FROM stale
UNION ALL SELECT 'armed_superseded', * FROM armed"""

_MIXED_READY = (
    _with("\nrequests AS (SELECT id, seq, arrival_ms, scheduled_at, status FROM accepted)").replace(
        "requests AS (SELECT", _ACCEPTED + ",\nrequests AS (SELECT", 1
    )
)

_UUID = "'00000000-0000-4000-8abc-' || lpad(id, 12, '0')"

# Stamps that fall back within a partition count as the latest so far.
_READ = """
requests AS (
  SELECT id, row_number() OVER (ORDER BY part, place) AS seq, status, scheduled_at,
         max(arrival_ms - seq % 7 * 1500) OVER (PARTITION BY part ORDER BY place) AS arrival_ms
  FROM (SELECT *, seq % 4 AS part, arrival_ms * 1000000 + seq AS place FROM plain))"""

_READABLE_TASKS = """
requests AS (
  SELECT '00000000-0000-4000-8abc-' || lpad(id, 12, '0') AS id, seq, arrival_ms, NULL AS scheduled_at,
         CASE WHEN seq % 12 IN (5, 7, 8) THEN NULL ELSE 'NEW' END AS status
  FROM plain WHERE seq % 12 IN (5, 6, 7, 8, 11))"""

_TASK_JSON = (
    f"""'{{"id":"' || {_UUID} || '","name":"' || status || '","description":null,"status":"NEW",'
    || '"cronExpression":"0 * * * *","nextExecutionTime":null,"createdAt":"'
    || """
    + _ISO.format(us=_CREATED)
    + """ || '","updatedAt":null,"parameters":{"count":"' || id || '","kind":"' || status
    || '"},"createdBy":"u' || id || '","assignedTo":null,"retryCount":0,"currentRetries":0,'
    || '"maxRetries":3,"retryDelayMs":0,"executionResult":null,"errorMessage":null}'"""
)

ORACLE: dict[str, str] = {
    "effective_schedule": _with()
    + "SELECT id, seq, arrival_ms, scheduled_at, exec_ms, schedule_source FROM scheduled",
    "schedule_provenance": _with()
    + "SELECT schedule_source, count(*) AS n FROM scheduled GROUP BY schedule_source",
    "annotated_requests": _with()
    + "SELECT id, seq, scheduled_at, 'SCHEDULED' AS status, exec_ms FROM scheduled",
    "fixed_delay_annotated": _with(_TASKS, _FIXED_TIME)
    + """SELECT id, seq, 'SCHEDULED' AS status, exec_ms AS next_execution_ms,
                arrival_ms AS updated_ms FROM scheduled""",
    "ready": _with() + _READY,
    "pending_as_of": _with(as_of=str(MIDWAY_MS))
    + "SELECT id, seq, exec_ms FROM resolved WHERE live AND NOT due",
    "superseded_requests": _with()
    + "SELECT id, seq, exec_ms, next_arrival_ms FROM resolved WHERE NOT live",
    "stale_timers": _with() + "SELECT id, exec_ms FROM stale",
    "timer_outcomes": _with(as_of=str(MIDWAY_MS))
    + f"SELECT outcome, count(*) AS n FROM ({_OUTCOMES}) GROUP BY outcome",
    "timer_mismatch_expected": _with() + "SELECT id, timer_ms, expected_ms FROM mismatch",
    "fixed_delay_ready": _with(_TASKS, _FIXED_TIME) + _READY_TASK,
    "fixed_delay_mismatch": _with(_TASKS, _FIXED_TIME)
    + "SELECT id, timer_ms, expected_ms FROM mismatch",
    "hot_id_ready": _with(_HOT) + _READY,
    "hot_id_timer_outcomes": _with(_HOT) + f"SELECT id, exec_ms, outcome FROM ({_OUTCOMES})",
    "hot_id_mismatch_expected": _with(_HOT) + "SELECT id, timer_ms, expected_ms FROM mismatch",
    "decode_requests": f"""
WITH {_REQUESTS.replace("requests AS", "plain AS")}, {_ACCEPTED}
SELECT bucket_id, id, tenant, scheduled_at, status, arrival_ms, seq AS "offset" FROM accepted""",
    "quarantined_requests": f"""
WITH {_REQUESTS}
SELECT {_REASON} AS reason, arrival_ms, seq AS "offset",
       CAST(CASE seq % 20
         WHEN 0 THEN 0 WHEN 1 THEN 4
         WHEN 2 THEN {_PLAIN_LENGTH} - 1
         WHEN 3 THEN {_PLAIN_LENGTH}
         WHEN 4 THEN length('{{"id":"' || id || '","scheduledAt":"abc"}}')
         WHEN 5 THEN length('{{"id":"' || id || '","scheduledAt":true}}')
         WHEN 6 THEN length('{{"id":"' || id || '","scheduledAt":99999999999999999999}}')
         WHEN 7 THEN length('{{"id":{{"x":' || id || '}},"scheduledAt":' || arrival_ms || '}}')
         WHEN 8 THEN length('{{"bucketId":' || id || ',"scheduledAt":' || arrival_ms || '}}')
         WHEN 9 THEN length('{{"ID":"' || id || '","scheduledAt":' || arrival_ms || '}}')
         WHEN 10 THEN {_PLAIN_LENGTH} + 1
       END AS INTEGER) AS bytes
FROM requests WHERE seq % 20 <= 10""",
    "quarantine_counts": _counts(_REASON),
    "decode_tasks": f"""
WITH {_REQUESTS}
SELECT {_UUID} AS id,
       CASE seq % 12 WHEN 7 THEN NULL WHEN 8 THEN id ELSE status END AS name,
       CAST(NULL AS VARCHAR) AS description,
       CASE WHEN seq % 12 IN (5, 7, 8) THEN NULL ELSE 'NEW' END AS status,
       CASE WHEN seq % 12 IN (5, 7, 8) THEN NULL ELSE '0 * * * *' END AS cron_expression,
       CAST(NULL AS BIGINT) AS next_execution_time,
       CASE WHEN seq % 12 IN (5, 7, 8) THEN NULL ELSE {_CREATED} END AS created_at,
       CAST(NULL AS BIGINT) AS updated_at,
       CASE seq % 12 WHEN 5 THEN NULL WHEN 7 THEN NULL WHEN 8 THEN '{{}}'
         ELSE '{{"count":"' || id || '","kind":"' || status || '"}}' END AS parameters,
       CASE WHEN seq % 12 IN (5, 7, 8) THEN NULL ELSE 'u' || id END AS created_by,
       CAST(NULL AS VARCHAR) AS assigned_to,
       CAST(CASE seq % 12 WHEN 6 THEN CAST(id AS INTEGER) ELSE 0 END AS INTEGER) AS retry_count,
       CAST(0 AS INTEGER) AS current_retries,
       CAST(CASE seq % 12 WHEN 6 THEN 2 WHEN 5 THEN 0 WHEN 7 THEN 0 WHEN 8 THEN 0 ELSE 3 END
            AS INTEGER) AS max_retries,
       CASE seq % 12 WHEN 6 THEN arrival_ms ELSE 0 END AS retry_delay_ms,
       CAST(NULL AS VARCHAR) AS execution_result, CAST(NULL AS VARCHAR) AS error_message,
       seq AS "offset"
FROM requests WHERE seq % 12 IN (5, 6, 7, 8, 11)""",
    "quarantine_task_counts": _counts(_TASK_REASON),
    "encode_ready": _with() + f"SELECT {_READY_JSON} AS value FROM fired",
    "encode_ready_tasks": _with(_TASKS, _FIXED_TIME)
    + f"SELECT {_READY_TASK_JSON} AS value FROM fired",
    "encode_requests": f"""
WITH {_REQUESTS}
SELECT '{{"bucketId":' || id || ',"id":"' || id || '","tenant":"' || status || '","scheduledAt":'
       || coalesce(CAST(scheduled_at AS VARCHAR), 'null') || ',"status":"NEW"}}' AS value
FROM requests""",
    "encode_tasks": f"WITH {_REQUESTS} SELECT {_TASK_JSON} AS value FROM requests",
    "payloads_to_ready": _MIXED_READY + f"SELECT {_READY_JSON} AS value FROM fired",
    "delivered_once": _with() + _READY,
    "audit_log": _with().rstrip() + "," + _AUDIT
    + """
SELECT id, phase, CAST(at_ms AS BIGINT) AS at_ms, CAST(exec_ms AS BIGINT) AS exec_ms,
       CAST(expected_ms AS BIGINT) AS expected_ms, CAST(bytes AS INTEGER) AS bytes, detail
FROM audit""",
    "audit_summary": _with().rstrip() + "," + _AUDIT
    + "\nSELECT phase, count(*) AS n FROM audit GROUP BY phase",
    "audit_task_log": _with(_READABLE_TASKS, _FIXED_TIME).rstrip() + "," + _TASK_AUDIT
    + f"""
SELECT id, phase, CAST(at_ms AS BIGINT) AS at_ms, CAST(exec_ms AS BIGINT) AS exec_ms,
       CAST(expected_ms AS BIGINT) AS expected_ms, CAST(bytes AS INTEGER) AS bytes, detail
FROM (SELECT * FROM audit
      UNION ALL
      SELECT 'DESERIALIZE', id, arrival_ms, NULL, NULL, NULL, NULL FROM requests
      UNION ALL
      SELECT 'DESERIALIZE-ERROR', NULL, arrival_ms, NULL, NULL, NULL, {_TASK_REASON}
      FROM plain WHERE seq % 12 NOT IN (5, 6, 7, 8, 11))""",
    "offset_order_ready": _with(_READ) + _READY,
    "stream_ready": _with() + _READY,
    "stream_ready_partitions": _with() + _READY,
    "stream_keyed_ready": _with() + _READY,
    "stream_keyed_ready_partitions": _with() + _READY,
    "stream_keyed_offset_order_ready": _with(_READ) + _READY,
    "live_pending": _with(as_of=str(MIDWAY_MS)) + "SELECT id, exec_ms FROM pending",
    "live_timers": _with(as_of=str(MIDWAY_MS))
    + f"SELECT id, exec_ms, outcome FROM ({_OUTCOMES}) WHERE outcome IN ('pending', 'armed_superseded')",
    "stream_seeded_ready": _with() + _READY,
    "stream_reconciliation": _with(as_of=str(MIDWAY_MS))
    + f"""SELECT outcome, count(*) AS n, CAST(0 AS BIGINT) AS missing, '0' AS difference
FROM (SELECT outcome FROM ({_OUTCOMES}) UNION ALL SELECT 'armed' FROM (SELECT DISTINCT id, exec_ms FROM resolved))
GROUP BY outcome""",
    "audit_lateness": _with()
    + """SELECT 'lateness_ms' AS phase, (SELECT count(*) FROM fired) AS n, part, true AS within_rank_error
FROM (SELECT unnest([0.5, 0.9, 0.99]::DOUBLE[]) AS part)""",
    "stream_delivered_once": _with() + _READY,
    "ready_from_snapshot": _with() + _READY,
    "pending_from_snapshot": _with(as_of=str(MIDWAY_MS + 86_400_000))
    + "SELECT id, seq, exec_ms FROM resolved WHERE live AND NOT due",
    "stream_offset_order_ready": _with(_READ) + _READY,
    "stream_set_offset_order_ready": _with(_READ) + _READY,
    "stream_mismatch_expected": _with() + "SELECT id, timer_ms, expected_ms FROM mismatch",
    "stream_hot_id_audit": _with(_HOT).rstrip() + "," + _AUDIT
    + """
SELECT id, phase, CAST(at_ms AS BIGINT) AS at_ms, CAST(exec_ms AS BIGINT) AS exec_ms,
       CAST(expected_ms AS BIGINT) AS expected_ms, CAST(bytes AS INTEGER) AS bytes, detail
FROM (SELECT * FROM audit
      UNION ALL
      SELECT 'DESERIALIZE', id, arrival_ms, NULL, NULL, NULL, NULL FROM requests)""",
    "stream_hot_id_mismatch_expected": _with(_HOT) + "SELECT id, timer_ms, expected_ms FROM mismatch",
    "stream_keyed_fixed_delay_ready": _with(_TASKS, _FIXED_TIME) + _READY_TASK,
    "stream_fixed_delay_ready": _with(_TASKS, _FIXED_TIME) + _READY_TASK,
    "stream_fanout": _MIXED_READY
    + """
SELECT 'topic' AS sink, count(*) AS n FROM fired
UNION ALL SELECT 'monitor', count(*) FROM fired""",
}
