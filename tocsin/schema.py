"""Records, vocabulary and delays shared by the batch and streaming forms."""

from __future__ import annotations

# Fixed values of the data contract.
READY = "READY_FOR_EXECUTION"
SCHEDULED = "SCHEDULED"
FALLBACK_DELAY_MS = 30_000
FIXED_DELAY_MS = 300_000

# How the effective time is chosen.
REQUESTED = "requested"
FIXED_DELAY = "fixed_delay"

# What became of a request.
FIRED = "fired"
PENDING = "pending"
SUPERSEDED = "superseded"
AHEAD = "ahead"

# What became of a timer (distinct id and time); FIRED and PENDING as above.
STALE = "stale"
ARMED_SUPERSEDED = "armed_superseded"

# What else the running job reports.
ACCEPTED = "accepted"
QUARANTINED = "quarantined"
LATE = "late"

# Why a payload was set aside.
EMPTY = "empty"
MALFORMED = "malformed"
BAD_TYPE = "bad_type"
OVERFLOW = "overflow"
BAD_UUID = "bad_uuid"
MISSING_ID = "missing_id"

# Fields of the two record types: column, JSON key, kind.
REQUEST_FIELDS = [
    ("bucket_id", "bucketId", "long"),
    ("id", "id", "text"),
    ("tenant", "tenant", "text"),
    ("scheduled_at", "scheduledAt", "long"),
    ("status", "status", "text"),
]
TASK_FIELDS = [
    ("id", "id", "uuid"),
    ("name", "name", "text"),
    ("description", "description", "text"),
    ("status", "status", "text"),
    ("cron_expression", "cronExpression", "text"),
    ("next_execution_time", "nextExecutionTime", "instant"),
    ("created_at", "createdAt", "instant"),
    ("updated_at", "updatedAt", "instant"),
    ("parameters", "parameters", "text_map"),
    ("created_by", "createdBy", "text"),
    ("assigned_to", "assignedTo", "text"),
    ("retry_count", "retryCount", "int0"),
    ("current_retries", "currentRetries", "int0"),
    ("max_retries", "maxRetries", "int0"),
    ("retry_delay_ms", "retryDelayMs", "long0"),
    ("execution_result", "executionResult", "text"),
    ("error_message", "errorMessage", "text"),
]

# The Spark type of each kind.
SPARK_TYPE = {
    "text": "string",
    "uuid": "string",
    "long": "bigint",
    "long0": "bigint",
    "int0": "int",
    "instant": "timestamp",
    "text_map": "map<string,string>",
}

# Columns a source adds around the payload.
ENVELOPE = "value binary, arrival_ms bigint, partition int, offset bigint"
