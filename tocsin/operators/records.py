"""The records that go out: ready records, annotated requests, and their JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tocsin.functions import codec
from tocsin.functions.rules import known_policy, with_schedule
from tocsin.operators.resolve import resolve
from tocsin.schema import (
    FIRED,
    FIXED_DELAY,
    READY,
    REQUEST_FIELDS,
    REQUESTED,
    SCHEDULED,
    SPARK_TYPE,
    TASK_FIELDS,
)


def record_fields(policy: str) -> list[tuple[str, str, str]]:
    return TASK_FIELDS if known_policy(policy) == FIXED_DELAY else REQUEST_FIELDS


def _ready_values(policy: str) -> list[Column]:
    """Of a fired schedule only the id and the time its timer was set for go out.

    All other fields are null, or zero where null is not allowed.
    """
    known = {"id": F.col("id"), "status": F.lit(READY)}
    if policy == FIXED_DELAY:
        known["updated_at"] = F.timestamp_millis("exec_ms")
    else:
        known["scheduled_at"] = F.col("exec_ms")
    return [
        known.get(column, F.lit(0 if kind.endswith("0") else None)).cast(SPARK_TYPE[kind])
        for column, _, kind in record_fields(policy)
    ]


def ready_records(fired: DataFrame, policy: str = REQUESTED) -> DataFrame:
    """Ready records from fired schedules, `id` and `exec_ms`."""
    names = [column for column, _, _ in record_fields(policy)]
    return fired.select(*[value.alias(name) for name, value in zip(names, _ready_values(policy))])


def ready_payload(policy: str = REQUESTED) -> Column:
    """The JSON text of the ready record of a fired schedule."""
    return codec.encode(record_fields(policy), _ready_values(policy))


def ready(requests: DataFrame, as_of: int, policy: str = REQUESTED, **options) -> DataFrame:
    """The records a log has made ready by `as_of`."""
    fired = resolve(requests, as_of, policy, **options).where(F.col("outcome") == FIRED)
    return ready_records(fired, policy)


def annotate_requests(requests: DataFrame, policy: str = REQUESTED) -> DataFrame:
    """Requests stamped as scheduled; a full task also gets the time it will run at."""
    stamped = with_schedule(requests, policy).withColumn("status", F.lit(SCHEDULED))
    if policy == FIXED_DELAY:
        stamped = stamped.withColumns(
            {
                "next_execution_time": F.timestamp_millis("exec_ms"),
                "updated_at": F.timestamp_millis("arrival_ms"),
            }
        )
    return stamped


def encode_records(records: DataFrame, policy: str = REQUESTED) -> DataFrame:
    """The single `value` column a topic takes."""
    return records.select(codec.encode(record_fields(policy)).alias("value"))


def once(records: DataFrame, policy: str = REQUESTED, within: str = "1 hour") -> DataFrame:
    """Ready records without the repetitions that an at-least-once sink may leave.

    An id and the time it was set for occur once in a history. A stream needs `arrival_ms`, and
    forgets a record once the stream has moved on by `within`.
    """
    keys = ["id", "updated_at" if known_policy(policy) == FIXED_DELAY else "scheduled_at"]
    if not records.isStreaming:
        return records.dropDuplicates(keys)
    timed = records.withColumn("_arrived", F.timestamp_millis("arrival_ms"))
    return timed.withWatermark("_arrived", within).dropDuplicatesWithinWatermark(keys).drop("_arrived")
