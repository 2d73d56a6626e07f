"""What happened to each request and timer, one row per step, and counts of the steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tocsin.functions.rules import schedule_source
from tocsin.operators.decode import Decoded
from tocsin.operators.expected import gone_off
from tocsin.operators.records import ready_payload
from tocsin.operators.resolve import history
from tocsin.schema import ACCEPTED, FIRED, FIXED_DELAY, QUARANTINED, REQUESTED, STALE

_COLUMNS = {
    "at_ms": "bigint",
    "exec_ms": "bigint",
    "expected_ms": "bigint",
    "bytes": "int",
    "detail": "string",
}


def _step(phase: str, **known: Column) -> Column:
    rest = [
        known.get(name, F.lit(None)).cast(spark_type).alias(name)
        for name, spark_type in _COLUMNS.items()
    ]
    return F.struct(F.lit(phase).alias("phase"), *rest)


def _steps(rows: DataFrame, *steps: Column) -> DataFrame:
    """Each step of each row; a null step is one that did not happen."""
    return (
        rows.select("id", F.explode(F.array(*steps)).alias("step"))
        .where(F.col("step").isNotNull())
        .select("id", "step.*")
    )


def accepted_steps(scheduled: DataFrame) -> DataFrame:
    """Steps taken on arrival, of requests with their schedule. They need no other row, hence no
    shuffle."""
    arrival, exec_ms = F.col("arrival_ms"), F.col("exec_ms")
    return _steps(
        scheduled,
        _step("INBOUND", at_ms=arrival, detail=F.col("status")),
        _step("PROCESSING", at_ms=arrival, exec_ms=exec_ms, detail=F.col("schedule_source")),
        _step("TIMER-REGISTERED", at_ms=arrival, exec_ms=exec_ms),
    )


def request_steps(requests: DataFrame, as_of: int, policy: str = REQUESTED) -> DataFrame:
    return accepted_steps(history(requests, as_of, policy))


def gone_off_steps(timers: DataFrame, policy: str = REQUESTED) -> DataFrame:
    """Steps taken when a timer goes off, from `id, exec_ms, outcome, expected_ms`."""
    at = F.col("exec_ms")
    fired = F.col("outcome") == FIRED
    return _steps(
        timers,
        _step("TIMER-FIRED", at_ms=at),
        F.when(fired, _step("SERIALIZE", at_ms=at, bytes=F.octet_length(ready_payload(policy)))),
        F.when(fired, _step("TIMER-COMPLETED", at_ms=at)),
        F.when(
            F.col("outcome") == STALE,
            _step("TIMER-MISMATCH", at_ms=at, expected_ms=F.col("expected_ms")),
        ),
    )


def timer_steps(
    requests: DataFrame, as_of: int, policy: str = REQUESTED, **options
) -> DataFrame:
    return gone_off_steps(gone_off(requests, as_of, policy, **options), policy)


def live_steps(
    rows: DataFrame, policy: str = REQUESTED, sent_ms: tuple[int, int] | None = None
) -> DataFrame:
    """The steps that a micro-batch of the running job has taken, from what its processor yields:
    `outcome`, `id`, `exec_ms` and `at_ms` with what belongs to the outcome. Durations are in
    microseconds, in `detail`. `sent_ms` is when sending out the micro-batch began and ended."""
    outcome, at, exec_ms = F.col("outcome"), F.col("at_ms"), F.col("exec_ms")
    accepted, fired = outcome == ACCEPTED, outcome == FIRED
    if policy == FIXED_DELAY:
        source = F.lit(FIXED_DELAY)
    else:
        source = schedule_source(F.col("scheduled_at"), at)
    off = fired | (outcome == STALE)
    return _steps(
        rows,
        F.when(outcome == QUARANTINED, _step("DESERIALIZE-ERROR", at_ms=at, detail=F.col("reason"))),
        F.when(accepted, _step("DESERIALIZE", at_ms=at)),
        F.when(accepted, _step("INBOUND", at_ms=at, detail=F.col("status"))),
        F.when(accepted, _step("PROCESSING", at_ms=at, exec_ms=exec_ms, detail=source)),
        F.when(accepted, _step("TIMER-REGISTERED", at_ms=at, exec_ms=exec_ms)),
        F.when(accepted, _step("PROCESSING-COMPLETE", at_ms=at, detail=F.col("took_us"))),
        F.when(accepted, _step("SUMMARY", at_ms=at, exec_ms=exec_ms, detail=F.col("took_us"))),
        F.when(off, _step("TIMER-FIRED", at_ms=exec_ms)),
        F.when(off, _step("TIMER-PROCESSING", at_ms=at, exec_ms=exec_ms, detail=F.col("took_us"))),
        *(
            F.when(fired, _step(phase, at_ms=F.lit(moment), exec_ms=exec_ms))
            for phase, moment in zip(("TIMER-OUTBOUND-BEFORE", "TIMER-OUTBOUND-AFTER"), sent_ms or ())
        ),
        F.when(fired, _step("SERIALIZE", at_ms=exec_ms, bytes=F.octet_length(ready_payload(policy)))),
        F.when(fired, _step("TIMER-COMPLETED", at_ms=exec_ms)),
        F.when(outcome == STALE, _step("TIMER-MISMATCH", at_ms=exec_ms, expected_ms=F.col("expected_ms"))),
    )


def read_steps(tagged: DataFrame) -> DataFrame:
    """A step for each payload: read, or set aside and why. Rows without `reason` were read."""
    reason = F.col("reason") if "reason" in tagged.columns else F.lit(None).cast("string")
    arrival = F.col("arrival_ms")
    return _steps(
        tagged,
        F.when(reason.isNull(), _step("DESERIALIZE", at_ms=arrival)),
        F.when(reason.isNotNull(), _step("DESERIALIZE-ERROR", at_ms=arrival, detail=reason)),
    )


def decode_steps(decoded: Decoded) -> DataFrame:
    return read_steps(decoded.tagged)


def audit_log(requests: DataFrame, as_of: int, policy: str = REQUESTED, **options) -> DataFrame:
    return request_steps(requests, as_of, policy).unionByName(
        timer_steps(requests, as_of, policy, **options)
    )


def audit_summary(log: DataFrame) -> DataFrame:
    return log.groupBy("phase").agg(F.count(F.lit(1)).alias("n"))


def decode_summary(decoded: Decoded) -> DataFrame:
    """How many payloads were read, and how many were set aside for which reason."""
    read = F.col("reason").isNull()
    return (
        decoded.tagged.groupBy("reason")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.when(read, F.lit("DESERIALIZE")).otherwise(F.lit("DESERIALIZE-ERROR")).alias("phase"), "reason", "n")
    )
