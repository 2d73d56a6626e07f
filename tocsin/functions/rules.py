"""The scheduling rule as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tocsin.schema import FALLBACK_DELAY_MS, FIXED_DELAY, FIXED_DELAY_MS, REQUESTED


def effective_time(requested: Column, now: Column, delay_ms: int = FALLBACK_DELAY_MS) -> Column:
    """The requested time if it lies after `now`, else `now` plus the delay.

    A missing time compares as null and takes the delay; so does a time equal to `now`.
    """
    return F.when(requested > now, requested).otherwise(now + F.lit(delay_ms))


def schedule_source(requested: Column, now: Column) -> Column:
    return F.when(requested > now, F.lit("provided")).otherwise(F.lit("fallback"))


def fixed_delay_time(now: Column, delay_ms: int = FIXED_DELAY_MS) -> Column:
    """A set delay after `now`, whatever was asked for."""
    return now + F.lit(delay_ms)


def known_policy(policy: str) -> str:
    if policy not in (REQUESTED, FIXED_DELAY):
        raise ValueError(f"unknown policy {policy!r}")
    return policy


def execution_time(policy: str, requested: Column, now: Column) -> Column:
    if known_policy(policy) == REQUESTED:
        return effective_time(requested, now)
    return fixed_delay_time(now)


def with_schedule(requests: DataFrame, policy: str = REQUESTED) -> DataFrame:
    """Add `exec_ms` and `schedule_source`, with each request's arrival as its `now`."""
    now = F.col("arrival_ms")
    if known_policy(policy) == FIXED_DELAY:
        return requests.withColumns(
            {"exec_ms": fixed_delay_time(now), "schedule_source": F.lit(FIXED_DELAY)}
        )
    requested = F.col("scheduled_at")
    return requests.withColumns(
        {
            "exec_ms": execution_time(policy, requested, now),
            "schedule_source": schedule_source(requested, now),
        }
    )
