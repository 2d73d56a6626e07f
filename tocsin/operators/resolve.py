"""What became of every request and every timer, as window queries over a request log.

For the requests of an id in order of `(arrival_ms, seq)`, a schedule stays alive exactly when no
later request arrives at or before its time; a live schedule emits once.

    live  <=>  next arrival is missing  or  next arrival > exec_ms

Input: `id, arrival_ms, seq, scheduled_at` and whatever should travel along. `seq` may be any
type that sorts; it settles the order within a millisecond and must be unique within an id.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tocsin.functions.rules import with_schedule
from tocsin.operators.slices import TARGET_ROWS, Slices, assign_slices, plan_slices
from tocsin.schema import ARMED_SUPERSEDED, FIRED, PENDING, REQUESTED, STALE, SUPERSEDED

ORDER = ["arrival_ms", "seq"]


class LogStats(NamedTuple):
    rows: int
    last_arrival_ms: int | None


def log_stats(requests: DataFrame) -> LogStats:
    """Row count and last arrival, from one narrow pass."""
    row = requests.agg(F.count(F.lit(1)), F.max("arrival_ms")).first()
    return LogStats(row[0], row[1])


def history(requests: DataFrame, as_of: int | None, policy: str = REQUESTED) -> DataFrame:
    """Keyed requests up to the horizon, with their effective times."""
    keyed = requests.where(F.col("id").isNotNull())
    if as_of is not None:
        keyed = keyed.where(F.col("arrival_ms") <= as_of)
    return with_schedule(keyed, policy)


def with_next_arrival(scheduled: DataFrame, slices: Slices | None) -> DataFrame:
    """Add `next_arrival_ms`, the arrival of the id's next request.

    Cuts are rows of the same log, so the next row after the last one of a slice is the cut
    that starts the following slice: no second pass is needed to join slices up.
    """
    if slices is None:
        window = Window.partitionBy("id").orderBy(*ORDER)
        return scheduled.withColumn("next_arrival_ms", F.lead("arrival_ms").over(window))
    window = Window.partitionBy("id", "_slice").orderBy(*ORDER)
    following = F.lead("arrival_ms").over(window)
    return (
        assign_slices(scheduled, slices, F.struct(*ORDER))
        .withColumn("_next_cut", F.col("_next_cut")["arrival_ms"])
        .withColumn("next_arrival_ms", F.coalesce(following, F.col("_next_cut")))
        .drop("_slice", "_next_cut")
    )


def plan_history(scheduled: DataFrame, rows: int, target_rows: int = TARGET_ROWS) -> Slices | None:
    return plan_slices(scheduled, ORDER, rows, target_rows)


def judge(scheduled: DataFrame, slices: Slices | None, as_of: int | None) -> DataFrame:
    """Add `next_arrival_ms`, `live` and `outcome` to requests that have an `exec_ms`."""
    following, exec_ms = F.col("next_arrival_ms"), F.col("exec_ms")
    due = F.lit(True) if as_of is None else exec_ms <= as_of
    return (
        with_next_arrival(scheduled, slices)
        .withColumn("live", following.isNull() | (following > exec_ms))
        .withColumn(
            "outcome",
            F.when(~F.col("live"), F.lit(SUPERSEDED)).when(due, F.lit(FIRED)).otherwise(F.lit(PENDING)),
        )
    )


def resolve(
    requests: DataFrame,
    as_of: int | None = None,
    policy: str = REQUESTED,
    rows: int | None = None,
    target_rows: int = TARGET_ROWS,
) -> DataFrame:
    """Every request with its `outcome` at the inclusive horizon `as_of` (None: the end of time).

    `rows` is the size of the log, if known; otherwise it is counted.
    """
    scheduled = history(requests, as_of, policy)
    if rows is None:
        rows = log_stats(scheduled).rows
    return judge(scheduled, plan_history(scheduled, rows, target_rows), as_of)


def timer_outcomes(resolved: DataFrame, as_of: int | None = None) -> DataFrame:
    """One row per armed timer, a distinct `(id, exec_ms)`, with what became of it.

    At most one request of a timer is live. Grouping within an id reuses the window's exchange.
    """
    due = F.lit(True) if as_of is None else F.col("exec_ms") <= as_of
    return (
        resolved.groupBy("id", "exec_ms")
        .agg(F.max("live").alias("live"))
        .select(
            "id",
            "exec_ms",
            F.when(F.col("live") & due, F.lit(FIRED))
            .when(F.col("live"), F.lit(PENDING))
            .when(due, F.lit(STALE))
            .otherwise(F.lit(ARMED_SUPERSEDED))
            .alias("outcome"),
        )
    )
