"""The time an id was waiting for when one of its timers went off.

Put the requests and timers of an id on one line, requests first at the same millisecond. What
the id waits for at a timer is the time of the last request before it. If that is the timer's own
time it fires. If it is a later time, that is what was expected instead; if an earlier one, it has
fired by then and nothing was expected.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tocsin.operators.resolve import ORDER, history, log_stats
from tocsin.operators.slices import TARGET_ROWS, Slices, assign_slices, plan_slices, slice_list
from tocsin.schema import FIRED, REQUESTED, STALE

# Ship the code below with the job, so that executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_POSITION = ["t", "kind", "seq"]


def _as_request() -> list[Column]:
    return [
        F.col("arrival_ms").alias("t"),
        F.lit(0).alias("kind"),
        F.col("seq").alias("seq"),
        F.col("exec_ms").alias("held"),
    ]


def _as_timer(scheduled: DataFrame) -> list[Column]:
    return [
        F.col("exec_ms").alias("t"),
        F.lit(1).alias("kind"),
        F.lit(None).cast(scheduled.schema["seq"].dataType).alias("seq"),
        F.lit(None).cast("bigint").alias("held"),
    ]


def _line(scheduled: DataFrame, as_of: int) -> DataFrame:
    """Two points per request, made where the request is: `id, t, kind, seq, held`."""
    points = F.array(F.struct(*_as_request()), F.struct(*_as_timer(scheduled)))
    line = scheduled.select("id", F.explode(points).alias("point")).select("id", "point.*")
    return line.where(F.col("t") <= as_of)


def _held_at_timers(line: DataFrame, *keys: str) -> DataFrame:
    """The time held at each timer, as far as the window over `keys` can tell.

    Equal timers are neighbours on the line; the first stands for all.
    """
    in_order = Window.partitionBy(*keys).orderBy(*_POSITION)
    until_now = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    timer = F.when(F.col("kind") == 1, F.col("t"))
    return (
        line.withColumns(
            {
                "held": F.last("held", ignorenulls=True).over(until_now),
                "_previous": F.lag(timer).over(in_order),
            }
        )
        .where((F.col("kind") == 1) & ~F.col("_previous").eqNullSafe(F.col("t")))
        .select(*keys, F.col("t").alias("exec_ms"), "held")
    )


def _held_unsliced(scheduled: DataFrame, as_of: int) -> DataFrame:
    """Requests are shuffled once, before they turn into points."""
    return _held_at_timers(_line(scheduled.repartition("id"), as_of), "id")


def _carried(placed: DataFrame, slices: Slices) -> DataFrame:
    """For each slice, what its id held when the slice began; at most one row per cut.

    `placed` is partitioned by slice already, so only a row per slice is shuffled. The join lets nulls
    meet, of which there are none among the slices: one that does not would filter `placed` first, which
    would then be shuffled a second time for that.
    """
    request = F.col("kind") == 0
    last_held = placed.groupBy(F.col("id").alias("_id"), F.col("_slice").alias("_of")).agg(
        F.max_by(F.when(request, F.col("held")), F.when(request, F.struct("t", "seq"))).alias("last_held")
    )
    its_own = F.col("id").eqNullSafe(F.col("_id")) & F.col("_slice").eqNullSafe(F.col("_of"))
    before = (
        Window.partitionBy("id")
        .orderBy("_slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        slice_list(slices)
        .join(last_held, its_own, "left")
        .select("id", "_slice", F.last("last_held", ignorenulls=True).over(before).alias("carried"))
    )


def _distinct_in_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal timers of a batch as one."""
    for batch in batches:
        table = pa.Table.from_batches([batch])
        yield from table.group_by(batch.schema.names).aggregate([]).cast(batch.schema).to_batches()


def _held_sliced(
    scheduled: DataFrame, slices: Slices, as_of: int, earlier: DataFrame | None = None
) -> DataFrame:
    """As above with hot ids cut into slices, each starting from what the one before left.

    A timer goes to the slice of its own time, so equal ones meet there whatever slices their
    requests are in, and one exchange serves all. Any number of a hot id may fall on one moment,
    which no cut could part; those are merged before they are sent.
    """
    line = _line(scheduled, as_of)
    if earlier is not None:
        line = line.unionByName(earlier.select("id", *_as_timer(scheduled)))
    placed = assign_slices(line, slices, F.struct(*_POSITION)).drop("_next_cut")
    crowd = F.col("_slice").isNotNull() & (F.col("kind") == 1)
    merged = placed.where(crowd).select("id", "t", "_slice")
    merged = merged.mapInArrow(_distinct_in_batches, merged.schema)
    nothing = [F.lit(None).cast(placed.schema[name].dataType).alias(name) for name in ("seq", "held")]
    merged = merged.select("id", "t", F.lit(1).alias("kind"), *nothing, "_slice")
    placed = placed.where(~crowd).unionByName(merged).repartition("id", "_slice")
    return (
        _held_at_timers(placed, "id", "_slice")
        .join(F.broadcast(_carried(placed, slices)), ["id", "_slice"], "left")
        .select("id", "exec_ms", F.coalesce("held", "carried").alias("held"))
    )


def _outcomes(timers: DataFrame) -> DataFrame:
    held, exec_ms = F.col("held"), F.col("exec_ms")
    return timers.select(
        "id",
        "exec_ms",
        F.when(held == exec_ms, F.lit(FIRED)).otherwise(F.lit(STALE)).alias("outcome"),
        F.when(held > exec_ms, held).alias("expected_ms"),
    )


def gone_off_since(
    scheduled: DataFrame, earlier: DataFrame, as_of: int, rows: int, target_rows: int = TARGET_ROWS
) -> DataFrame:
    """`gone_off` for a part of a history that carries on from an earlier one: `scheduled` is what
    ids waited for when it began, and its own requests; `earlier` are timers, `id, exec_ms`, that
    were set in vain before and have not gone off by then."""
    set_before = earlier.where(F.col("exec_ms") <= as_of).select("id", "exec_ms")
    scheduled = scheduled.select("id", *ORDER, "exec_ms")
    slices = None
    if rows > target_rows:
        slices = plan_slices(_line(scheduled, as_of), _POSITION, 2 * rows, target_rows)
    if slices is None:
        line = _line(scheduled, as_of).unionByName(set_before.select("id", *_as_timer(scheduled)))
        return _outcomes(_held_at_timers(line.repartition("id"), "id"))
    return _outcomes(_held_sliced(scheduled, slices, as_of, set_before))


def gone_off(
    requests: DataFrame,
    as_of: int,
    policy: str = REQUESTED,
    rows: int | None = None,
    target_rows: int = TARGET_ROWS,
) -> DataFrame:
    """Every timer that went off by `as_of`: `id, exec_ms, outcome, expected_ms`.

    `expected_ms` is what the id of a stale timer was waiting for, or null if that was nothing.
    """
    scheduled = history(requests, as_of, policy).select("id", *ORDER, "exec_ms")
    if rows is None:
        rows = log_stats(scheduled).rows
    slices = None
    if rows > target_rows:
        slices = plan_slices(_line(scheduled, as_of), _POSITION, 2 * rows, target_rows)
    return _outcomes(
        _held_unsliced(scheduled, as_of)
        if slices is None
        else _held_sliced(scheduled, slices, as_of)
    )


def mismatches(requests: DataFrame, as_of: int, **options) -> DataFrame:
    """Timers that went off in vain, with the time that was expected instead."""
    return (
        gone_off(requests, as_of, **options)
        .where(F.col("outcome") == STALE)
        .select("id", F.col("exec_ms").alias("timer_ms"), "expected_ms")
    )
