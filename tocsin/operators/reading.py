"""Reading order: what a partition holds further on also came later.

Producers may stamp records themselves, so the times of a partition need not rise. Taking the
latest time so far as a record's arrival makes the offset decide within a partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tocsin.operators.slices import Slices, assign_slices, plan_slices

# Offsets of a partition that one task goes through.
OFFSETS_PER_TASK = 250_000


def part_of(requests: DataFrame) -> Column:
    """The partition as text, which a missing one has too."""
    return F.coalesce(requests["seq"]["partition"].cast("string"), F.lit("None"))


def plan_ranges(requests: DataFrame, rows: int, rows_per_task: int = OFFSETS_PER_TASK) -> Slices | None:
    """Where to cut the offsets of partitions that have clearly more than so many rows; None if none has.

    Offsets may have gaps of any size, so the cuts go by the rows there are, not by the numbers.
    """
    places = requests.select(part_of(requests).alias("id"), requests["seq"]["offset"].alias("offset"))
    return plan_slices(places, ["offset"], rows, rows_per_task)


def _in_ranges(requests: DataFrame, ranges: Slices | None) -> DataFrame:
    """`row` holds the request, `part` and `range` say where it belongs."""
    rows = requests.select(F.struct(*requests.columns).alias("row"), part_of(requests).alias("id"))
    if ranges is not None:
        offset = F.struct(F.col("row")["seq"]["offset"].alias("offset"))
        rows = assign_slices(rows, ranges, offset)
    else:
        rows = rows.withColumn("_slice", F.lit(0))
    return rows.select("row", F.col("id").alias("part"), F.coalesce("_slice", F.lit(0)).alias("range"))


def ranges_read(requests: DataFrame, ranges: Slices | None = None) -> DataFrame:
    """Per partition and range of offsets: the latest and the first stamp, and the number of rows."""
    arrival = F.col("row")["arrival_ms"]
    return _in_ranges(requests, ranges).groupBy("part", "range").agg(
        F.max(arrival).alias("latest"), F.min(arrival).alias("first"), F.count(F.lit(1)).alias("n"))


def carried_on(
    requests: DataFrame, floors: list[tuple[str, int, int]], ranges: Slices | None = None
) -> DataFrame:
    """`in_reading_order` for the next part of a log: `floors` says for (partition, range) how far
    its stamps had got by the offset before."""
    known = requests.sparkSession.createDataFrame(floors, "part string, range int, floor bigint")
    so_far = (
        Window.partitionBy("part", "range").orderBy(F.col("row")["seq"]["offset"])
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    raised = F.greatest(F.max(F.col("row")["arrival_ms"]).over(so_far), F.col("floor"))
    return (
        _in_ranges(requests, ranges).join(F.broadcast(known), ["part", "range"], "left")
        .withColumn("_raised", raised)
        .select(*((F.col("_raised") if c == "arrival_ms" else F.col("row")[c]).alias(c) for c in requests.columns))
    )


def in_reading_order(requests: DataFrame, offsets_per_task: int = OFFSETS_PER_TASK) -> DataFrame:
    """`arrival_ms` raised to the latest so far in the partition; `seq` is (partition, offset).

    A partition is cut into ranges of offsets. The latest time of each range is pre-aggregated, so
    that a long partition is one row per range before it is gone through in parallel.
    """
    partition, offset = F.col("seq")["partition"], F.col("seq")["offset"]
    cut = requests.withColumns({"_part": partition, "_range": F.expr(f"seq.offset div {offsets_per_task}")})
    latest = cut.groupBy("_part", "_range").agg(F.max("arrival_ms").alias("_latest"))
    earlier = Window.partitionBy("_part").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    floors = latest.select("_part", "_range", F.max("_latest").over(earlier).alias("_floor"))
    so_far = (
        Window.partitionBy("_part", "_range").orderBy(offset).rowsBetween(Window.unboundedPreceding, 0)
    )
    raised = F.greatest(F.max("arrival_ms").over(so_far), F.col("_floor"))
    return (
        cut.join(floors, ["_part", "_range"])
        .withColumn("arrival_ms", raised)
        .select(*requests.columns)
    )
