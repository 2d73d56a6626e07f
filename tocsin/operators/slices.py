"""Cut the long histories of hot ids into slices that separate tasks can sort.

A window over `(id)` puts the whole history of an id into one task. Here the history of an id
with many rows is cut at positions drawn from a content-hashed sample, so that the window can
run over `(id, slice)`. The sample decides only where the cuts lie, never what comes out.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

TARGET_ROWS = 2_000_000
MAX_SLICES = 65_536
SAMPLES_PER_SLICE = 32


@dataclass(frozen=True)
class Slices:
    """Cut positions per hot id: `id, _cuts array<struct<pos>>`, at most about MAX_SLICES in all."""

    cuts: DataFrame
    most_cuts: int


def plan_slices(
    positions: DataFrame, order: list[str], rows: int, target_rows: int = TARGET_ROWS
) -> Slices | None:
    """Cut positions for ids with clearly more than `target_rows` rows; None if there are none.

    `positions` has `id` and the `order` columns, which must tell rows of an id apart.
    The slice size grows with `rows`, which bounds both the sample and the cuts it yields,
    so the cuts are safe to hold on the driver and to broadcast.
    """
    if rows <= target_rows:
        return None
    slice_rows = max(target_rows, -(-rows // MAX_SLICES))
    one_in = max(1, slice_rows // SAMPLES_PER_SLICE)
    per_slice = slice_rows // one_in
    # The hash takes all rows of a position or none, so equal ones must count once.
    sample = (
        positions.select("id", *order)
        .where(F.pmod(F.xxhash64("id", *order), F.lit(one_in)) == 0)
        .distinct()
    )
    rank = F.row_number().over(Window.partitionBy("id").orderBy(*order))
    cuts = (
        sample.withColumn("_rank", rank)
        .where(F.pmod("_rank", F.lit(per_slice)) == 0)
        .groupBy("id")
        .agg(F.array_sort(F.collect_list(F.struct(*order))).alias("_cuts"))
    )
    found = cuts.collect()
    if not found:
        return None
    table = positions.sparkSession.createDataFrame(found, cuts.schema)
    return Slices(table, max(len(row["_cuts"]) for row in found))


def assign_slices(
    rows: DataFrame, slices: Slices, position: Column, hot_only: bool = False
) -> DataFrame:
    """Add `_slice` (null for ids without cuts) and `_next_cut`, the start of the next slice.

    The slice is the number of cuts at or before the position, found by a binary search. Each
    step is a projection of its own, which keeps the search in generated code. A filter on the slice
    must not move below them: the optimizer would put each step into the next one, twice.
    """
    how = "inner" if hot_only else "left"
    placed = (
        rows.join(F.broadcast(slices.cuts), "id", how)
        .withColumn("_position", position)
        .withColumn("_slice", F.lit(0))
    )
    passed = F.col("_slice")
    for bit in reversed(range(slices.most_cuts.bit_length())):
        step = 1 << bit
        is_passed = F.get("_cuts", passed + (step - 1)) <= F.col("_position")
        placed = placed.withColumn("_slice", passed + F.when(is_passed, step).otherwise(0))
    return (
        placed.withColumn("_slice", F.when(F.col("_cuts").isNotNull(), passed))
        .withColumn("_next_cut", F.get("_cuts", passed))
        .drop("_cuts", "_position")
        .withColumn("_slice", F.explode(F.array("_slice")))
    )


def slice_list(slices: Slices) -> DataFrame:
    """Every `(id, _slice)`, empty ones too."""
    return slices.cuts.select(
        "id", F.explode(F.sequence(F.lit(0), F.size("_cuts"))).alias("_slice")
    )
