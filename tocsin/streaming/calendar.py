"""Schedules on shared storage by the time they come due, changed by what a micro-batch changes.

A calendar is a set of runs, which are only ever written whole and never changed. Each holds rows
that arm a schedule and rows that take one back, in blocks by due time: a block is as long as it is
far away, so there are few of them, near ones are short, and what is due is found by their names. Of the
rows of one schedule the one of the latest version holds. Rows whose time has passed are not looked at
again.

A micro-batch adds a run of what it changed. Four runs of about the same size are merged into one,
so a row is written again once for each fourfold growth, and rows whose time has passed go with it.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

# What a row says: a schedule its id waits for, one that is taken back, a timer that is set in vain,
# a request that the horizon has not reached.
WAITS, TAKEN_BACK, IN_VAIN, AHEAD = "waits", "taken_back", "in_vain", "ahead"

# The shortest block.
BLOCK_MS = 60_000

# The longest block is that many times twice as long, which still fits a number of milliseconds.
_MOST_DOUBLINGS = 44

# So many runs of one size are merged into one, sizes going by powers of the same number.
MERGE_RUNS = 4


class Run(NamedTuple):
    name: str
    rows: int


def _size(run: Run) -> int:
    size, rows = 0, run.rows
    while rows >= MERGE_RUNS:
        size, rows = size + 1, rows // MERGE_RUNS
    return size


def _block(at: Column, horizon: int) -> Column:
    """The start of the block of a time, no later than it."""
    blocks_away = F.greatest((at.cast("double") - F.lit(float(horizon))) / BLOCK_MS, F.lit(1.0))
    doublings = F.least(F.floor(F.log2(blocks_away)), F.lit(_MOST_DOUBLINGS))
    length = F.lit(BLOCK_MS) * F.pow(F.lit(2.0), doublings).cast("bigint")
    return F.coalesce(F.try_subtract(at, F.pmod(at, length)), F.lit(-(2**63)))


class Calendar:
    """Rows are `id, arrival_ms, seq, exec_ms, at_ms, version, kind`; `seq` may be of any type."""

    def __init__(self, path: str) -> None:
        self.path = path

    def _path(self, name: str) -> str:
        return f"{self.path}/run={name}"

    def rows(self, spark: SparkSession, seq: StructField, runs: list[Run]) -> DataFrame:
        """All rows of the runs, those whose time has passed included."""
        fields = [("id", StringType()), ("arrival_ms", LongType()), ("seq", seq.dataType), ("exec_ms", LongType()),
                  ("at_ms", LongType()), ("version", LongType()), ("kind", StringType()), ("block", LongType())]
        schema = StructType([StructField(name, kind) for name, kind in fields])
        used = [self._path(run.name) for run in runs]
        if not used:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).option("basePath", self.path).parquet(*used).drop("run")

    def write(self, rows: DataFrame, name: str, horizon: int) -> None:
        """Writes a run, or writes it again."""
        placed = rows.withColumn("block", _block(F.col("at_ms"), horizon))
        placed = placed.hint("rebalance", "kind", "block")
        placed.write.mode("overwrite").partitionBy("kind", "block").parquet(self._path(name))

    def holding(self, rows: DataFrame) -> DataFrame:
        """Of rows that arm or take back schedules, those that hold."""
        latest = F.max(F.struct("version", (F.col("kind") == WAITS).alias("waits"), "arrival_ms", "seq"))
        last = rows.groupBy("id", "exec_ms").agg(latest.alias("last"))
        return last.where(F.col("last")["waits"]).select(
            "id", F.col("last")["arrival_ms"].alias("arrival_ms"), F.col("last")["seq"].alias("seq"), "exec_ms",
        )

    def merged(self, spark: SparkSession, seq: StructField, runs: list[Run], version: int, horizon: int) -> list[Run]:
        """The runs with those of one size merged, for as long as there are enough of them."""
        turn = 0
        while True:
            by_size: dict[int, list[Run]] = {}
            for run in runs:
                by_size.setdefault(_size(run), []).append(run)
            group = next((group for size, group in sorted(by_size.items()) if len(group) >= MERGE_RUNS), None)
            if group is None:
                return runs
            name = f"{version}-{turn}"
            turn += 1
            rows = self.rows(spark, seq, group).where(F.col("at_ms") > horizon).drop("block")
            settled = F.col("kind").isin(WAITS, TAKEN_BACK)
            last = rows.where(settled).groupBy("id", "exec_ms").agg(
                F.max(F.struct("version", F.col("kind") == WAITS, "arrival_ms", "seq", "at_ms", "kind")).alias("last"))
            kept = last.select("id", *(F.col("last")[c].alias(c) for c in ("arrival_ms", "seq")), "exec_ms",
                               *(F.col("last")[c].alias(c) for c in ("at_ms", "version", "kind")))
            self.write(kept.unionByName(rows.where(~settled)), name, horizon)
            runs = [run for run in runs if run not in group]
            written = self.rows(spark, seq, [Run(name, 1)]).count()
            runs += [Run(name, written)] if written else []

    def first_after(self, rows: DataFrame, horizon: int) -> int | None:
        """The first time after the horizon at which something may come due."""
        return rows.where((F.col("at_ms") > horizon) & F.col("kind").isin(WAITS, IN_VAIN)).agg(F.min("at_ms")).first()[0]

    def remove(self, spark: SparkSession, names: set[str]) -> None:
        """Runs that no marks name any more."""
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self._path(name))
            path.getFileSystem(conf).delete(path, True)
