"""Sums of timers, sketches of durations, snapshots, the outbox, and state as tables in small."""

from __future__ import annotations

import random
import re

import pytest
from histories import CASES, SCHEMA, rows
from pyspark.sql import functions as F

from tocsin.operators.records import ready, ready_records
from tocsin.operators.resolve import resolve, timer_outcomes
from tocsin.operators.snapshots import Snapshots
from tocsin.sources.outbox import MOST_BUCKETS, Outbox
from tocsin.streaming.durations import quantiles, sketched
from tocsin.streaming.reconcile import ARMED, balance, differences, tally, tally_step
YIELDED = "id string, exec_ms long, outcome string, armed boolean"


def _yielded(spark, drop=None):
    """Two micro-batches of a job that set four timers: one fired, one in vain, two are left."""
    made = [
        ("a", 10, "accepted", True), ("a", 20, "accepted", True), ("b", 30, "accepted", True), ("a", 10, "accepted", False),
        ("c", 40, "accepted", True), ("a", 20, "stale", None), ("a", 10, "fired", None), (None, None, "quarantined", None),
    ]
    batches = [made[:4], made[4:]]
    return [spark.createDataFrame([row for row in batch if row != drop], YIELDED) for batch in batches]


def _left(spark):
    return spark.createDataFrame([("b", 30, "pending"), ("c", 40, "armed_superseded")], "id string, exec_ms long, outcome string")


def test_the_books_balance(spark):
    first, second = map(tally_step, _yielded(spark))
    found = {row.outcome: row for row in balance(first.unionByName(second), _left(spark)).collect()}
    assert {name: row.n for name, row in found.items()} == {ARMED: 4, "fired": 1, "stale": 1, "pending": 1, "armed_superseded": 1}
    assert all(row.missing == 0 and row.difference == 0 for row in found.values())


@pytest.mark.parametrize("drop", [("a", 10, "fired", None), ("c", 40, "accepted", True), ("a", 20, "stale", None)])
def test_a_lost_row_is_noticed(spark, drop):
    first, second = map(tally_step, _yielded(spark, drop))
    (row, *_) = balance(first.unionByName(second), _left(spark)).collect()
    assert row.missing != 0 and row.difference != 0


def test_one_record_in_place_of_another_is_noticed(spark):
    """The numbers agree, the sums do not."""
    right = spark.createDataFrame([("a", 10, "fired"), ("b", 10, "fired")], "id string, exec_ms long, outcome string")
    wrong = spark.createDataFrame([("a", 10, "fired"), ("b", 11, "fired")], "id string, exec_ms long, outcome string")
    (row,) = differences(tally(right), tally(wrong)).collect()
    assert row.missing == 0 and row.difference != 0
    (row,) = differences(tally(right), tally(right.orderBy(F.desc("id")))).collect()
    assert row.missing == 0 and row.difference == 0


def test_merged_sketches_keep_their_ranks(spark):
    chance = random.Random(3)
    values = [int(chance.lognormvariate(8, 2)) for _ in range(60_000)]
    frame = spark.createDataFrame([("p", v, i % 7) for i, v in enumerate(values)], "phase string, value long, batch int")
    parts = [sketched(frame.where(F.col("batch") == batch).select("phase", "value")) for batch in range(7)]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    for row in quantiles(whole, 0.1, 0.5, 0.99).collect():
        assert row.n == 60_000
        below = sum(v < row.value for v in values) / 60_000
        up_to = sum(v <= row.value for v in values) / 60_000
        assert below <= row.part + 0.01 and up_to >= row.part - 0.01


def test_snapshots_of_histories(spark, tmp_path):
    """At any two moments, with equal times and schedules due at the moment of a snapshot."""
    log = spark.createDataFrame(rows(), SCHEMA)
    for since in (10_000, 20_000, 50_000):
        snapshots = Snapshots(spark, f"{tmp_path}/{since}")
        snapshots.advance(log, since)
        for as_of in (since, 130_000):
            if as_of >= since:
                got = sorted((r.id, r.scheduled_at) for r in snapshots.ready(log, as_of).collect())
                assert got == sorted((r.id, r.scheduled_at) for r in ready(log, as_of).collect())
                want = resolve(log, as_of).where("outcome = 'pending'").select("id", "seq", "exec_ms")
                assert sorted(snapshots.pending(log, as_of).collect()) == sorted(want.collect())
    assert len(CASES) > 5


def test_a_chain_of_snapshots_reads_the_tail_only(spark, tmp_path):
    log = spark.range(3_000).select(
        (F.col("id") % 40).cast("string").alias("id"), (F.col("id") * 1000).alias("arrival_ms"), F.col("id").alias("seq"),
        (F.col("id") * 1000 + F.pmod(F.xxhash64("id"), F.lit(90_000))).alias("scheduled_at"))
    log.write.parquet(f"{tmp_path}/log")
    log = spark.read.parquet(f"{tmp_path}/log")
    snapshots = Snapshots(spark, f"{tmp_path}/snapshots")
    for as_of in (500_000, 1_700_000, 1_700_001, 2_500_000, 2_500_000):
        snapshots.advance(log, as_of)
    assert snapshots.versions() == [500_000, 1_700_000, 1_700_001, 2_500_000]
    frame = snapshots.ready(log, 2_900_000)
    assert sorted((r.id, r.scheduled_at) for r in frame.collect()) == sorted(
        (r.id, r.scheduled_at) for r in ready(log, 2_900_000).collect())
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"arrival_ms#\d+L > 2500000", plan) and "PushedFilters" in plan


class Topic:
    """Takes what it is given, and fails in the middle when it is told to."""

    def __init__(self):
        self.held, self.fail_after, self.asked = [], None, []

    def __call__(self, records, batch_id):
        found = [(row.id, row.scheduled_at) for row in records.collect()]
        if self.fail_after is not None and len(found) > self.fail_after:
            self.held += found[: self.fail_after]
            self.fail_after = None
            raise ConnectionError
        self.held += found

    def since(self, spark, moment_ms):
        self.asked.append(moment_ms)
        return spark.createDataFrame(self.held or [], "id string, scheduled_at long")


def test_an_outbox_sends_each_record_once(spark, tmp_path):
    topic = Topic()
    outbox = Outbox(str(tmp_path), topic, topic.since, bucket_rows=30)

    def fired(n, shift=0):
        return ready_records(spark.range(n).selectExpr(f"cast(id as string) AS id", f"id * 7 + {shift} AS exec_ms"))

    outbox(fired(100), 0)
    assert len(topic.held) == 100 and not topic.asked
    topic.fail_after = 10
    with pytest.raises(ConnectionError):
        outbox(fired(100, 1_000), 1)
    # Repeated with other rows, as an operator that is not deterministic would: what was written down counts.
    outbox(fired(50, 1_000), 1)
    outbox(fired(100, 1_000), 1)
    assert len(topic.held) == len(set(topic.held)) == 200 and len(topic.asked) == 1


def test_a_large_micro_batch_goes_out_in_few_buckets(spark, tmp_path):
    """Each bucket is sent by jobs of its own, so their number must not grow with the records."""
    calls = []
    sink = lambda records, batch_id: calls.append([(r.id, r.scheduled_at) for r in records.collect()])
    outbox = Outbox(str(tmp_path), sink, None, bucket_rows=5)
    outbox(ready_records(spark.range(1_000).selectExpr("cast(id as string) AS id", "id * 7 AS exec_ms")), 0)
    assert 8 < len(calls) <= MOST_BUCKETS + 4
    assert sorted(pair for call in calls for pair in call) == sorted((str(n), n * 7) for n in range(1_000))


def test_scratch_tables_go_with_their_block(spark):
    from tocsin.session import scratch_tables, staged

    before = staged(spark.range(3), "outside")
    with scratch_tables(spark):
        inside = staged(spark.range(5), "inside")
        assert inside.count() == 5
        folder = inside.inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0]
    from pathlib import Path

    assert not Path(folder.replace("//", "/")).exists()
    assert before.count() == 3


def test_outcomes_of_batch_add_up(spark):
    resolved = resolve(spark.createDataFrame(rows(), SCHEMA), 45_000)
    found = {row.outcome: row.n for row in tally(timer_outcomes(resolved, 45_000)).collect()}
    assert sum(found.values()) == resolved.select("id", "exec_ms").distinct().count()
