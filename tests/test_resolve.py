from __future__ import annotations

import re
import time
from collections import defaultdict

import pytest
from histories import CASES, SCHEMA, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from simulator import play

from tocsin.operators.expected import _held_sliced, _held_unsliced, gone_off, mismatches
from tocsin.operators.resolve import resolve, timer_outcomes
from tocsin.operators.slices import Slices
from tocsin.schema import FIXED_DELAY

END = 10_000_000


def by_id(rows, value):
    found = defaultdict(list)
    for row in rows:
        found[row.id].append(value(row))
    return found


def check_against_simulator(spark, logs, as_of, **options):
    """`logs`: history per id. Everything the engine derives must match the simulator."""
    data = [(name, *row) for name, history in logs.items() for row in history]
    requests = spark.createDataFrame(
        [(name, arrival, seq, scheduled) for name, arrival, seq, scheduled in data], SCHEMA
    )
    delay = {"fixed": 300_000} if options.get("policy") == FIXED_DELAY else {}
    want = {name: play(history, as_of, **delay) for name, history in logs.items()}

    resolved = resolve(requests, as_of, **options)
    fired = by_id(resolved.where("outcome = 'fired'").collect(), lambda r: r.exec_ms)
    pending = by_id(resolved.where("outcome = 'pending'").collect(), lambda r: r.exec_ms)
    timers = timer_outcomes(resolved, as_of).collect()
    stale = by_id([t for t in timers if t.outcome == "stale"], lambda r: r.exec_ms)
    held = by_id(
        mismatches(requests, as_of, **options).collect(), lambda r: (r.timer_ms, r.expected_ms)
    )
    for name, (want_fired, want_stale, want_held) in want.items():
        assert sorted(fired[name]) == sorted(want_fired), name
        assert pending[name] == ([] if want_held is None else [want_held]), name
        assert sorted(stale[name]) == sorted(want_stale), name
        assert dict(held[name]) == want_stale, name
        assert len(held[name]) == len(want_stale), name

    # Nothing is lost: each armed timer has one outcome, and as many have fired as requests say.
    armed = {(r.id, r.exec_ms) for r in resolved.select("id", "exec_ms").collect()}
    assert len(timers) == len(armed) and {(t.id, t.exec_ms) for t in timers} == armed
    assert sum(t.outcome == "fired" for t in timers) == sum(map(len, fired.values()))
    assert sum(t.outcome == "pending" for t in timers) == sum(map(len, pending.values()))


def test_histories(spark):
    requests = spark.createDataFrame(rows(), SCHEMA)
    fired = by_id(resolve(requests, END).where("outcome = 'fired'").collect(), lambda r: r.exec_ms)
    found = by_id(mismatches(requests, END).collect(), lambda r: (r.timer_ms, r.expected_ms))
    for name, (_, ready, stale) in CASES.items():
        assert sorted(fired[name]) == ready, name
        assert dict(found[name]) == stale, name


def test_simulator_agrees_with_the_histories():
    for name, (history, ready, stale) in CASES.items():
        numbered = [(arrival, seq, scheduled) for seq, (arrival, scheduled) in enumerate(history)]
        fired, vain, held = play(numbered, END)
        assert (sorted(fired), vain, held) == (ready, stale, None), name


# Few distinct moments, so that ties of every kind come up.
moment = st.integers(0, 12).map(lambda n: n * 10_000)
history = st.lists(
    st.tuples(moment, st.one_of(st.none(), moment)), min_size=1, max_size=12
).map(lambda rows: [(arrival, seq, scheduled) for seq, (arrival, scheduled) in enumerate(rows)])
several = st.lists(history, min_size=30, max_size=60).map(
    lambda found: {f"id{number}": rows for number, rows in enumerate(found)}
)
few_runs = settings(
    max_examples=4, deadline=None, suppress_health_check=list(HealthCheck), derandomize=True
)


@few_runs
@given(logs=several, as_of=moment)
def test_random_histories(spark, logs, as_of):
    check_against_simulator(spark, logs, as_of)


@few_runs
@given(logs=several, as_of=moment)
def test_random_histories_in_slices(spark, logs, as_of):
    """Every id with more than one row is cut into slices of a single row or two."""
    check_against_simulator(spark, logs, as_of, target_rows=1)


@few_runs
@given(logs=several, as_of=moment.map(lambda m: m * 4))
def test_random_histories_fixed_delay(spark, logs, as_of):
    check_against_simulator(spark, logs, as_of, policy=FIXED_DELAY)


def test_order_within_a_millisecond_may_be_a_struct(spark):
    requests = spark.createDataFrame(
        [("a", 0, (1, 7), 90_000), ("a", 0, (1, 8), 50_000), ("a", 0, (0, 9), 70_000)],
        "id string, arrival_ms bigint, seq struct<partition int, offset bigint>, scheduled_at bigint",
    )
    for target_rows in (1, 1000):
        resolved = resolve(requests, END, target_rows=target_rows)
        assert [r.exec_ms for r in resolved.where("outcome = 'fired'").collect()] == [50_000]
        timers = gone_off(requests, END, target_rows=target_rows).collect()
        assert {(t.exec_ms, t.outcome) for t in timers} == {
            (50_000, "fired"), (70_000, "stale"), (90_000, "stale")
        }


@pytest.fixture(scope="module")
def hot_log(spark):
    """A third of 30,000 requests on one id, a third of those at one millisecond."""
    return spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 700).cast("string")).alias("id"),
        F.when(F.col("id") % 9 == 0, F.lit(500_000)).otherwise(F.col("id") * 37).alias("arrival_ms"),
        F.col("id").alias("seq"),
        F.when(F.col("id") % 4 == 0, F.lit(900_000))
        .when(F.col("id") % 4 == 1, F.col("id") * 37 + 20 + F.col("id") % 50)
        .alias("scheduled_at"),
    )


def test_hot_id_in_slices(spark, hot_log):
    logs = defaultdict(list)
    for row in hot_log.collect():
        logs[row.id].append((row.arrival_ms, row.seq, row.scheduled_at))
    check_against_simulator(spark, logs, 1_000_000, target_rows=300)


def test_slices_are_balanced(hot_log):
    from tocsin.operators.resolve import ORDER
    from tocsin.operators.slices import assign_slices, plan_slices

    slices = plan_slices(hot_log, ORDER, 30_000, target_rows=500)
    placed = assign_slices(hot_log, slices, F.struct(*ORDER)).where("id = 'hot'")
    sizes = [row["count"] for row in placed.groupBy("_slice").count().collect()]
    assert sum(sizes) == 10_000
    assert len(sizes) > 10
    assert max(sizes) < 1_500
    assert {row.id for row in slices.cuts.collect()} == {"hot"}


def test_no_slices_without_hot_ids(spark, hot_log):
    from tocsin.operators.resolve import ORDER
    from tocsin.operators.slices import plan_slices

    assert plan_slices(hot_log, ORDER, 30_000, target_rows=50_000) is None
    assert plan_slices(hot_log.where("id != 'hot'"), ORDER, 20_000, target_rows=500) is None


def test_the_search_for_a_slice_is_planned_once_however_many_cuts(spark):
    """With each cut more the optimizer had more to write out, on the driver; 30,000 cuts took it half a minute."""
    log = spark.range(300).selectExpr(
        "if(id % 3 = 0, 'hot', string(id)) as id", "id * 10 as arrival_ms", "id as seq", "id * 10 + 300 as exec_ms")
    found = {}
    for n in (20, 30_000):
        cuts = [("hot", [(3_000 * i // n, 0, i) for i in range(n)])]
        table = spark.createDataFrame(cuts, "id string, _cuts array<struct<t:bigint,kind:int,seq:bigint>>")
        begun = time.monotonic()
        held = _held_sliced(log, Slices(table, n), END)
        plan = held._jdf.queryExecution().sparkPlan().toString()
        assert plan and time.monotonic() - begun < 10
        found[n] = sorted(map(tuple, held.collect()))
    assert found[20] == found[30_000] == sorted(map(tuple, _held_unsliced(log, END).collect()))


def test_the_points_of_a_line_are_shuffled_once(spark):
    """What a slice starts from is read off the same exchange."""
    log = spark.range(300).selectExpr("'hot' as id", "id * 10 as arrival_ms", "id as seq", "id * 10 + 300 as exec_ms")
    table = spark.createDataFrame([("hot", [(1_000, 0, 7)])], "id string, _cuts array<struct<t:bigint,kind:int,seq:bigint>>")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _held_sliced(log, Slices(table, 1), END)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert plan.count("REPARTITION_BY_COL") - len(re.findall("ReusedExchange.*REPARTITION_BY_COL", plan)) == 1
