"""Every registered query against its SQL, and the shape of the main plans."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry
from tocsin.plans import catalog
from tocsin.plans.catalog import QUERIES
from tocsin.plans.oracle import ORACLE

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for file in Path(SMALL).glob("*.parquet"):
        connection.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _sorted(rows, names):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def test_each_query_has_its_sql():
    assert QUERIES.keys() == ORACLE.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, database, name):
    frame = QUERIES[name](spark, SMALL)
    want = database.sql(ORACLE[name])
    assert sorted(frame.columns) == sorted(want.columns)
    got = _sorted([tuple(row) for row in frame.collect()], frame.columns)
    assert got == _sorted(want.fetchall(), want.columns)
    assert got


def test_entry(spark):
    assert entry(spark).count() == 721


def _plan(spark, name):
    return QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name", ["ready", "superseded_requests", "stale_timers", "timer_mismatch_expected", "hot_id_ready"]
)
def test_one_shuffle(spark, name):
    assert _plan(spark, name).count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize(
    "name", ["effective_schedule", "annotated_requests", "decode_requests", "encode_requests"]
)
def test_no_shuffle(spark, name):
    assert "Exchange" not in _plan(spark, name)


def test_only_needed_columns_are_read(spark):
    plan = _plan(spark, "ready")
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double>" in plan


@pytest.mark.parametrize("name", ["decode_requests", "quarantine_counts", "quarantine_task_counts"])
def test_a_payload_is_parsed_once(spark, name):
    plan = _plan(spark, name)
    assert plan.count("from_json(") == 1 and plan.count("FileScan") == 1


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join(spark, name):
    if not name.startswith("stream"):
        plan = _plan(spark, name)
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_the_horizon_reaches_the_scan(spark, tmp_path):
    from tocsin.operators.records import ready
    from tocsin.plans import logs

    logs.requests(spark, SMALL).write.parquet(f"{tmp_path}/log")
    stored = spark.read.parquet(f"{tmp_path}/log")
    plan = ready(stored, 1_705_363_200_000)._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(arrival_ms,1705363200000)" in plan
    assert "ReadSchema: struct<id:string,seq:bigint,arrival_ms:bigint,scheduled_at:bigint>" in plan


def test_job_arguments():
    from tocsin.__main__ import arguments

    given = arguments(["--checkpoint", "/c"])
    assert (given.servers, given.input_topic, given.output_topic) == (
        "localhost:9092", "task-requests", "scheduled-tasks"
    )
    given = arguments(["h:1", "in", "out", "--checkpoint", "/c", "--policy", "fixed_delay"])
    assert (given.servers, given.input_topic, given.output_topic) == ("h:1", "in", "out")
    assert given.policy == "fixed_delay"
    given = arguments(["--checkpoint", "/c", "--source-option", "maxOffsetsPerTrigger=5"])
    assert given.source_options == {"maxOffsetsPerTrigger": "5"}


def test_a_log_from_one_task_is_decoded_by_many(spark, tmp_path, monkeypatch):
    """A table of one file and one row group is written by one task; its log must not stay with one."""
    events = spark.range(240).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-02 00:00:00' + make_dt_interval(0, id * 2) AS ts", "id % 7 AS user_id",
        "'view' AS event_type", "CAST(id % 50 AS double) AS value", "'{}' AS props",
    )
    events.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(catalog, "LOG_FILE_ROWS", 10, raising=False)
    monkeypatch.setattr(catalog, "shared_folder", lambda spark, name: f"{tmp_path}/{name}")
    got = QUERIES["stream_ready"](spark, str(tmp_path)).collect()
    files = spark.read.parquet(f"{tmp_path}/stream-ready/log").selectExpr("input_file_name() AS name")
    sizes = [row["count"] for row in files.groupBy("name").count().collect()]
    assert sum(sizes) == 240 and max(sizes) <= 10
    assert got and sorted(got, key=repr) == sorted(QUERIES["ready"](spark, str(tmp_path)).collect(), key=repr)
