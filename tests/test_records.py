from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tocsin.operators.decode import decode_requests, decode_tasks
from tocsin.operators.records import annotate_requests, encode_records, ready_records
from tocsin.schema import FIXED_DELAY
from tocsin.session import shared_folder
from tocsin.sources.inputs import as_requests, topic_options
from tocsin.sources.outputs import fan_out

UUID = "00000000-0000-4000-8abc-0000000000ab"


@pytest.fixture(scope="module")
def fired(spark):
    return spark.createDataFrame([(UUID, 1_704_067_800_123)], "id string, exec_ms bigint")


def test_ready_record(fired):
    payload = encode_records(ready_records(fired)).first().value
    assert payload == (
        '{"bucketId":null,"id":"%s","tenant":null,"scheduledAt":1704067800123,'
        '"status":"READY_FOR_EXECUTION"}' % UUID
    )


def test_ready_task(fired):
    record = json.loads(encode_records(ready_records(fired, FIXED_DELAY), FIXED_DELAY).first().value)
    assert len(record) == 17
    assert record.pop("id") == UUID
    assert record.pop("status") == "READY_FOR_EXECUTION"
    assert record.pop("updatedAt") == "2024-01-01T00:10:00.123000Z"
    zero = {"retryCount", "currentRetries", "maxRetries", "retryDelayMs"}
    assert all(value == (0 if key in zero else None) for key, value in record.items())


def test_instants_do_not_depend_on_the_session_zone(spark, fired):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        record = json.loads(encode_records(ready_records(fired, FIXED_DELAY), FIXED_DELAY).first().value)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert record["updatedAt"] == "2024-01-01T00:10:00.123000Z"


def _round_trip(spark, decode, payload, policy):
    source = spark.createDataFrame([(payload.encode(),)], "value binary")
    return encode_records(decode(source).valid, policy).first().value


def test_round_trips(spark):
    request = '{"bucketId":1,"id":"ä\\"","tenant":"t","scheduledAt":5,"status":"NEW"}'
    assert json.loads(_round_trip(spark, decode_requests, request, "requested")) == json.loads(request)
    task = json.dumps(
        {
            "id": UUID, "name": "n", "description": "d", "status": "NEW", "cronExpression": "* * * * *",
            "nextExecutionTime": None, "createdAt": "2024-01-01T00:00:00.000000Z", "updatedAt": None,
            "parameters": {"a": "1", "b": None}, "createdBy": "c", "assignedTo": "x", "retryCount": 1,
            "currentRetries": 2, "maxRetries": 3, "retryDelayMs": 4, "executionResult": "r",
            "errorMessage": "e",
        }
    )
    assert json.loads(_round_trip(spark, decode_tasks, task, FIXED_DELAY)) == json.loads(task)


def test_annotate(spark):
    requests = spark.createDataFrame(
        [("a", 1000, 5000, "NEW")], "id string, arrival_ms bigint, scheduled_at bigint, status string"
    )
    row = annotate_requests(requests).first()
    assert (row.status, row.exec_ms) == ("SCHEDULED", 5000)
    fixed = annotate_requests(requests, FIXED_DELAY).select(
        "status", F.unix_millis("next_execution_time").alias("next"), F.unix_millis("updated_at").alias("updated")
    )
    assert tuple(fixed.first()) == ("SCHEDULED", 301_000, 1000)


def test_decoded_records_as_a_log(spark):
    source = spark.createDataFrame(
        [(b'{"id":"a","scheduledAt":9}', 5, 1, 7)],
        "value binary, arrival_ms bigint, partition int, offset bigint",
    )
    row = as_requests(decode_requests(source).valid).first()
    assert (row.id, row.scheduled_at, row.arrival_ms, tuple(row.seq)) == ("a", 9, 5, (1, 7))


def test_audit_of_decoded_records(spark):
    """One id asked for twice: the second request makes the first timer stale."""
    from tocsin.operators.audit import audit_log

    source = spark.createDataFrame(
        [
            (b'{"id":"a","scheduledAt":5000,"status":"NEW"}', 1000, 0, 1),
            (b'{"id":"a","scheduledAt":9000,"status":"AGAIN"}', 2000, 0, 2),
        ],
        "value binary, arrival_ms bigint, partition int, offset bigint",
    )
    log = audit_log(as_requests(decode_requests(source).valid), as_of=10_000)
    steps = sorted((r.at_ms, r.phase, r.exec_ms, r.expected_ms, r.detail) for r in log.collect())
    assert steps == [
        (1000, "INBOUND", None, None, "NEW"),
        (1000, "PROCESSING", 5000, None, "provided"),
        (1000, "TIMER-REGISTERED", 5000, None, None),
        (2000, "INBOUND", None, None, "AGAIN"),
        (2000, "PROCESSING", 9000, None, "provided"),
        (2000, "TIMER-REGISTERED", 9000, None, None),
        (5000, "TIMER-FIRED", None, None, None),
        (5000, "TIMER-MISMATCH", None, 9000, None),
        (9000, "SERIALIZE", None, None, None),
        (9000, "TIMER-COMPLETED", None, None, None),
        (9000, "TIMER-FIRED", None, None, None),
    ]


def test_topic_is_read_from_the_start():
    assert topic_options("h:1", "t") == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "earliest"
    }


def test_fan_out_computes_once(spark):
    computed = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            computed.add(batch.num_rows)
            yield batch

    rows = spark.range(100).selectExpr("id", "'fired' AS outcome")
    records = rows.mapInArrow(count, "id bigint, outcome string")
    seen = []
    fan_out(records, 3, [({"fired"}, lambda rows, batch: seen.append((batch, rows.count())))] * 3)
    assert seen == [(3, 100)] * 3
    assert computed.value == 100


def test_fan_out_is_silent_without_records(spark):
    seen = []
    nothing = spark.createDataFrame([], "id bigint, outcome string")
    fan_out(nothing, 0, [({"fired"}, lambda rows, batch: seen.append(batch))])
    some = spark.createDataFrame([(1, "stale")], "id bigint, outcome string")
    fan_out(some, 0, [({"fired"}, lambda rows, batch: seen.append(batch))])
    assert seen == []


def test_shared_folder_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    first, second = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert first != second
    assert first.startswith(f"{(root or spark.sparkContext.getCheckpointDir()).rstrip('/')}/x-")


def test_repetitions_in_a_stream(spark, tmp_path):
    from tocsin.operators.records import once

    schema = "id string, scheduled_at bigint, arrival_ms bigint"
    out = f"{tmp_path}/out"
    for rows in ([("a", 1, 10), ("a", 1, 11), ("a", 2, 12)], [("a", 1, 13), ("b", 1, 14)]):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        (
            once(stream).writeStream.option("checkpointLocation", f"{tmp_path}/c")
            .trigger(availableNow=True).format("parquet").start(out).awaitTermination()
        )
    found = sorted((r.id, r.scheduled_at) for r in spark.read.parquet(out).collect())
    assert found == [("a", 1), ("a", 2), ("b", 1)]
