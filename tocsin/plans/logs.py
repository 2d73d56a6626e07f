"""Request logs and payloads derived from the `events` table."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tocsin.session import apply_conf


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_conf(spark, {"spark.sql.session.timeZone": "UTC"})
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per event: some without a time, some with a past one, most in the future."""
    arrival = F.unix_millis(F.col("ts").cast("timestamp"))
    ahead = F.floor(F.col("value") * 600).cast("bigint") * 1000
    shape = F.col("event_id") % 5
    return events(spark, sf_dir).select(
        F.col("user_id").cast("string").alias("id"),
        F.col("event_id").alias("seq"),
        arrival.alias("arrival_ms"),
        F.when(shape == 0, F.lit(None))
        .when(shape == 1, arrival - 60_000)
        .otherwise(arrival + ahead)
        .alias("scheduled_at"),
        F.col("event_type").alias("status"),
    )


def hot_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same log with a third of all requests on one id."""
    return requests(spark, sf_dir).withColumn(
        "id", F.when(F.col("seq") % 3 == 0, F.lit("hot")).otherwise(F.col("id"))
    )


def _text(template: str) -> Column:
    """Text with `{name}` replaced by columns."""
    pieces = re.split(r"\{(\w+)\}", template)
    return F.concat(
        *[
            F.coalesce(F.col(piece).cast("string"), F.lit("null")) if odd % 2 else F.lit(piece)
            for odd, piece in enumerate(pieces)
        ]
    )


def _envelope(rows: DataFrame, value: Column) -> DataFrame:
    return rows.select(
        value.cast("binary").alias("value"),
        "arrival_ms",
        F.lit(0).alias("partition"),
        F.col("seq").alias("offset"),
    )


def in_partitions(payloads: DataFrame, partitions: int = 1) -> DataFrame:
    """The same payloads dealt to partitions, with offsets that rise with their arrival."""
    return payloads.withColumns({
        "partition": (F.col("offset") % partitions).cast("int"),
        "offset": F.col("arrival_ms") * 1_000_000 + F.col("offset"),
    })


def unordered_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests in four partitions, whose stamps fall behind those of records further up."""
    place = F.struct(
        (F.col("seq") % 4).cast("int").alias("partition"),
        (F.col("arrival_ms") * 1_000_000 + F.col("seq")).alias("offset"),
    )
    return requests(spark, sf_dir).withColumns(
        {"seq": place, "arrival_ms": F.col("arrival_ms") - F.col("seq") % 7 * 1_500}
    )


_PLAIN = '{"bucketId":{id},"id":"{id}","tenant":"{status}","scheduledAt":{scheduled_at},"status":"NEW"}'


def request_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every request as a well-formed payload."""
    return _envelope(requests(spark, sf_dir), _text(_PLAIN))


def hot_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log with a third of all requests on one id, as payloads."""
    return _envelope(hot_requests(spark, sf_dir), _text('{"id":"{id}","scheduledAt":{scheduled_at},"status":"{status}"}'))


def unordered_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The unordered requests as payloads; `place_ms` is when they were really written."""
    rows = unordered_requests(spark, sf_dir)
    place = F.col("seq")
    return rows.select(
        _text(_PLAIN).cast("binary").alias("value"), "arrival_ms", place["partition"].alias("partition"),
        place["offset"].alias("offset"), F.expr("seq.offset div 1000000").alias("place_ms"),
    )


# What the payload of an event looks like, by event_id % 20; all others are plain.
_REQUEST_SHAPES = {
    0: "",
    1: "null",
    4: '{"id":"{id}","scheduledAt":"abc"}',
    5: '{"id":"{id}","scheduledAt":true}',
    6: '{"id":"{id}","scheduledAt":99999999999999999999}',
    7: '{"id":{"x":{id}},"scheduledAt":{arrival_ms}}',
    8: '{"bucketId":{id},"scheduledAt":{arrival_ms}}',
    9: '{"ID":"{id}","scheduledAt":{arrival_ms}}',
    11: '{"id":{id},"scheduledAt":" {arrival_ms} "}',
    12: '{"id":"{id}","scheduledAt":{arrival_ms}.9}',
    13: _PLAIN + " trailing",
    14: '{"id":"other","id":"{id}","scheduledAt":{arrival_ms}}',
    15: '{"note":{"a":[1,{"b":null}]},"id":"{id}","more":[true],"scheduledAt":{arrival_ms}}',
    16: '{"id":"{id}","bucketId":"{id}","scheduledAt":""}',
}


def mixed_request_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every request as a payload, many of them odd or broken."""
    plain = _text(_PLAIN)
    shape = F.col("seq") % 20
    value = (
        F.when(shape == 2, F.left(plain, F.length(plain) - 1))
        .when(shape == 3, F.replace(plain, F.lit('"'), F.lit("'")))
        .when(shape == 17, F.concat(F.lit("\ufeff"), plain))
    )
    for number, template in _REQUEST_SHAPES.items():
        value = value.when(shape == number, _text(template))
    value = F.when(
        shape == 10, F.concat(F.unhex(F.lit("FF")), plain.cast("binary"))
    ).otherwise(value.otherwise(plain).cast("binary"))
    return _envelope(requests(spark, sf_dir), value)


_TASK = (
    '{"id":"{uuid}","name":"{status}","status":"NEW","cronExpression":"0 * * * *",'
    '"createdAt":"{created}","parameters":{"kind":"{status}","count":{id}},"createdBy":"u{id}",'
)

# Likewise for full tasks, by event_id % 12.
_TASK_SHAPES = {
    0: '{"id":"not-a-uuid","name":"{status}"}',
    1: '{"id":"{uuid}","retryCount":3000000000}',
    2: '{"id":"{uuid}","parameters":{"deep":{"x":{id}}}}',
    3: '{"id":"{uuid}","createdAt":"yesterday"}',
    4: '{"name":"{status}"}',
    5: '{"id":"{upper_uuid}","name":"{status}"}',
    6: _TASK + '"retryCount":"{id}","maxRetries":2.9,"retryDelayMs":{arrival_ms}}',
    7: '{"id":"{uuid}","parameters":null,"retryCount":null,"maxRetries":""}',
    8: '{"id":"{uuid}","parameters":{},"createdAt":null,"name":{id}}',
    9: '{"id":"{uuid}","createdAt":{arrival_ms}000}',
    10: '{"id":"{uuid}","updatedAt":-1e28,"name":"{status}"}',
}


def _uuid_of(user: str) -> Column:
    return F.concat(F.lit("00000000-0000-4000-8abc-"), F.lpad(user, 12, "0"))


def task_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests whose id is a UUID made from the user."""
    return requests(spark, sf_dir).withColumn("id", _uuid_of("id"))


def task_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every request as a well-formed full task."""
    return _envelope(_task_columns(spark, sf_dir), _text(_TASK + '"maxRetries":3}'))


def mixed_task_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every request as a full task, many of them odd or broken."""
    shape = F.col("seq") % 12
    value = F.when(F.lit(False), F.lit(""))
    for number, template in _TASK_SHAPES.items():
        value = value.when(shape == number, _text(template))
    return _envelope(
        _task_columns(spark, sf_dir), value.otherwise(_text(_TASK + '"maxRetries":3}'))
    )


def _task_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = requests(spark, sf_dir)
    uuid = _uuid_of("id")
    instant = F.timestamp_micros(F.col("arrival_ms") * 1000 + F.col("seq") % 1000)
    created = F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return rows.withColumns({"uuid": uuid, "upper_uuid": F.upper(uuid), "created": created})
