"""Where requests come from: a topic, a folder of payload files, or a table.

Every source yields the envelope `value, arrival_ms, partition, offset`; record keys and
headers are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tocsin.schema import ENVELOPE

DEFAULT_SERVERS = "localhost:9092"
DEFAULT_INPUT_TOPIC = "task-requests"

# Records of a micro-batch, unless told otherwise.
INTAKE = "1000000"


def topic_options(servers: str, topic: str) -> dict[str, str]:
    """The whole topic, oldest record first."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
    }


def _topic_envelope(records: DataFrame) -> DataFrame:
    return records.select(
        "value", F.unix_millis("timestamp").alias("arrival_ms"), "partition", "offset"
    )


def topic_stream(
    spark: SparkSession,
    servers: str = DEFAULT_SERVERS,
    topic: str = DEFAULT_INPUT_TOPIC,
    **options: str,
) -> DataFrame:
    """An unbounded read. A micro-batch takes a bounded number of records, so that timers go off
    while a backlog is read; `maxOffsetsPerTrigger` in `options` sets another bound."""
    settings = {**topic_options(servers, topic), "maxOffsetsPerTrigger": INTAKE, **options}
    return _topic_envelope(spark.readStream.format("kafka").options(**settings).load())


def topic_history(
    spark: SparkSession,
    servers: str = DEFAULT_SERVERS,
    topic: str = DEFAULT_INPUT_TOPIC,
    **options: str,
) -> DataFrame:
    """What the topic holds, as a batch. Each use reads it anew, up to `endingOffsets` in `options`
    or what is there by then: stage what is used more than once."""
    settings = {**topic_options(servers, topic), **options}
    return _topic_envelope(spark.read.format("kafka").options(**settings).load())


def folder_stream(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Parquet files of envelopes, as they appear in a folder."""
    return spark.readStream.schema(ENVELOPE).options(**options).parquet(path)


def _ticks(spark: SparkSession) -> DataFrame:
    """A row per second, the same again when a micro-batch is repeated."""
    return (
        spark.readStream.format("rate").option("rowsPerSecond", 1).option("numPartitions", 1).load()
    )


def _nulls_like(requests: DataFrame) -> list[Column]:
    return [F.lit(None).cast(field.dataType).alias(field.name) for field in requests.schema.fields]


def with_heartbeat(requests: DataFrame) -> DataFrame:
    """The same stream, with a clock as a second source that never adds a row.

    Spark starts no micro-batch after a restart until some source moves on, so without it
    schedules that came due in the meantime would wait for the next request.
    """
    ticks = _ticks(requests.sparkSession).where(F.col("value") < 0)
    return requests.unionByName(ticks.select(*_nulls_like(requests)))


def log_order() -> Column:
    """The order of records that arrive in the same millisecond."""
    return F.struct("partition", "offset").alias("seq")


def as_requests(valid: DataFrame) -> DataFrame:
    """Decoded records as a request log; full tasks have no requested time."""
    scheduled_at = (
        F.col("scheduled_at") if "scheduled_at" in valid.columns else F.lit(None).cast("bigint")
    )
    return valid.select(
        "id", scheduled_at.alias("scheduled_at"), "arrival_ms", log_order(), "status"
    )
