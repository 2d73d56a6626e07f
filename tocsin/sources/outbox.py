"""Sending out once what a restarted job would send again.

A topic takes records as they come, so a micro-batch that fails halfway through sending leaves some
of its records behind, and sends all again when it is repeated. The outbox writes a micro-batch down
first, cut by due time into buckets, and notes in a ledger which buckets have gone out. A
repetition sends what was written down, leaves out the buckets of the ledger, and asks of the one
bucket that was begun but not ended which of its records have arrived.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tocsin.functions.rules import known_policy
from tocsin.operators.decode import decode_requests, decode_tasks
from tocsin.schema import FIXED_DELAY, REQUESTED
from tocsin.sources.inputs import topic_history
from tocsin.sources.outputs import Sink

# Records of a bucket, roughly. One bucket at most is looked up after a failure.
BUCKET_ROWS = 100_000

# Buckets of a micro-batch, roughly and at most. Each costs jobs of its own, so those of a large micro-batch
# are larger.
MOST_BUCKETS = 32

_LEDGER = "batch_id bigint, bucket bigint, begun_ms bigint"

# What has arrived since a moment: ready records that have been sent out.
ReadBack = Callable[[SparkSession, int], DataFrame]


def topic_read_back(servers: str, topic: str, policy: str = REQUESTED, **options: str) -> ReadBack:
    """Reads a topic from a moment on. The moment is that of the job's clock, so the clocks of the
    job and of the topic must not differ by more than `slack_ms`."""
    slack_ms = int(options.pop("slack_ms", "60000"))
    decode = decode_tasks if known_policy(policy) == FIXED_DELAY else decode_requests

    def read(spark: SparkSession, since_ms: int) -> DataFrame:
        since = {"startingTimestamp": str(since_ms - slack_ms), "startingOffsetsByTimestampStrategy": "latest"}
        return decode(topic_history(spark, servers, topic, **since, **options)).valid

    return read


def _names(policy: str) -> list[str]:
    return ["id", "updated_at" if known_policy(policy) == FIXED_DELAY else "scheduled_at"]


class Outbox:
    """A sink that hands records on to another one, each once."""

    def __init__(
        self, path: str, sink: Sink, read_back: ReadBack, policy: str = REQUESTED, bucket_rows: int = BUCKET_ROWS
    ) -> None:
        self.path = path
        self.sink = sink
        self.read_back = read_back
        self.keys = _names(policy)
        self.bucket_rows = bucket_rows

    def _exists(self, spark: SparkSession, path: str) -> bool:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)

    def _written_down(self, records: DataFrame, batch_id: int) -> DataFrame:
        """The micro-batch as it was when it was first given, with a bucket for each record."""
        spark, path = records.sparkSession, f"{self.path}/records/batch_id={batch_id}"
        if not self._exists(spark, path):
            # In order of due time; a task of the sort holds a run of them and cuts it up further.
            due, salt = self.keys[1], F.xxhash64(*self.keys)
            placed = records.repartitionByRange(due, salt).sortWithinPartitions(due, salt)
            within = F.monotonically_increasing_id()
            bucket_rows = max(self.bucket_rows, -(-records.count() // MOST_BUCKETS))
            bucket = F.shiftright(within, 33) * (1 << 24) + (within.bitwiseAND((1 << 33) - 1) / bucket_rows).cast("bigint")
            placed.withColumn("_bucket", bucket).write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    def _mark(self, spark: SparkSession, kind: str, batch_id: int, bucket: int) -> None:
        row = {"batch_id": batch_id, "bucket": bucket, "begun_ms": int(time.time() * 1000)}
        path = f"{self.path}/{kind}/batch_id={batch_id}/bucket={bucket}"
        columns = [F.lit(value).cast("bigint").alias(name) for name, value in row.items()]
        spark.range(1, numPartitions=1).select(*columns).write.mode("overwrite").parquet(path)

    def _marked(self, spark: SparkSession, kind: str, batch_id: int) -> dict[int, int]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}/batch_id={batch_id}")
        files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        if not files.exists(folder):
            return {}
        names = [status.getPath().getName() for status in files.listStatus(folder)]
        ended = [name for name in names if self._exists(spark, f"{self.path}/{kind}/batch_id={batch_id}/{name}")]
        if not ended:
            return {}
        paths = [f"{self.path}/{kind}/batch_id={batch_id}/{name}" for name in ended]
        return {row.bucket: row.begun_ms for row in spark.read.schema(_LEDGER).option("basePath", self.path).parquet(*paths).select("bucket", "begun_ms").collect()}

    def __call__(self, records: DataFrame, batch_id: int) -> None:
        spark = records.sparkSession
        written = self._written_down(records, batch_id)
        ended, begun = self._marked(spark, "ended", batch_id), self._marked(spark, "begun", batch_id)
        for row in written.select("_bucket").distinct().orderBy("_bucket").collect():
            bucket = row["_bucket"]
            if bucket in ended:
                continue
            part = written.where(F.col("_bucket") == bucket).drop("_bucket")
            if bucket in begun:
                arrived = self.read_back(spark, begun[bucket]).select(*self.keys)
                part = part.join(arrived, self.keys, "left_anti").select(*records.columns)
            else:
                self._mark(spark, "begun", batch_id, bucket)
            self.sink(part, batch_id)
            self._mark(spark, "ended", batch_id, bucket)
