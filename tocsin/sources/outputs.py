"""Where ready records go. A sink takes the records of a micro-batch and the batch number."""

from __future__ import annotations

import sys
from collections.abc import Callable

from pyspark import StorageLevel, cloudpickle
from pyspark.sql import DataFrame

from tocsin.operators.records import encode_records
from tocsin.schema import REQUESTED

# Ship the code below with the job, so that executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

Sink = Callable[[DataFrame, int], None]

DEFAULT_OUTPUT_TOPIC = "scheduled-tasks"


def topic_sink(
    servers: str, topic: str = DEFAULT_OUTPUT_TOPIC, policy: str = REQUESTED, **options: str
) -> Sink:
    """JSON values without keys, delivered at least once."""
    settings = {"kafka.bootstrap.servers": servers, "topic": topic, **options}

    def write(records: DataFrame, batch_id: int) -> None:
        encode_records(records, policy).write.format("kafka").options(**settings).save()

    return write


def payload_sink(path: str, policy: str = REQUESTED) -> Sink:
    """The same payloads as text files; a repeated micro-batch replaces its own folder."""

    def write(records: DataFrame, batch_id: int) -> None:
        encode_records(records, policy).write.mode("overwrite").text(f"{path}/batch_id={batch_id}")

    return write


def table_sink(path: str) -> Sink:
    """Parquet, one folder per micro-batch; a repeated micro-batch replaces its own folder."""

    def write(records: DataFrame, batch_id: int) -> None:
        records.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def _print_lines(rows) -> None:
    for row in rows:
        print(row[0], flush=True)


def console_sink(policy: str = REQUESTED) -> Sink:
    """Every record on the standard output of the executor that holds it."""

    def write(records: DataFrame, batch_id: int) -> None:
        encode_records(records, policy).foreachPartition(_print_lines)

    return write


def fan_out(records: DataFrame, batch_id: int, targets: list[tuple[set[str], Sink]]) -> None:
    """Give each sink the same records, computed once, if there are any of the outcomes it is for.

    The count makes every task run, so state is committed also when nothing goes out.
    """
    kept = records.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        found = {row.outcome for row in kept.groupBy("outcome").count().collect()}
        for outcomes, sink in targets:
            if found & outcomes:
                sink(kept, batch_id)
    finally:
        kept.unpersist()
