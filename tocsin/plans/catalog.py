"""Named queries: each takes a session and a table folder and gives a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tocsin.functions.rules import with_schedule
from tocsin.operators.audit import audit_log, audit_summary, decode_steps, decode_summary
from tocsin.operators.decode import decode_requests, decode_tasks
from tocsin.operators.expected import mismatches
from tocsin.operators.reading import in_reading_order
from tocsin.operators.records import annotate_requests, encode_records, once, ready, ready_records
from tocsin.operators.resolve import log_stats, resolve, timer_outcomes
from tocsin.operators.snapshots import Snapshots
from tocsin.plans import logs
from tocsin.schema import (
    FIXED_DELAY,
    PENDING,
    REQUESTED,
    STALE,
    SUPERSEDED,
)
from tocsin.session import shared_folder, staged
from tocsin.sources.inputs import as_requests, folder_stream
from tocsin.sources.outbox import Outbox
from tocsin.sources.outputs import payload_sink, table_sink
from tocsin.streaming.durations import LATENESS, RANK_ERROR, quantiles, sketched
from tocsin.streaming.job import start_triggers
from tocsin.streaming.processor import ARRIVAL
from tocsin.streaming.reconcile import ARMED, balance, differences, tally
from tocsin.streaming.replay import PendingTable, finish_replay, start_replay
from tocsin.streaming.state import from_checkpoint, from_history, live_pending, live_timers

Query = Callable[[SparkSession, str], DataFrame]

# 2024-01-16 00:00:00 UTC, halfway through the log.
MIDWAY_MS = 1_705_363_200_000

# Small enough that the hot id of the test logs is cut into slices at any scale.
HOT_TARGET_ROWS = 200

# Payloads of a file of a log. A table of one row group is read by one task, whose files are decoded
# by one task each.
LOG_FILE_ROWS = 50_000


# --- the rule -------------------------------------------------------------------------------


def effective_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_schedule(logs.requests(spark, sf_dir)).select(
        "id", "seq", "arrival_ms", "scheduled_at", "exec_ms", "schedule_source"
    )


def schedule_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        with_schedule(logs.requests(spark, sf_dir))
        .groupBy("schedule_source")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def annotated_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotate_requests(logs.requests(spark, sf_dir)).select(
        "id", "seq", "scheduled_at", "status", "exec_ms"
    )


def fixed_delay_annotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotate_requests(logs.task_requests(spark, sf_dir), FIXED_DELAY).select(
        "id",
        "seq",
        "status",
        F.unix_millis("next_execution_time").alias("next_execution_ms"),
        F.unix_millis("updated_at").alias("updated_ms"),
    )


# --- outcomes at a horizon ------------------------------------------------------------------


def _at_end(requests: DataFrame, policy: str = REQUESTED, **options) -> tuple[DataFrame, int]:
    """The log resolved at its last arrival."""
    stats = log_stats(requests)
    as_of = stats.last_arrival_ms
    return resolve(requests, as_of, policy, rows=stats.rows, **options), as_of


def _ready_at_end(requests: DataFrame, policy: str = REQUESTED, **options) -> DataFrame:
    stats = log_stats(requests)
    return ready(requests, stats.last_arrival_ms, policy, rows=stats.rows, **options)


def ready_at_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ready_at_end(logs.requests(spark, sf_dir))


def pending_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        resolve(logs.requests(spark, sf_dir), MIDWAY_MS)
        .where(F.col("outcome") == PENDING)
        .select("id", "seq", "exec_ms")
    )


def superseded_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved, _ = _at_end(logs.requests(spark, sf_dir))
    return resolved.where(F.col("outcome") == SUPERSEDED).select(
        "id", "seq", "exec_ms", "next_arrival_ms"
    )


def stale_timers(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved, as_of = _at_end(logs.requests(spark, sf_dir))
    return timer_outcomes(resolved, as_of).where(F.col("outcome") == STALE).select("id", "exec_ms")


def timer_outcome_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved = resolve(logs.requests(spark, sf_dir), MIDWAY_MS)
    return (
        timer_outcomes(resolved, MIDWAY_MS).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))
    )


def timer_mismatch_expected(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = logs.requests(spark, sf_dir)
    stats = log_stats(requests)
    return mismatches(requests, stats.last_arrival_ms, rows=stats.rows)


def fixed_delay_ready(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain_task(_ready_at_end(logs.task_requests(spark, sf_dir), FIXED_DELAY))


def fixed_delay_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = logs.task_requests(spark, sf_dir)
    stats = log_stats(requests)
    return mismatches(requests, stats.last_arrival_ms, policy=FIXED_DELAY, rows=stats.rows)


# --- snapshots ------------------------------------------------------------------------------


def _snapshots(spark: SparkSession, sf_dir: str) -> tuple[Snapshots, DataFrame]:
    """Three snapshots up to midway, each made from the one before, and the log."""
    requests = logs.requests(spark, sf_dir)
    snapshots = Snapshots(spark, shared_folder(spark, "snapshots"))
    for as_of in (MIDWAY_MS - 10 * 86_400_000, MIDWAY_MS - 3 * 86_400_000, MIDWAY_MS):
        snapshots.advance(requests, as_of)
    return snapshots, requests


def ready_from_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    snapshots, requests = _snapshots(spark, sf_dir)
    return snapshots.ready(requests, log_stats(requests).last_arrival_ms)


def pending_from_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    snapshots, requests = _snapshots(spark, sf_dir)
    return snapshots.pending(requests, MIDWAY_MS + 86_400_000)


# --- the same with a third of the log on one id ---------------------------------------------


def hot_id_ready(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ready_at_end(logs.hot_requests(spark, sf_dir), target_rows=HOT_TARGET_ROWS)


def hot_id_timer_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved, as_of = _at_end(logs.hot_requests(spark, sf_dir), target_rows=HOT_TARGET_ROWS)
    return timer_outcomes(resolved, as_of)


def hot_id_mismatch_expected(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = logs.hot_requests(spark, sf_dir)
    stats = log_stats(requests)
    return mismatches(
        requests, stats.last_arrival_ms, rows=stats.rows, target_rows=HOT_TARGET_ROWS
    )


# --- payloads -------------------------------------------------------------------------------


def decoded_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_requests(logs.mixed_request_payloads(spark, sf_dir)).valid.drop("partition")


def quarantined_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_requests(logs.mixed_request_payloads(spark, sf_dir)).quarantine.select(
        "reason", "arrival_ms", "offset", F.octet_length("raw").alias("bytes")
    )


def quarantine_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_summary(decode_requests(logs.mixed_request_payloads(spark, sf_dir)))


def _plain_task(tasks: DataFrame) -> DataFrame:
    """Instants as microseconds and maps as text, which any engine compares alike."""
    return tasks.withColumns(
        {
            "next_execution_time": F.unix_micros("next_execution_time"),
            "created_at": F.unix_micros("created_at"),
            "updated_at": F.unix_micros("updated_at"),
            "parameters": F.to_json("parameters"),
        }
    )


def decoded_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = decode_tasks(logs.mixed_task_payloads(spark, sf_dir)).valid
    return _plain_task(valid.drop("partition", "arrival_ms"))


def quarantine_task_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_summary(decode_tasks(logs.mixed_task_payloads(spark, sf_dir)))


def encode_ready(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_records(_ready_at_end(logs.requests(spark, sf_dir)))


def encode_ready_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_records(
        _ready_at_end(logs.task_requests(spark, sf_dir), FIXED_DELAY), FIXED_DELAY
    )


def encode_decoded_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_records(decode_requests(logs.request_payloads(spark, sf_dir)).valid)


def encode_decoded_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_records(decode_tasks(logs.task_payloads(spark, sf_dir)).valid, FIXED_DELAY)


def payloads_to_ready(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From payloads to payloads: decode, keep what can be read, resolve, encode.

    The decoded log is staged, as measuring and resolving it would else decode it twice.
    """
    valid = decode_requests(logs.mixed_request_payloads(spark, sf_dir)).valid
    return encode_records(_ready_at_end(staged(as_requests(valid), "decoded")))


def delivered_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ready payloads, a third of them delivered twice, read back without the repetitions."""
    sent = encode_records(_ready_at_end(logs.requests(spark, sf_dir)))
    again = sent.where(F.crc32(F.col("value").cast("binary")) % 3 == 0)
    return once(decode_requests(sent.unionByName(again)).valid)


# --- audit ----------------------------------------------------------------------------------


def audit_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = logs.requests(spark, sf_dir)
    stats = log_stats(requests)
    return audit_log(requests, stats.last_arrival_ms, rows=stats.rows)


def audit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_summary(audit_steps(spark, sf_dir))


def audit_task_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every step of full tasks under the set delay, from their payloads on."""
    decoded = decode_tasks(logs.mixed_task_payloads(spark, sf_dir))
    requests = staged(as_requests(decoded.valid), "tasks")
    stats = log_stats(requests)
    steps = audit_log(requests, stats.last_arrival_ms, FIXED_DELAY, rows=stats.rows)
    return decode_steps(decoded).unionByName(steps)


# --- reading order --------------------------------------------------------------------------

# A day of the test log's offsets.
_DAY_OF_OFFSETS = 86_400_000 * 1_000_000


def offset_order_ready(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ready_at_end(in_reading_order(logs.unordered_requests(spark, sf_dir), _DAY_OF_OFFSETS))


# --- streaming ------------------------------------------------------------------------------

# 2024-01-11 and 2024-01-21.
_THIRDS = [1_704_931_200_000, 1_705_795_200_000]


def _before(payloads: DataFrame, start: int | None, end: int | None, by: str) -> DataFrame:
    if start is not None:
        payloads = payloads.where(F.col(by) >= start)
    return payloads if end is None else payloads.where(F.col(by) < end)


def _thirds(payloads: DataFrame, by: str = "arrival_ms") -> list[DataFrame]:
    bounds = [None, *_THIRDS, None]
    return [_before(payloads, start, end, by) for start, end in zip(bounds, bounds[1:])]


def _uneven(payloads: DataFrame, by: str = "arrival_ms") -> list[DataFrame]:
    """Partitions read at different speeds: some are a third ahead of the others."""
    fast = F.col("partition") % 2 == 0
    first, second, third = _thirds(payloads, by)
    return [
        first.unionByName(second.where(fast)),
        second.where(~fast).unionByName(third.where(fast)),
        third.where(~fast),
    ]


def _sunk(spark: SparkSession, path: str, policy: str) -> DataFrame:
    """What a table sink has been given, nothing included."""
    fired = spark.createDataFrame([], "id string, exec_ms bigint")
    try:
        return spark.read.schema(ready_records(fired, policy).schema).parquet(path).drop("batch_id")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return ready_records(fired, policy)


def _append(part: DataFrame, log: str) -> None:
    """Adds payloads to a log in files that tasks of their own decode, however few the tasks that write."""
    part.write.option("maxRecordsPerFile", LOG_FILE_ROWS).mode("append").parquet(log)


def _replay_in_parts(spark, parts, decode, sinks, folder, policy, partitions: int = 1, **options) -> None:
    """Let a payload log grow part by part and catch up after each, in a new run."""
    log, checkpoint = f"{folder}/log", f"{folder}/checkpoint"
    for part in parts:
        _append(part, log)
        tagged = decode(folder_stream(spark, log)).tagged
        start_replay(
            tagged, sinks, checkpoint, policy, partitions=partitions, quarantine_sinks=[], **options
        ).awaitTermination()
    finish_replay(tagged, sinks, checkpoint, policy, **options)


def _ticks_in_parts(spark, parts, decode, sinks, folder, clocks) -> None:
    """The set-oriented running form over the parts of a log, with a clock set by hand for each."""
    log = f"{folder}/log"
    for part, clock in zip(parts, clocks):
        _append(part, log)
        pending = PendingTable(f"{folder}/pending", sinks, ticking=True, clock=lambda: clock)
        folder_stream(spark, log).transform(lambda payloads: decode(payloads).tagged).writeStream.foreachBatch(
            pending.step
        ).option("checkpointLocation", f"{folder}/progress").trigger(availableNow=True).start().awaitTermination()


def _keyed_in_parts(spark, parts, decode, sinks, folder, policy, partitions: int = 1, **options) -> None:
    """The same through the stateful operator, by the log's own clock."""
    log = f"{folder}/log"
    for part in parts:
        _append(part, log)
        start_triggers(
            decode(folder_stream(spark, log)).tagged, sinks, f"{folder}/checkpoint", policy,
            quarantine_sinks=[], clock=ARRIVAL, trigger={"availableNow": True}, partitions=partitions, **options,
        ).awaitTermination()


def _end_of_log(payloads: DataFrame, partitions: int = 1, at_ms: int | None = None) -> DataFrame:
    """An empty payload in each partition, a millisecond after the last of all or after a moment:
    time passes, nothing is asked for."""
    last = F.max("arrival_ms") if at_ms is None else F.lit(at_ms)
    end = payloads.agg((last + 1).alias("arrival_ms"), F.max("offset").alias("offset"))
    return end.select(
        F.lit(b"").alias("value"), "arrival_ms",
        F.explode(F.sequence(F.lit(0), F.lit(partitions - 1))).alias("partition"),
        (F.col("offset") + 1_000_000).alias("offset"),
    )


def stream_ready(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "stream-ready")
    out = f"{folder}/ready"
    parts = _thirds(logs.request_payloads(spark, sf_dir))
    _replay_in_parts(spark, parts, decode_requests, [table_sink(out)], folder, REQUESTED)
    return _sunk(spark, out, REQUESTED)


def stream_ready_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "stream-ready-partitions")
    out = f"{folder}/ready"
    parts = _uneven(logs.in_partitions(logs.request_payloads(spark, sf_dir), 4))
    _replay_in_parts(spark, parts, decode_requests, [table_sink(out)], folder, REQUESTED, 4)
    return _sunk(spark, out, REQUESTED)


def stream_offset_order_ready(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stamps that fall back within a partition, in partitions read at different speeds."""
    folder = shared_folder(spark, "stream-offset-order")
    out = f"{folder}/ready"
    parts = [part.drop("place_ms") for part in _uneven(logs.unordered_payloads(spark, sf_dir), "place_ms")]
    _replay_in_parts(spark, parts, decode_requests, [table_sink(out)], folder, REQUESTED, 4)
    return _sunk(spark, out, REQUESTED)


def stream_set_offset_order_ready(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by the running form, whose clock stands still until the log is read."""
    folder = shared_folder(spark, "stream-set-offset-order")
    out = f"{folder}/ready"
    payloads = logs.unordered_payloads(spark, sf_dir)
    parts = [*_thirds(payloads, "place_ms"), _end_of_log(payloads, 4)]
    last = payloads.agg(F.max("arrival_ms")).first()[0]
    parts = [part.drop("place_ms") for part in parts]
    _ticks_in_parts(spark, parts, decode_requests, [table_sink(out)], folder, [*[end - 20_000 for end in _THIRDS], last, last])
    return _sunk(spark, out, REQUESTED)


def _mismatched(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema("id string, timer_ms bigint, expected_ms bigint").parquet(path).drop("batch_id")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "id string, timer_ms bigint, expected_ms bigint")


def _stream_mismatch(spark: SparkSession, payloads: DataFrame, name: str, **options) -> DataFrame:
    folder = shared_folder(spark, name)
    out = f"{folder}/stale"
    parts = _uneven(payloads)
    _replay_in_parts(
        spark, parts, decode_requests, [], folder, REQUESTED, 4, mismatch_sinks=[table_sink(out)], **options)
    return _mismatched(spark, out)


def stream_mismatch_expected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected times looked up as the log is read, from what earlier micro-batches have left."""
    payloads = logs.in_partitions(logs.request_payloads(spark, sf_dir), 4)
    return _stream_mismatch(spark, payloads, "stream-mismatch")


def stream_hot_id_mismatch_expected(spark: SparkSession, sf_dir: str) -> DataFrame:
    payloads = logs.in_partitions(logs.hot_payloads(spark, sf_dir), 4)
    return _stream_mismatch(spark, payloads, "stream-hot-mismatch", target_rows=HOT_TARGET_ROWS)


def _steps_written(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(
        "id string, phase string, at_ms bigint, exec_ms bigint, expected_ms bigint, bytes int, detail string"
    ).parquet(path).drop("batch_id")


def stream_hot_id_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every step of a replay with a third of its log on one id, which is cut into slices."""
    folder = shared_folder(spark, "stream-hot-audit")
    out = f"{folder}/audit"
    payloads = logs.in_partitions(logs.hot_payloads(spark, sf_dir), 4)
    _replay_in_parts(
        spark, _uneven(payloads), decode_requests, [], folder, REQUESTED, 4, target_rows=HOT_TARGET_ROWS,
        audit_sinks=[table_sink(out)])
    return _steps_written(spark, out)


class _BreaksHalfway:
    """A sink without memory, like a topic: what it is given comes on top of what is there. It
    fails once, after it has taken half of the records it was given."""

    def __init__(self, path: str) -> None:
        self.path = path
        self.broken = False

    def __call__(self, records: DataFrame, batch_id: int) -> None:
        if batch_id < 1 or self.broken:
            records.write.mode("append").parquet(self.path)
            return
        self.broken = True
        half = F.pmod(F.xxhash64("id", "scheduled_at"), F.lit(2)) == 0
        records.where(half).write.mode("append").parquet(self.path)
        raise ConnectionError("the sink is gone")

    def since(self, spark: SparkSession, moment_ms: int) -> DataFrame:
        return _sunk(spark, self.path, REQUESTED)


def stream_delivered_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A replay whose sink fails in the middle of a micro-batch, and is taken up again."""
    folder = shared_folder(spark, "stream-delivered-once")
    log, checkpoint = f"{folder}/log", f"{folder}/checkpoint"
    sink = _BreaksHalfway(f"{folder}/topic")
    outbox = Outbox(f"{folder}/outbox", sink, sink.since, bucket_rows=200)
    for part in _thirds(logs.request_payloads(spark, sf_dir)):
        _append(part, log)
        requests = as_requests(decode_requests(folder_stream(spark, log)).valid)
        for _ in range(2):
            try:
                start_replay(requests, [outbox], checkpoint).awaitTermination()
                break
            except StreamingQueryException:
                if not sink.broken:
                    raise
    finish_replay(requests, [outbox], checkpoint)
    return _sunk(spark, sink.path, REQUESTED)


def stream_fixed_delay_ready(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "stream-fixed-delay-ready")
    out = f"{folder}/ready"
    parts = _thirds(logs.task_payloads(spark, sf_dir))
    _replay_in_parts(spark, parts, decode_tasks, [table_sink(out)], folder, FIXED_DELAY)
    return _plain_task(_sunk(spark, out, FIXED_DELAY))


def stream_keyed_ready(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "stream-keyed-ready")
    out = f"{folder}/ready"
    payloads = logs.in_partitions(logs.request_payloads(spark, sf_dir))
    parts = [*_thirds(payloads), _end_of_log(payloads)]
    _keyed_in_parts(spark, parts, decode_requests, [table_sink(out)], folder, REQUESTED)
    return _sunk(spark, out, REQUESTED)


def stream_keyed_ready_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four partitions, read at different speeds, in a run for each part of the log."""
    folder = shared_folder(spark, "stream-keyed-ready-partitions")
    out = f"{folder}/ready"
    payloads = logs.in_partitions(logs.request_payloads(spark, sf_dir), 4)
    parts = [*_uneven(payloads), _end_of_log(payloads, 4)]
    _keyed_in_parts(spark, parts, decode_requests, [table_sink(out)], folder, REQUESTED, 4)
    return _sunk(spark, out, REQUESTED)


def stream_keyed_offset_order_ready(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stamps that fall back within a partition, also from one micro-batch to the next."""
    folder = shared_folder(spark, "stream-keyed-offset-order")
    out = f"{folder}/ready"
    payloads = logs.unordered_payloads(spark, sf_dir)
    parts = [*_uneven(payloads, "place_ms"), _end_of_log(payloads, 4)]
    parts = [part.drop("place_ms") for part in parts]
    _keyed_in_parts(spark, parts, decode_requests, [table_sink(out)], folder, REQUESTED, 4)
    return _sunk(spark, out, REQUESTED)


# --- running state --------------------------------------------------------------------------


def _run_to_midway(spark: SparkSession, sf_dir: str, name: str, **options) -> str:
    """The checkpoint of a keyed run stopped midway, in two partitions."""
    folder = shared_folder(spark, name)
    payloads = logs.in_partitions(logs.request_payloads(spark, sf_dir), 2)
    first = payloads.where(F.col("arrival_ms") <= MIDWAY_MS)
    parts = [first, _end_of_log(payloads, 2, MIDWAY_MS)]
    _keyed_in_parts(spark, parts, decode_requests, [], folder, REQUESTED, 2, **options)
    return f"{folder}/checkpoint"


def live_pending_midway(spark: SparkSession, sf_dir: str) -> DataFrame:
    return live_pending(spark, _run_to_midway(spark, sf_dir, "live-pending"))


def live_timers_midway(spark: SparkSession, sf_dir: str) -> DataFrame:
    return live_timers(spark, _run_to_midway(spark, sf_dir, "live-timers", keep_stale_timers=True))


def stream_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a keyed run has noted of its timers and has left in its state, against the batch rule;
    the sum of all against what was set."""
    path = shared_folder(spark, "ledger")
    checkpoint = _run_to_midway(spark, sf_dir, "reconciliation", ledger_sinks=[table_sink(path)])
    ledger = spark.read.schema("outcome string, n bigint, digest decimal(38,0)").parquet(path)
    live = balance(ledger, live_timers(spark, checkpoint))
    resolved = resolve(logs.requests(spark, sf_dir), MIDWAY_MS)
    ways = differences(live.where(F.col("outcome") != ARMED), tally(timer_outcomes(resolved, MIDWAY_MS)))
    whole = live.where(F.col("outcome") == ARMED).select("outcome", "n", "missing", "difference")
    return ways.unionByName(whole).withColumn("difference", F.col("difference").cast("string"))


def audit_lateness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How late records go out if a job looks every ten seconds: sketched for each third of the log,
    merged, and held against exact ranks."""
    interval = 10_000
    fired = _ready_at_end(logs.requests(spark, sf_dir)).select(F.col("scheduled_at").alias("exec_ms"))
    late = fired.withColumn("value", F.pmod(-F.col("exec_ms"), F.lit(interval))).withColumn("phase", F.lit(LATENESS))
    late = staged(late, "lateness")
    path = shared_folder(spark, "sketches")
    for number, part in enumerate(_thirds(late, "exec_ms")):
        table_sink(path)(sketched(part.select("phase", "value")), number)
    found = quantiles(spark.read.parquet(path).drop("batch_id"), 0.5, 0.9, 0.99)
    ranks = late.join(F.broadcast(found.withColumnRenamed("value", "found")), "phase")
    exact = ranks.groupBy("phase", "n", "part").agg(
        F.avg((F.col("value") < F.col("found")).cast("int")).alias("below"),
        F.avg((F.col("value") <= F.col("found")).cast("int")).alias("up_to"),
    )
    within = (F.col("below") <= F.col("part") + RANK_ERROR) & (F.col("up_to") >= F.col("part") - RANK_ERROR)
    return exact.select("phase", "n", "part", within.alias("within_rank_error"))


def stream_seeded_ready(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the log by the batch rule, a third by a keyed run that starts from there, the rest
    by another with a different number of shuffle partitions that starts from its state."""
    folder = shared_folder(spark, "stream-seeded")
    out = f"{folder}/ready"
    payloads = logs.in_partitions(logs.request_payloads(spark, sf_dir), 2)
    first, second, third = _thirds(payloads)
    ends = [end - 1 for end in _THIRDS]
    history = staged(as_requests(decode_requests(first).valid), "history")
    table_sink(f"{out}/batch")(ready(history, ends[0]), 0)
    start = from_history(history, ends[0])
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    runs = [(3, [second, _end_of_log(payloads, 2, ends[1])]), (5, [third, _end_of_log(payloads, 2)])]
    try:
        for number, (partitions, parts) in enumerate(runs):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            run = f"{folder}/run-{number}"
            sinks = [table_sink(f"{out}/run-{number}")]
            _keyed_in_parts(spark, parts, decode_requests, sinks, run, REQUESTED, 2, start=start)
            start = from_checkpoint(spark, f"{run}/checkpoint")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", usual)
    whole = _sunk(spark, f"{out}/batch", REQUESTED)
    for number in range(len(runs)):
        whole = whole.unionByName(_sunk(spark, f"{out}/run-{number}", REQUESTED))
    return whole


def stream_keyed_fixed_delay_ready(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "stream-keyed-fixed-delay-ready")
    out = f"{folder}/ready"
    payloads = logs.in_partitions(logs.task_payloads(spark, sf_dir))
    parts = [*_thirds(payloads), _end_of_log(payloads)]
    _keyed_in_parts(spark, parts, decode_tasks, [table_sink(out)], folder, FIXED_DELAY)
    return _plain_task(_sunk(spark, out, FIXED_DELAY))


def stream_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that reached each of two sinks of one replay."""
    folder = shared_folder(spark, "stream-fanout")
    table, topic = f"{folder}/monitor", f"{folder}/topic"
    parts = _thirds(logs.mixed_request_payloads(spark, sf_dir))
    sinks = [payload_sink(topic), table_sink(table)]
    _replay_in_parts(spark, parts, decode_requests, sinks, folder, REQUESTED)
    return (
        spark.read.text(topic)
        .select(F.lit("topic").alias("sink"))
        .unionByName(_sunk(spark, table, REQUESTED).select(F.lit("monitor").alias("sink")))
        .groupBy("sink")
        .agg(F.count(F.lit(1)).alias("n"))
    )


QUERIES: dict[str, Query] = {
    "effective_schedule": effective_schedule,
    "schedule_provenance": schedule_provenance,
    "annotated_requests": annotated_requests,
    "fixed_delay_annotated": fixed_delay_annotated,
    "ready": ready_at_end,
    "pending_as_of": pending_as_of,
    "superseded_requests": superseded_requests,
    "stale_timers": stale_timers,
    "timer_outcomes": timer_outcome_counts,
    "timer_mismatch_expected": timer_mismatch_expected,
    "fixed_delay_ready": fixed_delay_ready,
    "fixed_delay_mismatch": fixed_delay_mismatch,
    "ready_from_snapshot": ready_from_snapshot,
    "pending_from_snapshot": pending_from_snapshot,
    "hot_id_ready": hot_id_ready,
    "hot_id_timer_outcomes": hot_id_timer_outcomes,
    "hot_id_mismatch_expected": hot_id_mismatch_expected,
    "decode_requests": decoded_requests,
    "quarantined_requests": quarantined_requests,
    "quarantine_counts": quarantine_counts,
    "decode_tasks": decoded_tasks,
    "quarantine_task_counts": quarantine_task_counts,
    "encode_ready": encode_ready,
    "encode_ready_tasks": encode_ready_tasks,
    "encode_requests": encode_decoded_requests,
    "encode_tasks": encode_decoded_tasks,
    "payloads_to_ready": payloads_to_ready,
    "delivered_once": delivered_once,
    "audit_log": audit_steps,
    "audit_summary": audit_counts,
    "audit_task_log": audit_task_log,
    "offset_order_ready": offset_order_ready,
    "stream_ready": stream_ready,
    "stream_ready_partitions": stream_ready_partitions,
    "stream_keyed_ready": stream_keyed_ready,
    "stream_keyed_ready_partitions": stream_keyed_ready_partitions,
    "stream_keyed_offset_order_ready": stream_keyed_offset_order_ready,
    "live_pending": live_pending_midway,
    "live_timers": live_timers_midway,
    "stream_seeded_ready": stream_seeded_ready,
    "stream_reconciliation": stream_reconciliation,
    "audit_lateness": audit_lateness,
    "stream_keyed_fixed_delay_ready": stream_keyed_fixed_delay_ready,
    "stream_offset_order_ready": stream_offset_order_ready,
    "stream_set_offset_order_ready": stream_set_offset_order_ready,
    "stream_mismatch_expected": stream_mismatch_expected,
    "stream_hot_id_mismatch_expected": stream_hot_id_mismatch_expected,
    "stream_hot_id_audit": stream_hot_id_audit,
    "stream_delivered_once": stream_delivered_once,
    "stream_fixed_delay_ready": stream_fixed_delay_ready,
    "stream_fanout": stream_fanout,
}
