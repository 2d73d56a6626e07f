"""Set-oriented streaming: each micro-batch applies the batch rule, without keyed state.

A micro-batch takes the schedules that are due or whose ids have new requests, applies the rule to
them and the new requests up to a horizon, sends out what has fired and notes what has changed.
All other schedules stay where they are, in a calendar on shared storage. Hot ids are cut into
slices as in the batch form. Within a partition the offset decides: stamps never fall along it, also
from one micro-batch to the next.

In a replay the horizon is the moment up to which every partition of the log is known: the least,
over the partitions, of their latest arrivals, and it never falls. Requests beyond it wait in the
state; requests behind it, as of a partition that turns up late, go to a table of their own and
are counted. Nothing fires at the horizon's very millisecond, since more requests may come with
it; `finish_replay` says that the log is at its end and sends out the rest.

In the running job the horizon is the clock, taken once per micro-batch and stored, so that a
repeated micro-batch sees the same. Requests are judged at their arrival, but not before the start
of the run.

Marks next to the checkpoint say, for a micro-batch and its predecessor, which runs of the calendar
hold. A micro-batch reads what its predecessor left and adds runs of its own, so repeating it after
a failure gives the same result. One in which nothing came in and nothing is due adds none.
"""

from __future__ import annotations

import time
from typing import NamedTuple

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructField, StructType

from tocsin.functions.rules import known_policy, with_schedule
from tocsin.operators.audit import accepted_steps, gone_off_steps, read_steps
from tocsin.operators.expected import gone_off_since
from tocsin.operators.reading import carried_on, plan_ranges, ranges_read
from tocsin.operators.records import ready_records
from tocsin.operators.resolve import judge, plan_history
from tocsin.operators.slices import TARGET_ROWS
from tocsin.schema import FIRED, PENDING, REQUESTED, STALE, SUPERSEDED
from tocsin.session import CACHE_CONF, apply_conf
from tocsin.sources.inputs import log_order, with_heartbeat
from tocsin.sources.outputs import Sink
from tocsin.streaming.calendar import AHEAD, IN_VAIN, TAKEN_BACK, WAITS, Calendar, Run

_STATE = ["id", "arrival_ms", "seq", "exec_ms"]
_NEVER = -(2**63)
_MARKS = (
    "batch_id bigint, version bigint, horizon bigint, next_due bigint, latest map<string,bigint>,"
    " runs array<struct<name:string,rows:bigint>>"
)


class Marks(NamedTuple):
    """After a micro-batch: how many have changed the state, the horizon, the next time due, the
    latest arrival by partition, and the runs that hold."""

    batch_id: int = -1
    version: int = 0
    horizon: int = _NEVER
    next_due: int | None = None
    latest: dict[str, int] = {}
    runs: list[Run] = []


class PendingTable:
    """What is pending between micro-batches, and the step from one to the next."""

    def __init__(
        self,
        state_path: str,
        sinks: list[Sink],
        policy: str = REQUESTED,
        target_rows: int = TARGET_ROWS,
        ticking: bool = False,
        started_ms: int | None = None,
        partitions: int = 1,
        late_sinks: list[Sink] | None = None,
        quarantine_sinks: list[Sink] | None = None,
        mismatch_sinks: list[Sink] | None = None,
        audit_sinks: list[Sink] | None = None,
        clock=lambda: int(time.time() * 1000),
    ) -> None:
        self.state_path = state_path
        self.sinks = sinks
        self.policy = known_policy(policy)
        self.target_rows = target_rows
        self.ticking = ticking
        self.started_ms = started_ms
        self.partitions = partitions
        self.late_sinks = late_sinks or []
        self.quarantine_sinks = quarantine_sinks or []
        self.mismatch_sinks = mismatch_sinks or []
        self.audit_sinks = audit_sinks or []
        # Timers that are set in vain are kept for those who ask.
        self.all_timers = bool(self.mismatch_sinks or self.audit_sinks)
        self.clock = clock
        self.calendar = Calendar(f"{state_path}/runs")

    # --- what is stored -------------------------------------------------------------------

    def _stored(self, spark: SparkSession, parity: int) -> Marks | None:
        try:
            rows = spark.read.schema(_MARKS).parquet(f"{self.state_path}/marks/{parity}").collect()
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
        return Marks(*rows[0])._replace(runs=[Run(*run) for run in rows[0].runs]) if rows else None

    def _marks(self, spark: SparkSession, batch_id: int) -> Marks | None:
        """What a micro-batch left, if it got that far."""
        found = self._stored(spark, batch_id % 2)
        return found if found and found.batch_id == batch_id else None

    def _store(self, spark: SparkSession, marks: Marks) -> None:
        path = f"{self.state_path}/marks/{marks.batch_id % 2}"
        spark.createDataFrame([tuple(marks)], _MARKS).coalesce(1).write.mode("overwrite").parquet(path)

    def _tidy(self, spark: SparkSession, before: Marks, batch_id: int) -> None:
        """Runs that only the marks before the last ones name are of no use to anybody."""
        old = self._stored(spark, batch_id % 2)
        if old and old.batch_id < before.batch_id:
            self.calendar.remove(spark, {run.name for run in old.runs} - {run.name for run in before.runs})

    # --- a micro-batch --------------------------------------------------------------------

    def _log(self, rows: DataFrame) -> DataFrame:
        """What is looked at of decoded records, or of a request log."""
        has = rows.columns
        names = {"id": F.col("id"), "arrival_ms": F.col("arrival_ms")}
        names["scheduled_at"] = F.col("scheduled_at") if "scheduled_at" in has else F.lit(None).cast("bigint")
        names["seq"] = F.col("seq") if "seq" in has else log_order()
        names["status"] = F.col("status") if "status" in has else F.lit(None).cast("string")
        if "reason" in has:
            names |= {"reason": F.col("reason"), "raw": F.col("raw")}
        return rows.select(*(column.alias(name) for name, column in names.items()))

    def _scheduled(self, requests: DataFrame) -> DataFrame:
        """Requests with the time they are judged at and the time that gives."""
        now = F.col("arrival_ms")
        if self.started_ms is not None:
            now = F.greatest(now, F.lit(self.started_ms))
        return with_schedule(requests.withColumn("arrival_ms", now), self.policy)

    def _judged(self, requests: DataFrame) -> DataFrame:
        return self._scheduled(requests).select(*_STATE)

    def _read(self, log: DataFrame, before: Marks) -> tuple[DataFrame, dict[str, int], int, int]:
        """New requests in reading order, the latest arrivals by partition after them, how many
        there are, and at most how many of them come too late."""
        kind = log.schema["seq"].dataType
        usable = log.where(F.col("id").isNotNull())
        latest = dict(before.latest)
        if not isinstance(kind, StructType) or "partition" not in kind.names:
            behind = F.count(F.when(F.col("arrival_ms") <= before.horizon, 1))
            last, arrived, late = usable.agg(F.max("arrival_ms"), F.count(F.lit(1)), behind).first()
            if arrived:
                latest["0"] = max(last, latest.get("0", _NEVER))
            return usable, latest, arrived, late
        found = ranges_read(usable).collect()
        arrived = sum(row.n for row in found)
        late = sum(row.n for row in found if row.part not in before.latest and row.first <= before.horizon)
        falls = any(row.latest > row.first or row.first < latest.get(row.part, _NEVER) for row in found)
        ranges = plan_ranges(usable, arrived) if falls else None
        floors = []
        for row in sorted(found if ranges is None else ranges_read(usable, ranges).collect(), key=lambda row: row[:2]):
            floor = latest.get(row.part, _NEVER)
            floors.append((row.part, row.range, floor))
            latest[row.part] = max(row.latest, floor)
        if falls:
            # Putting requests in order sorts them, and they are looked at several times. Two stages of
            # one job would both do it, so it is done ahead of them.
            usable = carried_on(usable, floors, ranges).persist(StorageLevel.MEMORY_AND_DISK)
            usable.count()
        return usable, latest, arrived, late

    def step(self, rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        apply_conf(spark, CACHE_CONF)
        before = (self._marks(spark, batch_id - 1) if batch_id > 0 else None) or Marks()
        log = decoded = self._log(rows).persist(StorageLevel.MEMORY_AND_DISK)
        read = None
        try:
            if "reason" in log.columns:
                self._set_aside(log, batch_id)
                log = log.where(F.col("reason").isNull())
            read, latest, arrived, late = self._read(log, before)
            if self.ticking:
                repeated = self._marks(spark, batch_id)
                horizon = repeated.horizon if repeated else max(before.horizon, self.clock())
                late = 0
            elif len(latest) >= self.partitions:
                horizon = max(before.horizon, min(latest.values(), default=_NEVER + 1) - 1)
            else:
                horizon = before.horizon
            marks = before._replace(batch_id=batch_id, horizon=horizon, latest=latest)
            self._tidy(spark, before, batch_id)
            if not arrived and (before.next_due is None or before.next_due > horizon):
                self._store(spark, marks)
                return
            marks = marks._replace(version=before.version + 1)
            if self.ticking:
                # Ahead of the work, for the clock of a repetition.
                self._store(spark, marks)
            if self.audit_sinks and arrived:
                self._audit(read, batch_id)
            new = self._judged(read)
            if late:
                for sink in self.late_sinks:
                    sink(new.where(F.col("arrival_ms") <= before.horizon), batch_id)
                new = new.where(F.col("arrival_ms") > before.horizon)
            self._advance(new, arrived, before, marks, batch_id)
        finally:
            if read is not None:
                read.unpersist()
            decoded.unpersist()

    def _audit(self, read: DataFrame, batch_id: int) -> None:
        scheduled = self._scheduled(read)
        steps = read_steps(scheduled).unionByName(accepted_steps(scheduled))
        for sink in self.audit_sinks:
            sink(steps, 4 * batch_id)

    def _set_aside(self, log: DataFrame, batch_id: int) -> None:
        bad = log.where(F.col("reason").isNotNull())
        if not (self.quarantine_sinks or self.audit_sinks) or bad.isEmpty():
            return
        for sink in self.audit_sinks:
            sink(read_steps(bad), 4 * batch_id + 1)
        place = F.col("seq")
        bad = bad.select("raw", "reason", "arrival_ms", place["partition"].alias("partition"), place["offset"].alias("offset"))
        for sink in self.quarantine_sinks:
            sink(bad, batch_id)

    def _known(self, new: DataFrame, stored: DataFrame, arrived: int, before: Marks, marks: Marks) -> DataFrame:
        """What the rule is applied to: new requests and those that waited for the horizon, and
        the schedules that are due or whose ids come up again."""
        come = new
        still_open = stored.where(F.col("at_ms") > before.horizon)
        due = (F.col("block") <= marks.horizon) & (F.col("at_ms") <= marks.horizon)
        if not self.ticking:
            waited = still_open.where((F.col("kind") == AHEAD) & due).select(*_STATE)
            come = come.where(F.col("arrival_ms") <= marks.horizon).unionByName(waited)
        armed = still_open.where(F.col("kind").isin(WAITS, TAKEN_BACK))
        ids = come.select("id") if arrived or not self.ticking else None
        if self.all_timers:
            off = still_open.where((F.col("kind") == IN_VAIN) & due).select("id")
            ids = off if ids is None else ids.unionByName(off)
        if ids is None:
            found = armed.where(due)
        else:
            again = ids.distinct().withColumn("again", F.lit(True))
            found = armed.join(again, "id", "left").where(due | F.col("again")).drop("again")
        kept = self.calendar.holding(found)
        if self.ticking:
            # What is pending was read before all that is new, and a stamp ahead of the clock counts
            # as the clock.
            kept = kept.withColumn("arrival_ms", F.lit(_NEVER))
            come = come.withColumn("arrival_ms", F.least("arrival_ms", F.lit(marks.horizon)))
        return kept.select(*_STATE, F.lit(True).alias("kept")).unionByName(
            come.select(*_STATE, F.lit(False).alias("kept")))

    def _advance(self, new: DataFrame, arrived: int, before: Marks, marks: Marks, number: int) -> None:
        spark = new.sparkSession
        apply_conf(spark, CACHE_CONF)
        seq = StructField("seq", new.schema["seq"].dataType)
        stored = self.calendar.rows(spark, seq, before.runs)
        known = self._known(new, stored, arrived, before, marks)
        slices = plan_history(known, arrived, self.target_rows)
        judged = judge(known, slices, marks.horizon).select(*_STATE, "kept", "outcome")
        judged = judged.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            changes = self._changes(judged, new, marks)
            self.calendar.write(changes, str(marks.version), marks.horizon)
            sent = judged.where(F.col("outcome") == FIRED).select(F.col("exec_ms").alias("at_ms"), F.lit(FIRED).alias("kind"))
            seen = changes.select("at_ms", "kind").unionByName(sent).groupBy("kind")
            written = {kind: (n, first) for kind, n, first in seen.agg(F.count(F.lit(1)), F.min("at_ms")).collect()}
            fired, _ = written.pop(FIRED, (0, None))
            run = Run(str(marks.version), sum(n for n, _ in written.values()))
            runs = [*before.runs, *([run] if run.rows else [])]
            runs = self.calendar.merged(spark, seq, runs, marks.version, marks.horizon)
            firsts = [first for kind, (_, first) in written.items() if kind in (WAITS, IN_VAIN)]
            if before.next_due is not None and before.next_due > marks.horizon:
                firsts.append(before.next_due)
            elif before.runs:
                firsts.append(self.calendar.first_after(stored, marks.horizon))
            due = min((first for first in firsts if first is not None), default=None)
            self._send(judged, fired, stored, arrived, before, marks, number)
            self._store(spark, marks._replace(next_due=due, runs=runs))
        finally:
            judged.unpersist()

    def _changes(self, judged: DataFrame, new: DataFrame, marks: Marks) -> DataFrame:
        """The rows that the calendar lacks after this micro-batch."""
        outcome, later = F.col("outcome"), F.col("exec_ms") > marks.horizon
        waits = F.when((outcome == PENDING) & ~F.col("kept"), F.lit(WAITS))
        gone = F.when((outcome == SUPERSEDED) & later & F.col("kept"), F.lit(TAKEN_BACK))
        kinds = [waits, gone]
        if self.all_timers:
            kinds.append(F.when((outcome == SUPERSEDED) & later, F.lit(IN_VAIN)))
        changes = judged.select(*_STATE, F.col("exec_ms").alias("at_ms"), F.explode(F.array(*kinds)).alias("kind"))
        changes = changes.where(F.col("kind").isNotNull())
        if not self.ticking:
            ahead = new.where(F.col("arrival_ms") > marks.horizon)
            changes = changes.unionByName(
                ahead.select(*_STATE, F.col("arrival_ms").alias("at_ms"), F.lit(AHEAD).alias("kind")))
        return changes.withColumn("version", F.lit(marks.version).cast("bigint"))

    def _send(
        self, judged: DataFrame, fired: int, stored: DataFrame, arrived: int, before: Marks, marks: Marks, number: int
    ) -> None:
        if fired:
            for sink in self.sinks:
                sink(ready_records(judged.where(F.col("outcome") == FIRED), self.policy), number)
        if self.all_timers:
            earlier = stored.where(
                (F.col("kind") == IN_VAIN) & (F.col("at_ms") > before.horizon) & (F.col("block") <= marks.horizon))
            off = gone_off_since(judged, earlier, marks.horizon, arrived, self.target_rows)
            off = off.persist(StorageLevel.MEMORY_AND_DISK)
            stale = off.where(F.col("outcome") == STALE).select("id", F.col("exec_ms").alias("timer_ms"), "expected_ms")
            try:
                if not off.isEmpty():
                    for sink in self.audit_sinks:
                        sink(gone_off_steps(off, self.policy), 4 * number + 2)
                if self.mismatch_sinks and not stale.isEmpty():
                    for sink in self.mismatch_sinks:
                        sink(stale, number)
            finally:
                off.unpersist()

    def finish(self, like: DataFrame) -> None:
        """Take the log as ended: send out what has fired by its last arrival."""
        spark = like.sparkSession
        both = [self._stored(spark, parity) for parity in (0, 1)]
        before = max((marks for marks in both if marks), key=lambda m: m.batch_id, default=Marks())
        if before.version == 0:
            return
        marks = before._replace(version=before.version + 1, horizon=max(before.latest.values()))
        ahead = sum(run.rows for run in before.runs)
        # Sinks get a number of its own, which no micro-batch will have.
        self._advance(like.limit(0), ahead, before, marks, -1 - marks.batch_id)


def _table(state_path: str, name: str) -> Sink:
    def write(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{state_path}/{name}/batch_id={batch_id}")

    return write


def start_replay(
    requests: DataFrame,
    sinks: list[Sink],
    checkpoint: str,
    policy: str = REQUESTED,
    trigger: dict | None = None,
    target_rows: int = TARGET_ROWS,
    partitions: int = 1,
    late_sinks: list[Sink] | None = None,
    quarantine_sinks: list[Sink] | None = None,
    mismatch_sinks: list[Sink] | None = None,
    audit_sinks: list[Sink] | None = None,
) -> StreamingQuery:
    """Replay a stream of `id, scheduled_at, arrival_ms, seq`, or a `Decoded.tagged`; by default to
    the end of its input.

    `partitions` is how many must have shown up before anything fires. Requests that come too late
    go to `late_sinks`, by default a table next to the checkpoint, likewise what could not be
    decoded to `quarantine_sinks`. `mismatch_sinks` get timers that went off in vain,
    `audit_sinks` a row for each step. Call `finish_replay` when no more will come.
    """
    state = f"{checkpoint}/pending"
    pending = PendingTable(
        state, sinks, policy, target_rows, partitions=partitions,
        late_sinks=[_table(checkpoint, "late")] if late_sinks is None else late_sinks,
        quarantine_sinks=[_table(checkpoint, "quarantined")] if quarantine_sinks is None else quarantine_sinks,
        mismatch_sinks=mismatch_sinks, audit_sinks=audit_sinks,
    )
    return (
        requests.writeStream.foreachBatch(pending.step)
        .option("checkpointLocation", f"{checkpoint}/progress")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def finish_replay(
    requests: DataFrame, sinks: list[Sink], checkpoint: str, policy: str = REQUESTED,
    target_rows: int = TARGET_ROWS, mismatch_sinks: list[Sink] | None = None,
    audit_sinks: list[Sink] | None = None,
) -> None:
    """Send out what a replayed log has made ready by its last arrival. `requests` is the stream
    that was replayed; only its schema is looked at."""
    spark = requests.sparkSession
    pending = PendingTable(
        f"{checkpoint}/pending", sinks, policy, target_rows, mismatch_sinks=mismatch_sinks, audit_sinks=audit_sinks)
    pending.finish(pending._judged(pending._log(spark.createDataFrame([], requests.schema))))


def start_set_triggers(
    tagged: DataFrame,
    sinks: list[Sink],
    checkpoint: str,
    policy: str = REQUESTED,
    interval: str = "1 second",
    target_rows: int = TARGET_ROWS,
    name: str = "set-triggers",
    quarantine_sinks: list[Sink] | None = None,
    mismatch_sinks: list[Sink] | None = None,
    audit_sinks: list[Sink] | None = None,
) -> StreamingQuery:
    """Run by the wall clock on a `Decoded.tagged`, or on `id, scheduled_at, arrival_ms, seq`, until
    stopped.

    Emits what the keyed form does. A micro-batch reads what is pending without a call per id and
    writes what has changed, so it suits many changes per micro-batch. What could not be decoded
    goes to `quarantine_sinks`, by default a table next to the checkpoint. `mismatch_sinks` get timers
    that went off in vain, `audit_sinks` a row for each step; hot ids are cut into slices for them too.
    """
    pending = PendingTable(
        f"{checkpoint}/pending", sinks, policy, target_rows, ticking=True,
        started_ms=int(time.time() * 1000),
        quarantine_sinks=[_table(checkpoint, "quarantined")] if quarantine_sinks is None else quarantine_sinks,
        mismatch_sinks=mismatch_sinks, audit_sinks=audit_sinks,
    )
    return (
        with_heartbeat(tagged)
        .writeStream.queryName(name)
        .foreachBatch(pending.step)
        .option("checkpointLocation", f"{checkpoint}/progress")
        .trigger(processingTime=interval)
        .start()
    )
