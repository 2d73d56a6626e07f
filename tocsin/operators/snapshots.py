"""Versions of what a history has led to, so that later questions read only what came since.

A snapshot at a moment holds, per id, the request that is still pending, and the schedules that
have fired since the snapshot before. A question about a later moment takes the snapshot and the
requests that came in between: the pending ones stand in for all that came before, as nothing else
of it can still come to anything. Each snapshot is made from the one before in the same way.

Requests are looked for by their arrival, so a log that is laid out by arrival is read from the
snapshot on only. A request that turns up later with an earlier arrival is not seen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tocsin.functions.rules import known_policy, with_schedule
from tocsin.operators.records import ready_records
from tocsin.operators.resolve import judge, plan_history
from tocsin.operators.slices import TARGET_ROWS
from tocsin.schema import FIRED, PENDING, REQUESTED

_STATE = ["id", "arrival_ms", "seq", "exec_ms"]
_VERSIONS = "as_of bigint, previous bigint"


class Snapshots:
    """Snapshots of one log under a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str, policy: str = REQUESTED, target_rows: int = TARGET_ROWS) -> None:
        self.spark = spark
        self.path = path
        self.policy = known_policy(policy)
        self.target_rows = target_rows

    def _folder(self, kind: str, as_of: int) -> str:
        return f"{self.path}/{kind}/{as_of}"

    def versions(self) -> list[int]:
        """The moments there is a finished snapshot of."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        folder = jvm.org.apache.hadoop.fs.Path(f"{self.path}/finished")
        files = folder.getFileSystem(conf)
        if not files.exists(folder):
            return []
        return sorted(int(status.getPath().getName()) for status in files.listStatus(folder))

    def latest(self, as_of: int) -> int | None:
        """The last snapshot at or before a moment."""
        return max((version for version in self.versions() if version <= as_of), default=None)

    def _resolved(self, requests: DataFrame, as_of: int, since: int | None) -> DataFrame:
        """What became, by a moment, of what was pending at a snapshot and of the requests since."""
        tail = requests.where(F.col("id").isNotNull() & (F.col("arrival_ms") <= as_of))
        if since is not None:
            tail = tail.where(F.col("arrival_ms") > since)
        known = with_schedule(tail, self.policy).select(*_STATE)
        if since is not None:
            known = self.spark.read.schema(known.schema).parquet(self._folder("pending", since)).unionByName(known)
        slices = plan_history(known, known.count(), self.target_rows) if self.target_rows else None
        return judge(known, slices, as_of).select(*_STATE, "outcome")

    def advance(self, requests: DataFrame, as_of: int) -> None:
        """A snapshot at a moment, from the last one before it. Made again, it comes out the same."""
        since = self.latest(as_of - 1)
        outcomes = self._folder("outcomes", as_of)
        resolved = self._resolved(requests, as_of, since).where(F.col("outcome").isin(FIRED, PENDING))
        resolved.write.mode("overwrite").parquet(outcomes)
        written = self.spark.read.schema(resolved.schema).parquet(outcomes)
        for kind, outcome in (("pending", PENDING), ("fired", FIRED)):
            part = written.where(F.col("outcome") == outcome).drop("outcome")
            part.write.mode("overwrite").parquet(self._folder(kind, as_of))
        # A snapshot counts from here on; one that was cut short is made anew.
        chain = self.spark.createDataFrame([(as_of, since)], _VERSIONS)
        chain.coalesce(1).write.mode("overwrite").parquet(self._folder("finished", as_of))

    def _fired(self, version: int | None, like: DataFrame) -> DataFrame:
        """All that has fired by a snapshot, from it and those it was made from."""
        chain = []
        while version is not None:
            chain.append(self._folder("fired", version))
            version = self.spark.read.schema(_VERSIONS).parquet(self._folder("finished", version)).first().previous
        if not chain:
            return like.limit(0)
        return self.spark.read.schema(like.schema).parquet(*chain)

    def pending(self, requests: DataFrame, as_of: int) -> DataFrame:
        """`id, seq, exec_ms` of what is pending at a moment."""
        resolved = self._resolved(requests, as_of, self.latest(as_of))
        return resolved.where(F.col("outcome") == PENDING).select("id", "seq", "exec_ms")

    def ready(self, requests: DataFrame, as_of: int) -> DataFrame:
        """All records that the log has made ready by a moment."""
        since = self.latest(as_of)
        late = self._resolved(requests, as_of, since).where(F.col("outcome") == FIRED).select(*_STATE)
        return ready_records(self._fired(since, late).unionByName(late), self.policy)
