"""Session settings the engine relies on, and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

STREAM_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Upload only what a batch changed, not a whole snapshot of the state.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # All stores of an executor share one bound; else each may fill buffers of its own.
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    # Of values as long as blocks of rows are, few go to Python at a time.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(1 << 24),
}

# Rows that are persisted come in as many partitions as their size asks for. Otherwise each use of them
# runs a task per shuffle partition, however few rows there are.
CACHE_CONF = {"spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true"}

# A key that occurs twice in a nested object takes its last value.
DECODE_CONF = {"spark.sql.variant.allowDuplicateKeys": "true"}


def build_session(app: str = "tocsin", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, UTC and no web page; `conf` overrides."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **STREAM_CONF,
        **DECODE_CONF,
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_conf(spark: SparkSession, settings: dict[str, str]) -> None:
    """Set runtime settings on a session somebody else built."""
    for key, value in settings.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under `spark.checkpoint.dir`, which every executor can reach.

    Only a local session may go without that setting; it then gets a temporary folder, which
    goes when the program ends.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        own = tempfile.mkdtemp(prefix="tocsin-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        context.setCheckpointDir(own)
        root = context.getCheckpointDir()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


# Folders of the tables that are to go when a block of `scratch_tables` ends; none outside of one.
_SCRATCH: list[list[str]] = []


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[None]:
    """Removes, at its end, the tables that `staged` has written inside.

    Put the use of a result inside as well: a DataFrame that was made here reads them.
    """
    _SCRATCH.append([])
    try:
        yield
    finally:
        hadoop = spark._jvm.org.apache.hadoop.fs
        for folder in _SCRATCH.pop():
            path = hadoop.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def staged(rows: DataFrame, name: str) -> DataFrame:
    """Write rows to the shared folder and read them back.

    For rows that are dear to derive and used more than once: a lost executor then costs a
    re-read, not a re-run of what led to them. The tables stay until `scratch_tables` removes them.
    """
    path = shared_folder(rows.sparkSession, name)
    if _SCRATCH:
        _SCRATCH[-1].append(path)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
