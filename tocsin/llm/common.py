"""What the operators of this folder share: tables, batch size, scratch tables, key digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tocsin.session import apply_conf, staged

# Bytes per Arrow batch: bounds what a Python worker holds of long texts, and leaves narrow rows
# in large batches.
ARROW_BYTES = "1048576b"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    apply_conf(spark, {"spark.sql.execution.arrow.maxBytesPerBatch": ARROW_BYTES})


def free_name(rows: DataFrame, name: str) -> str:
    """A column name that `rows` does not have yet, whatever the case."""
    taken = {column.lower() for column in rows.columns}
    while name.lower() in taken:
        name += "_"
    return name


def unit(*parts: Column) -> Column:
    """A number in (0, 1) drawn from the parts: the first 52 bits of their MD5."""
    digest = F.md5(F.concat_ws("|", *parts))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def crc_mod(key: Column, divisor: int) -> Column:
    """crc32 of the key as text, modulo; a null key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % divisor


def keep_table(rows: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives lost executors."""
    return staged(rows, name)


def discard(rows: DataFrame) -> None:
    """Remove a table of `keep_table` that nothing reads any more, as of an earlier round."""
    files = rows.inputFiles()
    if files:
        jvm, conf = rows.sparkSession._jvm, rows.sparkSession._jsc.hadoopConfiguration()
        folder = jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        folder.getFileSystem(conf).delete(folder, True)
