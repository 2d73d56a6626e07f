"""Running sums over groups of any size: first over buckets of the order, then inside each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows of a group that one window task sorts, roughly.
BUCKET_ROWS = 2_000


def digest_bucket(digest: Column, rows: int, groups: int = 1) -> Column:
    """A bucket of the order of a hex digest, such that a bucket holds some BUCKET_ROWS rows.

    Digests are spread evenly, so leading bits cut every group alike, however large it is; the
    number of buckets follows the number of rows.
    """
    wanted = max(1, rows // (BUCKET_ROWS * groups))
    bits = min(28, (wanted - 1).bit_length())
    return F.shiftright(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), 32 - bits)


def before(rows: DataFrame, group: list[str], bucket: str, order: list[str],
           amounts: dict[str, str]) -> DataFrame:
    """For each new column, the sum of an amount over what precedes the row in its group.

    A group is cut into buckets that follow the order. Bucket sums are pre-aggregated before
    their shuffle; a hot group costs one row per bucket there and many small windows below.
    Group columns must not be null.
    """
    keys = [*group, bucket]
    totals = rows.groupBy(*keys).agg(*(F.sum(a).alias(f"{n}__sum") for n, a in amounts.items()))
    earlier = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys,
        *(F.coalesce(F.sum(f"{n}__sum").over(earlier), F.lit(0)).alias(f"{n}__off") for n in amounts),
    )
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    joined = rows.join(offsets, keys)
    for name, amount in amounts.items():
        inner = F.coalesce(F.sum(amount).over(inside), F.lit(0))
        joined = joined.withColumn(name, F.col(f"{name}__off") + inner)
    return joined.drop(*(f"{name}__off" for name in amounts))


# Copies of one row that a single array lists.
_CHUNK = 10_000


def copies(rows: DataFrame, count: str, name: str, keys: list[str] | None = None) -> DataFrame:
    """Each row as often as `count` says, numbered from 0. Chunks of the copies are dealt out
    before they are listed, so that no task makes all copies of one row; by `keys`, if these tell
    rows apart."""
    chunk = f"{name}__from"
    keep = keys or [column for column in rows.columns if column != count]
    chunks = rows.withColumn(chunk, F.explode(F.sequence(F.lit(0), F.col(count) - 1, F.lit(_CHUNK))))
    dealt = chunks.repartition(*keep, chunk)
    last = F.least(F.col(chunk) + _CHUNK, F.col(count)) - 1
    return dealt.withColumn(name, F.explode(F.sequence(chunk, last))).drop(chunk, count)
