"""Placing rows into shards with a weighted hash tree of regions, racks and shards.

At each level every child draws -ln(u) / weight, with u hashed from the row's key and the child's
name, and the least draw wins; a child thus gets its weight's share. A draw depends on nothing but
key, child and weight, so a change of weight moves rows only out of or into the subtree whose
weight changed: raising it takes rows from its siblings, lowering it gives rows to them, and the
paths inside the siblings stay as they are. A shard added as a region of its own takes rows only
into itself.

The law is `key`: key and shard count alone decide. Equal rows share a shard and hold adjacent
slots; equal draws go to the child named first. A null key is hashed as an empty text with a mark of
its own; null texts have no bytes, texts of any length count whole. An empty table gives an empty
result, and other columns take no part, whatever their names.
"""

from __future__ import annotations

from collections import defaultdict
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tocsin.llm.common import keep_table, unit
from tocsin.llm.running import before, copies, digest_bucket

SHARDS = 24
RACKS_PER_REGION = 3
SHARDS_PER_RACK = 4

# Bytes a row takes besides its text.
ROW_BYTES = 8


class Leaf(NamedTuple):
    """A shard, the rack and the region it stands in, and its weight."""

    region: int
    rack: int
    shard: int
    weight: float = 1.0


def tree(shards: int = SHARDS, added: int = 0) -> list[Leaf]:
    """Shards of equal weight in full racks and regions, then `added` shards, each a region of
    its own."""
    per_region = RACKS_PER_REGION * SHARDS_PER_RACK
    laid = [
        Leaf(s // per_region, s % per_region // SHARDS_PER_RACK, s) for s in range(shards)
    ]
    regions = 1 + max((leaf.region for leaf in laid), default=-1)
    return laid + [Leaf(regions + i, 0, shards + i) for i in range(added)]


def _least_draw(key: Column, path: str, weights: dict[int, float]) -> Column:
    draws = [
        F.struct(
            (-F.log(unit(key, F.lit(f"{path}/{child}"))) / F.lit(float(weight))).alias("draw"),
            F.lit(child).alias("child"),
        )
        for child, weight in sorted(weights.items())
        if weight > 0
    ]
    return F.array_min(F.array(*draws))["child"]


def _by(chosen: Column, options: dict[int, Column]) -> Column:
    if len(options) == 1:
        return next(iter(options.values()))
    picked = F
    for child, column in sorted(options.items()):
        picked = picked.when(chosen == child, column)
    return picked


def place(key: Column, leaves: list[Leaf]) -> Column:
    """The shard that a key descends to."""
    regions: dict[int, float] = defaultdict(float)
    racks: dict[int, dict[int, float]] = defaultdict(lambda: defaultdict(float))
    shards: dict[tuple[int, int], dict[int, float]] = defaultdict(dict)
    for leaf in leaves:
        regions[leaf.region] += leaf.weight
        racks[leaf.region][leaf.rack] += leaf.weight
        shards[leaf.region, leaf.rack][leaf.shard] = leaf.weight
    ends = {}
    for region, inner in racks.items():
        if regions[region] > 0:
            rack = _least_draw(key, f"rack/{region}", inner)
            ends[region] = _by(rack, {
                r: _least_draw(key, f"shard/{region}/{r}", shards[region, r])
                for r, weight in inner.items() if weight > 0
            })
    return _by(_least_draw(key, "region", regions), ends)


def key_text(key: str) -> Column:
    return F.coalesce(F.concat(F.lit("k"), F.col(key).cast("string")), F.lit("null"))


def assign(documents: DataFrame, shards: int = SHARDS, key: str = "doc_id",
           text: str = "text") -> DataFrame:
    """Shard, slot and the shard after growing by one, for each row.

    Slots are dense in each shard. They follow a digest of the row, cut into buckets by its
    leading bits; equal rows are counted before the shuffle and listed after it.
    """
    known = F.coalesce(F.col(text), F.lit(""))
    sized = documents.select(
        F.col(key),
        (F.octet_length(known) + ROW_BYTES).cast("bigint").alias("size"),
        F.crc32(known.cast("binary")).cast("bigint").alias("text_crc32"),
    )
    columns = [key, "size", "text_crc32"]
    counted = sized.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    digest = F.md5(F.concat_ws("|", key_text(key), F.col("size"), F.col("text_crc32")))
    placed = keep_table(
        counted.withColumn("shard", place(key_text(key), tree(shards)))
        .withColumn("grown_shard", place(key_text(key), tree(shards, 1)))
        .withColumn("digest", digest),
        "shards",
    )
    cut = placed.withColumn("bucket", digest_bucket(F.col("digest"), placed.count(), shards))
    order = ["digest", *columns]
    listed = copies(before(cut, ["shard"], "bucket", order, {"slot": "n"}), "n", "copy")
    return listed.select(
        *columns,
        F.lit("key").alias("law"),
        "shard",
        (F.col("slot") + F.col("copy")).cast("bigint").alias("slot"),
        "grown_shard",
    )
