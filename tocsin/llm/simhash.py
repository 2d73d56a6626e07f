"""Near-duplicates by SimHash, found with deletion variants of two halves.

Fingerprints of 64 bits that differ in at most three bits have a half in which at most one bit
differs: two halves, not four segments. Each half is therefore indexed 32 times, each time with
one bit taken out; two halves that differ in one bit or none agree in some variant. Fingerprints
that agree in a variant are compared. Equal fingerprints are one class from the start.

Inside a variant's bucket only links that connect something new are written, so that a group of g
fingerprints makes g links, not g squared. A bucket of more than BUCKET fingerprints is cut further
by the same rule: the other half has two quarters, one of which differs in at most one bit. What
agrees in a variant of those too has 18 free bits left, which bounds the last comparison.

Null and empty texts have fingerprint zero and link like any other. Rows without id take part and
get the least id that they reach, if any. Repeated rows are members of the same class. Texts of any
length are fingerprinted whole; a bit that exactly half the hashes have is 0. An empty table gives
an empty result. Other columns take no part in groups and pass through `one_of_each`, whatever
their names.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tocsin.llm.common import free_name, keep_table, small_batches
from tocsin.llm.components import components

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHINGLE = 3
MAX_BITS = 3
SEED = 42

# Fingerprints of one bucket that are compared at once; decides the way, not the result.
BUCKET = 4096

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def _hashes(text: str | None, words: int) -> list[int]:
    from xxhash import xxh64_intdigest

    found = (text or "").encode().translate(_LOWER).split()
    if not found:
        return []
    if len(found) < words:
        return [xxh64_intdigest(b" ".join(found), SEED)]
    runs = zip(*(found[i:] for i in range(words)))
    return [xxh64_intdigest(b" ".join(run), SEED) for run in runs]


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each text, given the number of its hashes, the bits set in over half of them.

    Eight bits are counted at a time, one in each byte of a word, over runs of up to 255.
    """
    result = np.zeros(len(counts), dtype=np.uint64)
    some = np.flatnonzero(counts)
    if not len(some):
        return result
    runs = -(-counts[some] // 255)
    first_run = np.concatenate([[0], np.cumsum(runs)])[:-1]
    text_start = np.concatenate([[0], np.cumsum(counts[some])])[:-1]
    within = np.arange(runs.sum()) - np.repeat(first_run, runs)
    run_start = np.repeat(text_start, runs) + within * 255
    lane = np.uint64(0x0101010101010101)
    for shift in range(8):
        sums = np.add.reduceat((hashes >> np.uint64(shift)) & lane, run_start)
        bytes_ = sums.view(np.uint8).reshape(-1, 8).astype(np.int64)
        ones = np.add.reduceat(bytes_, first_run, axis=0)
        for byte in range(8):
            over = (2 * ones[:, byte] > counts[some]).astype(np.uint64)
            result[some] |= over << np.uint64(8 * byte + shift)
    return result


def _fingerprint_column(words: int):
    @F.arrow_udf("bigint")
    def fingerprint(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found: list[int] = []
            counts = []
            for text in batch:
                own = _hashes(text.as_py(), words)
                counts.append(len(own))
                found += own
            bits = majority(np.array(found, dtype=np.uint64), np.array(counts, dtype=np.int64))
            yield pa.array(bits.view(np.int64))

    return fingerprint


def fingerprints(documents: DataFrame, key: str = "doc_id", text: str = "text",
                 words: int = SHINGLE) -> DataFrame:
    small_batches(documents.sparkSession)
    return documents.select(
        F.col(key).alias("key"), _fingerprint_column(words)(F.col(text)).alias("fingerprint")
    )


# --- links ----------------------------------------------------------------------------------


def _least_shared(difference: np.ndarray, width: int, variant: int) -> np.ndarray:
    """Whether this variant is the first in which a pair agrees, given the difference of the two
    bit fields of 2 * width bits. Keeps a pair from being found in every variant it shares."""
    part, bit = divmod(variant, width)
    mask = np.uint64((1 << width) - 1)
    low, high = difference & mask, (difference >> np.uint64(width)) & mask
    mine = high if part else low
    first = (mine == np.uint64(1 << bit)) | ((mine == 0) & (bit == 0))
    return first & (np.bitwise_count(low) > 1) if part else first


def _forest(prints: np.ndarray, keep, max_bits: int) -> tuple[list[int], list[int]]:
    """Links that connect all that is connected by pairs within max_bits that `keep` admits."""
    left = np.arange(len(prints))
    a: list[int] = []
    b: list[int] = []
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            one = queue.pop()
            difference = prints[left] ^ prints[one]
            near = (np.bitwise_count(difference) <= max_bits) & keep(difference)
            found, left = left[near], left[~near]
            a += [one] * len(found)
            b += found.tolist()
            queue += found.tolist()
    return a, b


def _canonical(key: int, level: int):
    """Which differences count in a bucket, so that each pair is looked at in one only."""
    variant = key >> 32
    if level == 1:
        return lambda difference: _least_shared(difference, 32, variant)
    half, inner = divmod(variant, 32)[0], (key >> 16) & 0xFFFF
    other = np.uint64(0 if half else 32)

    def keep(difference: np.ndarray) -> np.ndarray:
        rest = (difference >> other) & np.uint64(0xFFFFFFFF)
        return _least_shared(rest, 16, inner)

    return keep


def _link_buckets(max_bits: int, limit: int | None):
    """Over rows sorted by bucket: links inside each, or the rows of a bucket beyond the limit."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("bucket", pa.int64())])

    def pairs_of_two(keys: np.ndarray, prints: np.ndarray, at: np.ndarray):
        """Buckets of two, all at once."""
        difference = prints[at] ^ prints[at + 1]
        near = np.flatnonzero(np.bitwise_count(difference) <= max_bits)
        ok = [
            i for i in near
            if _least_shared(difference[i : i + 1], 32, int(keys[at[i]]) >> 32)[0]
        ]
        return prints[at[ok]], prints[at[ok] + 1]

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key = np.empty(0, np.int64)
        held = np.empty(0, np.uint64)
        over = None

        def rows(a, b, bucket=None):
            a, b = np.asarray(a, np.uint64).view(np.int64), np.asarray(b, np.uint64).view(np.int64)
            buckets = pa.nulls(len(a), pa.int64()) if bucket is None else pa.array([bucket] * len(a), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), buckets], schema=schema)

        def settle(keys: np.ndarray, prints: np.ndarray) -> Iterator[pa.RecordBatch]:
            if not len(keys):
                return
            starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            sizes = np.diff(np.concatenate([starts, [len(keys)]]))
            twos = starts[sizes == 2]
            if len(twos):
                yield rows(*pairs_of_two(keys, prints, twos))
            for start, size in zip(starts[sizes > 2], sizes[sizes > 2]):
                own, key = prints[start : start + size], int(keys[start])
                if limit and size > limit:
                    yield rows(own, own, key)
                else:
                    a, b = _forest(own, _canonical(key, 1), max_bits)
                    if a:
                        yield rows(own[a], own[b])

        for batch in batches:
            keys = np.concatenate([held_key, batch.column(0).to_numpy()])
            prints = np.concatenate([held, batch.column(1).to_numpy().view(np.uint64)])
            if over is not None:
                same = int(np.searchsorted(keys, over, side="right"))
                if same:
                    yield rows(prints[:same], prints[:same], over)
                keys, prints = keys[same:], prints[same:]
                over = None if len(keys) else over
            if not len(keys):
                held_key, held = keys, prints
                continue
            last = int(np.searchsorted(keys, keys[-1], side="left"))
            yield from settle(keys[:last], prints[:last])
            held_key, held = keys[last:], prints[last:]
            if limit and len(held) > limit:
                over = int(held_key[0])
                yield rows(held, held, over)
                held_key, held = held_key[:0], held[:0]
        yield from settle(held_key, held)

    return link


def _link_inner(max_bits: int):
    """One bucket of the second kind: first key, second variant, fingerprints."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def link(group: pa.Table) -> pa.Table:
        prints = group.column("a").to_numpy().view(np.uint64)
        outer = _canonical(group.column("bucket")[0].as_py(), 1)
        inner = _canonical(group.column("inner")[0].as_py(), 2)
        a, b = _forest(prints, lambda d: outer(d) & inner(d), max_bits)
        return pa.Table.from_arrays(
            [pa.array(prints[a].view(np.int64)), pa.array(prints[b].view(np.int64))], schema=schema
        )

    return link


def _bits(column, start: int, width: int):
    return F.shiftrightunsigned(column, start).bitwiseAND(F.lit((1 << width) - 1))


def links(prints: DataFrame, max_bits: int = MAX_BITS, limit: int = BUCKET) -> DataFrame:
    """Links (a, b) between distinct fingerprints, enough to connect all that are within
    `max_bits` (at most three) of each other."""
    if max_bits > 3:
        raise ValueError("two halves find up to three differing bits")
    value = F.col("fingerprint")
    variants = F.array(*(
        F.lit(half * 32 + bit << 32).bitwiseOR(
            _bits(value, 32 * half, 32).bitwiseAND(F.lit(0xFFFFFFFF ^ 1 << bit))
        )
        for half in range(2) for bit in range(32)
    ))
    keyed = prints.select(F.explode(variants).alias("bucket"), value.alias("a"))
    sorted_ = keyed.repartition("bucket").sortWithinPartitions("bucket", "a")
    found = keep_table(
        sorted_.mapInArrow(_link_buckets(max_bits, limit), "a bigint, b bigint, bucket bigint"),
        "near",
    )
    plain = found.where("bucket IS NULL").select("a", "b")
    large = found.where("bucket IS NOT NULL").select("a", "bucket")
    if large.isEmpty():
        return plain
    half = F.shiftright(F.col("bucket"), 37)
    rest = F.when(half == 0, _bits(F.col("a"), 32, 32)).otherwise(_bits(F.col("a"), 0, 32))
    first = F.shiftright(F.col("bucket"), 32)
    inner = F.array(*(
        F.shiftleft(first, 32).bitwiseOR(F.lit(quarter * 16 + bit << 16)).bitwiseOR(
            _bits(rest, 16 * quarter, 16).bitwiseAND(F.lit(0xFFFF ^ 1 << bit))
        )
        for quarter in range(2) for bit in range(16)
    ))
    deeper = large.withColumn("inner", F.explode(inner))
    more = deeper.groupBy("bucket", "inner").applyInArrow(_link_inner(max_bits), "a bigint, b bigint")
    return plain.unionByName(more)


# --- groups ---------------------------------------------------------------------------------


def groups(documents: DataFrame, key: str = "doc_id", text: str = "text", words: int = SHINGLE,
           max_bits: int = MAX_BITS) -> DataFrame:
    """Per row its key, fingerprint, root (a fingerprint) and component: the least key of all rows
    that are linked, however far."""
    own = keep_table(fingerprints(documents, key, text, words), "prints")
    classes = keep_table(
        own.groupBy("fingerprint").agg(F.min("key").alias("first")), "classes"
    )
    found = components(links(classes.select("fingerprint"), max_bits))
    rooted = keep_table(
        classes.join(found, F.col("fingerprint") == F.col("node"), "left").select(
            "fingerprint", "first", F.coalesce("root", "fingerprint").alias("root")
        ),
        "roots",
    )
    least = rooted.groupBy("root").agg(F.min("first").alias("component"))
    named = rooted.join(least, "root").select("fingerprint", "root", "component")
    return own.join(named, "fingerprint")


def one_of_each(documents: DataFrame, key: str = "doc_id", text: str = "text",
                words: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The documents without near-duplicates: of each group the row with the least id stays, with
    all its columns. Of several rows of a group with that id one stays. A group without any id
    keeps one row too."""
    small_batches(documents.sparkSession)
    found = keep_table(groups(documents, key, text, words, max_bits), "groups")
    mine, place = free_name(documents, "first_of_group"), free_name(documents, "place_in_group")
    order = [F.xxhash64(F.col(text)), F.col(text)]
    # Rows of one id mostly have one fingerprint, so the id tells their group. Of ids with several,
    # the fingerprint of the row does.
    ids = found.where("key IS NOT NULL").groupBy("key").agg(
        F.max(F.col("key") == F.col("component")).alias("first"),
        (F.min("fingerprint") != F.max("fingerprint")).alias("several"),
    )
    ids = keep_table(ids.where("first"), "firsts")
    one = Window.partitionBy(key).orderBy(*order)
    named = (
        documents.join(ids.where("NOT several").select(F.col("key").alias(mine)), F.col(key) == F.col(mine), "left_semi")
        .withColumn(place, F.row_number().over(one))
        .where(F.col(place) == 1)
        .drop(place)
    )
    several = ids.where("several").select("key")
    if not several.isEmpty():
        named = named.unionByName(_first_of_several(documents, several, found, key, text, words, order))
    rootless = found.where("component IS NULL").select(
        F.col("fingerprint").alias(mine), F.col("root").alias(place)
    ).distinct()
    nameless = documents.where(F.col(key).isNull())
    print_ = free_name(documents, "fingerprint_of_row")
    rest = (
        nameless.withColumn(print_, _fingerprint_column(words)(F.col(text)))
        .join(rootless, F.col(print_) == F.col(mine))
        .withColumn(mine, F.row_number().over(Window.partitionBy(place).orderBy(*order)))
        .where(F.col(mine) == 1)
        .drop(mine, place, print_)
    )
    return named.unionByName(rest)


def _first_of_several(documents: DataFrame, several: DataFrame, found: DataFrame, key: str, text: str,
                      words: int, order: list) -> DataFrame:
    """Of ids with several fingerprints, the row of each group that has the id as its least."""
    mine, place = free_name(documents, "first_of_group"), free_name(documents, "place_in_group")
    print_, root = free_name(documents, "fingerprint_of_row"), free_name(documents, "root_of_row")
    groups_ = found.where("key = component").join(several, "key", "left_semi").select(
        F.col("key").alias(mine), F.col("fingerprint").alias(place), F.col("root").alias(root)
    ).distinct()
    own = documents.join(several.select(F.col("key").alias(mine)), F.col(key) == F.col(mine), "left_semi")
    return (
        own.withColumn(print_, _fingerprint_column(words)(F.col(text)))
        .join(groups_, (F.col(key) == F.col(mine)) & (F.col(print_) == F.col(place)))
        .withColumn(mine, F.row_number().over(Window.partitionBy(root).orderBy(*order)))
        .where(F.col(mine) == 1)
        .drop(mine, place, print_, root)
    )


def hex_digits(fingerprint):
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))
