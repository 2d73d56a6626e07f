"""Packing token sequences: documents into as few sequences of a fixed length as can be.

A document that is longer than a sequence is cut into whole sequences and a rest; nothing else is
cut. Pieces are dealt by hash into buckets of bounded size. A bucket is packed best fit first, the
longest piece first, and then improved by local search: between two bins that are not full, the
fuller one takes a piece, or gives one or two pieces for a longer one, or one for a longer two.
Each exchange makes the sum of squared fills grow, so it ends, and the emptier bins drain until
they are gone. What full bins hold is settled. The pieces of all other bins are dealt into fewer
new buckets and packed again, until there are no more bins than the sum of their lengths asks for, one
bucket holds all of them, or a round saves less than one bin in LEAST_SAVING.

Null texts count as empty. An empty text is the closing id alone. Rows are packed each on its own,
so repeated rows, repeated ids and null ids all stay, and equal lengths go by the piece's place in
the table. A text of any length is encoded as a whole. An empty table gives no pieces. Columns other
than the key and the text take no part in `cut`; `pack` keeps all columns of its pieces but those
called like its results.
"""

from __future__ import annotations

import sys
import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from itertools import count as count_from

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tocsin.llm.bpe import Codec, _once, _shared
from tocsin.llm.common import free_name, keep_table, small_batches

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CAPACITY = 4096
CLOSING_ID = 1

# Pieces that one task packs together. A bucket wastes less than a bin as a rule, and rounds over
# what is left take most of that back.
BUCKET_PIECES = 8_192

# A further round is made if the last one saved a bin in so many.
LEAST_SAVING = 1_000


def _with_closing(flat: np.ndarray, ends: np.ndarray, closing: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts with one more at the end of each."""
    documents = len(ends) - 1
    out = np.empty(len(flat) + documents, dtype=np.int32)
    closed = ends[1:] + np.arange(documents)
    is_id = np.ones(len(out), dtype=bool)
    is_id[closed] = False
    out[is_id], out[closed] = flat, closing
    return out, np.concatenate([[0], closed + 1])


def cut(
    documents: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text",
    capacity: int = CAPACITY, closing: int = CLOSING_ID, with_ids: bool = False,
) -> DataFrame:
    """The pieces of all documents: key, piece, start, length, ids_crc32 and, if asked for, ids."""
    small_batches(documents.sparkSession)
    shared = _shared(documents, tokenizer_path)
    rows = documents.select(F.col(key), F.col(text).cast("string"))
    fields = [
        rows.schema.fields[0],
        T.StructField("piece", T.IntegerType()),
        *(T.StructField(name, T.LongType()) for name in ("start", "length", "ids_crc32")),
        *([T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else []),
    ]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _once(shared, Codec)
        for batch in batches:
            ids, ends = _with_closing(*codec.encode(batch.column(1).to_pylist()), closing)
            counts = -(-np.diff(ends) // capacity)
            owner = np.repeat(np.arange(batch.num_rows), counts)
            piece = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
            start = piece * capacity
            begin = ends[owner] + start
            length = np.minimum(capacity, ends[owner + 1] - begin)
            raw = memoryview(ids.astype("<u4")).cast("B")
            crc = [zlib.crc32(raw[4 * i : 4 * (i + n)]) for i, n in zip(begin.tolist(), length.tolist())]
            columns = [
                batch.column(0).take(pa.array(owner)), pa.array(piece, pa.int32()),
                pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
            ]
            if with_ids:
                at = pa.array(np.append(begin, len(ids)), pa.int32())
                columns.append(pa.ListArray.from_arrays(at, pa.array(ids, pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=[field.name for field in fields])

    return rows.mapInArrow(pieces, T.StructType(fields))


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of places in `lengths`: the longest first, each into the fullest bin that takes it."""
    bins: list[list[int]] = []
    room: list[tuple[int, int]] = []
    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        at = bisect_left(room, (lengths[item], -1))
        if at < len(room):
            free, place = room.pop(at)
        else:
            free, place = capacity, len(bins)
            bins.append([])
        bins[place].append(item)
        if free > lengths[item]:
            insort(room, (free - lengths[item], place))
    return bins


class Search:
    """Local search over the bins of one bucket that are not full.

    What the emptier bins have to give is kept by length: which of them hold a piece of a length,
    and which hold two pieces of a length in sum.
    """

    def __init__(self, lengths: list[int], bins: list[list[int]], capacity: int) -> None:
        self.lengths, self.bins, self.capacity = lengths, bins, capacity
        self.fill = [sum(lengths[i] for i in items) for items in bins]

    def _offers(self, b: int) -> tuple[set[int], set[int]]:
        """Lengths of the pieces of a bin, and sums of two of them."""
        once: set[int] = set()
        twice: set[int] = set()
        for i in self.bins[b]:
            (twice if self.lengths[i] in once else once).add(self.lengths[i])
        kept = sorted(once)
        sums = {x + y for at, x in enumerate(kept) for y in kept[at + 1 :]}
        return once, sums | {2 * x for x in twice}

    def _open_for_giving(self, b: int) -> None:
        insort(self.open, (self.fill[b], b))
        for kind, values in enumerate(self._offers(b)):
            for value in values:
                self.holders[kind][value].add(b)
                self.offered[kind][value] = True

    def _close(self, b: int) -> None:
        del self.open[bisect_left(self.open, (self.fill[b], b))]
        for kind, values in enumerate(self._offers(b)):
            for value in values:
                self.holders[kind][value].remove(b)
                self.offered[kind][value] = bool(self.holders[kind][value])

    def _exchange(self, target: int) -> tuple[int, int, int] | None:
        """The exchange that fills the target most: what comes (1 or 2 pieces, their sum), and
        the sum of what goes."""
        room = self.capacity - self.fill[target]
        own, pairs = self._offers(target)
        best_gain, best = 0, None
        for kind, outs in enumerate(((0, *own, *pairs), tuple(own))):
            going = np.array(outs, dtype=np.int64)
            if not len(going):
                continue
            largest = np.maximum.accumulate(np.where(self.offered[kind], self.numbers, 0))
            gain = largest[going + room] - going
            at = int(gain.argmax())
            if gain[at] > best_gain:
                best_gain = int(gain[at])
                best = kind, outs[at] + best_gain, outs[at]
        return best

    def _chosen(self, b: int, total: int, pieces: int) -> list[int]:
        """That many pieces of a bin of that length in all."""
        held: dict[int, int] = {}
        for i in self.bins[b]:
            length = self.lengths[i]
            if pieces == 1 and length == total:
                return [i]
            if pieces == 2 and total - length in held:
                return [held[total - length], i]
            held[length] = i
        return []

    def _move(self, items: list[int], here: int, there: int) -> None:
        for item in items:
            self.bins[here].remove(item)
            self.bins[there].append(item)
            self.fill[here] -= self.lengths[item]
            self.fill[there] += self.lengths[item]

    def _pass(self) -> None:
        """Takes the fullest bin each time; it ends as full as any exchange with an emptier one
        can make it. Emptier bins drain on the way."""
        self.numbers = np.arange(2 * self.capacity + 1)
        self.offered = [np.zeros(2 * self.capacity + 1, dtype=bool) for _ in range(2)]
        self.holders: list[dict[int, set[int]]] = [defaultdict(set), defaultdict(set)]
        self.open: list[tuple[int, int]] = []
        for b, fill in enumerate(self.fill):
            if 0 < fill < self.capacity:
                self._open_for_giving(b)
        while len(self.open) > 1:
            _, target = self.open[-1]
            self._close(target)
            while self.fill[target] < self.capacity and (found := self._exchange(target)):
                kind, comes, goes = found
                donor = min(self.holders[kind][comes], key=lambda b: (self.fill[b], b))
                self._close(donor)
                out = self._chosen(target, goes, 1) or self._chosen(target, goes, 2) if goes else []
                self._move(self._chosen(donor, comes, kind + 1), donor, target)
                self._move(out, target, donor)
                if self.fill[donor]:
                    self._open_for_giving(donor)

    def run(self) -> None:
        """Passes for as long as one empties a bin."""
        before = len(self.bins) + 1
        while (used := sum(fill > 0 for fill in self.fill)) < before:
            before = used
            self._pass()


def pack_lengths(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of places in `lengths`, none empty."""
    bins = best_fit(lengths, capacity)
    if len(bins) > 1:
        Search(lengths, bins, capacity).run()
    return [items for items in bins if items]


def _standing(packed: DataFrame, full: str, length: str, capacity: int) -> tuple[int, int, int, int]:
    """Full bins, other bins, the pieces in these, and what these lack to be full."""
    bins = packed.groupBy("sequence_id", full).agg(F.count(F.lit(1)).alias("n"), F.sum(length).alias("fill"))
    found = {row[full]: row for row in bins.groupBy(full).agg(
        F.count(F.lit(1)).alias("bins"), F.sum("n").alias("n"), F.sum(F.lit(capacity) - F.col("fill")).alias("lacking")
    ).collect()}
    filled = found[True]["bins"] if True in found else 0
    return (filled, *((found[False][name] for name in ("bins", "n", "lacking")) if False in found else (0, 0, 0)))


def pack(pieces: DataFrame, capacity: int = CAPACITY, length: str = "length") -> DataFrame:
    """Adds sequence_id and offset to pieces of 1 to `capacity` tokens. Sequence ids are negative
    for pieces that fill a sequence alone."""
    kept = pieces.drop("sequence_id", "offset")
    place, bucket, full = (free_name(kept, name) for name in ("place", "bucket", "full"))
    rows = keep_table(kept.withColumn(place, F.monotonically_increasing_id()), "pieces")
    alone = rows.where(F.col(length) >= capacity).select(
        *kept.columns, (-1 - F.col(place)).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    results = [alone]
    rows = rows.where(F.col(length) < capacity)
    schema = T.StructType([
        *rows.schema.fields,
        T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()),
        T.StructField(full, T.BooleanType()),
    ])
    count = rows.count()
    held, bins_held = rows, 0
    for turn in count_from(0):
        if not count:
            break
        buckets = -(-count // BUCKET_PIECES)
        dealt = rows.withColumn(bucket, F.pmod(F.xxhash64(F.lit(turn), F.col(place)), F.lit(buckets)))
        base = turn << 58

        def packed(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
            table = table.drop_columns([bucket]).sort_by(place)
            lengths = table.column(length).to_pylist()
            number = base + (key[0].as_py() << 24)
            sequence, offset, done = ([0] * len(lengths) for _ in range(3))
            for b, items in enumerate(pack_lengths(lengths, capacity)):
                at = 0
                for item in items:
                    sequence[item], offset[item] = number + b, at
                    at += lengths[item]
                for item in items:
                    done[item] = at == capacity
            for name, values, kind in (
                ("sequence_id", sequence, pa.int64()), ("offset", offset, pa.int64()), (full, done, pa.bool_()),
            ):
                table = table.append_column(name, pa.array(values, kind))
            return table

        result = keep_table(dealt.groupBy(bucket).applyInArrow(packed, schema), "packed")
        filled, bins, count, lacking = _standing(result, full, length, capacity)
        saved = bins_held - filled - bins if turn else 0
        if turn and saved <= 0:
            results.append(held.select(*alone.columns))
            break
        results.append(result.where(full).select(*alone.columns))
        held = result.where(~F.col(full))
        if buckets == 1 or lacking < capacity or (turn and saved * LEAST_SAVING < bins_held):
            results.append(held.select(*alone.columns))
            break
        bins_held = bins
        rows = held.drop("sequence_id", "offset", full)
    out = results[0]
    for part in results[1:]:
        out = out.unionByName(part)
    return out


def sequences(packed: DataFrame) -> DataFrame:
    """The ids of each sequence, from packed pieces that hold theirs."""
    placed = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(placed["ids"]).alias("ids"))
