"""Repair of conversation structure at the least cost.

A conversation should read, by the first letters of its roles, `(s?(ua)+)?`: nothing, or turns of
user and assistant behind an optional system turn. Each row is blank, a duplicate of an earlier
one, truncated, or sound (the first of these that holds). The cheapest edits are looked for: Keep a
row (0), Rerole it to user or assistant (3), Delete it (4; blank rows and duplicates must go), Insert
an empty turn of either (3); truncated rows that stay cost 3 more. Of equally cheap edits those win
whose initials, written in order, come first in ASCII.

The costs of finishing from each of four positions in that pattern form a vector. Less its least
entry it is one of few, so tables give, for each of these and each block of BLOCK symbols (a
symbol: initial and fault of a row), the vector before the block and what to add. A conversation
is gone through from its end, a table look-up a block; the blocks are then expanded, each from the
vector at its end backwards, and the least letter that is still cheapest is taken from its start.

Rows are ordered by turn (nulls first); within a turn by the first letters of role and text, then by a
digest of both, so equal rows stand side by side and the order of the table does not matter. Rows
are dealt by that order, so one conversation may run over any number of tasks: it is cut into
segments, each segment says how it would turn any vector and position into others, these are
chained, and every segment is then expanded by itself. Only the last pass, which hashes the repaired
text, reads a conversation from one end to the other; it does so row by row.

Null roles and texts count as one space, a null conversation is one like any other, null turns count
for no gap. Texts of any length are taken whole. Equal rows are duplicates. An empty table gives no
rows. Other columns take no part, whatever their names.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tocsin.llm.common import keep_table, small_batches

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SPACES = " \t\n\x0b\f\r"

# Rows of a segment, as a power of two.
SEGMENT_BITS = 12

# Symbols of a block; tables hold SYMBOLS ** BLOCK entries per vector.
BLOCK = 4

REROLE, DELETE, INSERT, CUT_SHORT = 3, 4, 3, 3

# Positions in the pattern: start, after s, after u, after a. A user or assistant turn can come next
# in one way only; where a kept row leads, by its initial (s, u, a, other).
NEXT = (2, 2, 3, 2)
KEPT = ((1, None, None, None), (2, 2, None, 2), (None, None, 3, None), (None,) * 4)
ROLES = ("user", "user", "assistant", "user")

# Symbols: twice the number of the initial, one more if truncated; must go; nothing.
MUST_GO, NOTHING, SYMBOLS = 8, 9, 10
_SYMBOL = np.full(256, NOTHING, np.int64)
_SYMBOL[[*b"01234567bd"]] = [*range(8), MUST_GO, MUST_GO]


def _with_inserts(costs: list[int]) -> list[int]:
    """Inserting before going on; two in a row at most can be of use."""
    for _ in range(2):
        costs = [min(cost, INSERT + costs[NEXT[q]]) for q, cost in enumerate(costs)]
    return costs


END = tuple(_with_inserts([0, 99, 99, 0]))


def _before(symbol: int, after: tuple[int, ...]) -> list[int]:
    """Costs of finishing before a row, from those after it."""
    if symbol == NOTHING:
        return list(after)
    costs = [DELETE + cost for cost in after]
    if symbol != MUST_GO:
        initial, short = divmod(symbol, 2)
        for q in range(4):
            costs[q] = min(costs[q], REROLE + CUT_SHORT * short + after[NEXT[q]])
            if KEPT[initial][q] is not None:
                costs[q] = min(costs[q], CUT_SHORT * short + after[KEPT[initial][q]])
    return _with_inserts(costs)


class Blocks:
    """The tables: vectors that occur, steps of one symbol, steps of one block."""

    def __init__(self) -> None:
        self.vectors, step, add = [END], [], []
        number = {END: 0}
        for vector in self.vectors:
            for symbol in range(SYMBOLS):
                costs = _before(symbol, vector)
                least = min(costs)
                normal = tuple(cost - least for cost in costs)
                if normal not in number:
                    number[normal] = len(self.vectors)
                    self.vectors.append(normal)
                step.append(number[normal])
                add.append(least)
        vectors = len(self.vectors)
        self.step = np.array(step).reshape(vectors, SYMBOLS)
        self.add = np.array(add).reshape(vectors, SYMBOLS)
        block, block_add = np.arange(vectors)[:, None], np.zeros((vectors, 1), int)
        for _ in range(BLOCK):
            block, block_add = (
                np.moveaxis(self.step[block], 2, 1).reshape(vectors, -1),
                np.moveaxis(block_add[:, :, None] + self.add[block], 2, 1).reshape(vectors, -1),
            )
        self.block = block.tolist()
        self.block_add = block_add.tolist()
        self.expanded: dict[tuple[int, int, int], tuple[str, int]] = {}

    def blocks(self, codes: str) -> list[int]:
        """Numbers of the blocks of a segment; the first one is filled up in front."""
        symbols = _SYMBOL[np.frombuffer(codes.encode(), np.uint8)]
        padded = np.concatenate([np.full(-len(symbols) % BLOCK, NOTHING), symbols])
        return (padded.reshape(-1, BLOCK) @ SYMBOLS ** np.arange(BLOCK - 1, -1, -1)).tolist()

    def backwards(self, blocks: list[int], end: int) -> tuple[list[int], int, int]:
        """Vectors at the end of each block, the one before all of them, and what that adds."""
        ends, cost = [0] * len(blocks), 0
        for at in range(len(blocks) - 1, -1, -1):
            ends[at] = end
            cost += self.block_add[end][blocks[at]]
            end = self.block[end][blocks[at]]
        return ends, end, cost

    def _expand(self, end: int, block: int, q: int) -> tuple[str, int]:
        symbols = [block // SYMBOLS**power % SYMBOLS for power in range(BLOCK - 1, -1, -1)]
        after = [end]
        for symbol in symbols[:0:-1]:
            after.append(int(self.step[after[-1], symbol]))
        edits = ""
        for symbol, then in zip(symbols, reversed(after)):
            if symbol == NOTHING:
                continue
            rest = self.vectors[then]
            costs = [cost + int(self.add[then, symbol]) for cost in self.vectors[self.step[then, symbol]]]
            while costs[q] != DELETE + rest[q] and costs[q] == INSERT + costs[NEXT[q]]:
                edits, q = edits + "I", NEXT[q]
            kept = KEPT[symbol // 2][q] if symbol < MUST_GO else None
            if costs[q] == DELETE + rest[q]:
                edits += "D"
            elif kept is not None and costs[q] == CUT_SHORT * (symbol % 2) + rest[kept]:
                edits, q = edits + "K", kept
            else:
                edits, q = edits + "R", NEXT[q]
        return edits, q

    def expand(self, blocks: list[int], ends: list[int], q: int) -> tuple[str, int]:
        """The edits of a segment that is entered at position q, and where they lead."""
        edits = []
        for key in zip(ends, blocks):
            found = self.expanded.get((*key, q))
            if found is None:
                found = self.expanded[*key, q] = self._expand(*key, q)
            edits.append(found[0])
            q = found[1]
        return "".join(edits), q

    def closing(self, q: int) -> str:
        """What is inserted at the very end."""
        edits = ""
        while self.vectors[0][q]:
            edits, q = edits + "I", NEXT[q]
        return edits


def damage(conversations: DataFrame) -> DataFrame:
    """Conversations with planted faults, by a draw per conversation and turn: a row in twenty is
    dropped, emptied, freed of sentence ends, repeated, or given to the user."""
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    draw = F.crc32(key) % 20
    rows = conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), draw.alias("draw"),
        *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")),
    )
    cleared = F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.translate("text", ".!?", ""))
    damaged = rows.where("draw <> 0").select(
        "conv_id", "turn",
        F.when(F.col("draw") == 4, "user").otherwise(F.col("role")).alias("role"),
        cleared.otherwise(F.col("text")).alias("text"),
        F.when(F.col("draw") == 3, 2).otherwise(1).alias("copies"),
    )
    return damaged.select(
        "conv_id", "turn", "role", "text", F.explode(F.sequence(F.lit(1), "copies")).alias("copy")
    ).drop("copy")


def _in_order(rows: DataFrame) -> DataFrame:
    """All rows with a number that rises in the order of their conversation, as a table."""
    known = rows.select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")),
    )
    both = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    order = [
        F.col("conv_id"), F.col("turn"), F.substring("role", 1, 32), F.substring("text", 1, 32),
        F.col("digest"), F.col("salt"),
    ]
    # The salt parts equal rows only, so that any number of them can be dealt out.
    keyed = known.withColumn("digest", F.sha2(both, 256)).withColumn("salt", F.monotonically_increasing_id())
    dealt = keyed.repartitionByRange(*order).sortWithinPartitions(*order).drop("salt")
    return keep_table(dealt.withColumn("seq", F.monotonically_increasing_id()), "turns")


def _code() -> Column:
    """The symbol of a row that is no duplicate, as a letter; b if it is blank."""
    bare = F.rtrim(F.col("text"), F.lit(SPACES))
    initial = F.substring("role", 1, 1)
    number = F.when(initial == "s", 0).when(initial == "u", 2).when(initial == "a", 4).otherwise(6)
    short = (~F.substring(bare, -1, 1).isin(".", "!", "?")).cast("int")
    return F.when(bare == "", "b").otherwise((number + short).cast("string"))


def _segments(turns: DataFrame) -> DataFrame:
    """From ordered rows to (conv_id, seq of the first row, codes of the rows): d for duplicates."""
    narrow = keep_table(turns.select("conv_id", "seq", "digest", _code().alias("code")), "codes")
    first = narrow.where("code <> 'b'").groupBy("conv_id", "digest").agg(F.min("seq").alias("seq"))
    repeated = F.col("first").isNull() & (F.col("code") != "b")
    coded = narrow.join(first.select("seq", F.lit(1).alias("first")), "seq", "left").select(
        "conv_id", "seq", F.when(repeated, "d").otherwise(F.col("code")).alias("code"))
    listed = F.array_sort(F.collect_list(F.struct("seq", "code")))
    return coded.groupBy("conv_id", F.shiftright("seq", SEGMENT_BITS).alias("part")).agg(
        F.min("seq").alias("seq"), F.array_join(listed["code"], "").alias("codes"))


def _chain(segments: DataFrame) -> DataFrame:
    """For the segments of conversations that have several: the vector at the end, the position at
    the start, and whether it is the last one."""
    several = segments.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    same = segments["conv_id"].eqNullSafe(several["conv_id"])

    @F.arrow_udf("array<int>")
    def behaviour(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        """For each vector at the end: the one at the start, and where each position leads."""
        tables = Blocks()
        for batch in batches:
            out = []
            for codes in batch.to_pylist():
                blocks, found = tables.blocks(codes), []
                for end in range(len(tables.vectors)):
                    ends, start, _ = tables.backwards(blocks, end)
                    found += [start, *(tables.expand(blocks, ends, q)[1] for q in range(4))]
                out.append(found)
            yield pa.array(out, pa.list_(pa.int32()))

    def chained(table: pa.Table) -> pa.Table:
        """A conversation's segments, one short row each."""
        table = table.sort_by("seq")
        found = table.column("behaviour").to_pylist()
        ends, end = [], 0
        for moves in reversed(found):
            ends.append(end)
            end = moves[5 * end]
        ends.reverse()
        starts, q = [], 0
        for moves, end in zip(found, ends):
            starts.append(q)
            q = moves[5 * end + 1 + q]
        last = [False] * (len(found) - 1) + [True]
        return pa.table([
            table.column("seq"), pa.array(ends, pa.int32()), pa.array(starts, pa.int32()), pa.array(last)
        ], names=["seq", "vector", "position", "last"])

    moves = segments.join(several, same, "left_semi").select("conv_id", "seq", behaviour("codes").alias("behaviour"))
    return moves.groupBy("conv_id").applyInArrow(chained, "seq long, vector int, position int, last boolean")


def _edits(segments: DataFrame) -> DataFrame:
    """(conv_id, seq, codes, edits) of each segment."""
    @F.arrow_udf("string")
    def expanded(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        tables = Blocks()
        for batch in batches:
            out = []
            for codes, vector, position, last in zip(*(column.to_pylist() for column in batch)):
                blocks = tables.blocks(codes)
                edits, q = tables.expand(blocks, tables.backwards(blocks, vector)[0], position)
                out.append(edits + tables.closing(q) if last else edits)
            yield pa.array(out, pa.string())

    known = segments.join(_chain(segments), "seq", "left").select(
        "conv_id", "seq", "codes", F.coalesce("vector", F.lit(0)).alias("vector"),
        F.coalesce("position", F.lit(0)).alias("position"), F.coalesce("last", F.lit(True)).alias("last"))
    return known.select("conv_id", "seq", "codes", expanded("codes", "vector", "position", "last").alias("edits"))


class Reader:
    """One conversation, row by row, with the edits of each segment ahead of its rows."""

    def __init__(self, conversation) -> None:
        self.conversation = conversation
        self.hash, self.lines, self.audit = hashlib.sha256(), 0, []
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "cost"), 0)
        self.turns, self.first, self.latest = 0, None, None
        self.initial, self.position = None, 0
        self.codes, self.edits = iter(""), ""

    def _line(self, edit: str, role: str, text: str) -> tuple[int, str, str, str]:
        self.hash.update(("\n" * (self.lines > 0) + f"{role}:{text}").encode())
        self.lines += 1
        return self.lines - 1, edit, role, text

    def _inserted(self) -> list[tuple[int, str, str, str]]:
        """The turns that the edits insert here."""
        rest = self.edits.lstrip("I")
        out = []
        for _ in range(len(self.edits) - len(rest)):
            out.append(self._line("I", ROLES[self.position], ""))
            self.position = NEXT[self.position]
            self.counts["cost"] += INSERT
        self.edits = rest
        return out

    def segment(self, codes: str, edits: str) -> None:
        self.codes, self.edits = iter(codes), edits
        self.audit.append(edits)

    def row(self, turn: int | None, role: str, text: str) -> list[tuple[int, str, str, str]]:
        """Takes the next row; gives the repaired ones that are due."""
        if turn is not None:
            self.turns += turn != self.latest
            self.first = turn if self.first is None else self.first
            self.latest = turn
        if self.initial is not None:
            self.counts["illegal"] += self.initial + role[:1] not in ("su", "ua", "au")
        self.initial = role[:1]
        code = next(self.codes)
        short = code not in "bd" and int(code) % 2
        for name, holds in (("blank", code == "b"), ("duplicate", code == "d"), ("truncated", short)):
            self.counts[name] += holds
        out = self._inserted()
        edit, self.edits = self.edits[0], self.edits[1:]
        if edit == "D":
            self.counts["cost"] += DELETE
        else:
            self.counts["cost"] += CUT_SHORT * short + REROLE * (edit == "R")
            then = NEXT[self.position] if edit == "R" else KEPT[int(code) // 2][self.position]
            out.append(self._line(edit, ROLES[self.position] if edit == "R" else role, text))
            self.position = then
        # Behind the last row of a conversation only insertions are left.
        return out + self._inserted() if self.edits.strip("I") == "" else out

    def report(self) -> tuple:
        gaps = 0 if self.first is None else self.latest - self.first + 1 - self.turns
        return (
            self.conversation, min(gaps, (1 << 63) - 1), *self.counts.values(), "".join(self.audit),
            self.hash.hexdigest(),
        )


def _stream(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """What a reader takes, conversation by conversation: a start, then segments and rows."""
    turns = _in_order(rows)
    edits = _edits(keep_table(_segments(turns), "segments"))
    kept = ["conv_id", "seq", "kind", "codes", "edits", "turn", "role", "text"]

    def shaped(part: DataFrame, kind: int) -> DataFrame:
        known = part.withColumn("kind", F.lit(kind))
        return known.select(*(F.col(c) if c in known.columns else F.lit(None).alias(c) for c in kept))

    starts = conversations.select("conv_id").distinct().withColumn("seq", F.lit(-1).cast("long"))
    whole = shaped(turns, 2).unionByName(shaped(edits, 1)).unionByName(shaped(starts, 0))
    return whole.repartition("conv_id").sortWithinPartitions("conv_id", "seq", "kind")


def _read(stream: DataFrame, schema: T.StructType, reports: bool) -> DataFrame:
    small_batches(stream.sparkSession)
    arrow = pa.schema([(f.name, _ARROW[f.dataType.typeName()]) if f.name != "conv_id" else (f.name, pa.null())
                       for f in schema.fields])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, kind_of_id = None, None
        for batch in batches:
            kind_of_id = batch.schema.field("conv_id").type
            out = []
            columns = (batch.column(name).to_pylist() for name in batch.schema.names)
            for conversation, _, kind, codes, edits, turn, role, text in zip(*columns):
                if kind == 0:
                    if reader and reports:
                        out.append(reader.report())
                    reader = Reader(conversation)
                elif kind == 1:
                    reader.segment(codes, edits)
                else:
                    made = reader.row(turn, role, text)
                    if not reports:
                        out += [(conversation, *line) for line in made]
            yield _batch(out, arrow, kind_of_id)
        if reader and reports:
            yield _batch([reader.report()], arrow, kind_of_id)

    return stream.mapInArrow(read, schema)


_ARROW = {"long": pa.int64(), "string": pa.string()}


def _batch(rows: list[tuple], schema: pa.Schema, kind_of_id: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    kinds = [kind_of_id if field.name == "conv_id" else field.type for field in schema]
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kind) for column, kind in zip(columns, kinds)], names=schema.names)


def report(rows: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """Per conversation its faults, the cost and initials of the edits, and a digest of the repaired
    lines `role:text`. Also for those of `conversations` that have no row."""
    listed = rows if conversations is None else conversations
    schema = T.StructType([
        listed.select("conv_id").schema.fields[0],
        *(T.StructField(n, T.LongType()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        T.StructField("audit", T.StringType()),
        T.StructField("repaired_sha256", T.StringType()),
    ])
    return _read(_stream(listed, rows), schema, True)


def repair(rows: DataFrame) -> DataFrame:
    """The repaired conversations: (conv_id, place, edit, role, text)."""
    schema = T.StructType([
        rows.select("conv_id").schema.fields[0],
        T.StructField("place", T.LongType()),
        *(T.StructField(name, T.StringType()) for name in ("edit", "role", "text")),
    ])
    return _read(_stream(rows, rows), schema, False)
