from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict
from functools import lru_cache

import pytest

from tocsin.llm import repair
from tocsin.llm.catalog import QUERIES

WORDS = re.compile(r"[^\x20\x09-\x0D]")
PATTERN = re.compile(r"(s?(ua)+)?")


def cheapest(rows):
    """(cost, audit, lines) by trying every edit at every place; rows are (role, text, fault)."""

    @lru_cache(None)
    def best(at, made, inserts):
        """The rest from a row on: made holds the last initial written, s, u, a or nothing."""
        found = []
        if at == len(rows) and made in ("", "a"):
            found.append((0, "", ()))

        def then(cost, letter, at, initial, line, inserts=0):
            allowed = {"": "su", "s": "u", "u": "a", "a": "u"}[made]
            if line is not None and initial not in allowed:
                return
            more = best(at, made if line is None else initial, inserts)
            if more:
                found.append((cost + more[0], letter + more[1], ((line,) if line is not None else ()) + more[2]))

        if inserts < 3:
            for role in ("user", "assistant"):
                then(3, "I", at, role[0], f"{role}:", inserts + 1)
        if at < len(rows):
            role, text, fault = rows[at]
            then(4, "D", at + 1, "", None)
            if fault not in ("blank", "duplicate"):
                extra = 3 * (fault == "truncated")
                if role[:1] in ("s", "u", "a"):
                    then(extra, "K", at + 1, role[0], f"{role}:{text}")
                for other in ("user", "assistant"):
                    then(3 + extra, "R", at + 1, other[0], f"{other}:{text}")
        return min(found, key=lambda f: (f[0], f[1])) if found else None

    return best(0, "", 0)


def spoiled(rows):
    """The damage, row by row."""
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        yield from [(conv, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)


def brute(conv, rows):
    rows = sorted(rows, key=lambda r: (
        r[1] is not None, r[1] or 0, r[2][:32].encode(), r[3][:32].encode(),
        hashlib.sha256(f"{len(r[2])}:{r[2]}{r[3]}".encode()).hexdigest()))
    seen, faulty, count = set(), [], defaultdict(int)
    for _, _, role, text in rows:
        chars = WORDS.findall(text)
        fault = "blank" if not chars else "duplicate" if (role, text) in seen else "truncated" if chars[-1] not in ".!?" else ""
        seen.add((role, text))
        count[fault] += 1
        faulty.append((role, text, fault))
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit, lines = cheapest(tuple(faulty))
    assert PATTERN.fullmatch("".join(line[0] for line in lines))
    return (conv, gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines)


def by_conversation(rows):
    out = defaultdict(list)
    for row in rows:
        out[row[0]].append(row)
    return out


@pytest.mark.parametrize("seed", range(60))
def test_blocks_give_the_cheapest_edits(seed):
    chance = random.Random(seed)
    tables = repair.Blocks()
    for _ in range(20):
        codes = "".join(chance.choice("0123456bd7") for _ in range(chance.randint(0, 11)))
        rows = [(("system", "user", "assistant", "x")[int(c) // 2], "", "truncated" if int(c) % 2 else "")
                if c.isdigit() else ("user", "", "blank") for c in codes]
        cost, audit, _ = cheapest(tuple(rows))
        blocks = tables.blocks(codes)
        ends, start, added = tables.backwards(blocks, 0)
        edits, q = tables.expand(blocks, ends, 0)
        assert edits + tables.closing(q) == audit
        assert added + tables.vectors[start][0] == cost


CHANCE = random.Random(7)


def _random_conversations():
    rows = []
    for conv in [None, *range(60)]:
        for turn in range(CHANCE.randint(1, 9)):
            role = CHANCE.choice(["user", "assistant", "assistant", "system", "User", "", None, "tool"])
            text = CHANCE.choice(["a.", "b!", "b", "", " \t", None, "Ende.\n ", "é?\x00", "a.b"])
            turn = CHANCE.choice([turn, turn, turn, turn + 3, None, -turn])
            rows += [(conv, turn, role, text)] * CHANCE.choice([1, 1, 1, 2])
    return rows


@pytest.mark.parametrize("bits", [12, 1])
def test_equals_brute_force(spark, monkeypatch, bits):
    """With conversations whole and cut into segments of two rows, over several tasks."""
    monkeypatch.setattr(repair, "SEGMENT_BITS", bits)
    rows = _random_conversations()
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, seq string, kind int")
    got = {row.conv_id: tuple(row) for row in repair.report(repair.damage(frame), frame).collect()}
    damaged = by_conversation(spoiled(rows))
    assert got == {conv: brute(conv, damaged.get(conv, []))[:-1] for conv in by_conversation(rows)}
    lines = defaultdict(list)
    for row in sorted(repair.repair(repair.damage(frame)).collect(), key=lambda r: r.place):
        lines[row.conv_id].append(f"{row.role}:{row.text}")
    assert lines == {c: list(w) for c in damaged if (w := brute(c, damaged[c])[-1])}


def test_registered_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    damaged = by_conversation(spoiled(rows))
    got = {row.conv_id: tuple(row) for row in QUERIES["op12_repair"](spark, folder).collect()}
    assert got == {conv: brute(conv, damaged.get(conv, []))[:-1] for conv in by_conversation(rows)}


def test_one_long_conversation(spark, monkeypatch):
    """Nothing but one conversation, most of it one row; extreme turns; a long text."""
    monkeypatch.setattr(repair, "SEGMENT_BITS", 4)
    rows = [(5, 0, "user", "same.")] * 400 + [(5, 1, "assistant", "w " * 50_000 + "end.")]
    rows += [(5, t, "user" if t % 2 else "assistant", f"{t}.") for t in range(2, 120)]
    rows += [(5, -(1 << 63), "system", "x."), (5, (1 << 63) - 1, "user", "x.")]
    frame = spark.createDataFrame(rows, "conv_id int, turn long, role string, text string")
    (row,) = repair.report(frame).collect()
    wanted = [(r, t, "duplicate" if at and (r, t) == (rows[at - 1][2:]) else "") for at, (_, _, r, t) in enumerate(rows[:-2])]
    wanted = [("system", "x.", ""), *wanted, ("user", "x.", "")]
    import sys
    sys.setrecursionlimit(20_000)
    cost, audit, lines = cheapest(tuple(wanted))
    assert (row.duplicate, row.cost, row.audit, row.gaps) == (399, cost, audit, (1 << 63) - 1)
    assert row.repaired_sha256 == hashlib.sha256("\n".join(lines).encode()).hexdigest()


def test_nothing_left_and_nothing_there(spark):
    frame = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair.report(repair.damage(frame), frame).collect() == []
    dropped = next(c for c in range(99) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    frame = spark.createDataFrame([(dropped, 0, "user", "a.")], frame.schema)
    empty = hashlib.sha256(b"").hexdigest()
    assert [tuple(r) for r in repair.report(repair.damage(frame), frame).collect()] == [(dropped, *[0] * 6, "", empty)]
