"""Mixing, sharding and chat formatting."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tocsin.llm import chat, mixing, running, sharding
from tocsin.llm.oracle import ORACLE

DOCS = "doc_id bigint, text string, source string, size int, mix_plan string"


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, s, 7, "clash") for i, t, s in rows], DOCS)


# --- mixing ---------------------------------------------------------------------------------


def _corpus():
    chance = random.Random(1)
    rows = [(i, "w " * chance.randint(0, 30), "big") for i in range(300)]
    rows += [(1000 + i, "w " * chance.randint(0, 30), "small") for i in range(40)]
    rows += [(2000 + i, "w\tw", None) for i in range(9)]
    return rows + [(2100, None, None), (None, "a b c", "small"), (1001, "x y", "small"), (1001, "x y", "small")]


def _tokens(rows):
    totals = Counter()
    for _, text, source in rows:
        totals[source or ""] += len((text or "").split()) + 1
    return totals


def _power(totals, budget, max_repeats=None, evenness=None):
    total = sum(totals.values())

    def fits(a):
        raised = {s: (t / total) ** a for s, t in totals.items()}
        z = sum(raised.values())
        weights = {s: r / z for s, r in raised.items()}
        if evenness is not None:
            return -sum(w * math.log(w) for w in weights.values()) >= evenness * math.log(len(totals))
        return max(weights[s] * budget / totals[s] for s in totals) <= max_repeats

    if fits(1.0 if evenness is not None else 0.0):
        return 1.0 if evenness is not None else 0.0
    low, high = 0.0, 1.0
    for _ in range(mixing.DEPTH):
        middle = (low + high) / 2
        if fits(middle) == (evenness is not None):
            low = middle
        else:
            high = middle
    return low if evenness is not None else high


@pytest.mark.parametrize("target", [{"max_repeats": 1.2}, {"max_repeats": 3.0}, {"evenness": 0.9}, {"evenness": 0.5}])
def test_power_and_quotas(spark, target):
    rows = _corpus()
    totals = _tokens(rows)
    frame = spark.createDataFrame(list(totals.items()), "source string, tokens bigint")
    total = sum(totals.values())
    power = mixing.bisect_power(frame, total, **target)
    assert power == _power(totals, total, **target)
    mixed = mixing.mix(_docs(spark, rows), **target).collect()
    raised = {s: (t / total) ** power for s, t in totals.items()}
    out = Counter()
    for row in mixed:
        out[row.source] += row.size
    for source, tokens in totals.items():
        quota = raised[source] / sum(raised.values()) * total
        # The cut pass ends with the last row that fits.
        assert quota - 100 <= out[source] <= quota


def test_passes_are_permutations(spark):
    rows = _corpus()
    docs = _docs(spark, rows)
    mixed = mixing.mix(docs, budget=3 * sum(_tokens(rows).values()), max_repeats=4.0, block_tokens=500).collect()
    by_pass = defaultdict(Counter)
    for row in mixed:
        by_pass[row.source, row["pass"]][row.doc_id] += 1
    want = defaultdict(Counter)
    for i, _, s in rows:
        want[s or ""][i] += 1
    last = {s: max(p for (t, p) in by_pass if t == s) for s in want}
    for (source, turn), found in by_pass.items():
        if turn < last[source]:
            assert found == want[source]
        else:
            assert not found - want[source]
    slots = defaultdict(list)
    for row in mixed:
        slots[row.block].append(row.slot)
    assert all(sorted(found) == list(range(len(found))) for found in slots.values())
    sizes = Counter()
    for row in mixed:
        sizes[row.block] += row.size
    assert len(sizes) > 10 and max(sizes.values()) < 800


@pytest.mark.parametrize("sent", [100_000, 0])
def test_rows_of_the_mix(spark, monkeypatch, sent):
    """With all columns, and the plan sent along or joined by source and salt."""
    monkeypatch.setattr(mixing, "SENT_SOURCES", sent)
    rows = _corpus()
    docs = _docs(spark, rows)
    target = {"budget": 2 * sum(_tokens(rows).values()), "max_repeats": 3.0}
    kept = mixing.mix_rows(docs, **target)
    assert kept.columns == docs.columns
    found = Counter((r.doc_id, r.source or "") for r in kept.collect())
    assert found == Counter((r.doc_id, r.source) for r in mixing.mix(docs, **target).collect())


def _parted():
    """A source of one repeated row, one of rows without id, both down-weighted, and small ones."""
    rows = [(7, "w " * 9, "hot")] * 400 + [(None, f"text {i:04d}", "nameless") for i in range(1200)]
    return rows + [(1000 + i, "a b c d", f"s{i % 4}") for i in range(400)]


@pytest.mark.parametrize("sent", [100_000, 0])
def test_the_cut_goes_through_equal_rows(spark, monkeypatch, sent):
    monkeypatch.setattr(mixing, "SENT_SOURCES", sent)
    rows = _parted()
    totals = _tokens(rows)
    total = sum(totals.values())
    target = {"budget": total // 2, "evenness": 0.99}
    docs = _docs(spark, rows)
    mixed = mixing.mix(docs, **target).collect()
    power = _power(totals, total // 2, evenness=0.99)
    raised = {s: (t / total) ** power for s, t in totals.items()}
    out = Counter()
    for row in mixed:
        out[row.source] += row.size
    for source in ("hot", "nameless"):
        quota = raised[source] / sum(raised.values()) * (total // 2)
        assert quota < totals[source] and quota - 10 <= out[source] <= quota
    kept = mixing.mix_rows(docs, **target)
    assert kept.columns == docs.columns
    found = Counter((r.doc_id, r.source) for r in kept.collect())
    assert found == Counter((r.doc_id, r.source) for r in mixed)
    nameless = [r.text for r in kept.where("source = 'nameless'").collect()]
    assert len(nameless) == len(set(nameless))
    again = mixing.mix_rows(docs.repartition(3), **target).where("source = 'nameless'").collect()
    assert sorted(r.text for r in again) == sorted(nameless)


def test_the_sql_cuts_inside_equal_rows_too(spark):
    """600 copies of a row of a source that holds most tokens, and other repetitions."""
    import duckdb

    rows = [(7, "w " * 9, "hot")] * 600 + [(i % 5, "a b c", f"s{i % 4}") for i in range(60)] + [(None, "x y", None)] * 9
    docs = _docs(spark, rows)
    documents = docs.toArrow()
    connection = duckdb.connect()
    connection.register("documents", documents)
    want = connection.sql(ORACLE["op2_mixing"])
    got = mixing.mix(docs, max_repeats=mixing.MAX_REPEATS).select(*want.columns).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want.fetchall(), key=repr)
    assert 0 < sum(row.source == "hot" for row in got) < 600


def test_mix_of_nothing_and_wrong_targets(spark):
    docs = _docs(spark, [])
    assert mixing.mix(docs, max_repeats=2.0).collect() == [] and mixing.mix_rows(docs, max_repeats=2.0).collect() == []
    with pytest.raises(ValueError):
        mixing.mix(_docs(spark, [(1, "a", "s")]))
    with pytest.raises(ValueError):
        mixing.mix(_docs(spark, [(1, "a", "s")]), budget=100, max_repeats=2.0)


def test_running_sums_over_buckets(spark, monkeypatch):
    monkeypatch.setattr(running, "BUCKET_ROWS", 5)
    chance = random.Random(2)
    rows = [("hot" if chance.random() < 0.7 else "cold", f"{chance.getrandbits(128):032x}", chance.randint(1, 9)) for _ in range(400)]
    frame = spark.createDataFrame(rows, "g string, d string, n bigint")
    cut = frame.withColumn("bucket", running.digest_bucket(F.col("d"), 400))
    assert cut.select("bucket").distinct().count() > 30
    for row in running.before(cut, ["g"], "bucket", ["d"], {"total": "n"}).collect():
        assert row.total == sum(n for g, d, n in rows if g == row.g and d < row.d)


def test_copies(spark, monkeypatch):
    monkeypatch.setattr(running, "_CHUNK", 7)
    frame = spark.createDataFrame([("a", 1), ("b", 30)], "k string, n bigint")
    found = sorted(map(tuple, running.copies(frame, "n", "i").collect()))
    assert found == [("a", 0)] + [("b", i) for i in range(30)]


# --- sharding -------------------------------------------------------------------------------


def test_shards(spark):
    rows = [(i, "t" * (i % 5), "s") for i in range(6000)] + [(None, None, None), (5, "", "s"), (5, "", "s"), (5, None, "s")]
    got = sharding.assign(_docs(spark, rows)).collect()
    assert len(got) == len(rows)
    slots, keys = defaultdict(list), defaultdict(set)
    for row in got:
        slots[row.shard].append(row.slot)
        keys[row.doc_id].add((row.shard, row.grown_shard))
        assert row.grown_shard in (row.shard, 24)
    assert slots.keys() == set(range(24))
    assert all(sorted(found) == list(range(len(found))) for found in slots.values())
    assert all(len(found) == 1 for found in keys.values())
    assert all(180 < len(found) < 330 for found in slots.values())
    assert 180 < sum(row.grown_shard == 24 for row in got) < 300
    assert sharding.assign(_docs(spark, [])).collect() == []


def test_equal_rows_of_a_third_of_the_table(spark):
    rows = [(7, "same", "s")] * 300 + [(i, "other", "s") for i in range(600)]
    got = sharding.assign(_docs(spark, rows)).collect()
    own = [row.shard for row in got if row.doc_id == 7 and row.size == 12]
    assert len(own) == 300 and len(set(own)) == 1
    slots = sorted(row.slot for row in got if row.shard == own[0])
    assert slots == list(range(len(slots)))


def test_movement_stays_in_the_subtree_whose_weight_changes(spark):
    leaves = sharding.tree(24)
    heavier = [leaf._replace(weight=3.0) if leaf.shard == 5 else leaf for leaf in leaves]
    key = F.concat(F.lit("k"), F.col("id").cast("string"))
    frame = spark.range(20_000).select(
        sharding.place(key, leaves).alias("old"), sharding.place(key, heavier).alias("new")
    )
    moved = [(row.old, row.new) for row in frame.where("old <> new").collect()]
    region = lambda shard: shard // 12
    rack = lambda shard: shard // 4
    assert moved
    for old, new in moved:
        # Into the region from outside, into the rack from inside the region, into the shard from its rack.
        assert region(new) == region(5)
        if region(old) == region(5):
            assert rack(new) == rack(5)
        if rack(old) == rack(5):
            assert new == 5
    share = frame.where("new = 5").count() / 20_000
    assert 0.09 < share < 0.14
    gone = [leaf._replace(weight=0.0) if leaf.shard == 5 else leaf for leaf in leaves]
    assert spark.range(2_000).select(sharding.place(key, gone).alias("s")).where("s = 5 OR s IS NULL").count() == 0


# --- chat -----------------------------------------------------------------------------------

TALK = "conv_id bigint, turn bigint, role string, text string, view string, start int"


def _turns(spark, rows):
    return spark.createDataFrame([(*row, "clash", 0) for row in rows], TALK)


def _render(rows):
    """Brute force: each rendering, and its learnt spans."""
    talks = defaultdict(list)
    for conv, turn, role, text in rows:
        talks[conv].append((turn is not None, turn or 0, role or "unknown", text or ""))
    out = {}
    for conv, turns in talks.items():
        turns.sort()
        for view in {speaker for _, _, speaker, _ in turns} - {"system"}:
            whole, spans = "", []
            for _, _, speaker, text in turns:
                name = "".join("_" if c in "|<>\r\n" else c for c in speaker)
                head = "<|assistant|>\n" if speaker == view else "<|system|>\n" if speaker == "system" else f"<|user {name}|>\n"
                body = text.replace("<|", "< |") + "<|end|>\n"
                if speaker == view:
                    spans.append((len(whole) + len(head), len(whole) + len(head) + len(body)))
                whole += head + body
            out[conv, view] = whole, spans
    return out


def _rendered(frame):
    whole, spans, places = defaultdict(dict), defaultdict(list), defaultdict(list)
    for row in frame.collect():
        key = row.conv_id, row.view
        whole[key][row.start] = row.segment
        places[key].append(row.position)
        assert row.stop == row.start + len(row.segment)
        if row.learn_from < row.stop:
            spans[key].append((row.learn_from, row.stop))
    for found in places.values():
        assert sorted(found) == list(range(len(found)))
    return {key: ("".join(s for _, s in sorted(found.items())), sorted(spans[key])) for key, found in whole.items()}


def test_every_view(spark):
    rows = [
        (1, 0, "system", "Be kind."), (1, 1, "ann", "Hi <|end|> <|assistant|>"), (1, 2, "bob", "Hello \U0001f642"),
        (1, 3, "cy|<x>", None), (1, 4, "ann", ""), (1, 4, "ann", ""), (2, 5, None, "who"), (2, None, "ann", "first"),
        (None, 1, "ann", "no id"), (None, 2, "bob", "same talk"), (3, 0, "system", "alone"), (4, 0, "x", "y" * 100_000),
    ]
    assert _rendered(chat.perspectives(_turns(spark, rows))) == _render(rows)


def test_a_long_dialogue_is_cut_into_buckets(spark, monkeypatch):
    monkeypatch.setattr(chat, "BUCKET_BITS", 3)
    rows = [(1, i, f"p{i % 3}", f"turn {i}" * (i % 4)) for i in range(300)] + [(2, -5, "p0", "a"), (2, -13, "p1", "b")]
    assert _rendered(chat.perspectives(_turns(spark, rows))) == _render(rows)


def test_an_empty_id_is_not_a_missing_one(spark):
    rows = [("", 0, "ann", "a"), (None, 0, "ann", "b"), ("", 1, "bob", "c"), (None, None, "cy", "d")]
    frame = spark.createDataFrame([(*row, "x", 0) for row in rows], TALK.replace("conv_id bigint", "conv_id string"))
    assert _rendered(chat.perspectives(frame)) == _render(rows)


def test_a_turn_and_a_row_of_any_size(spark, monkeypatch):
    """Null turns without a conversation, many of them the same row."""
    monkeypatch.setattr(chat, "BUCKET_BITS", 3)
    monkeypatch.setattr(running, "_CHUNK", 7)
    rows = [(None, None, "ann", "the same")] * 100 + [(None, None, f"p{i % 2}", f"{i:03d}") for i in range(100)]
    assert _rendered(chat.perspectives(_turns(spark, rows))) == _render(rows)


def test_no_turns(spark):
    assert chat.perspectives(_turns(spark, [])).collect() == []
