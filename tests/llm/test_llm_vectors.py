"""Exact top-k and nearest neighbours against brute force."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tocsin.llm import ann, topk

SCHEMA = "vec_id bigint, embedding array<double>, score string, rank int"


def _frame(spark, vectors):
    return spark.createDataFrame([(i, v, "clash", 0) for i, v in vectors], SCHEMA)


def _usable(vectors):
    """Rows that take part, each by itself."""
    return [
        (i, v) for i, v in vectors
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]


def _vectors(seed, n=180, width=7):
    """Whole numbers close together, so that scores tie; some equal vectors, some not usable."""
    chance = random.Random(seed)
    vectors = [(i, [chance.randrange(-2, 3) / 4 for _ in range(width)]) for i in range(n)]
    vectors += [(n + i, [0.5] * width) for i in range(60)]
    # Ids that come again: with the same vector, and with others.
    vectors += [(n + 3, [0.5] * width), (3, [1.0] * width), (4, [-0.25] * width), (10, [1.0] * width), (20, [0.5] * width)]
    return vectors + [
        (1000, None), (1001, [1.0, None] + [0.0] * (width - 2)), (1002, [math.nan] * width), (None, [1.0] * width),
        (1003, [math.inf] + [0.0] * (width - 1)), (1010, [0.0] * width), (1020, [0.25] * (width - 2)), (1030, []),
    ]


def _brute_top(vectors, k, every):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in _usable(vectors)]
    lists = set()
    for place, (q, v) in enumerate(kept):
        if q % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for at, (i, w) in enumerate(kept) if at != place)
            limited = [(max(-(1 << 63), min((1 << 63) - 1, -s)), i) for s, i in scores]
            limited.sort(key=lambda pair: (-pair[0], pair[1]))
            lists.add((q, tuple(v), tuple((r + 1, i, s) for r, (s, i) in enumerate(limited[:k]))))
    return sorted((q, *row) for q, _, rows in lists for row in rows)


@pytest.mark.parametrize("lists", [1, 2, 3])
@pytest.mark.parametrize("tiles", [(512, 8192), (3, 16)])
def test_exact_top_k(spark, monkeypatch, lists, tiles):
    monkeypatch.setattr(topk, "TILE_QUERIES", tiles[0])
    monkeypatch.setattr(topk, "TILE_VECTORS", tiles[1])
    vectors = _vectors(lists)
    got = topk.exact_top_k(_frame(spark, vectors), F.col("vec_id") % 10 == 0, 10, lists=lists).collect()
    assert sorted(map(tuple, got)) == _brute_top(vectors, 10, 10)


def test_exact_top_k_of_few_and_none(spark):
    few = [(0, [1.0, 2.0]), (10, [3.0, -1.0]), (3, [1e300, 1.0])]
    got = topk.exact_top_k(_frame(spark, few), F.col("vec_id") % 10 == 0, 10).collect()
    assert sorted((r.query_id, r.rank, r.vec_id) for r in got) == [(0, 1, 3), (0, 2, 10), (10, 1, 3), (10, 2, 0)]
    for nothing in ([], [(0, None)], [(0, [1.0])]):
        assert topk.exact_top_k(_frame(spark, nothing), F.col("vec_id") % 10 == 0, 10).collect() == []


@pytest.mark.parametrize("large", [[300_000.0, 400_000.0, -7e5], [3e9, -2.5e9, 1.5], [1e300, -1e300, 2.0, 3e15]])
def test_components_of_any_size(spark, monkeypatch, large):
    monkeypatch.setattr(topk, "WIDE_QUERIES", 3)
    monkeypatch.setattr(topk, "WIDE_VECTORS", 5)
    chance = random.Random(8)
    vectors = [(i, [chance.choice([*large, 0.0, 1.0, -0.3, 0.001]) for _ in range(3)]) for i in range(40)]
    vectors += [(100 + i, [chance.uniform(-1, 1) for _ in range(3)]) for i in range(60)]
    got = topk.exact_top_k(_frame(spark, vectors), F.col("vec_id") % 10 == 0, 5).collect()
    assert sorted(map(tuple, got)) == _brute_top(vectors, 5, 10)


def _brute_near(vectors, k, every):
    """Per query row its id and the k largest cosines with other rows, as (id, cosine)."""
    kept = [(i, np.array(v)) for i, v in _usable(vectors) if any(v)]
    width = max((len(v) for _, v in kept), default=1)
    kept = [(i, np.pad(v, (0, width - len(v)))) for i, v in kept]
    out = {}
    for place, (q, v) in enumerate(kept):
        if q % every == 0:
            cosines = [(i, v @ w / math.sqrt((v @ v) * (w @ w))) for at, (i, w) in enumerate(kept) if at != place]
            out[q, tuple(v)] = sorted(cosines, key=lambda item: (-round(item[1], 9), item[0]))[:k]
    return out


def test_nearest_neighbours(spark):
    chance = random.Random(5)
    vectors = _vectors(9) + [(2000 + i, [chance.gauss(0, 1) for _ in range(7)]) for i in range(600)]
    odd = [0.3, -0.91, 0.17, 0.33, -0.4, 0.05, 0.7]
    vectors += [(50, odd), (50, odd), (51, odd), (51, [0.9 * x for x in odd])]
    got = {}
    for row in ann.nearest(_frame(spark, vectors), F.col("vec_id") % 50 == 0, 5).collect():
        got.setdefault(row.query_id, []).append(row)
    want = {}
    for (q, _), best in _brute_near(vectors, 5, 50).items():
        want.setdefault(q, []).append(best)
    assert got.keys() == want.keys()
    found = total = 0
    for q, lists in want.items():
        rows = sorted(got[q], key=lambda r: r.rank)
        assert [r.rank for r in rows] == sorted(r for _ in lists for r in (1, 2, 3, 4, 5))
        total += 5 * len(lists)
        least = sorted((best[-1][1] for best in lists), reverse=True)
        found += sum(any(r.score >= low - 1e-9 for low in least) for r in rows)
    assert found / total >= 0.95
    # A copy of a query row is its nearest other, under its own id.
    assert any(r.vec_id == 50 and r.score > 1 - 1e-12 for r in got[50])


def test_nearest_of_few_and_none(spark):
    few = [(0, [1.0, 0.0]), (50, [0.0, 2.0]), (7, [1.0, 1.0]), (8, [1.0, 1.0]), (100, [0.0, 0.0]), (150, None)]
    got = ann.nearest(_frame(spark, few), F.col("vec_id") % 50 == 0, 5).collect()
    rows = sorted((r.query_id, r.rank, r.vec_id, round(r.score, 6)) for r in got)
    half = round(math.sqrt(0.5), 6)
    assert rows == [
        (0, 1, 7, half), (0, 2, 8, half), (0, 3, 50, 0.0), (50, 1, 7, half), (50, 2, 8, half), (50, 3, 0, 0.0),
    ]
    for nothing in ([], [(0, None)], [(0, [1.0])]):
        assert ann.nearest(_frame(spark, nothing), F.col("vec_id") % 50 == 0, 5).collect() == []


def test_the_graph_finds_most_true_neighbours(spark):
    chance = np.random.default_rng(2)
    points = chance.normal(size=(1500, 12))
    units = points / np.linalg.norm(points, axis=1)[:, None]
    frame = spark.createDataFrame([(i, u.astype(np.float16).tobytes()) for i, u in enumerate(units)], "id bigint, unit binary")
    graph = ann.build_graph(frame, ann.Pivots(frame, 32, 12), k=8)
    near = {}
    for row in graph.collect():
        near.setdefault(row.u, set()).add(row.v)
    cosines = units @ units.T
    np.fill_diagonal(cosines, -2)
    true = np.argsort(-cosines, axis=1)[:, :8]
    assert np.mean([len(near[i] & set(true[i].tolist())) / 8 for i in range(1500)]) > 0.9


def _unit_frame(spark, units):
    return spark.createDataFrame([(i, u.astype(np.float16).tobytes()) for i, u in enumerate(units)], "id bigint, unit binary")


def _units(seed, n, width):
    points = np.random.default_rng(seed).normal(size=(n, width))
    return points / np.linalg.norm(points, axis=1)[:, None]


def test_a_cell_of_any_size_is_compared_whole(spark, monkeypatch):
    """With two pivots that all vectors share, the first graph is the exact one."""
    monkeypatch.setattr(ann, "CELL_ROWS", 64)
    units = _units(3, 500, 8)
    near = {}
    frame = _unit_frame(spark, units)
    for row in ann._first_graph(frame, ann.Pivots(frame, 2, 8), ann.CELL_LINKS).collect():
        near.setdefault(row.u, []).append(row.sim)
    rounded = units.astype(np.float16).astype(np.float32)
    cosines = rounded @ rounded.T
    np.fill_diagonal(cosines, -2)
    for i in range(500):
        assert np.allclose(sorted(near[i]), np.sort(cosines[i])[-ann.CELL_LINKS :], atol=1e-5)


def test_pivots_and_beam_grow_with_the_rows():
    for rows in (1_000, 50_000, 5_000_000):
        assert rows * ann.CELLS / ann.pivot_count(rows) <= ann.CELL_ROWS / 2
    assert ann.walk_width(100) == ann.walk_width(16_384) == (ann.BEAM, ann.ENTRIES)
    assert ann.walk_width(5_000_000) > ann.walk_width(200_000) > ann.walk_width(16_385)
    assert ann.walk_width(10**9)[0] < 4 * ann.BEAM


def test_many_pivots_are_found_by_groups(spark, monkeypatch):
    """Most of the nearest pivots are those that holding against all of them gives."""
    units = _units(7, 3_000, 8)
    frame = _unit_frame(spark, units)

    def pivots():
        links = ann.Pivots(frame, 400, 8).nearest(frame, 5).collect()
        return {(row.u, row.v) for row in links}

    whole = pivots()
    assert len(whole) == 3_000 * 5
    monkeypatch.setattr(ann, "FLAT_PIVOTS", 64)
    monkeypatch.setattr(ann, "GROUP_ROWS", 100)
    grouped = pivots()
    assert len(grouped) == len(whole) and len(grouped & whole) >= 0.75 * len(whole)


def test_recall_on_ten_thousand(spark):
    """Clusters that overlap, by the sizes that are registered."""
    chance = np.random.default_rng(11)
    points = chance.normal(size=(40, 32))[chance.integers(0, 40, 10_000)] + chance.normal(size=(10_000, 32))
    rows = spark.createDataFrame([(i, p) for i, p in enumerate(points.tolist())], "vec_id bigint, embedding array<double>")
    got = {}
    for row in ann.nearest(rows, F.col("vec_id") % 50 == 0, 5).collect():
        got.setdefault(row.query_id, set()).add(row.vec_id)
    units = points / np.linalg.norm(points, axis=1)[:, None]
    hits = 0
    for q in range(0, 10_000, 50):
        cosines = units @ units[q]
        cosines[q] = -2
        hits += len(got[q] & set(np.argsort(-cosines)[:5].tolist()))
    assert hits / 1_000 >= 0.95


def test_all_that_name_a_hub_are_met_in_turn(spark):
    links = [(u, 0, 0.5, True, False) for u in range(1, 3 * ann.NAMED_BY + 1)]
    graph = spark.createDataFrame(links, "u bigint, v bigint, sim float, fresh boolean, met boolean")
    met = set()
    for turn in range(1, 4):
        now = graph.withColumn("met", F.col("u").isin(list(met)))
        met |= {row.u for row in ann._drawn(now, turn).collect()}
    assert met == set(range(1, 3 * ann.NAMED_BY + 1))


def test_a_vector_on_no_list_is_found(spark):
    units = _units(4, 4, 6)
    frame = _unit_frame(spark, units)
    graph = spark.createDataFrame([(0, 1, 0.9), (1, 0, 0.9), (2, 1, 0.9), (3, 2, 0.9)], "u bigint, v bigint, sim float")
    entries = spark.createDataFrame([(0, 0)], "query bigint, node bigint")
    found = ann.greedy_search(frame.where("id = 0"), graph, frame, entries, 4, 6).collect()
    assert {row.node for row in found} == {0, 1, 2, 3}


def test_what_half_precision_cannot_tell_apart_is_ranked_exactly(spark):
    """150 vectors within a rounding of each other, more than are rescored by rank."""
    chance = np.random.default_rng(6)
    vectors = [(i, (np.array([1.0, 2.0, 3.0, 4.0]) + 1e-5 * chance.normal(size=4)).tolist()) for i in range(150)]
    want = _brute_exact(vectors, 5, 50)
    got = {}
    for row in ann.nearest(_frame(spark, vectors), F.col("vec_id") % 50 == 0, 5).collect():
        got.setdefault(row.query_id, set()).add(row.vec_id)
    assert np.mean([len(got[q] & want[q]) / 5 for q in want]) >= 0.95


def _brute_exact(vectors, k, every):
    """Angles from differences of unit vectors, which cosines this close to one do not resolve."""
    units = {i: np.array(v) / np.linalg.norm(v) for i, v in vectors}
    return {
        q: set(sorted((i for i in units if i != q), key=lambda i: np.linalg.norm(units[i] - units[q]))[:k])
        for q in units if q % every == 0
    }
