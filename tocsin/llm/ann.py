"""Approximate nearest neighbours by cosine: a graph grown by NN-descent, searched greedily.

The graph starts from cells around pivots: each vector meets all that share one of its nearest
pivots. The pivots grow with the rows, so cells keep their size; a cell that is larger all the same
is compared in tiles, part against part. Up to FLAT_PIVOTS of them are sent to all tasks. Beyond,
they are grouped around some of them, which are few enough to be sent, and a vector is held only
against the pivots of the groups next to it, which come to it by a join. Then neighbours of neighbours are tried, round after round: around every node its
neighbours, either way, are compared with each other, at least one of a pair being new since the
last round, and a pair that improves either side's list is kept. It ends when a round changes few
entries. A query enters the graph at the pivots nearest to it and follows links greedily, either
way: the best nodes known are expanded until none of them is unexpanded; some more are followed with
each doubling of the rows. All of it runs as Spark joins; a task sees pools of at most
two neighbour lists, or tiles of a bounded number of vectors.

The graph and the walk are approximate, the scores are not: they are cosines of the original
vectors in double precision, worked out for all found that half precision cannot tell from the
best. Of a node's many reverse neighbours a few enter a pool, drawn anew each round, those first
that have not been in it yet; that is the method's own sampling, which recall is measured with.
Every vector is a node.

Vectors that are null, zero, or hold null or non-finite components take no part, neither do rows
without id. All other rows count, each by itself: several vectors under one id, and copies of a
row, which are candidates for one another; as queries copies are one. Equal vectors are one node.
With fewer vectors than asked for, all of them are returned; ties go to the smaller id. A shorter
vector counts as padded with zeros. An empty table gives no rows, and other columns take no part,
whatever their names.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tocsin.llm.common import discard, keep_table, small_batches
from tocsin.llm.vectors import answers, classes, finite

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Neighbours kept per node, and of those that name it, how many enter a pool.
NEIGHBOURS = 32
NAMED_BY = 16

# Pivots at least, the cells each vector joins, the rows of a cell compared at once, and the links
# that each vector takes out of a cell. There are as many pivots as make cells half full.
PIVOTS = 256
CELLS = 10
CELL_ROWS = 2_048
CELL_LINKS = 12

# Nodes a query keeps and expands, and pivots it starts from, up to so many rows, and what each
# doubling beyond adds.
BEAM, BEAM_MORE = 48, 8
ENTRIES, ENTRIES_MORE = 8, 1
WALKED_ROWS = 16_384

# Pivots that are sent to all tasks; of groups of pivots, those that a vector looks into.
FLAT_PIVOTS = 8_192
GROUPS = 4

# Vectors of one group that are held against its pivots by one task.
GROUP_ROWS = 8_192

# Found nodes whose exact score is worked out, per node asked for, and the most by which cosines in
# half precision are off: a rounding of either vector, and what single precision adds.
RESCORED = 4
OFF = 1.1 / 1_024

# Rows that are held against all pivots at once.
PIVOT_ROWS = 256

# A round that changes less than this part of all entries is the last.
SETTLED = 0.05

_LINK = "u bigint, v bigint, sim float"


def _matrix(column, width: int) -> np.ndarray:
    """Unit vectors from their packed form, half-precision numbers."""
    packed = np.frombuffer(b"".join(column.to_pylist()), np.float16)
    return packed.astype(np.float32).reshape(-1, width)


def _packed(width: int):
    """Vectors of length one, packed. Only the graph and the walk use them."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("vector")
            sizes = vectors.value_lengths().to_numpy()
            rows = np.zeros((len(sizes), width))
            row = np.repeat(np.arange(len(sizes)), sizes)
            rows[row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = (
                vectors.flatten().to_numpy()
            )
            rows /= np.abs(rows).max(axis=1, keepdims=True)
            rows /= np.linalg.norm(rows, axis=1, keepdims=True)
            units = [unit.tobytes() for unit in rows.astype(np.float16)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(units, pa.binary())], names=["id", "unit"]
            )

    return pack


def _links(u, v, sim) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(sim, pa.float32())],
        names=["u", "v", "sim"],
    )


def pivot_count(rows: int) -> int:
    return max(PIVOTS, -(-2 * rows * CELLS // CELL_ROWS))


def walk_width(rows: int) -> tuple[int, int]:
    """The nodes a query keeps, and the pivots it starts from."""
    doublings = max(0, math.ceil(math.log2(max(rows, 1) / WALKED_ROWS)))
    return BEAM + BEAM_MORE * doublings, ENTRIES + ENTRIES_MORE * doublings


def _nearest_of(sims: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest of each row, in any order."""
    if k >= sims.shape[1]:
        return np.broadcast_to(np.arange(sims.shape[1]), sims.shape)
    return np.argpartition(-sims, k - 1, axis=1)[:, :k]


def _nearest_pivots(pivots, width: int, n: int):
    """The n nearest pivots of each vector, with their cosines. `pivots` is a broadcast of them
    and their names. Of equally near ones other rows take others, so that a crowd of vectors that
    half precision cannot tell apart does not meet in the same few cells."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, names = pivots.value
        for batch in batches:
            for start in range(0, batch.num_rows, PIVOT_ROWS):
                part = batch.slice(start, PIVOT_ROWS)
                ids = part.column("id").to_numpy()
                turned = np.random.default_rng(int(ids[0]) & 0xFFFFFFFF).permutation(len(names))
                sims = _matrix(part.column("unit"), width) @ units[turned].T
                near = _nearest_of(sims, n)
                best = np.take_along_axis(sims, near, 1)
                yield _links(np.repeat(ids, near.shape[1]), names[turned][near].ravel(), best.ravel())

    return assign


def _pivots_of_group(width: int, n: int):
    """Of one group of pivots and some of the vectors next to it: the n nearest pivots of each."""

    def assign(table: pa.Table) -> pa.Table:
        asks = table.column("asks").to_numpy()
        ids, units = table.column("id").to_numpy(), _matrix(table.column("unit"), width)
        names, wanted = ids[~asks], ids[asks]
        out = [pa.RecordBatch.from_pylist([], schema=_links([], [], []).schema)]
        for start in range(0, len(wanted) if len(names) else 0, PIVOT_ROWS):
            sims = units[asks][start : start + PIVOT_ROWS] @ units[~asks].T
            near = _nearest_of(sims, n)
            rows = wanted[start : start + PIVOT_ROWS]
            out.append(_links(np.repeat(rows, near.shape[1]), names[near].ravel(), np.take_along_axis(sims, near, 1).ravel()))
        return pa.Table.from_batches(out)

    return assign


class Pivots:
    """The pivots of a graph, sent whole if they are few and found by groups if not."""

    def __init__(self, units: DataFrame, count: int, width: int) -> None:
        self.width = width
        first = units.orderBy(F.xxhash64("id"), "id")
        self.several = None
        if count > FLAT_PIVOTS:
            self.several = keep_table(first.limit(count), "pivots")
            # As many groups as pivots in one, no more than may be sent.
            count = min(FLAT_PIVOTS, math.isqrt(count))
            first = self.several.orderBy(F.xxhash64("id", F.lit(1)), "id")
        chosen = first.limit(count).toArrow()
        names = chosen.column("id").to_numpy()
        self.sent = units.sparkSession.sparkContext.broadcast((_matrix(chosen.column("unit"), width), names))

    def nearest(self, units: DataFrame, n: int) -> DataFrame:
        """(u, v, sim): the n nearest pivots of each vector, nearly if they are many."""
        if self.several is None:
            return units.mapInArrow(_nearest_pivots(self.sent, self.width, n), _LINK)

        def grouped(rows: DataFrame, groups: int, asks: bool) -> DataFrame:
            near = rows.mapInArrow(_nearest_pivots(self.sent, self.width, groups), _LINK)
            return near.select(F.col("u").alias("id"), F.col("v").alias("group")).join(rows, "id").withColumn(
                "asks", F.lit(asks))

        wanted = keep_table(grouped(units, GROUPS, True), "wanted")
        parts = F.ceil(F.col("n") / GROUP_ROWS).cast("int")
        sizes = wanted.groupBy("group").agg(F.count(F.lit(1)).alias("n")).select("group", parts.alias("parts"))
        vectors = wanted.join(sizes, "group").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))
        offered = grouped(self.several, 1, False).join(sizes, "group")
        offered = offered.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
        both = vectors.select("group", "part", "id", "unit", "asks").unionByName(
            offered.select("group", "part", "id", "unit", "asks"))
        found = both.groupBy("group", "part").applyInArrow(_pivots_of_group(self.width, n), _LINK)
        return _best(found.distinct(), n).drop("r")


def _cell_links(k: int, width: int):
    """The k nearest of each vector inside its tile of a cell."""

    def link(cell: pa.Table) -> pa.Table:
        ids = cell.column("id").to_numpy()
        units = _matrix(cell.column("unit"), width)
        sims = units @ units.T
        np.fill_diagonal(sims, -np.inf)
        near = _nearest_of(sims, min(k, len(ids) - 1)) if len(ids) > 1 else np.empty((1, 0), np.int64)
        best = np.take_along_axis(sims, near, 1)
        return pa.Table.from_batches([_links(np.repeat(ids, near.shape[1]), ids[near].ravel(), best.ravel())])

    return link


def _pool_links(width: int):
    """Of each pool, the pairs with a new member that improve one side's list."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pools = batch.column("pool")
            sizes = np.diff(pools.offsets.to_numpy())
            if not len(sizes) or not sizes.max():
                continue
            member = pools.flatten()
            ids = member.field("v").to_numpy()
            kth = member.field("kth").to_numpy()
            new = member.field("fresh").to_numpy(zero_copy_only=False).astype(bool)
            units = _matrix(member.field("unit"), width)
            row = np.repeat(np.arange(len(sizes)), sizes)
            column = np.arange(len(ids)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            at = np.full((len(sizes), sizes.max()), -1)
            at[row, column] = np.arange(len(ids))
            block = np.zeros((*at.shape, width), dtype=np.float32)
            block[row, column] = units
            sims = block @ block.transpose(0, 2, 1)
            held, some = at >= 0, np.zeros(at.shape, dtype=bool)
            some[row, column] = new
            worst = np.full(at.shape, np.inf, dtype=np.float32)
            worst[row, column] = kth
            useful = held[:, None, :] & held[:, :, None] & (some[:, None, :] | some[:, :, None])
            useful &= sims > worst[:, :, None]
            pool, i, j = np.nonzero(useful)
            a, b = ids[at[pool, i]], ids[at[pool, j]]
            other = a != b
            yield _links(a[other], b[other], sims[pool, i, j][other])

    return link


def _best(links: DataFrame, k: int) -> DataFrame:
    """The k most similar of each node; ranks are cut before the shuffle, so hubs do no harm."""
    near = Window.partitionBy("u").orderBy(F.desc("sim"), "v")
    return links.withColumn("r", F.row_number().over(near)).where(F.col("r") <= k)


def _first_graph(units: DataFrame, pivots: Pivots, k: int) -> DataFrame:
    width = pivots.width
    assigned = keep_table(pivots.nearest(units, CELLS), "cells")
    sizes = assigned.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    # A cell of more than CELL_ROWS is dealt to parts of half as many, and each part meets each other.
    parts = F.when(F.col("n") <= CELL_ROWS, 1).otherwise(F.ceil(2 * F.col("n") / CELL_ROWS)).cast("int")
    dealt = assigned.join(sizes, "v").withColumn("parts", parts).select(
        "v", F.col("u").alias("id"), "parts", F.pmod(F.xxhash64("u"), F.col("parts")).cast("int").alias("part")
    )
    met = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    tiles = dealt.select("v", "id", "parts", "part", met).where("parts = 1 OR part <> other").select(
        "v", "id", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high")
    )
    linked = tiles.join(units, "id").groupBy("v", "low", "high").applyInArrow(
        _cell_links(CELL_LINKS, width), _LINK
    )
    fresh = _best(linked.distinct(), k).drop("r").withColumn("fresh", F.lit(True))
    return fresh.withColumn("met", F.lit(False))


def _drawn(graph: DataFrame, turn: int) -> DataFrame:
    """NAMED_BY links to each node, drawn anew each turn; first those that it has not met yet."""
    few = Window.partitionBy("v").orderBy("met", F.xxhash64("u", "v", F.lit(turn)), "u")
    drawn = graph.select("u", "v", "sim", "met").withColumn("r", F.row_number().over(few))
    return drawn.where(F.col("r") <= NAMED_BY).drop("r")


def _either_way(graph: DataFrame, drawn: DataFrame) -> DataFrame:
    """Pools: a node's neighbours and the drawn ones that name it, new if they were not in it."""
    named = drawn.select(F.col("v").alias("u"), F.col("u").alias("v"), (~F.col("met")).alias("fresh"))
    both = graph.select("u", "v", "fresh").unionByName(named)
    return both.groupBy("u", "v").agg(F.max("fresh").alias("fresh"))


def build_graph(units: DataFrame, pivots: Pivots, k: int = NEIGHBOURS, settled: float = SETTLED) -> DataFrame:
    """Links (u, v, sim) from each node to its k nearest, nearly. `units` are (id, unit)."""
    nodes, width = units.count(), pivots.width
    graph = keep_table(_first_graph(units, pivots, k), "graph")
    changed, turn = nodes * k, 0
    while changed > settled * nodes * k:
        turn += 1
        drawn = keep_table(_drawn(graph, turn), "drawn")
        worst = graph.groupBy("u").agg(
            F.when(F.count(F.lit(1)) >= k, F.min("sim")).otherwise(F.lit(-2.0)).alias("kth")
        )
        told = units.join(worst, units.id == worst.u, "left").select(
            F.col("id").alias("v"), "unit", F.coalesce("kth", F.lit(-2.0)).cast("float").alias("kth")
        )
        pools = (
            _either_way(graph, drawn).join(told, "v")
            .groupBy("u")
            .agg(F.collect_list(F.struct("v", "fresh", "kth", "unit")).alias("pool"))
            .where(F.exists("pool", lambda m: m["fresh"]))
            .select("pool")
        )
        tried = pools.mapInArrow(_pool_links(width), _LINK)
        tried = tried.select("*", F.lit(True).alias("fresh"), F.lit(False).alias("met"))
        kept = graph.select("u", "v", "sim", F.lit(False).alias("fresh"), "met")
        seen = drawn.select("u", "v", "sim", F.lit(False).alias("fresh"), F.lit(True).alias("met"))
        merged = kept.unionByName(seen).unionByName(tried).groupBy("u", "v").agg(
            F.max("sim").alias("sim"), F.min("fresh").alias("fresh"), F.max("met").alias("met")
        )
        before, graph = graph, keep_table(_best(merged, k).drop("r"), "graph")
        discard(before)
        discard(drawn)
        changed = graph.where("fresh").count()
    return graph.select("u", "v", "sim")


def _cosine(a: Column, b: Column) -> Column:
    zero = F.lit(0.0)

    def total(products: Column) -> Column:
        return F.aggregate(products, zero, lambda s, x: s + x)

    dot = total(F.zip_with(a, b, lambda x, y: F.coalesce(x.cast("double") * y, zero)))
    return dot / (_norm(a) * _norm(b))


def _norm(vector: Column) -> Column:
    doubles = F.transform(vector, lambda x: x.cast("double"))
    return F.sqrt(F.aggregate(doubles, F.lit(0.0), lambda s, x: s + x * x))


def _query_scores(width: int):
    """Of queries and nodes that they have just reached: their cosines."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sims = np.einsum("ij,ij->i", _matrix(batch.column("asked"), width), _matrix(batch.column("unit"), width))
            yield _links(batch.column("query"), batch.column("node"), sims)

    return score


def greedy_search(queries: DataFrame, graph: DataFrame, units: DataFrame, entries: DataFrame,
                  k: int, width: int, beam: int = BEAM) -> DataFrame:
    """The k best (query, node, sim) that following links from the entries finds, and all that half
    precision cannot tell from the RESCORED-th part of them.

    Per query the `beam` best nodes seen are kept; those not yet expanded are, all at once, and
    their neighbours, either way, are seen next. A node that falls off the beam never comes back. `queries` and `units` are (id, unit), `entries`
    (query, node).
    """
    ways = graph.select("u", "v").unionByName(graph.select(F.col("v").alias("u"), F.col("u").alias("v")))
    ways = keep_table(ways.distinct(), "ways")
    other = units.select(F.col("id").alias("node"), "unit")

    def scored(pairs: DataFrame) -> DataFrame:
        asked = queries.select(F.col("id").alias("query"), F.col("unit").alias("asked"))
        reached = pairs.join(other, "node").join(asked, "query")
        found = reached.select("query", "node", "asked", "unit").mapInArrow(_query_scores(width), _LINK)
        return found.select(F.col("u").alias("query"), F.col("v").alias("node"), "sim")

    near = Window.partitionBy("query").orderBy(F.desc("sim"), "node")

    def best(rows: DataFrame) -> DataFrame:
        return keep_table(rows.withColumn("r", F.row_number().over(near)).where(F.col("r") <= beam).drop("r"), "beam")

    # What a step reaches is a table of its own; only the few best of each query are written again.
    seen = keep_table(scored(entries.distinct()), "seen")
    kept = best(seen.withColumn("open", F.lit(True)))
    while True:
        front = kept.where("open").select("query", "node")
        if front.isEmpty():
            break
        reached = front.join(ways, front.node == ways.u).select("query", F.col("v").alias("node"))
        new = reached.distinct().join(seen, ["query", "node"], "left_anti")
        new = keep_table(scored(new), "seen")
        before, kept = kept, best(
            kept.withColumn("open", F.lit(False)).unionByName(new.withColumn("open", F.lit(True))))
        seen = seen.unionByName(new)
        discard(before)
    ranked = seen.withColumn("r", F.row_number().over(near))
    sure = F.min(F.when(F.col("r") <= -(-k // RESCORED), F.col("sim"))).over(Window.partitionBy("query"))
    return (
        ranked.withColumn("sure", sure)
        .where((F.col("r") <= k) | (F.col("sim") >= F.col("sure") - 2 * OFF))
        .select("query", "node")
    )


def nearest(rows: DataFrame, is_query: Column, k: int, key: str = "vec_id",
            vector: str = "embedding") -> DataFrame:
    """For each row that `is_query` marks, its k nearest others found: query_id, rank, vec_id,
    score."""
    small_batches(rows.sparkSession)
    some = F.exists(F.col(vector), lambda x: x != 0)
    whole = rows.where(finite(F.col(vector)) & some).select(
        F.col(key).alias("id"), F.col(vector).alias("vector"), is_query.alias("query")
    )
    grouped = classes(whole, F.coalesce("query", F.lit(False)), k + 1)
    vectors = grouped.vectors.select(F.col("rep").alias("id"), "vector")
    width = vectors.agg(F.max(F.size("vector"))).first()[0] or 1
    units = keep_table(vectors.mapInArrow(_packed(width), "id bigint, unit binary"), "units")
    nodes = units.count()
    pivots = Pivots(units, pivot_count(nodes), width)
    graph = build_graph(units, pivots)
    asked = grouped.queries.select(F.col("rep").alias("id")).distinct()
    asking = keep_table(units.join(asked, "id", "left_semi"), "asking")
    beam, starts = walk_width(nodes)
    entries = pivots.nearest(asking, starts)
    entries = entries.select(F.col("u").alias("query"), F.col("v").alias("node"))
    # A query that is a node itself enters there too; rows with its very vector are found by that.
    entries = entries.unionByName(asked.select(F.col("id").alias("query"), F.col("id").alias("node")))
    found = greedy_search(asking, graph, units, entries, RESCORED * (k + 1), width, beam)
    ask = vectors.select(F.col("id").alias("query"), F.col("vector").alias("a"))
    answer = vectors.select(F.col("id").alias("node"), F.col("vector").alias("b"))
    exact = found.join(ask, "query").join(answer, "node").select(
        F.col("query").alias("rep"),
        F.col("node").alias("other"),
        _cosine(F.col("a"), F.col("b")).alias("score"),
    )
    return answers(exact, grouped, k)
