"""Exact top-k by inner product with the three-phase uniform threshold.

The components of the vectors are dealt to m lists; a list holds each vector's part of every
score. Phase one takes the k best of each list for each query; their whole scores give a cutoff
that k vectors are known to reach. A vector that reaches it has a part of at least cutoff / m in
some list, so phase two collects all parts from there on. Phase three drops what cannot reach the
cutoff even with the most that its unseen parts may give, and works the rest out exactly.

Parts may be negative, so a sum of the parts seen is no lower bound; that is why the cutoff is
made of whole scores. Lists are worked on in tiles of a bounded number of queries and vectors,
each a numpy product: every query meets every vector in some tile, and no side is broadcast.

Components are taken as integers, floor(scale * x), of any size. Vectors with a component so large
that a sum of products might not fit a long, if there are any, are held against all others in
tiles of Python integers instead; only a score that no long holds is given as the nearest that one does.

Vectors that are null or hold a null or non-finite component take no part, neither do rows without
id. All other rows count, each by itself: several vectors under one id, and copies of a row, which
are candidates for one another; as queries copies are one. A shorter vector counts as padded with
zeros, ties go to the smaller id. A query that meets fewer than k others gets them all, an empty
table gives no rows, and other columns take no part, whatever their names.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tocsin.llm.common import keep_table
from tocsin.llm.vectors import answers, classes, finite

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCALE = 1024
LISTS = 2

# Queries and vectors of a tile.
TILE_QUERIES = 512
TILE_VECTORS = 8_192

# Tiles of Python integers.
WIDE_QUERIES = 64
WIDE_VECTORS = 1_024

_LONG = 1 << 63
_PARTS = "query bigint, list int, other bigint, part bigint"


def quantised(vector: Column, scale: int = SCALE) -> Column:
    """Whole numbers as doubles, which hold floor(scale * x) exactly whatever its size."""

    def whole(x: Column) -> Column:
        most = F.lit(sys.float_info.max)
        scaled = F.greatest(F.least(x.cast("double") * scale, most), -most)
        # From 2 to the 52nd on a double is a whole number.
        return F.when(F.abs(scaled) < float(1 << 52), F.floor(scaled).cast("double")).otherwise(scaled)

    return F.transform(vector, whole)


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    lists = column.combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.values.slice(lists.offsets[0].as_py(), int(sizes.sum())).to_numpy()
    out = np.zeros((len(sizes), width), dtype=np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact: in doubles where no sum can pass 2 to the 53rd, else in whole numbers."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def _tile(k: int, lists: int, width: int, cutoffs: bool):
    """Of a tile: each query's k best parts, or all parts from its cutoff / lists on."""

    def best(parts: np.ndarray, ids: np.ndarray):
        if parts.shape[1] <= k:
            return np.nonzero(np.ones_like(parts, dtype=bool))
        kth = np.partition(parts, parts.shape[1] - k, axis=1)[:, parts.shape[1] - k]
        rows, columns = [], []
        for row, least in enumerate(kth):
            near = np.flatnonzero(parts[row] >= least)
            chosen = near[np.lexsort((ids[near], -parts[row, near]))[:k]]
            rows.append(np.full(len(chosen), row))
            columns.append(chosen)
        return np.concatenate(rows), np.concatenate(columns)

    def work(tile: pa.Table) -> pa.Table:
        asks = tile.column("asks").to_numpy()
        ids = tile.column("id").to_numpy()
        matrix = _matrix(tile.column("part"), width)
        cutoff = tile.column("cutoff").to_numpy()[asks] if cutoffs else None
        q_ids, v_ids, queries, vectors = ids[asks], ids[~asks], matrix[asks], matrix[~asks]
        out = [np.empty(0, np.int64)] * 3
        if len(q_ids) and len(v_ids):
            pieces = []
            for start in range(0, len(q_ids), 64):
                parts = _product(queries[start : start + 64], vectors)
                if cutoffs:
                    row, column = np.nonzero(parts * lists >= cutoff[start : start + 64, None])
                else:
                    row, column = best(parts, v_ids)
                pieces.append((q_ids[start + row], v_ids[column], parts[row, column]))
            out = [np.concatenate(column) for column in zip(*pieces)]
        number = tile.column("list")[0].as_py()
        return pa.table({
            "query": pa.array(out[0], pa.int64()),
            "list": pa.array(np.full(len(out[0]), number), pa.int32()),
            "other": pa.array(out[1], pa.int64()),
            "part": pa.array(out[2], pa.int64()),
        })

    return work


def _tiles(vectors: DataFrame, queries: DataFrame, lists: int, width: int, sizes: tuple[int, int]):
    """Both sides dealt to tiles (query block, vector block, list); queries may carry a cutoff."""
    query_blocks = max(1, -(-sizes[0] // TILE_QUERIES))
    vector_blocks = max(1, -(-sizes[1] // TILE_VECTORS))
    step = -(-width // lists)

    def dealt(rows: DataFrame, asks: bool, cutoff: Column) -> DataFrame:
        block = F.pmod(F.xxhash64("id"), F.lit(query_blocks if asks else vector_blocks)).cast("int")
        others = F.explode(F.sequence(F.lit(0), F.lit((vector_blocks if asks else query_blocks) - 1)))
        parts = F.array(*(
            F.struct(F.lit(i).alias("list"), F.slice("vector", i * step + 1, max(1, step)).alias("part"))
            for i in range(lists)
        ))
        spread = rows.select("id", cutoff.alias("cutoff"), block.alias("own"), F.explode(parts).alias("p"))
        return spread.select("*", others.alias("across")).select(
            (F.col("own") if asks else F.col("across")).alias("query_block"),
            (F.col("across") if asks else F.col("own")).alias("vector_block"),
            F.col("p.list").alias("list"), F.col("p.part").alias("part"),
            "id", F.lit(asks).alias("asks"), F.col("cutoff").cast("bigint").alias("cutoff"),
        )

    cutoff = F.col("cutoff") if "cutoff" in queries.columns else F.lit(0)
    both = dealt(queries, True, cutoff).unionByName(dealt(vectors, False, F.lit(0)))
    return both.groupBy("query_block", "vector_block", "list")


def _resolved(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """Whole scores of pairs (query, other)."""
    ask = vectors.select(F.col("rep").alias("query"), F.col("vector").alias("q"))
    answer = vectors.select(F.col("rep").alias("other"), F.col("vector").alias("v"))
    product = F.zip_with(
        "q", "v", lambda a, b: F.coalesce(a.cast("bigint") * b, F.lit(0).cast("bigint"))
    )
    score = F.aggregate(product, F.lit(0).cast("bigint"), lambda total, x: total + x)
    return pairs.join(ask, "query").join(answer, "other").select("query", "other", score.alias("score"))


def threshold_search(vectors: DataFrame, queries: DataFrame, k: int, lists: int = LISTS) -> DataFrame:
    """The k best (query, other, score) of all (rep, vector) for each query among them, itself
    included, ties to the smaller id."""
    asked = vectors.join(queries.select("rep").distinct(), "rep", "left_semi")
    sized = vectors.withColumnRenamed("rep", "id")
    asked = asked.withColumnRenamed("rep", "id")
    count, width = vectors.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    width = max(1, width or 1)
    lists = min(lists, width)
    step = -(-width // lists)
    sizes = (asked.count(), count)

    # Phase one: the k best of each list, and the k-th best of their whole scores.
    first = _tiles(sized, asked, lists, width, sizes).applyInArrow(_tile(k, lists, step, False), _PARTS)
    by_list = Window.partitionBy("query", "list").orderBy(F.desc("part"), "other")
    first = first.withColumn("r", F.row_number().over(by_list)).where(F.col("r") <= k)
    gathered = keep_table(_resolved(first.select("query", "other").distinct(), vectors), "gathered")
    by_score = Window.partitionBy("query").orderBy(F.desc("score"), "other")
    kth = gathered.withColumn("r", F.row_number().over(by_score)).where(F.col("r") == k)
    cutoffs = kth.select(F.col("query").alias("id"), F.col("score").alias("cutoff"))

    # Phase two: every part that a vector reaching the cutoff must have in some list.
    nothing = F.lit(-(1 << 62))
    told = keep_table(
        asked.join(cutoffs, "id", "left").withColumn("cutoff", F.coalesce("cutoff", nothing)), "cutoffs"
    )
    second = _tiles(sized, told, lists, width, sizes).applyInArrow(_tile(k, lists, step, True), _PARTS)

    # Phase three: unseen parts are below cutoff / lists.
    seen = second.groupBy("query", "other").agg(
        F.sum("part").alias("seen"), F.count(F.lit(1)).alias("parts")
    )
    unseen = F.lit(lists) - F.col("parts")
    hopeful = seen.join(told.select(F.col("id").alias("query"), "cutoff"), "query").where(
        (F.col("seen") * lists + unseen * F.col("cutoff") >= F.col("cutoff") * lists)
        | (F.col("cutoff") == nothing)
    )
    hopeful = keep_table(hopeful, "hopeful")
    known = hopeful.where(unseen == 0).select("query", "other", F.col("seen").alias("score"))
    rest = _resolved(hopeful.where(unseen > 0).select("query", "other"), vectors)
    best = known.unionByName(rest).withColumn("r", F.row_number().over(by_score))
    return best.where(F.col("r") <= k).select("query", "other", "score")


def _wide_tile(k: int):
    """Of a tile of any whole numbers: each query's k best vectors."""

    def work(tile: pa.Table) -> pa.Table:
        asks = tile.column("asks").to_numpy()
        ids = tile.column("id").to_numpy()
        rows = [[int(x) for x in row] for row in tile.column("vector").to_pylist()]
        out = []
        for query in np.flatnonzero(asks):
            scores = [(-sum(a * b for a, b in zip(rows[query], rows[i])), ids[i]) for i in np.flatnonzero(~asks)]
            out += [(ids[query], i, max(-_LONG, min(_LONG - 1, -score))) for score, i in sorted(scores)[:k]]
        columns = list(zip(*out)) or [()] * 3
        return pa.table([pa.array(column, pa.int64()) for column in columns], names=["query", "other", "score"])

    return work


def _wide_search(asking: DataFrame, answering: DataFrame, k: int) -> DataFrame:
    """The k best (query, other, score) of each tile of two sets of (rep, vector)."""
    blocks = [max(1, -(-rows.count() // size)) for rows, size in ((asking, WIDE_QUERIES), (answering, WIDE_VECTORS))]

    def dealt(rows: DataFrame, asks: bool) -> DataFrame:
        own = F.pmod(F.xxhash64("rep"), F.lit(blocks[0 if asks else 1]))
        across = F.explode(F.sequence(F.lit(0), F.lit(blocks[1 if asks else 0] - 1)))
        spread = rows.select(F.col("rep").alias("id"), "vector", own.alias("own"), across.alias("across"))
        first, second = ("own", "across") if asks else ("across", "own")
        return spread.select(
            F.col(first).cast("int").alias("query_block"), F.col(second).cast("int").alias("vector_block"),
            "id", "vector", F.lit(asks).alias("asks"))

    both = dealt(asking, True).unionByName(dealt(answering, False))
    return both.groupBy("query_block", "vector_block").applyInArrow(
        _wide_tile(k), "query bigint, other bigint, score bigint")


def search(vectors: DataFrame, queries: DataFrame, k: int, lists: int = LISTS) -> DataFrame:
    """`threshold_search` for vectors of whole numbers of any size, as doubles."""
    largest = F.array_max(F.transform("vector", F.abs))
    width, most = vectors.agg(F.max(F.size("vector")), F.max(largest)).first()
    # Below, no sum of products passes 2 to the 62nd.
    limit = math.isqrt((1 << 62) // max(1, width or 1)) - 1
    narrow = F.coalesce(largest, F.lit(0.0)) <= limit

    def small(rows: DataFrame) -> DataFrame:
        return rows.where(narrow).select("rep", F.col("vector").cast("array<int>").alias("vector"))

    if (most or 0) <= limit:
        return threshold_search(small(vectors), queries, k, lists)
    asked = vectors.join(queries.select("rep").distinct(), "rep", "left_semi")
    found = (
        threshold_search(small(vectors), small(asked).select("rep"), k, lists)
        .unionByName(_wide_search(asked.where(~narrow), vectors, k))
        .unionByName(_wide_search(asked.where(narrow), vectors.where(~narrow), k))
    )
    best = Window.partitionBy("query").orderBy(F.desc("score"), "other")
    return found.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k).drop("r")


def exact_top_k(rows: DataFrame, is_query: Column, k: int, key: str = "vec_id",
                vector: str = "embedding", scale: int = SCALE, lists: int = LISTS) -> DataFrame:
    """For each row that `is_query` marks, its k best other rows: query_id, rank, vec_id, score."""
    whole = rows.where(finite(F.col(vector))).select(
        F.col(key).alias("id"), quantised(F.col(vector), scale).alias("vector"), is_query.alias("query")
    )
    # One more than k, since the query itself is among the found.
    grouped = classes(whole, F.coalesce("query", F.lit(False)), k + 1)
    found = search(grouped.vectors, grouped.queries, k + 1, lists)
    return answers(found.withColumnRenamed("query", "rep"), grouped, k)
