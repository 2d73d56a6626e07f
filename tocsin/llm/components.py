"""Connected components by star contraction, with nothing gathered anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tocsin.llm.common import discard, keep_table


def _with_least(edges: DataFrame) -> DataFrame:
    """Each edge (a, b) with the least node among a's neighbours and a itself."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    return edges.join(least, "a").withColumn("m", F.least("a", "m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the least node around it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return _with_least(both).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the least of them. Edges go from larger to
    smaller nodes here."""
    linked = _with_least(edges)
    others = linked.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.unionByName(linked.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """From links (a, b) to (node, root): root is the least node reachable. Nodes without links,
    and roots themselves, have no row.

    Larger and smaller neighbours are hung in turn onto the least node around, which needs some
    log(n) rounds whatever the shape. Minima are pre-aggregated; the join that spreads them can
    be split where a node has very many links. Each round is a table in the shared folder.
    """
    links = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = keep_table(links.where("a <> b").distinct(), "links")
    mark = None
    while True:
        new = _mark(links)
        if new == mark or not new[0]:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark, before = new, links
        links = keep_table(_small_star(_large_star(before).distinct()).distinct(), "links")
        discard(before)


def _mark(links: DataFrame) -> tuple:
    """Two sets of links with the same mark are taken to be equal."""
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())
