"""Vector tables: what takes part, and equal vectors as one class."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tocsin.llm.common import keep_table


class Classes(NamedTuple):
    """Distinct vectors under a number that rises with the least id that has them, the rows of each
    (the `most` least ids, copies of a row numbered from 1), and the rows that are queries."""

    vectors: DataFrame
    members: DataFrame
    queries: DataFrame


def finite(vector: Column) -> Column:
    whole = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return vector.isNotNull() & whole


def classes(rows: DataFrame, is_query: Column, most: int) -> Classes:
    """From (id, vector, is a query?). Rows without id take no part. All rows count: vectors under
    one id, and copies of a row too; as queries, copies of a row are one.

    No nearest list of length n can hold other rows of a class than its n least, or n + 1 with the
    query itself. The ranks are cut off before the shuffle, so a class of any size sends no more
    than that from each task.
    """
    known = rows.where(F.col("id").isNotNull()).select("id", "vector", is_query.alias("query"))
    single = known.groupBy("id", "vector").agg(F.max("query").alias("query"), F.count(F.lit(1)).alias("n"))
    single = keep_table(single, "vectors")
    distinct = single.groupBy("vector").agg(F.min("id").alias("least"))
    distinct = distinct.repartitionByRange("least").sortWithinPartitions("least", "vector")
    distinct = keep_table(distinct.select("vector", F.monotonically_increasing_id().alias("rep")), "classes")
    tagged = keep_table(single.join(distinct, "vector").select("id", "rep", "query", "n"), "members")
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), F.least("n", F.lit(most)))).alias("copy")
    least = Window.partitionBy("rep").orderBy("id", "copy")
    members = tagged.select("id", "rep", copies).withColumn("r", F.row_number().over(least))
    return Classes(
        distinct, members.where(F.col("r") <= most).select("id", "rep", "copy"),
        tagged.where("query").select("id", "rep"),
    )


def answers(found: DataFrame, classes: Classes, k: int) -> DataFrame:
    """From nearest classes (rep, other, score) per class of queries to the k nearest rows per
    query row, itself left out, ties to the smaller id."""
    members = classes.members.select(F.col("rep").alias("other"), F.col("id").alias("vec_id"), "copy")
    listed = (
        found.join(members, "other")
        .join(classes.queries.select("rep", F.col("id").alias("query_id")), "rep")
        .where("query_id <> vec_id OR rep <> other OR copy <> 1")
    )
    best = Window.partitionBy("query_id", "rep").orderBy(F.desc("score"), "vec_id", "other", "copy")
    return (
        listed.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
