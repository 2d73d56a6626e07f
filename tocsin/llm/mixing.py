"""Mixing sources to weights that a temperature sets, within a budget of tokens.

Weights are the sources' token shares to a power, normalised. The power is bisected: the largest
one whose mix is even enough (entropy), or the smallest one that repeats no source more often than
allowed. Each source then deals out its documents in permutations, one per pass; the last pass is
cut where the source's quota ends. Rows of all sources are laid into output blocks of a set number
of tokens, each block with every source in proportion, in hashed order inside the block.

A token is a word, and every document has one more for its end. A null source counts as the source
with the empty name, a null text as empty, a null id as a key of its own. Equal rows (source, id,
size) keep together in the order; where the quota ends among them, as many as fit enter the cut
pass. An empty table gives an empty mix.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tocsin.llm.common import free_name, keep_table
from tocsin.llm.running import before, copies, digest_bucket
from tocsin.llm.sharding import key_text

# A source is repeated 1.2 times at most, in a mix as large as the corpus.
MAX_REPEATS = 1.2
BLOCK_TOKENS = 65_536

WORD = r"[^\x20\x09-\x0D]+"

# A plan of so many sources at most goes to every task; a larger one is joined by source and salt.
SENT_SOURCES = 100_000
SALTS = 64

# The power is a multiple of 2 to the minus this; so many steps are looked at in one pass.
DEPTH = 30
STEPS = 6


def tokens(text: Column) -> Column:
    return (F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)) + 1).cast("bigint")


def _measures(totals: DataFrame, total: int, powers: list[float]) -> dict[float, tuple]:
    """For each power: entropy of the weights, and the largest weight against its share."""
    share = F.col("tokens") / F.lit(float(total))
    tried = totals.select(
        share.alias("share"), F.explode(F.array(*map(F.lit, powers))).alias("power")
    )
    raised = F.pow("share", F.col("power"))
    rows = tried.groupBy("power").agg(
        F.sum(raised).alias("z"),
        F.sum(raised * F.log("share")).alias("logs"),
        F.max(raised / F.col("share")).alias("most"),
    ).collect()
    return {
        row.power: (math.log(row.z) - row.power * row.logs / row.z, row.most / row.z) for row in rows
    }


def bisect_power(totals: DataFrame, budget: int, max_repeats: float | None = None,
                 evenness: float | None = None) -> float:
    """The exponent of the shares. Give `max_repeats`, or `evenness`: the entropy wanted, as a
    part of the largest there can be.

    Both measures fall or rise steadily with the exponent. Six halvings are read off one pass
    over the sources, all 63 points they might visit being measured together, so the sources
    are summed on the executors and only 63 numbers come back.
    """
    if (max_repeats is None) == (evenness is None):
        raise ValueError("give either max_repeats or evenness")
    total, sources = totals.agg(F.sum("tokens"), F.count(F.lit(1))).first()
    if not total:
        return 1.0
    rate = budget / total

    def fits(measured: tuple[float, float]) -> bool:
        entropy, most = measured
        if evenness is not None:
            return entropy >= evenness * math.log(sources)
        return most * rate <= max_repeats

    ends = _measures(totals, total, [0.0, 1.0])
    if evenness is not None and fits(ends[1.0]):
        return 1.0
    if max_repeats is not None:
        if rate > max_repeats:
            raise ValueError("the budget asks for more than max_repeats allows in any mix")
        if fits(ends[0.0]):
            return 0.0
    low, high = 0.0, 1.0
    for _ in range(DEPTH // STEPS):
        width = (high - low) / (1 << STEPS)
        measured = _measures(totals, total, [low + width * i for i in range(1, 1 << STEPS)])
        for _ in range(STEPS):
            middle = (low + high) / 2
            if fits(measured[middle]) == (evenness is not None):
                low = middle
            else:
                high = middle
    return low if evenness is not None else high


def quotas(classes: DataFrame, budget: int | None = None, max_repeats: float | None = None,
           evenness: float | None = None) -> DataFrame:
    """Per source: its tokens, its quota of the budget, full passes and what the last pass takes."""
    totals = keep_table(
        classes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("tokens")), "sources"
    )
    total = totals.agg(F.sum("tokens")).first()[0] or 0
    budget = total if budget is None else budget
    power = bisect_power(totals, budget, max_repeats, evenness)
    raised = F.pow(F.col("tokens") / F.lit(float(max(total, 1))), F.lit(power))
    z = totals.agg(F.sum(raised)).first()[0] or 1.0
    quota = F.floor(raised / F.lit(float(z)) * F.lit(float(budget))).cast("bigint")
    planned = (
        totals.withColumn("quota", quota)
        .withColumn("passes", F.expr("quota div tokens"))
        .withColumn("rest", F.expr("quota % tokens"))
    )
    return keep_table(planned, "plan")


def order_key(source: Column, key: Column, size: Column, turn: Column, seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), turn, source, key, size))


def _classes(documents: DataFrame, key: str, source: str, text: str) -> DataFrame:
    """Equal rows counted: source, id, size and how many. Narrow, and read several times."""
    sized = documents.select(
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"),
        F.col(key).alias("key"),
        tokens(F.col(text)).alias("size"),
    )
    return keep_table(sized.groupBy("source", "key", "size").agg(F.count(F.lit(1)).alias("n")), "sizes")


def _with_plan(rows: DataFrame, plan: DataFrame, name: str, spread: Column) -> DataFrame:
    """Rows with the plan of their source. A plan of a counted, bounded size is broadcast; beyond
    that a source's rows are dealt to SALTS keys, each with a copy of its plan."""
    if plan.count() <= SENT_SOURCES:
        return rows.join(F.broadcast(plan), name)
    salt = free_name(rows, "mix_salt")
    salted = rows.withColumn(salt, F.pmod(spread, F.lit(SALTS)).cast("int"))
    each = plan.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(each, [name, salt]).drop(salt)


def _laid(classes: DataFrame, planned: DataFrame, turn: Column, rows: int, seed: int) -> DataFrame:
    """Classes in the order of the passes `turn` lists, each with the tokens before it."""
    ordered = (
        _with_plan(classes, planned, "source", F.xxhash64("key", "size"))
        .withColumn("turn", F.explode(turn))
        .withColumn(
            "order",
            order_key(F.col("source"), key_text("key"), F.col("size"), F.col("turn"), seed),
        )
        .withColumn("weight", F.col("size") * F.col("n"))
        .withColumn("bucket", digest_bucket(F.col("order"), rows))
    )
    return before(
        ordered, ["source", "turn"], "bucket", ["order", "key", "size"], {"start": "weight"}
    )


def _in_quota() -> Column:
    """How many of a class's rows go out: all in whole passes, and in the last those that end
    within the quota."""
    whole = F.col("turn") < F.col("passes")
    fitting = F.expr("(rest - start) div size")
    return F.when(whole, F.col("n")).otherwise(F.greatest(F.lit(0), F.least(F.col("n"), fitting)))


def mix(documents: DataFrame, budget: int | None = None, max_repeats: float | None = None,
        evenness: float | None = None, block_tokens: int = BLOCK_TOKENS, seed: int = 0,
        key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """One row per document and pass of the mix, with its output block and slot there.

    A block holds about `block_tokens` tokens, so its rows are sorted in one task.
    """
    classes = _classes(documents, key, source, text)
    planned = quotas(classes, budget, max_repeats, evenness)
    turns = F.sequence(F.lit(0), F.col("passes").cast("int"))
    laid = _laid(classes, planned, turns, classes.count(), seed).withColumn("n", _in_quota()).where("n > 0")
    blocks = max(1, (planned.agg(F.sum("quota")).first()[0] or 0) // block_tokens)
    rows = copies(
        laid.select("source", "key", "size", "turn", "order", "start", "tokens", "quota", "n"),
        "n", "copy",
    )
    reached = F.col("turn") * F.col("tokens") + F.col("start") + F.col("copy") * F.col("size")
    place = reached.cast("double") / F.col("quota").cast("double") * F.lit(float(blocks))
    blocked = rows.withColumn("block", F.floor(place).cast("bigint"))
    inside = Window.partitionBy("block").orderBy("order", "key", "copy")
    return blocked.select(
        F.col("key").alias(key),
        F.col("source").alias(source),
        "size",
        F.col("turn").alias("pass"),
        F.col("copy").cast("bigint").alias("copy"),
        "block",
        (F.row_number().over(inside) - 1).alias("slot"),
    )


def mix_rows(documents: DataFrame, budget: int | None = None, max_repeats: float | None = None,
             evenness: float | None = None, seed: int = 0, key: str = "doc_id",
             source: str = "source", text: str = "text") -> DataFrame:
    """The documents of the same mix, with all their columns, each as often as it occurs.

    Texts are not shuffled: per source, the number of whole passes and the place in the order
    where the last pass is cut say how often a row goes out. Only where the cut goes through rows
    of one id and size are these dealt out by their digest, to tell those that still go out.
    """
    classes = _classes(documents, key, source, text)
    planned = quotas(classes, budget, max_repeats, evenness)
    last = F.array(F.col("passes").cast("int"))
    cuts = (
        _laid(classes, planned, last, classes.count(), seed)
        .withColumn("fit", _in_quota())
        .where("fit > 0")
        .groupBy("source")
        .agg(
            F.max(F.when(F.col("fit") == F.col("n"), F.col("order"))).alias("cut"),
            F.max(F.when(F.col("fit") < F.col("n"), F.col("order"))).alias("parted"),
            F.max(F.when(F.col("fit") < F.col("n"), F.col("fit"))).alias("fit"),
        )
    )
    mine, plan = free_name(documents, "mix_source"), free_name(documents, "mix_plan")
    told = planned.join(cuts, "source", "left").select(
        F.col("source").alias(mine), F.struct("passes", "cut", "parted", "fit").alias(plan)
    )
    told = keep_table(told, "cuts")
    named = documents.withColumn(mine, F.coalesce(F.col(source).cast("string"), F.lit("")))
    joined = _with_plan(named, told, mine, F.xxhash64(key_text(key), F.col(text)))
    passes, cut = F.col(plan)["passes"], F.col(plan)["cut"]
    order = order_key(F.col(mine), key_text(key), tokens(F.col(text)), passes.cast("int"), seed)
    times = passes.cast("int") + F.coalesce((order <= cut).cast("int"), F.lit(0))
    mixed = joined.withColumn(plan, F.explode(F.array_repeat(F.lit(0), times))).select(*documents.columns)
    if told.where(F.col(plan)["parted"].isNotNull()).isEmpty():
        return mixed
    parted = joined.where(order == F.col(plan)["parted"]).select(
        F.col(mine).alias("source"), F.col(plan)["fit"].alias("fit"), F.struct(*documents.columns).alias("row")
    )
    return mixed.unionByName(_first_of_parted(parted).select("row.*"))


def _first_of_parted(rows: DataFrame) -> DataFrame:
    """Of each source's rows, as many as `fit` says: the first by the digest of the whole row.
    Equal rows are counted before they are dealt out."""
    digest = F.md5(F.to_json(F.struct("row")))
    counted = rows.withColumn("digest", digest).groupBy("source", "digest").agg(
        F.first("fit").alias("fit"), F.first("row").alias("row"), F.count(F.lit(1)).alias("n")
    )
    counted = keep_table(counted, "parted")
    place = counted.select("source", "digest", "fit", "n")
    place = place.withColumn("bucket", digest_bucket(F.col("digest"), place.count()))
    placed = before(place, ["source"], "bucket", ["digest"], {"start": "n"})
    out = F.least(F.col("n"), F.col("fit") - F.col("start"))
    taken = placed.select("source", "digest", out.alias("times")).where("times > 0")
    found = counted.drop("fit", "n").join(taken, ["source", "digest"])
    return copies(found, "times", "copy", ["source", "digest"])
