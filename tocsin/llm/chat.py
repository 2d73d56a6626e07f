"""Chat formatting: a dialogue rendered once from the point of view of each participant.

In a participant's rendering its own turns are the assistant's, and only they are learnt from;
all others are users under their names. System turns stay system turns and are nobody's view. A
rendering is the concatenation of its segments in order; each is a row with its place in the
whole, so a dialogue of any length is never put together in one task.

Turns come in the order of `turn`, speaker and text (null turns first). A null speaker is called
"unknown", a null text is empty. Rows without conversation id form one conversation, which is not that
of an empty id. Repeated rows are turns of their own; they are counted before they are dealt out, so
a conversation, a turn or a row may hold any part of the table. A text of any length is one
segment. A conversation with nothing but system turns has no rendering, an empty table gives no
rows, and other columns take no part, whatever their names. Markers inside texts and names are
broken up so that they cannot be taken for the format's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tocsin.llm.common import keep_table
from tocsin.llm.running import before, copies

SYSTEM = "system"
END = "<|end|>\n"

# Distinct turns that one window task sorts, as a power of two.
BUCKET_BITS = 11


def _plain(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def _name(speaker: Column) -> Column:
    return F.regexp_replace(speaker, r"[|<>\r\n]", "_")


def perspectives(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn",
                 speaker: str = "role", text: str = "text") -> DataFrame:
    """Segments of every rendering: conversation, view (the participant), position, turn, speaker,
    segment, and in characters of the rendering: start, learn_from, stop. A segment is learnt from
    between learn_from and stop; where they are equal, not at all."""
    told = turns.select(
        F.coalesce(F.concat(F.lit("k"), F.col(conversation).cast("string")), F.lit("null")).alias("conv_key"),
        F.col(conversation).alias(conversation),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(speaker), F.lit("unknown")).alias("speaker"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    same = ["conv_key", conversation, "turn", "speaker", "text"]
    counted = told.groupBy(*same).agg(F.count(F.lit(1)).alias("n"))
    # A number that rises in the order of a conversation; bounds are drawn from the texts' beginnings.
    dealt = counted.repartitionByRange("conv_key", "turn", "speaker", F.substring("text", 1, 64))
    dealt = dealt.sortWithinPartitions("conv_key", "turn", "speaker", "text")
    told = keep_table(dealt.withColumn("seq", F.monotonically_increasing_id()), "turns")
    views = (
        told.where(F.col("speaker") != SYSTEM)
        .select("conv_key", F.col("speaker").alias("view"))
        .distinct()
    )
    own = F.col("speaker") == F.col("view")
    head = (
        F.when(own, F.lit("<|assistant|>\n"))
        .when(F.col("speaker") == SYSTEM, F.lit("<|system|>\n"))
        .otherwise(F.concat(F.lit("<|user "), _name(F.col("speaker")), F.lit("|>\n")))
    )
    rendered = (
        told.join(views, "conv_key")
        .withColumn("head", F.length(head))
        .withColumn("segment", F.concat(head, _plain(F.col("text")), F.lit(END)))
        .withColumn("long", F.length("segment").cast("bigint"))
        .withColumn("all_long", F.col("long") * F.col("n"))
        .withColumn("bucket", F.shiftright("seq", BUCKET_BITS))
    )
    first = before(rendered, ["conv_key", "view"], "bucket", ["seq"], {"start": "all_long", "position": "n"})
    placed = copies(first, "n", "copy", ["view", "seq"])
    placed = placed.withColumns({
        "start": F.col("start") + F.col("copy") * F.col("long"), "position": F.col("position") + F.col("copy"),
    })
    stop = F.col("start") + F.col("long")
    return placed.select(
        conversation,
        "view",
        F.col("position").cast("bigint").alias("position"),
        "turn",
        "speaker",
        "segment",
        F.col("start").cast("bigint").alias("start"),
        F.when(own, F.col("start") + F.col("head")).otherwise(stop).cast("bigint").alias("learn_from"),
        stop.cast("bigint").alias("stop"),
    )
