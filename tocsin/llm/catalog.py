"""The registered queries of this folder: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tocsin.llm import alignment, ann, bpe, chat, langid, lm, mixing, packing, quality, repair, sharding, simhash, topk
from tocsin.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return topk.exact_top_k(rows, F.col("vec_id") % 100 == 0, 10)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), max_repeats=mixing.MAX_REPEATS)


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), tokenizer_path())


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.groups(table(spark, sf_dir, "documents")).select(
        F.col("key").alias("doc_id"),
        simhash.hex_digits("fingerprint").alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op5_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scores(table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.languages(table(spark, sf_dir, "documents"))


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.perspectives(table(spark, sf_dir, "conversations"))


def op9_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.cut(table(spark, sf_dir, "documents"), tokenizer_path())
    return packing.pack(pieces)


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return repair.report(repair.damage(conversations), conversations)


def alignment_files() -> alignment.Files:
    import public_tokenizers

    json, ranks, pieces = map(public_tokenizers.path, ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"))
    return alignment.Files(json, ranks, public_tokenizers.PATTERN, pieces)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(table(spark, sf_dir, "documents"), alignment_files())


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        op1_topk, op2_mixing, op3_bpe, op4_simhash, op5_lm, op6_quality, op7_langid, op8_chat,
        op9_ann, op10_sharding, op11_packing, op12_repair,
        op13_alignment,
    )
}
