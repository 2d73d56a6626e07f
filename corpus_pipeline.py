"""From raw documents to token ids: quality, language, near-duplicates, mix, ids.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as
the next one's documents. All but the last return the columns of the documents, whatever else these
hold and however it is named.

A null text counts as empty. The quality stage scores it like others, the language stage drops it,
as it has no letters. Texts of any length are taken whole. Repeated rows fall or stay alike up to the
near-duplicate stage, which keeps one row of each group, null ids included; ties go to the smaller
id and then to the digest of the text. Labels of which half are good count as good. An empty table
passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tocsin.llm import bpe, langid, mixing, quality, simhash
from tocsin.llm.catalog import tokenizer_path
from tocsin.llm.common import keep_table, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the classifier takes for bad."""
    return quality.good_only(docs, table(spark, sf_dir, "labels"))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what has no letters, or whose words fit a background of letters better than all known
    languages together."""
    return langid.known_only(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group."""
    return simhash.one_of_each(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and cuts sources to their weights."""
    return mixing.mix_rows(docs, max_repeats=mixing.MAX_REPEATS)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document."""
    encoded = bpe.encode(docs.select("doc_id", "source", "lang", "text"), tokenizer_path())
    return encoded.selectExpr("doc_id", "source", "lang", "cast(size(ids) as bigint) AS n_tokens", "ids")


STAGES = [
    ("quality", quality_stage),
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("mixing", mixing_stage),
    ("encoding", encoding_stage),
]

# The classifiers cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep_table(stage(spark, docs, sf_dir), name)
    return docs
