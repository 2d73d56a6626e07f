"""The registered queries against SQL where there is any, and the shape of all."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from tocsin.llm.catalog import QUERIES
from tocsin.llm.oracle import ORACLE

SMALL = "/root/testdata/sf0.001"

CONTRACT = {
    "op1_topk": "query_id bigint, rank int, vec_id bigint, score bigint",
    "op3_bpe": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op4_simhash": "doc_id bigint, fingerprint string, component_id bigint",
    "op5_lm": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint,"
    " base_score double, score double",
    "op6_quality": "doc_id bigint, held_out boolean, score double, predicted int",
    "op7_langid": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op9_ann": "query_id bigint, rank int, vec_id bigint, score double",
    "op10_sharding": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint,"
    " grown_shard int",
    "op11_packing": "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint,"
    " offset bigint",
    "op12_repair": "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint,"
    " cost bigint, audit string, repaired_sha256 string",
    "op13_alignment": "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint,"
    " count_sum bigint, groups_sha256 string",
}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, name):
    database = duckdb.connect()
    for file in Path(SMALL).glob("*.parquet"):
        database.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    want = database.sql(ORACLE[name])
    got = QUERIES[name](spark, SMALL).select(*want.columns).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want.fetchall(), key=repr)
    assert got


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_columns(spark, name):
    frame = QUERIES[name](spark, SMALL)
    kinds = {field.name: field.dataType.simpleString() for field in frame.schema}
    for wanted in CONTRACT[name].split(","):
        column, kind = wanted.split()
        assert kinds[column] == kind


def test_all_operators_are_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
