"""The stages one after another, each against a plain version of what it does."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tocsin.llm import langid, mixing, quality, simhash
from tocsin.llm.catalog import tokenizer_path
from tocsin.llm.common import keep_table, table

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def passed(spark):
    docs, found = table(spark, SMALL, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        after = keep_table(stage(spark, docs, SMALL), name)
        found.append((docs, after))
        docs = after
    return found


def _ids(frame):
    return Counter(row.doc_id for row in frame.select("doc_id").collect())


def test_stages(passed):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "language", "near_duplicates", "mixing", "encoding"]
    for before, after in passed[:-1]:
        assert after.columns == before.columns


def test_quality_stage(spark, passed):
    before, after = passed[0]
    scores = quality.scores(before, table(spark, SMALL, "labels")).collect()
    assert _ids(after) == Counter(row.doc_id for row in scores if row.predicted == 1)
    assert 0 < after.count() < before.count()


def test_language_stage(spark, passed):
    """What the stage keeps, worked out text by text: shares by plain expectation-maximisation over
    all known languages and the background, without taking any out."""
    before, after = passed[1]
    model = langid.train(before, langid.learnable())
    kept = Counter()
    unsure = set()
    for row in before.collect():
        found = langid.words([row.text])
        if row.text is None or not len(found.starts):
            continue
        logs = np.column_stack([model.strict[found.bins], sum(model.single[i][b] for i, b in enumerate(found.triples))])
        likely = np.add.reduceat(logs.astype(np.float64), found.starts, axis=0)
        likely = np.exp(likely - likely.max(axis=1, keepdims=True))
        shares = np.full(likely.shape[1], 1 / likely.shape[1])
        for _ in range(50):
            joint = likely * shares
            shares = (joint / joint.sum(axis=1, keepdims=True)).mean(axis=0)
        if abs(shares[:-1].sum() - langid.LEAST_SHARE) < 0.15:
            unsure.add(row.doc_id)
        elif shares[:-1].sum() >= langid.LEAST_SHARE:
            kept[row.doc_id] += 1
    got = _ids(after)
    assert {i: n for i, n in got.items() if i not in unsure} == kept
    assert len(unsure) <= 0.02 * before.count() and 0 < after.count()


def test_near_duplicate_stage(passed):
    before, after = passed[2]
    assert _ids(after) == Counter({r.component for r in simhash.groups(before).collect()})


def test_mixing_stage(passed):
    before, after = passed[3]
    mixed = mixing.mix(before, max_repeats=mixing.MAX_REPEATS).collect()
    assert _ids(after) == Counter(row.doc_id for row in mixed)


def test_encoding_stage(passed):
    before, after = passed[4]
    library = Tokenizer.from_file(tokenizer_path())
    texts = {row.doc_id: row.text for row in before.collect()}
    rows = after.collect()
    assert len(rows) == before.count()
    for row in rows:
        assert row.ids == library.encode(texts[row.doc_id], add_special_tokens=False).ids
        assert row.n_tokens == len(row.ids)


def test_run(spark, passed):
    assert _ids(corpus_pipeline.run(spark, SMALL)) == _ids(passed[-1][1])


def test_stages_take_odd_tables(spark):
    """Nulls in every column, repeated rows, clashing names, and no rows at all."""
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, ids string, quality_score int"
    plain = "Erinst resh the of and that was in the for with are this."
    rows = [
        (1, plain, "en", "a", 1, "x", 1), (1, plain, "en", "a", 1, "x", 1), (None, None, None, None, None, None, None),
        (2, "", "en", None, 0, "y", 2), (None, plain + " more", None, "b", 3, "z", 3), (3, "le " * 60_000, "fr", "b", 9, "x", 1),
    ]
    for given in (rows, []):
        docs = spark.createDataFrame(given, schema)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            after = stage(spark, docs, SMALL)
            assert after.columns == docs.columns
            assert after.count() <= max(1, 2 * len(given))
        _, last = corpus_pipeline.STAGES[-1]
        assert last(spark, docs, SMALL).count() == len(given)
