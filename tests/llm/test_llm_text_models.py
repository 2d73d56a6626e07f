"""Language model, quality classifier and language identification."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tocsin.llm import langid, lm, quality
from tocsin.llm.common import table

SMALL = "/root/testdata/sf0.01"

DOCS = "doc_id bigint, text string, lang string, source string, score double, statistics string"


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, g, "s", 0.5, "clash") for i, t, g in rows], DOCS)


def _rest(key, divisor):
    return zlib.crc32(("" if key is None else str(key)).encode()) % divisor


# --- language model -------------------------------------------------------------------------


def _words(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", text), lm.END]


def _base(rows):
    counts = Counter(w for i, t, _ in rows if _rest(i, 10) for w in _words(t))
    total, distinct = sum(counts.values()), len(counts)
    norm = math.log10(total + 0.1 * (distinct + 1))
    out = []
    for i, t, _ in rows:
        words = _words(t)
        score = sum(math.log10(counts[w] + 0.1) - norm for w in words)
        out.append((i, _rest(i, 10) == 0, len(words), sum(counts[w] > 0 for w in words), total, round(score, 6)))
    return sorted(out, key=repr)


ODD = [
    (1, None, "en"), (2, "", None), (3, "A b\x0bC  É", "en"), (3, "A b\x0bC  É", "en"), (None, "nameless", "fr"),
    (70, "never seen words here", "en"), (71, "x" * 5_000, "en"), (72, "the " * 20_000, "en"),
]


@pytest.fixture(scope="module")
def scored(spark):
    return lm.scores(table(spark, SMALL, "documents")).toPandas()


def test_base_scores(spark):
    rows = ODD + [(100 + i, f"word{i % 7} common tail{i}", "en") for i in range(60)]
    got = lm.scores(_docs(spark, rows)).collect()
    values = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got]
    assert sorted(values, key=repr) == _base(rows)


def test_words_beyond_the_frequent_are_joined(spark, monkeypatch):
    monkeypatch.setattr(lm, "FREQUENT", 5)
    monkeypatch.setattr(lm.most_frequent, "__defaults__", (5,))
    rows = [(i, f"word{i % 9} the the of rare{i}", "en") for i in range(80)]
    got = lm.scores(_docs(spark, rows)).collect()
    values = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got]
    assert sorted(values, key=repr) == _base(rows)


def test_scores_are_those_of_plain_sums(spark, monkeypatch):
    """Pairs of neighbours, class sizes and the score of each text, worked out word by word from
    the trained vectors."""
    monkeypatch.setattr(lm.most_frequent, "__defaults__", (30,))
    chance = random.Random(6)
    common = [f"w{i}" for i in range(40)]
    rows = ODD + [
        (200 + i, " ".join(chance.choices(common, k=chance.randint(0, 30)) + [f"rare{chance.randrange(60)}."]), "en")
        for i in range(80)
    ]
    caught = {}
    train = lm.train

    def caught_train(pairs, classes):
        caught["pairs"] = {divmod(row.pair, classes.total): row.n for row in pairs.collect()}
        caught["classes"] = classes
        caught["vectors"], totals = train(pairs, classes)
        return caught["vectors"], totals

    monkeypatch.setattr(lm, "train", caught_train)
    got = sorted((repr(r.doc_id), r.n_tokens, round(r.score, 3)) for r in lm.scores(_docs(spark, rows)).collect())

    learnt = [t for i, t, _ in rows if _rest(i, 10)]
    counts = Counter(w for t in learnt for w in _words(t))
    ranked = sorted(counts, key=lambda w: (-counts[w], w.encode()))[:30]

    own, total = caught["classes"]

    def class_of(word):
        if word in ranked[:own]:
            return ranked.index(word)
        ending = word.encode().rstrip(b".,;:!?")[-3:]
        return own + zlib.crc32(ending) % (total - own)

    pairs = Counter()
    for text in learnt:
        line = [lm.END, *_words(text)]
        pairs.update((class_of(a), class_of(b)) for a, b in zip(line, line[1:]))
    assert caught["pairs"] == pairs

    sizes = Counter()
    for word, n in counts.items():
        sizes[class_of(word)] += n + 0.1
    before, after, bias = (np.array(v, dtype=float) for v in caught["vectors"])
    want = []
    for i, text, _ in rows:
        score, last = 0.0, class_of(lm.END)
        words = _words(text)
        for word in words:
            logits = after @ before[last] + bias
            last = class_of(word)
            size = sizes[last] + (0.1 if last >= own else 0)
            share = (counts[word] + 0.1) / max(size, 0.1)
            score += math.log10(math.exp(logits[last] - logits.max()) / np.exp(logits - logits.max()).sum() * share)
        want.append((repr(i), len(words), score))
    for (i, n, value), (j, m, other) in zip(got, sorted(want)):
        assert (i, n) == (j, m) and abs(value - other) <= 1e-3 + 1e-4 * abs(other)


def test_words_that_share_a_hash_are_told_apart(spark):
    rows = [(1, "first", 3), (1, "second", 9), (2, "third", 5), (3, "fourth", 4)]
    counts = spark.createDataFrame(rows, "hash long, word string, n long")
    assert list(lm.most_frequent(counts, 1).place) == [b"second", b"first"]
    assert list(lm.most_frequent(counts, 3).place) == [b"second", b"third", b"fourth", b"first"]


def test_the_most_frequent_words(spark):
    """In order of frequency, then of letters, with ties at the last place."""
    chance = random.Random(2)
    rows = [(i, f"w{chance.randrange(10**6)}x{i}", int(2 ** (chance.random() * 12))) for i in range(500)]
    counts = spark.createDataFrame(rows, "hash long, word string, n long")
    ranked = [w.encode() for _, w, _ in sorted(rows, key=lambda row: (-row[2], row[1].encode()))]
    for most in (1, 7, 100, 499, 500, 600):
        assert list(lm.most_frequent(counts, most).place) == ranked[:most]
    assert not lm.most_frequent(counts.limit(0)).place


def test_what_a_worker_remembers_is_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(lm, "CACHE_BYTES", 100_000)
    lexicon = lm.Lexicon(lm.Frequent({b"the": 0}, np.array([5])), lm.classes_for(5))
    for i in range(30):
        lexicon.sequences([f"{i:05d}" + "x" * 20_000 + " the"] * 2)
        assert sum(map(len, lexicon.number)) <= lexicon.held <= 100_000 + 21_000


def test_model_beats_the_base_on_held_out_texts(scored):
    held = scored[scored.held_out]
    assert held.score.sum() > held.base_score.sum()
    assert (held.score > held.base_score).mean() > 0.8
    assert (scored.score < 0).all() and np.isfinite(scored.score).all()


def test_probabilities_are_normalised(spark):
    """Over classes after any class, and over the words of a class with one unseen."""
    random_ = np.random.default_rng(1)
    shape = (2048, lm.DIMENSIONS)
    vectors = lm.Vectors(random_.normal(size=shape), random_.normal(size=shape), random_.normal(size=2048))
    found = lm.norms(spark, vectors)
    assert np.allclose(np.exp(vectors.logits(slice(None)) - found[:, None]).sum(axis=1), 1, atol=1e-3)
    rows = [(100 + i, " ".join(f"w{j}" for j in range(i)), "en") for i in range(1700, 1704)]
    counts = lm.word_counts(_docs(spark, rows).select("text"))
    frequent, classes = lm.most_frequent(counts), lm.Classes(1536, 2048)
    told = spark.sparkContext.broadcast((tuple(frequent), tuple(classes)))
    sizes = lm.class_sizes(counts, told, frequent, classes)
    mass = np.zeros(classes.total)
    for row in counts.collect():
        own = frequent.class_of(row.word.encode(), classes)
        mass[own] += (row.n + lm.SMOOTHING) / 10 ** sizes[own]
    own = np.arange(classes.total) >= classes.own
    mass[own] += lm.SMOOTHING / 10 ** sizes[own]
    used = mass > 0
    assert np.allclose(mass[used], 1)


@pytest.mark.parametrize("at_once", [2, 256])
def test_contrast_steps_learn_what_follows(monkeypatch, at_once):
    """Two kinds of context with different followers, all contexts at once or some at a time."""
    monkeypatch.setattr(lm, "STEP_CONTEXTS", at_once)
    pairs = np.zeros((4, 2048), dtype=np.float32)
    pairs[:2, 10], pairs[2:, 20] = 500, 500
    noise = (pairs.sum(axis=0) + 1) / (pairs.sum(axis=0) + 1).sum()
    found = lm.contrast_steps(lm._start(noise), np.arange(4), pairs, noise.astype(np.float32), 60)
    logs = found.logits(slice(None)) / math.log(10)
    assert (logs[:2, 10] > logs[:2, 20] + 0.5).all() and (logs[2:4, 20] > logs[2:4, 10] + 0.5).all()


def test_classes_grow_with_the_corpus():
    sizes = [lm.classes_for(10**k).total for k in range(0, 16)]
    assert sizes == sorted(sizes) and sizes[0] == lm.CLASS_STEP and sizes[-1] == lm.MOST_CLASSES
    for tokens in (10**7, 10**8, 10**9):
        assert 0.8 < lm.classes_for(tokens).total ** 2 / (tokens / 4) < 1.25
        assert lm.classes_for(tokens).own < lm.FREQUENT
    assert lm.classes_for(10**15).own < lm.FREQUENT


def test_pairs_passed_on_early_and_many_blocks(spark, monkeypatch):
    """The same counts when a task may hold few pairs; vectors of all classes from many blocks."""
    rows = [(i, " ".join(f"w{(i * j) % 97}" for j in range(50)), "en") for i in range(300)]
    texts = _docs(spark, rows).select("text")
    counts = lm.word_counts(texts)
    told = spark.sparkContext.broadcast((tuple(lm.most_frequent(counts)), tuple(lm.classes_for(0))))
    monkeypatch.setattr(lm, "BLOCK_CONTEXTS", 10)
    monkeypatch.setattr(lm, "ROUNDS", 2)

    def counted():
        # The functions' own module is what travels to the workers.
        pairs = texts.mapInArrow(lm._pair_counts(told), "pair bigint, n bigint")
        return pairs.groupBy("pair").agg(F.sum("n").alias("n"))

    whole = {row.pair: row.n for row in counted().collect()}
    monkeypatch.setattr(lm, "HELD_PAIRS", 50)
    pairs = counted()
    assert {row.pair: row.n for row in pairs.collect()} == whole
    vectors, totals = lm.train(pairs, lm.classes_for(0))
    assert totals.sum() == sum(len(_words(t)) for _, t, _ in rows) == sum(whole.values())
    start = lm._start((totals + 1) / (totals + 1).sum())
    moved = (vectors.before != start.before).any(axis=1)
    assert {pair // lm.CLASS_STEP for pair in whole} == set(np.flatnonzero(moved).tolist())
    assert np.isfinite(vectors.after).all() and (vectors.after != start.after).any(axis=1).all()


def test_nothing_to_learn_from(spark):
    assert lm.scores(_docs(spark, ODD).limit(0)).collect() == []
    held = [i for i in range(200) if _rest(i, 10) == 0][:3]
    got = lm.scores(_docs(spark, [(i, "a b", "en") for i in held])).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.base_score == 3 * math.log10(0.1 / 0.1) for r in got)


# --- quality --------------------------------------------------------------------------------


def test_quality_on_held_out_labels(spark):
    got = quality.scores(table(spark, SMALL, "documents"), table(spark, SMALL, "labels")).toPandas()
    labels = table(spark, SMALL, "labels").toPandas().merge(got, on="doc_id")
    held = labels[labels.held_out]
    assert len(got) == 1000 and got.score.between(0, 1).all()
    assert (held.predicted == held.quality).mean() > 0.95
    assert (got.held_out == [_rest(i, 3) == 1 for i in got.doc_id]).all()


def _labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def test_quality_edges(spark):
    good = "Plain words in a plain sentence, one after another and so on."
    rows = [(i, good if i % 2 else "BUY!!! $$$ ||| ### BUY!!! BUY!!!", "en") for i in range(300)]
    rows += [(900, None, None), (901, "", "en"), (None, good, "en"), (902, "word " * 30_000, "en"), (1, rows[1][1], "en")]
    marks = [(i, i % 2, 0) for i in range(300)] + [(None, 1, 0), (5, None, 0), (7, 1, 0), (7, 1, 1)]
    docs = _docs(spark, rows)
    got = quality.scores(docs, _labels(spark, marks)).collect()
    assert len(got) == len(rows)
    for row in got:
        if row.doc_id is not None and row.doc_id < 300:
            assert row.predicted == row.doc_id % 2
        assert 0 <= row.score <= 1 and row.predicted == (row.score >= 0.5)
    kept = quality.good_only(docs, _labels(spark, marks))
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} >= {i for i in range(300) if i % 2}
    for marks, want in (([], 0.5), ([(i, 1, 0) for i in range(50)], 1.0), ([(i, 0, 0) for i in range(50)], 0.0)):
        assert {r.score for r in quality.scores(docs, _labels(spark, marks)).collect()} == {want}
    assert quality.scores(docs.limit(0), _labels(spark, [(1, 1, 0)])).collect() == []


def test_isotonic_regression():
    chance = random.Random(1)
    for _ in range(200):
        n = chance.randint(1, 9)
        x = np.array([chance.random() for _ in range(n)])
        y = np.array([float(chance.randint(0, 1)) for _ in range(n)])
        steps, levels = quality.isotonic(x, y)
        order = np.argsort(x)
        # The largest over starts of the least over ends of a mean, for each place.
        want = [
            max(min(y[order][a : b + 1].mean() for b in range(i, n)) for a in range(i + 1)) for i in range(n)
        ]
        assert np.allclose(np.repeat(levels, [sum(np.isclose(want, level)) for level in levels]), want)
        assert (np.diff(steps) > 0).all() or len(steps) == 1


def test_summed_parts_equal_the_whole(spark):
    """Normal equations do not depend on how rows are dealt to tasks."""
    chance = np.random.default_rng(1)
    rows = [(chance.normal(size=quality.WIDTH).tolist(), float(i % 2)) for i in range(50)]
    frame = spark.createDataFrame(rows, "statistics array<double>, good double").repartition(4)
    model = quality.Model(
        np.zeros(quality.WIDTH), np.ones(quality.WIDTH), chance.normal(size=(quality.WIDTH, quality.FEATURES)),
        np.zeros(quality.FEATURES), None, None, None,
    )
    parts = frame.mapInArrow(quality._normal_equations(model), "i int, sums array<double>")
    sums = parts.groupBy("i").applyInArrow(quality._added, "i int, sums array<double>").collect()
    features = model.features(np.array([r[0] for r in rows]))
    whole = features.T @ np.hstack([features, np.array([[r[1]] for r in rows])])
    assert np.allclose(np.array([r.sums for r in sorted(sums, key=lambda r: r.i)]), whole)


# --- language -------------------------------------------------------------------------------

SPOKEN = {
    "xx": "karo moti sulan peko rimat dobel kasun temir",
    "yy": "zhwe qyfth bryxk vwotz jhyq kfzwe thqyx wrzpk",
}


def _spoken(lang, n, seed):
    chance = random.Random(seed)
    return " ".join(chance.choice(SPOKEN[lang].split()) for _ in range(n))


def _talk():
    return [(i, _spoken("xx" if i % 2 else "yy", 30, i), "xx" if i % 2 else "yy") for i in range(200)]


def test_languages_on_held_out_texts(spark):
    got = langid.languages(table(spark, SMALL, "documents")).toPandas()
    truth = table(spark, SMALL, "documents").select("doc_id", "lang").toPandas().merge(got, on="doc_id")
    held = truth[truth.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.98
    assert got.score.between(0, 1).all()


def test_mixtures_and_edges(spark):
    both = _spoken("xx", 60, 1) + " " + _spoken("yy", 30, 2)
    rows = _talk() + [
        (900, both, None), (901, None, "xx"), (902, "", None), (903, "123 !? \U0001f642", None), (904, "KARO Moti!", None),
        (None, _spoken("yy", 9, 3), None), (905, _spoken("xx", 30_000, 4), None), (3, rows_text(3), "xx"),
    ]
    docs = _docs(spark, rows)
    got = {}
    for row in langid.languages(docs).collect():
        got.setdefault(row.doc_id, []).append(row)
    assert sum(map(len, got.values())) == len(rows)
    (mixed,) = got[900]
    assert mixed.lang_pred == "xx" and mixed.shares.keys() == {"xx", "yy"} and abs(mixed.score - 2 / 3) < 0.05
    for unknown in (901, 902, 903):
        assert (got[unknown][0].lang_pred, got[unknown][0].score) == ("und", 0.0)
    assert got[904][0].lang_pred == "xx" and got[905][0].lang_pred == "xx" and got[None][0].lang_pred == "yy"
    for i in range(200):
        assert {r.lang_pred for r in got[i]} == {"xx" if i % 2 else "yy"}
        assert got[i][0].shares.keys() == {got[i][0].lang_pred} and got[i][0].score == 1.0
    kept = langid.known_only(docs)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert not ids & {901, 902, 903} and set(range(200)) | {900, 904} <= ids


def test_letters_of_no_known_language_are_dropped(spark):
    """Random consonants are no words of any; most of a text in known ones is enough to stay."""
    chance = random.Random(4)
    junk = [" ".join("".join(chance.choices("bcdfghjklmnpqrstvwxz", k=chance.randint(3, 9))) for _ in range(40)) for _ in range(50)]
    clean = table(spark, SMALL, "documents").where("lang IS NOT NULL").select("doc_id", "text", "lang").limit(150)
    rows = [(row.doc_id, row.text, row.lang) for row in clean.collect()]
    rows += [(10_000 + i, text, None) for i, text in enumerate(junk)] + [(20_000, rows[0][1] + " " + junk[0], None)]
    learnt = [(100_000 + i, row[1], row[2]) for i, row in enumerate(rows[:150])]
    kept = {row.doc_id for row in langid.known_only(_docs(spark, rows + learnt)).collect()}
    assert not kept & set(range(10_000, 10_050))
    assert {row[0] for row in rows[:150] if len(row[1].split()) > 5} <= kept


def test_the_set_of_languages_is_nearly_the_best_of_all_subsets():
    """Penalised likelihood of the chosen set against that of every other set."""
    from itertools import combinations

    chance = np.random.default_rng(5)
    good = 0
    for _ in range(60):
        n = int(chance.integers(3, 40))
        true = chance.dirichlet(np.full(4, 0.4))
        spoken = chance.choice(4, size=n, p=true)
        likely = np.exp(chance.normal(-2, 1, (n, 4)) + 3.0 * (np.arange(4) == spoken[:, None]))
        chosen = langid._mixtures(likely, np.array([0]), np.array([n]))[0] > 0
        penalty = 0.5 * np.log(n + 1) + 1
        values = {}
        for size in range(1, 5):
            for some in combinations(range(4), size):
                even = np.zeros((1, 4))
                even[0, list(some)] = 1 / size
                values[some] = langid._improve(likely, np.array([0]), np.array([n]), even, 200)[1][0] - size * penalty
        good += values[tuple(np.flatnonzero(chosen))] >= max(values.values()) - 0.5
    assert good >= 55


def test_a_dirty_language_column(spark, monkeypatch):
    """Of many values those of most rows are learnt."""
    monkeypatch.setattr(langid, "MOST_LANGUAGES", 2)
    rows = _talk() + [(1000 + i, _spoken("xx", 20, i), f"junk {i}") for i in range(50)]
    got = langid.languages(_docs(spark, rows)).collect()
    assert {r.lang_pred for r in got} == {"xx", "yy"} and len(got) == len(rows)


def rows_text(i):
    return _talk()[i][1]


def test_no_language_to_learn(spark):
    got = langid.languages(_docs(spark, [(1, "some words", None), (2, None, "xx")])).collect()
    assert {(r.lang_pred, r.score) for r in got} == {("und", 0.0)}
    assert langid.languages(_docs(spark, []).limit(0)).collect() == []


def test_shares_are_those_of_plain_expectation_maximisation():
    likely = np.random.default_rng(1).random((40, 3)) + 0.01
    shares, logs = langid._improve(likely, np.array([0]), np.array([40]), np.full((1, 3), 1 / 3), 6)
    want = np.full(3, 1 / 3)
    for _ in range(6):
        joint = likely * want
        want = (joint / joint.sum(axis=1, keepdims=True)).mean(axis=0)
    assert np.allclose(shares[0], want) and np.isclose(logs[0], np.log(likely @ want).sum())
