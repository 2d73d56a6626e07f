from __future__ import annotations

import random
import sys

import numpy as np
import pytest
from tokenizers import Tokenizer

from tocsin.llm import bpe
from tocsin.llm.catalog import tokenizer_path


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path())


@pytest.fixture(scope="module")
def parts():
    with open(tokenizer_path(), encoding="utf-8") as file:
        text = file.read()
    return bpe.Codec(text), bpe.Names(text)


PLAIN = "".join(map(chr, range(0x250)))
ODD = [
    None, "", " \n", PLAIN, PLAIN.upper(), "a<|endoftext|>B<|startoftext|><|endoftext|> <|x <|", "éç" * 500,
    "x" * 2_000, "don't we'LL I'M 's", "<|ENDOFTEXT|>", "İstanbul ΣΑΣ a b c​d",
    "ẛ̣ Å ﬁ é", "\U0001f642\U0001f642 中文", "\x00\x1c\x1d\x85", "12 3½² ٠",
]


def _random_texts():
    chance = random.Random(1)
    pool = [*range(0x250), 0x301, 0x3A3, 0x2028, 0x200B, 0x4E2D, 0x1F642, 0xFB01, 0x212B, 0x323, 0x660, 0xAC00]
    return ["".join(chr(chance.choice(pool)) for _ in range(40)) for _ in range(500)]


def test_equals_the_library(library, parts):
    codec, names = parts
    texts = ODD + _random_texts()
    ids, ends = codec.encode(texts)
    decoded = names.decode(ids, ends)
    for i, text in enumerate(texts):
        want = library.encode(text or "", add_special_tokens=False).ids
        assert ids[ends[i] : ends[i + 1]].tolist() == want, text
        assert decoded[i] == library.decode(want, skip_special_tokens=False)


def test_no_token_spans_a_cut(parts):
    codec, _ = parts
    (cuts,) = codec.cuts(["éçèê".encode()])
    assert cuts
    number = {letter: byte for byte, letter in enumerate(codec.letters)}
    import json

    with open(tokenizer_path(), encoding="utf-8") as file:
        vocab = json.load(file)["model"]["vocab"]
    spelled = "éçèê".encode()
    for cut in cuts:
        pair = spelled[cut - 1 : cut + 1]
        for token in vocab:
            raw = bytes(number[c] for c in token.removesuffix("</w>") if c in number)
            assert pair not in raw


def test_a_full_cache_changes_nothing(parts, monkeypatch):
    codec, _ = parts
    want = codec.encode(ODD)
    monkeypatch.setattr(bpe, "CACHE_BYTES", 3)
    for _ in range(3):
        got = codec.encode(ODD)
        assert np.array_equal(got[0], want[0]) and np.array_equal(got[1], want[1])


def test_frequent_words_outlast_a_full_cache(library, monkeypatch):
    """Words that come up again are not encoded anew because many others came in between."""
    monkeypatch.setattr(bpe, "CACHE_BYTES", 100_000)
    with open(tokenizer_path(), encoding="utf-8") as file:
        codec = bpe.Codec(file.read())
    learnt, learn = [], codec._learn
    monkeypatch.setattr(codec, "_learn", lambda words: (learnt.extend(words), learn(words)))
    chance = random.Random(3)
    often = ["ofthe", "éçèê", "<|endoftext|>", "12", "!!"]
    for _ in range(30):
        rare = ["".join(chance.choices("abcdefé", k=9)) for _ in range(400)]
        texts = [" ".join([*often, word, *often]) for word in rare]
        ids, ends = codec.encode(texts)
        assert codec.held < 100_000 + 400 * 300
        for i in chance.sample(range(400), 20):
            want = library.encode(texts[i], add_special_tokens=False).ids
            assert ids[ends[i] : ends[i + 1]].tolist() == want
    assert len(learnt) > 10_000
    assert [learnt.count(word) for word in ("ofthe", "éçèê", "<|endoftext|>")] == [1, 1, 1]


def test_new_words_of_known_fragments_take_no_call_each(library):
    """The fragments of all new words of a batch are looked up together."""
    with open(tokenizer_path(), encoding="utf-8") as file:
        codec = bpe.Codec(file.read())
    chance = random.Random(5)
    words = ["".join(chance.choices("éçèê", k=12)) for _ in range(3_000)]
    codec.encode(words[:1_000])
    calls = []
    sys.setprofile(lambda frame, event, arg: calls.append(frame.f_code.co_name) if event == "call" else None)
    try:
        ids, ends = codec.encode([*words[1_000:], "<|endoftext|>"])
    finally:
        sys.setprofile(None)
    # A call for each text, one for each new word to give it its number, and few besides.
    assert calls.count("__missing__") > 1_900
    assert len(calls) - 3 * 2_001 < 200
    for i, word in enumerate([*words[1_000:], "<|endoftext|>"]):
        assert ids[ends[i] : ends[i + 1]].tolist() == library.encode(word, add_special_tokens=False).ids


def test_long_words_do_not_pile_up(library):
    """What is remembered is bounded by bytes, not by words, also where words are cut."""
    with open(tokenizer_path(), encoding="utf-8") as file:
        codec = bpe.Codec(file.read())
    chance = random.Random(2)
    for _ in range(40):
        batch = ["".join(chance.choices("abcdefé", k=20_000)) for _ in range(60)]
        codec.encode(batch)
        assert codec.held < bpe.CACHE_BYTES + 60 * (20_000 * 50)
        assert len(codec.place) * 20_000 + 4 * len(codec.flat) + len(codec.known) <= codec.held
    ids, ends = codec.encode(batch[:2])
    for i in range(2):
        assert ids[ends[i] : ends[i + 1]].tolist() == library.encode(batch[i], add_special_tokens=False).ids


def test_whole_tables(spark, library):
    rows = [(i, text, "clash", [i]) for i, text in enumerate(ODD)] + [(None, "hello", "x", None), (0, None, "y", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, decoded string, ids array<int>")
    out = bpe.decode(bpe.encode(docs, tokenizer_path()), tokenizer_path()).collect()
    assert len(out) == len(rows)
    for row in out:
        want = library.encode(row.text or "", add_special_tokens=False).ids
        assert row.ids == want and row.decoded == library.decode(want, skip_special_tokens=False)
    none = spark.createDataFrame([(None,)], "ids array<int>")
    assert bpe.decode(none, tokenizer_path()).first().decoded == ""
    assert bpe.digests(docs.limit(0), tokenizer_path()).collect() == []
