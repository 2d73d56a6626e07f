from __future__ import annotations

import hashlib
import json
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tocsin.llm import alignment
from tocsin.llm.bpe import byte_letters
from tocsin.llm.catalog import QUERIES, alignment_files


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def aligner():
    files = alignment_files()
    read = {"pattern": files.byte_pattern, "json": open(files.byte_json, encoding="utf-8").read()}
    read["ranks"], read["pieces"] = (open(path, "rb").read() for path in (files.byte_ranks, files.pieces))
    return alignment.Aligner(read)


def brute(libraries, texts):
    """Every pair of tokens of every text compared by its byte ranges."""
    a, b = libraries
    letters = {letter: byte for byte, letter in enumerate(byte_letters())}
    docs, linked = [], defaultdict(set)
    for number, text in enumerate(texts):
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        spans = []
        for names, read in (
            ([a.id_to_token(i) for i in ids_a], lambda t: bytes(letters[c] for c in t)),
            ([b.id_to_piece(i) for i in ids_b], lambda t: bytes([int(t[3:5], 16)]) if len(t) == 6 and t[:3] == "<0x" else t.replace("▁", " ").encode()),
        ):
            parts, at = [read(name) for name in names], 0
            spans.append([])
            for part in parts:
                spans[-1].append((at, at + len(part)))
                at += len(part)
            if text and b"".join(parts) != (" " + text).encode():
                ids_a, ids_b = [], []
        if not ids_a:
            docs.append(None)
            continue
        links = []
        j = 0
        for i, (start, end) in enumerate(spans[0]):
            while spans[1][j][1] <= start:
                j += 1
            k = j
            while k < len(spans[1]) and spans[1][k][0] < end:
                links.append((ids_a[i], ids_b[k]))
                k += 1
        shared = sorted({end for _, end in spans[0]} & {end for _, end in spans[1]})
        groups, low = [], 0
        for end in shared:
            groups.append("|".join(
                ",".join(str(x) for x, (s, e) in zip(ids, span) if low <= s < end) for ids, span in zip((ids_a, ids_b), spans)
            ) if len(text) < 3_000 else "")
            low = end
        docs.append((len(ids_a), len(ids_b), links, groups))
        for pair in links:
            linked[pair].add(number)
    best = Counter()
    for (x, _), where in linked.items():
        best[x] = max(best[x], len(where))
    out = []
    for doc in docs:
        if doc is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, links, groups = doc
        out.append((
            n_a, n_b, len(groups), len(links), sum(len(linked[p]) == best[p[0]] for p in links),
            sum(len(linked[p]) for p in links), hashlib.sha256(";".join(groups).encode()).hexdigest(),
        ))
    return out


ORDER = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
PLAIN = "".join(map(chr, range(0x250)))
ODD = [
    None, "", " ", "  ", "\n", "a", "a", "same text here", "same text here", "the end <|endoftext|> of </s> <unk> text",
    "<0x41> \x00\x1c\x85", "▁a ▁ b", "é́ ﬁ ​﻿", "中文 한국어 \U0001f642\U0001f642", PLAIN, PLAIN[::-1],
    "don't  we'll\t\tI'm  3½²", "tion" * 200, "x  y   z    \n\n  w", " leading", "trailing ", "\r\n a\r\n",
]


def _random_texts():
    chance = random.Random(1)
    pool = [*map(chr, range(32, 0x250)), " ", " ", " ", "e", "n", "中", "\U0001f642", "▁", "the ", "ing "]
    return ["".join(chance.choice(pool) for _ in range(chance.randint(1, 60))) for _ in range(300)]


def test_quick_ids_are_the_library_s(aligner):
    for text in [t for t in ODD if t] + _random_texts():
        want = aligner.tokenizers.exact.encode(" " + text, add_special_tokens=False).ids
        assert aligner.tokenizers.encode_a(" " + text) == want
        if text.isascii() or max(text) < "ɐ":
            assert aligner.tokenizers.quick.encode_ordinary(" " + text) == want


@pytest.mark.parametrize("limit", [1 << 20, 40, 0])
def test_equals_brute_force(spark, libraries, limit, monkeypatch):
    """With all counts along, with some joined, with all joined; with and without a memory."""
    monkeypatch.setattr(alignment, "PAIRS_ALONG", limit)
    if limit == 40:
        monkeypatch.setattr(alignment, "MEMO_BYTES", 0)
    texts = ODD + _random_texts()
    rows = [(i if i % 7 else None, text, "n", 1, [2]) for i, text in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, place string, n_a int, links array<int>")
    got = alignment.align_documents(docs, alignment_files()).collect()
    assert sorted((repr(r.doc_id), *(r[c] for c in ORDER)) for r in got) == sorted(
        (repr(row[0]), *want) for row, want in zip(rows, brute(libraries, texts)))


def test_long_texts(aligner, libraries):
    chance = random.Random(3)
    texts = ["x" * 60_000, " " * 5_000, "".join(chance.choices("abcdefgh", k=30_000)), "word " * 20_000]
    made = aligner(texts)
    for i, want in enumerate(brute(libraries, texts)):
        assert tuple(made[name][i].as_py() for name in ORDER[:4]) == want[:4]


def test_windows_are_remembered(aligner):
    aligner.windows.forget()
    aligner(["the same words again"] * 3 + ["again the same"])
    known = len(aligner.windows.number)
    aligner(["same words the same"])
    assert known == len(aligner.windows.number) == 4


def test_registered_query(spark, libraries):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    short = {d.doc_id for d in docs if len(d.text or "") < 3_000}
    want = dict(zip((d.doc_id for d in docs), brute(libraries, [d.text for d in docs])))
    got = {r.doc_id: tuple(r[c] for c in ORDER) for r in QUERIES["op13_alignment"](spark, folder).collect()}
    assert got.keys() == want.keys() and len(docs) == len(got)
    for key, row in got.items():
        assert row[:6] == want[key][:6] and (key not in short or row == want[key])


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align_documents(docs, alignment_files()).collect() == []
    docs = spark.createDataFrame([(1, None)], "doc_id long, text string")
    assert [tuple(r[c] for c in ORDER) for r in alignment.align_documents(docs, alignment_files()).collect()] == [(0,) * 6 + ("",)]


def test_ids_of_all_tokens_fit(aligner):
    spec = json.loads(open(alignment_files().byte_json, encoding="utf-8").read())
    assert len(aligner.tokenizers.bytes_a) == len(spec["model"]["vocab"]) + len(spec["added_tokens"]) < 65_535
    assert len(aligner.tokenizers.bytes_b) <= 1 << alignment.B_BITS
