"""Alignment of two tokenizers over the same text.

Both encode each whole text. Where the bytes of both equal a space and the text, tokens can be laid
over one another: offsets where both end cut the text into groups, and two tokens are linked if
their bytes overlap. Shared ends with a token that starts with a space behind them, on either side,
are anchors. They split a document into windows, mostly words, which come back again and again;
what a window of token ids gives is remembered by its ids, so it is worked out once per worker.

How many documents hold a pair of ids linked is counted over all documents. The most frequent
pairs, PAIRS_ALONG at most, travel with the second pass; whatever is not among them is joined.

Null and empty texts, and texts whose bytes either tokenizer changes, have no tokens: zeros and an
empty text. Special tokens inside a text are plain text. Each row is a document, so repeated rows and
ids, null ids too, count each. Equal counts are all highest. Very long texts are encoded whole; windows
without spaces of any length are aligned like others. An empty table gives no rows. Columns other
than the key and the text take no part, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import sys
from array import array
from collections.abc import Iterator
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tocsin.llm.bpe import _once, byte_letters
from tocsin.llm.common import keep_table, small_batches

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Pairs of ids whose counts go along with the tasks: 17 bytes each.
PAIRS_ALONG = 1 << 20

# Bytes of windows, roughly, that a worker remembers between batches.
MEMO_BYTES = 64 << 20

# Bits of an id of the second tokenizer within a pair, and of a number of links beside a pair.
B_BITS, TIMES_BITS = 16, 31

# Longer runs of letters or of blanks are left to the library that merges them with a heap.
LONG_RUN = 1_000

_BEYOND_PLAIN = re.compile("[^\x00-ɏ]")


class Files(NamedTuple):
    """The byte-level tokenizer as a file of the tokenizers library and as ranks with their pattern,
    and the model of the other one."""

    byte_json: str
    byte_ranks: str
    byte_pattern: str
    pieces: str


class Tokenizers:
    """Both tokenizers, and the bytes of their tokens."""

    def __init__(self, files: dict) -> None:
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_str(files["json"])
        self.exact.encode_special_tokens = True
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, files["ranks"].splitlines())}
        self.quick = tiktoken.Encoding("ranks", pat_str=files["pattern"], mergeable_ranks=ranks, special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=files["pieces"])
        spec = json.loads(files["json"])
        number = {letter: byte for byte, letter in enumerate(byte_letters())}
        vocab = {i: bytes(map(number.__getitem__, token)) for token, i in spec["model"]["vocab"].items()
                 if all(letter in number for letter in token)}
        vocab |= {token["id"]: token["content"].encode() for token in spec["added_tokens"]}
        self.bytes_a = [vocab[i] for i in range(max(vocab) + 1)]
        self.bytes_b = [self._piece(i) for i in range(self.pieces.piece_size())]

    def _piece(self, i: int) -> bytes:
        piece = self.pieces.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.pieces.is_byte(i) else piece.replace("▁", " ").encode()

    def encode_a(self, text: str) -> list[int]:
        """The ranks give the same ids faster, where letters and blanks are beyond doubt and no run
        is long."""
        if text.isascii() or not _BEYOND_PLAIN.search(text):
            words = text.split()
            blanks = len(text) - sum(map(len, words))
            if blanks - len(words) < LONG_RUN and max(map(len, words), default=0) < LONG_RUN:
                return self.quick.encode_ordinary(text)
        return self.exact.encode(text, add_special_tokens=False).ids

    def encode_b(self, texts: list[str]) -> list[list[int]]:
        return self.pieces.encode(texts, num_threads=1)


class Windows:
    """Alignments of windows of token ids, by number."""

    def __init__(self, bytes_a: list[bytes], bytes_b: list[bytes]) -> None:
        self.lengths_a, self.lengths_b = (
            np.array([len(token) for token in kind]) for kind in (bytes_a, bytes_b))
        self.decimals = list(map(str, range(max(len(bytes_a), len(bytes_b)))))
        self.space_a, self.space_b = (
            np.array([token.startswith(b" ") for token in kind]) for kind in (bytes_a, bytes_b))
        self.forget()

    def forget(self) -> None:
        self.number: dict[bytes, int] = {}
        self.shown: list[str] = []
        self.groups = array("q")
        self.starts = array("q", [0])
        self.pairs = array("q")
        self.held = 0

    def _learn(self, keys: list[bytes], a: np.ndarray, b: np.ndarray, hi_a: np.ndarray, hi_b: np.ndarray) -> None:
        """Aligns new windows, all tokens of which follow one another; `hi` are their ends."""
        offsets_a, offsets_b = np.cumsum(self.lengths_a[a]), np.cumsum(self.lengths_b[b])
        cuts = np.zeros(offsets_a[-1] + 1, dtype=np.int8)
        cuts[offsets_a] = 1
        cuts[offsets_b] += 2
        at = np.flatnonzero(cuts)
        kinds = cuts[at]
        ends_a, ends_b = (kinds & 1).astype(bool), (kinds & 2).astype(bool)
        # Between two cuts lies one link; the tokens it links are those that have not ended before.
        of_a, of_b = np.cumsum(ends_a) - ends_a, np.cumsum(ends_b) - ends_b
        pairs = a[of_a] << B_BITS | b[of_b]
        both = ends_a & ends_b
        stops = np.searchsorted(at, offsets_a[hi_a - 1]) + 1
        self.starts.extend((len(self.pairs) + stops).tolist())
        self.pairs.frombytes(pairs.astype(np.int64).tobytes())
        groups_to = np.cumsum(both)[stops - 1]
        self.groups.extend(np.diff(groups_to, prepend=0).tolist())
        names_a, names_b = (list(map(self.decimals.__getitem__, ids.tolist())) for ids in (a, b))
        shown = []
        i = j = 0
        for k, l in zip((of_a[both] + 1).tolist(), (of_b[both] + 1).tolist()):
            if k - i == 1 and l - j == 1:
                shown.append(names_a[i] + "|" + names_b[j])
            else:
                shown.append(",".join(names_a[i:k]) + "|" + ",".join(names_b[j:l]))
            i, j = k, l
        first = 0
        for key, to in zip(keys, groups_to.tolist()):
            text = shown[first] if to - first == 1 else ";".join(shown[first:to])
            self.shown.append(text)
            self.held += 300 + len(key) + len(text)
            first = to
        self.held += 8 * len(pairs)

    def _split(self, a: np.ndarray, b: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
        """Where windows end: tokens of a, tokens of b, and whether a document ends. `ends` are the
        ends of documents in tokens of a; documents follow one another in both."""
        offsets_a, offsets_b = np.cumsum(self.lengths_a[a]), np.cumsum(self.lengths_b[b])
        of_a, of_b = (np.zeros(offsets_a[-1] + 1, dtype=bool) for _ in range(2))
        of_a[offsets_a], of_b[offsets_b] = True, True
        shared_a, shared_b = np.flatnonzero(of_b[offsets_a]) + 1, np.flatnonzero(of_a[offsets_b]) + 1
        last = np.zeros(len(a) + 1, dtype=bool)
        last[ends] = True
        space_a, space_b = np.append(self.space_a[a], False), np.append(self.space_b[b], False)
        anchor = last[shared_a] | (space_a[shared_a] & space_b[shared_b])
        return shared_a[anchor], shared_b[anchor], last[shared_a[anchor]]

    def numbers(self, documents: list[tuple[list[int], list[int]]]) -> tuple[np.ndarray, np.ndarray]:
        """The windows of all documents one after another, and how many each has. Each document
        has tokens, the same bytes on both sides."""
        if self.held > MEMO_BYTES:
            self.forget()
        a = np.concatenate([np.array(ids, np.int64) for ids, _ in documents])
        b = np.concatenate([np.array(ids, np.int64) for _, ids in documents])
        hi_a, hi_b, closes = self._split(a, b, np.cumsum([len(ids) for ids, _ in documents]))
        # No id is 65,535, so the first such two bytes part the ids of a from those of b.
        raw_a, raw_b = a.astype("<u2").tobytes(), b.astype("<u2").tobytes()
        known = self.number
        before = len(known)
        bounds_a, bounds_b = (2 * hi_a).tolist(), (2 * hi_b).tolist()
        keys = [
            raw_a[i:k] + b"\xff\xff" + raw_b[j:l]
            for i, k, j, l in zip([0, *bounds_a], bounds_a, [0, *bounds_b], bounds_b)
        ]
        numbers = np.array([known.setdefault(key, len(known)) for key in keys])
        if len(known) > before:
            self._learn(list(islice(known, before, None)), *self._first_met(a, b, hi_a, hi_b, numbers, before))
        counts = np.diff(np.flatnonzero(closes) + 1, prepend=0)
        return numbers, counts

    def _first_met(
        self, a: np.ndarray, b: np.ndarray, hi_a: np.ndarray, hi_b: np.ndarray, numbers: np.ndarray, before: int
    ) -> list[np.ndarray]:
        """The tokens of windows numbered from `before` on, and where these end among them."""
        _, at = np.unique(numbers, return_index=True)
        at = at[-(numbers.max() + 1 - before) :]
        tokens, ends = [], []
        for ids, hi in ((a, hi_a), (b, hi_b)):
            sizes = np.diff(hi, prepend=0)[at]
            to = np.cumsum(sizes)
            tokens.append(ids[np.arange(to[-1]) + np.repeat(hi[at] - to, sizes)])
            ends.append(to)
        return [*tokens, *ends]

    def links(self, numbers: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
        """Distinct (document, pair) with the number of links, and links per window."""
        starts, pairs = np.array(self.starts), np.array(self.pairs)
        sizes = np.diff(starts)[numbers]
        at = np.arange(sizes.sum()) + np.repeat(starts[numbers] - np.cumsum(sizes) + sizes, sizes)
        document = np.repeat(np.repeat(np.arange(len(counts)), counts), sizes)
        # Pairs are below 2 ** 32, documents of a batch far below 2 ** 31.
        found, times = np.unique(document << 32 | pairs[at], return_counts=True)
        return found >> 32, found & 0xFFFFFFFF, times, sizes


class Aligner:
    """Both tokenizers and the memory of a worker."""

    def __init__(self, files: dict) -> None:
        self.tokenizers = Tokenizers(files)
        self.windows = Windows(self.tokenizers.bytes_a, self.tokenizers.bytes_b)

    def __call__(self, texts: list[str | None]) -> dict[str, pa.Array]:
        """Per text its numbers of tokens, groups and links, a digest, and its distinct links."""
        rows = len(texts)
        full = [i for i, text in enumerate(texts) if text]
        names_a, names_b = self.tokenizers.bytes_a, self.tokenizers.bytes_b
        documents, kept = [], []
        for i, b in zip(full, self.tokenizers.encode_b([texts[i] for i in full])):
            spaced = " " + texts[i]
            a = self.tokenizers.encode_a(spaced)
            raw = spaced.encode()
            if b"".join(map(names_b.__getitem__, b)) == raw and b"".join(map(names_a.__getitem__, a)) == raw:
                documents.append((a, b))
                kept.append(i)
        sums = {name: np.zeros(rows, np.int64) for name in ("n_a", "n_b", "n_groups", "n_links")}
        digests, stops, links = [""] * rows, np.zeros(rows + 1, np.int32), np.zeros(0, np.int64)
        if kept:
            numbers, counts = self.windows.numbers(documents)
            document, pairs, times, sizes = self.windows.links(numbers, counts)
            first = np.cumsum(counts) - counts
            sums["n_a"][kept] = [len(a) for a, _ in documents]
            sums["n_b"][kept] = [len(b) for _, b in documents]
            sums["n_groups"][kept] = np.add.reduceat(np.array(self.windows.groups)[numbers], first)
            sums["n_links"][kept] = np.add.reduceat(sizes, first)
            shown, listed = self.windows.shown, numbers.tolist()
            for i, start, count in zip(kept, first.tolist(), counts.tolist()):
                groups = ";".join([shown[n] for n in listed[start : start + count]])
                digests[i] = hashlib.sha256(groups.encode()).hexdigest()
            links = pairs << TIMES_BITS | times
            of_row = np.zeros(rows, np.int64)
            of_row[kept] = np.bincount(document, minlength=len(kept))
            stops[1:] = np.cumsum(of_row)
        return {
            **{name: pa.array(values) for name, values in sums.items()},
            "groups_sha256": pa.array(digests, pa.string()),
            "links": pa.ListArray.from_arrays(pa.array(stops), pa.array(links, pa.int64())),
        }


def aligned(documents: DataFrame, files: Files, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document its key, n_a, n_b, n_groups, n_links, groups_sha256, and `links`: distinct pairs
    of ids with the number of links of each, as pair * 2 ** TIMES_BITS + number."""
    small_batches(documents.sparkSession)
    read = {"pattern": files.byte_pattern}
    with open(files.byte_json, encoding="utf-8") as file:
        read["json"] = file.read()
    for name, path in (("ranks", files.byte_ranks), ("pieces", files.pieces)):
        with open(path, "rb") as file:
            read[name] = file.read()
    shared = documents.sparkSession.sparkContext.broadcast({"text": read})
    rows = documents.select(F.col(key), F.col(text).cast("string"))
    schema = T.StructType([
        rows.schema.fields[0],
        *(T.StructField(name, T.LongType()) for name in ("n_a", "n_b", "n_groups", "n_links")),
        T.StructField("groups_sha256", T.StringType()),
        T.StructField("links", T.ArrayType(T.LongType())),
    ])

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _once(shared, Aligner)
        for batch in batches:
            made = aligner(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), *made.values()], names=[key, *made])

    return rows.mapInArrow(align, schema)


def pair_counts(found: DataFrame) -> DataFrame:
    """(pair, documents, best): how many documents link a pair, and whether no other pair with its
    first id is linked by more."""
    pairs = found.select(F.explode("links").alias("link"))
    counts = pairs.groupBy(F.shiftright("link", TIMES_BITS).alias("pair")).agg(F.count(F.lit(1)).alias("documents"))
    counts = keep_table(counts, "pair_counts").withColumn("a", F.shiftright("pair", B_BITS))
    most = counts.groupBy("a").agg(F.max("documents").alias("most"))
    return counts.join(most, "a").select("pair", "documents", (F.col("documents") == F.col("most")).alias("best"))


def _frequent(counts: DataFrame, limit: int) -> tuple[DataFrame, DataFrame | None]:
    """The most frequent pairs, no more than `limit`, and all others if there are any."""
    size = F.floor(F.log2("documents") * 16).cast("int")
    sizes = counts.groupBy(size.alias("size")).agg(F.count(F.lit(1)).alias("n")).collect()
    least, room = None, limit
    for row in sorted(sizes, key=lambda row: -row["size"]):
        room -= row["n"]
        if room < 0:
            break
        least = row["size"]
    if room >= 0:
        return counts, None
    if least is None:
        return counts.limit(0), counts
    return counts.where(size >= least), counts.where(size < least)


def with_counts(found: DataFrame, counts: DataFrame, limit: int | None = None) -> DataFrame:
    """Adds n_best, the links whose pair is the most frequent of its first id, and count_sum, the
    counts of the pairs of all links."""
    place = "place"
    limit = PAIRS_ALONG if limit is None else limit
    frequent, others = _frequent(counts, limit)
    along = frequent.orderBy("pair").toArrow()
    known = {name: along.column(name).to_numpy() for name in ("pair", "documents", "best")}
    shared = found.sparkSession.sparkContext.broadcast(known)
    rows = found.withColumn(place, F.monotonically_increasing_id()) if others is not None else found

    @F.arrow_udf("struct<n_best:bigint,count_sum:bigint,rest:array<bigint>>")
    def summed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pair, documents, best = (shared.value[name] for name in ("pair", "documents", "best"))
        for batch in batches:
            links = batch.flatten().to_numpy()
            ends = np.concatenate([[0], np.cumsum(batch.value_lengths().to_numpy())])
            wanted, times = links >> TIMES_BITS, links & ((1 << TIMES_BITS) - 1)
            at = np.searchsorted(pair, wanted)
            at[at == len(pair)] = 0
            hit = pair[at] == wanted if len(pair) else np.zeros(len(wanted), dtype=bool)
            at = at[hit]
            worth, top = np.zeros(len(links), np.int64), np.zeros(len(links), np.int64)
            worth[hit] = documents[at] * times[hit]
            top[hit] = best[at] * times[hit]
            sums = [np.diff(np.concatenate([[0], np.cumsum(values)])[ends]) for values in (top, worth)]
            missed = np.concatenate([[0], np.cumsum(~hit)])[ends].astype(np.int32)
            rest = pa.ListArray.from_arrays(pa.array(missed), pa.array(links[~hit], pa.int64()))
            yield pa.StructArray.from_arrays([*map(pa.array, sums), rest], names=["n_best", "count_sum", "rest"])

    sums = rows.withColumn("sums", summed("links")).drop("links").select("*", "sums.*").drop("sums")
    if others is None:
        return sums.drop("rest")
    sums = keep_table(sums, "sums")
    link = sums.where(F.size("rest") > 0).select(place, F.explode("rest").alias("link"))
    times = F.col("link").bitwiseAND(F.lit((1 << TIMES_BITS) - 1))
    more = (
        link.select(place, F.shiftright("link", TIMES_BITS).alias("pair"), times.alias("times"))
        .join(others, "pair").groupBy(place)
        .agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
             F.sum(F.col("times") * F.col("documents")).alias("more_sum"))
    )
    both = sums.drop("rest").join(more, place, "left").drop(place)
    return both.withColumns({
        "n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)),
        "count_sum": F.col("count_sum") + F.coalesce("more_sum", F.lit(0)),
    }).drop("more_best", "more_sum")


def align_documents(documents: DataFrame, files: Files) -> DataFrame:
    """Per document: tokens, groups, links, how many of these are the most frequent of their first
    id, the sum of their counts, and a digest of the groups."""
    found = keep_table(aligned(documents, files), "aligned")
    counts = keep_table(pair_counts(found), "pairs")
    return with_counts(found, counts)
