"""Byte-pair encoding in independent fragments, and decoding.

A merge can only ever join two neighbouring bytes if those two bytes stand side by side inside
some token of the vocabulary. Where they do not, a cut is certain: no token spans it. Words (the
tokenizer's pre-tokens) are cut at all such places, each distinct fragment is encoded once and
remembered, and the ids of the fragments are put one after another. A run of any length without
white space thus costs what its fragments cost.

Null texts count as empty and give no ids. A null list of ids decodes to the empty text. Repeated
rows are encoded each on its own; other columns pass through untouched, except that columns
called like the result are replaced. An empty table gives no rows. Ties between merges cannot occur,
as each merge has a rank of its own.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from array import array
from collections.abc import Callable, Iterator
from functools import partial
from itertools import chain, compress
from operator import attrgetter

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tocsin.llm.common import small_batches

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Bytes of words and ids, roughly, that a Python worker remembers. Beyond that it keeps the words met
# most often, in half as many bytes; it may hold what one batch brings on top. An entry costs some
# bytes besides its letters and ids.
CACHE_BYTES = 32 << 20
_ENTRY_BYTES = 160

# Up to here every letter is composed already and lower-cases without looking at its neighbours.
PLAIN_LIMIT = 0x250


def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies write for each byte: itself where it
    has a visible Latin-1 form, else the next letter from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in visible else chr(next(hidden)) for b in range(256)]


def _plain_pattern(contractions: str) -> re.Pattern:
    """The splitting pattern with its classes spelled out below PLAIN_LIMIT, after lower-casing."""
    lowered = sorted({c for point in range(PLAIN_LIMIT) for c in chr(point).lower()})

    def spell(kind: str) -> str:
        return "".join(re.escape(c) for c in lowered if unicodedata.category(c)[0] == kind)

    letters, numbers = spell("L"), spell("N")
    spaces = r"\t\n\x0b\f\r \x85\xa0"
    return re.compile(f"{contractions}|[{letters}]+|[{numbers}]|[^{spaces}{letters}{numbers}]+")


class Places(dict):
    """Numbers of words, from 0 on as they are met; `new` has those met since it was last emptied."""

    def __init__(self, words: list[str]) -> None:
        super().__init__(zip(words, range(len(words))))
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        number = self[word] = len(self)
        return number


class Fragments(dict):
    """Ids of fragments, encoded as they are met; `held` is the bytes they are counted with."""

    def __init__(self, encode: Callable[[bytes], list[int]]) -> None:
        super().__init__()
        self.encode = encode
        self.held = 0

    def __missing__(self, fragment: bytes) -> list[int]:
        ids = self[fragment] = self.encode(fragment)
        self.held += _ENTRY_BYTES + len(fragment) + 8 * len(ids)
        return ids


def _merged(is_second: np.ndarray, sizes: np.ndarray, first, second) -> np.ndarray:
    """Ids of two kinds in the order in which their owners stand."""
    flat = np.empty(int(sizes.sum()), dtype=np.int32)
    of_second = np.repeat(is_second, sizes)
    flat[~of_second], flat[of_second] = first, second
    return flat


class Codec:
    """One tokenizer file, ready to encode inside a worker."""

    def __init__(self, text: str) -> None:
        from tokenizers import Tokenizer, models

        spec = json.loads(text)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        merges = [tuple(pair) for pair in model["merges"]]
        last = dict(vocab=model["vocab"], merges=merges, end_of_word_suffix=self.suffix)
        self.last = models.BPE(**last)
        self.inner = models.BPE(vocab=model["vocab"], merges=merges)
        whole = Tokenizer.from_str(text)
        self.normalizer, self.splitter = whole.normalizer, whole.pre_tokenizer
        self.letters = byte_letters()
        self.spelling = dict(enumerate(self.letters))
        self.spelling_words = {**self.spelling, ord(" "): " "}
        self.special = {token["content"]: token["id"] for token in spec["added_tokens"]}
        self.cut_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.plain = _plain_pattern(pattern.split("|[")[0])
        self.beyond_plain = re.compile(f"[^\0-{chr(PLAIN_LIMIT - 1)}]")
        self.joined = self._neighbours(model["vocab"])
        self._forget()

    def _neighbours(self, vocab: dict[str, int]) -> np.ndarray:
        """For each pair of bytes, whether some token holds it."""
        number = {letter: byte for byte, letter in enumerate(self.letters)}
        seen = np.zeros(1 << 16, dtype=bool)
        for token in vocab:
            spelled = [number[c] for c in token.removesuffix(self.suffix) if c in number]
            for a, b in zip(spelled, spelled[1:]):
                seen[a << 8 | b] = True
        return seen

    def _forget(self) -> None:
        self._forget_fragments()
        self._keep([], np.empty(0, np.int32), *(np.empty(0, np.int64) for _ in range(3)))

    def _forget_fragments(self) -> None:
        """Of those that end no word and those that do; a special token counts as one of these."""
        self.known = tuple(Fragments(partial(self._ids, final=final)) for final in (False, True))
        self.known[True].update((token.encode(), [number]) for token, number in self.special.items())

    def _keep(self, words: list[str], flat: np.ndarray, sizes: np.ndarray, costs: np.ndarray, uses: np.ndarray) -> None:
        """Remember these words: ids of all one after another, and of each how many they are, the
        bytes it is counted with and how often it was met."""
        self.place = Places(words)
        self.flat = array("i", flat.tobytes())
        self.starts = array("q", np.concatenate([[0], np.cumsum(sizes)]).tobytes())
        self.costs = array("q", costs.tobytes())
        self.uses = uses
        self.held = int(costs.sum())

    def _make_room(self) -> None:
        """Forget fragments, words met once, and of the others those met least, down to half."""
        costs, starts = np.array(self.costs), np.array(self.starts)
        often = np.argsort(-self.uses, kind="stable")[: np.count_nonzero(self.uses > 1)]
        kept = np.sort(often[np.cumsum(costs[often]) <= CACHE_BYTES // 2])
        words = list(self.place)
        sizes = np.diff(starts)
        chosen = np.repeat(np.isin(np.arange(len(words)), kept), sizes)
        flat = np.array(self.flat)[chosen]
        self._forget_fragments()
        self._keep([words[i] for i in kept.tolist()], flat, sizes[kept], costs[kept], self.uses[kept] // 2)

    def _places_apart(self, joined: bytes, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places in joined words where two neighbouring bytes of a word share no token, and the
        word of each."""
        whole = np.frombuffer(joined, np.uint8).astype(np.uint16)
        apart = ~self.joined[whole[:-1] << 8 | whole[1:]]
        apart[ends[:-1] - 1] = False
        places = np.flatnonzero(apart) + 1
        return places, np.searchsorted(ends, places, side="right")

    def cuts(self, words: list[bytes]) -> list[list[int]]:
        """For each word, the places where two neighbouring bytes share no token."""
        ends = np.cumsum([len(word) for word in words])
        places, owner = self._places_apart(b"".join(words), ends)
        cuts: list[list[int]] = [[] for _ in words]
        for word, place in zip(owner.tolist(), (places - (ends - np.diff(ends, prepend=0))[owner]).tolist()):
            cuts[word].append(place)
        return cuts

    def _ids(self, fragment: bytes, final: bool) -> list[int]:
        spelled = fragment.decode("latin-1").translate(self.spelling)
        return [token.id for token in (self.last if final else self.inner).tokenize(spelled)]

    def _whole_ids(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words that are not cut, one after another, and how many each has."""
        # No word holds a blank.
        spelled = b" ".join(words).decode("latin-1").translate(self.spelling_words).split(" ") if words else []
        tokens = list(map(self.last.tokenize, spelled))
        sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        ids = np.fromiter(map(attrgetter("id"), chain.from_iterable(tokens)), np.int32, int(sizes.sum()))
        return ids, sizes

    def _learn(self, words: list[str]) -> None:
        """Encode words met for the first time, which have their places already."""
        raw = list(map(str.encode, words))
        joined = b"".join(raw)
        letters = np.fromiter(map(len, raw), np.int64, len(raw))
        ends = np.cumsum(letters)
        is_special = np.zeros(len(words), dtype=bool)
        first = len(self.place) - len(words)
        is_special[[at - first for at in map(self.place.get, self.special) if at is not None and at >= first]] = True
        cuts, owner = self._places_apart(joined, ends)
        # Special tokens are not cut.
        cuts, owner = cuts[~is_special[owner]], owner[~is_special[owner]]
        is_apart = is_special.copy()
        is_apart[owner] = True
        # Fragments follow one another, so the n-th begin and the n-th stop belong together.
        begins = np.sort(np.concatenate([(ends - letters)[is_apart], cuts]))
        stops = np.sort(np.concatenate([ends[is_apart], cuts]))
        final = np.isin(stops, ends, assume_unique=True)
        counts = np.empty(len(stops), dtype=np.int64)
        found = []
        self.held -= sum(known.held for known in self.known)
        for known, chosen in zip(self.known, (~final, final)):
            pieces = map(slice, begins[chosen].tolist(), stops[chosen].tolist())
            found.append(list(map(known.__getitem__, map(joined.__getitem__, pieces))))
            counts[chosen] = np.fromiter(map(len, found[-1]), np.int64, len(found[-1]))
        of_parts = _merged(final, counts, *(list(chain.from_iterable(ids)) for ids in found))
        sizes = np.zeros(len(words), dtype=np.int64)
        np.add.at(sizes, np.searchsorted(ends, begins, side="right"), counts)
        of_whole, sizes[~is_apart] = self._whole_ids(list(compress(raw, (~is_apart).tolist())))
        flat = _merged(is_apart, sizes, of_whole, of_parts)
        costs = _ENTRY_BYTES + 4 * sizes + letters
        self.starts.frombytes((self.starts[-1] + np.cumsum(sizes)).tobytes())
        self.flat.frombytes(flat.tobytes())
        self.costs.frombytes(costs.tobytes())
        self.held += int(costs.sum()) + sum(known.held for known in self.known)

    def _part_words(self, text: str) -> list[str]:
        if text.isascii() or not self.beyond_plain.search(text):
            return self.plain.findall(text.lower())
        number = {letter: byte for byte, letter in enumerate(self.letters)}
        spelled = self.splitter.pre_tokenize_str(self.normalizer.normalize_str(text))
        return [bytes(map(number.__getitem__, piece)).decode() for piece, _ in spelled]

    def words(self, text: str) -> list[str]:
        """Pre-tokens, special tokens among them as they are spelled."""
        if "<|" not in text:
            return self._part_words(text) if text else []
        out: list[str] = []
        for part in self.cut_special.split(text):
            out += [part] if part in self.special else self._part_words(part) if part else []
        return out

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and where each text starts (and the last ends)."""
        if self.held > CACHE_BYTES:
            self._make_room()
        places = array("q")
        ends = [0]
        find = self.place.__getitem__
        for text in texts:
            if text:
                places.extend(map(find, self.words(text)))
            ends.append(len(places))
        chosen = np.frombuffer(places, dtype=np.int64)
        if self.place.new:
            self._learn(self.place.new)
            self.place.new = []
        uses = np.bincount(chosen, minlength=len(self.place))
        uses[: len(self.uses)] += self.uses
        self.uses = uses
        # The last start is where the next word will be put.
        starts = np.frombuffer(self.starts, dtype=np.int64)
        begin = starts[chosen]
        lengths = starts[chosen + 1] - begin
        del starts
        stops = np.concatenate([[0], np.cumsum(lengths)])
        at = np.arange(stops[-1]) + np.repeat(begin - stops[:-1], lengths)
        ids = np.frombuffer(self.flat, dtype=np.int32)[at] if len(at) else at.astype(np.int32)
        return ids, stops[np.array(ends)]


class Names:
    """Tokens by id, for decoding."""

    def __init__(self, text: str) -> None:
        spec = json.loads(text)
        names = {number: token for token, number in spec["model"]["vocab"].items()}
        names.update({token["id"]: token["content"] for token in spec["added_tokens"]})
        self.names = [names.get(number, "") for number in range(max(names) + 1)]

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """Tokens by name with blanks between them: such a file names no decoder. Takes ids of
        all texts one after another, and where each text starts and the last ends."""
        tokens = list(map(self.names.__getitem__, ids.tolist()))
        return [" ".join(tokens[i:j]) for i, j in zip(ends.tolist(), ends[1:].tolist())]


def _once(shared, kind: type):
    """Built once per Python worker: the value of a broadcast lives as long as the worker."""
    held = shared.value
    if kind.__name__ not in held:
        held[kind.__name__] = kind(held["text"])
    return held[kind.__name__]


def _shared(rows: DataFrame, tokenizer_path: str):
    with open(tokenizer_path, encoding="utf-8") as file:
        return rows.sparkSession.sparkContext.broadcast({"text": file.read()})


def encode(rows: DataFrame, tokenizer_path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Adds the ids of each whole text as an array. The vocabulary file is broadcast; it is a
    fixed file, not data."""
    small_batches(rows.sparkSession)
    shared = _shared(rows, tokenizer_path)

    @F.arrow_udf("array<int>")
    def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _once(shared, Codec)
        for batch in batches:
            flat, ends = codec.encode(batch.to_pylist())
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))

    return rows.withColumn(ids, encoded(F.col(text)))


def decode(rows: DataFrame, tokenizer_path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Adds the text that an array of ids stands for."""
    small_batches(rows.sparkSession)
    shared = _shared(rows, tokenizer_path)

    @F.arrow_udf("string")
    def decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        names = _once(shared, Names)
        for batch in batches:
            sizes = batch.value_lengths().fill_null(0).to_numpy()
            ends = np.concatenate([[0], np.cumsum(sizes)])
            yield pa.array(names.decode(batch.flatten().to_numpy(), ends), pa.string())

    return rows.withColumn(text, decoded(F.col(ids)))


def digests(documents: DataFrame, tokenizer_path: str) -> DataFrame:
    """Per document the number of ids and digests of the ids and of the text decoded from them."""
    kept = documents.select("doc_id", "text")
    both = decode(encode(kept, tokenizer_path), tokenizer_path)
    return both.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
