"""Language identification as a mixture: the share of each language in a text.

For each language the byte trigrams of lower-cased words are counted over all texts to learn from.
A word's likelihood in a language is that of its trigrams. Expectation-maximisation finds the
shares of the languages that make a text's words likeliest; languages are then taken out, the
smallest share first, as long as the loss of log-likelihood is less than the penalty for a
language. What remains is the text's set of languages, and the largest share gives the answer.

Texts that are null or hold no letter are `und`, with score 0 and no languages. A row whose
language is null is not learnt from. With nothing to learn from, all texts are `und`. Equal shares
go to the language first in the alphabet. Repeated rows are answered alike, very long texts as a
whole. An empty table gives no rows, and other columns take no part, whatever their names.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tocsin.llm.common import crc_mod, free_name, small_batches

cloudpickle.register_pickle_by_value(sys.modules[__name__])

UNKNOWN = "und"

# Trigrams are hashed into so many bins; a model is a number per bin and language.
BINS = 1 << 16
SMOOTHING = 0.5

# Beside the background a trigram that a language has never shown must count for little, or the
# bins that no language uses would make up for it.
STRICT_SMOOTHING = 0.01

# Values of the language column that are learnt, those of most rows first: a bound for a column that
# holds anything but languages.
MOST_LANGUAGES = 256

ROUNDS = 8
ROUNDS_LESS = 4

# A text is kept if the known languages together have this share of its words, against a background
# that draws the bytes of all of them one by one. Texts that mix languages are sound texts.
LEAST_SHARE = 0.3

_LETTER = re.compile(r"[^\W\d_]")

# Letters of ASCII and parts of longer characters stay, all else separates.
_KEEP = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


class Words(NamedTuple):
    """Trigrams of a batch of texts by bins and by their bytes, where each word starts among them,
    whose word it is."""

    bins: np.ndarray
    triples: np.ndarray
    starts: np.ndarray
    owner: np.ndarray


def words(texts: list[str | None]) -> Words:
    """A word of n bytes has n trigrams: each byte with the two before it, blanks ahead."""
    parts = [b"" if t is None else t.lower().encode().translate(_KEEP) for t in texts]
    whole = np.frombuffer(b"  " + b" ".join(parts) + b" ", np.uint8)
    ends = np.cumsum([len(p) + 1 for p in parts]) + 2
    letter = whole != 32
    places = np.flatnonzero(letter)
    if not len(places):
        none = np.empty(0, np.int64)
        return Words(none, none.reshape(3, 0), none, none)
    b0, b1, b2 = whole[places].astype(np.uint32), whole[places - 1], whole[places - 2]
    # After a blank the byte before it belongs to another word.
    b2 = np.where(b1 == 32, 32, b2)
    code = b0 * np.uint32(0x9E3779B1) + b1 * np.uint32(0x85EBCA6B) + b2 * np.uint32(0xC2B2AE35)
    bins = (code ^ (code >> np.uint32(15))) % np.uint32(BINS)
    first = np.flatnonzero(b1 == 32)
    return Words(bins, np.stack([b0, b1, b2]), first, np.searchsorted(ends, places[first], side="right"))


def _grams(languages: list[str]):
    """Each task's trigram counts by language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(languages), BINS), dtype=np.int64)
        # Of the three places of a trigram, under -1 to -3.
        single = np.zeros((3, 256), dtype=np.int64)
        place = {language: i for i, language in enumerate(languages)}
        for batch in batches:
            spoken = batch.column("lang").to_pylist()
            texts = batch.column("text").to_pylist()
            for language in set(spoken):
                found = words([t for t, s in zip(texts, spoken) if s == language])
                total[place[language]] += np.bincount(found.bins, minlength=BINS)
                for i, bytes_ in enumerate(found.triples):
                    single[i] += np.bincount(bytes_, minlength=256)
        language, gram = np.nonzero(total)
        place, byte = np.nonzero(single)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.append(language, -1 - place), pa.int32()), pa.array(np.append(gram, byte), pa.int32()),
                pa.array(np.append(total[language, gram], single[place, byte])),
            ],
            names=["language", "gram", "n"],
        )

    return count


class Model(NamedTuple):
    """Languages in alphabetical order, log-likelihoods by bin and language, the same beside a
    background, and that: log-likelihoods of the bytes at each place, whatever the language."""

    languages: list[str]
    logs: np.ndarray
    strict: np.ndarray
    single: np.ndarray

    def shares(self, texts: list[str | None], background: bool = False) -> np.ndarray:
        """Shares of the languages of each text, and of the background behind them; zero throughout
        where there are no words."""
        found = words(texts)
        shares = np.zeros((len(texts), len(self.languages) + background), dtype=np.float64)
        if not len(found.starts) or not self.languages:
            return shares
        logs = (self.strict if background else self.logs)[found.bins]
        if background:
            alone = sum(self.single[i][bytes_] for i, bytes_ in enumerate(found.triples))
            logs = np.column_stack([logs, alone])
        likely = np.add.reduceat(logs, found.starts, axis=0)
        top = likely.max(axis=1, keepdims=True)
        likely = np.exp(likely - top)
        some, first = np.unique(found.owner, return_index=True)
        sizes = np.diff(np.append(first, len(found.owner)))
        shares[some] = _mixtures(likely, first, sizes)
        return shares


def _improve(likely: np.ndarray, first: np.ndarray, sizes: np.ndarray, shares: np.ndarray, rounds: int):
    """Expectation-maximisation; gives the shares and the log-likelihoods."""
    logs = np.zeros(len(sizes))
    for step in range(rounds + 1):
        joint = likely * np.repeat(shares, sizes, axis=0)
        total = joint.sum(axis=1)
        if step == rounds:
            logs = np.add.reduceat(np.log(np.maximum(total, 1e-300)), first)
        else:
            joint /= np.maximum(total, 1e-300)[:, None]
            shares = np.add.reduceat(joint, first, axis=0) / sizes[:, None]
    return shares, logs


def _mixtures(likely: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Shares after taking out the languages that do not pay for themselves."""
    texts, languages = len(sizes), likely.shape[1]
    even = np.full((texts, languages), 1 / languages)
    shares, logs = _improve(likely, first, sizes, even, ROUNDS)
    penalty = 0.5 * np.log(sizes + 1) + 1
    result = np.empty_like(shares)
    index = np.arange(texts)
    while len(index):
        active = shares > 0
        several = active.sum(axis=1) > 1
        result[index] = shares
        if not several.any():
            break
        row = np.repeat(several, sizes)
        index, likely, sizes = index[several], likely[row], sizes[several]
        shares, logs = shares[several], logs[several]
        first = np.cumsum(sizes) - sizes
        least = np.where(shares > 0, shares, np.inf)
        # Of equal shares the last language goes.
        drop = least.shape[1] - 1 - np.argmin(least[:, ::-1], axis=1)
        fewer = shares.copy()
        fewer[np.arange(len(index)), drop] = 0
        fewer /= fewer.sum(axis=1, keepdims=True)
        fewer, less = _improve(likely, first, sizes, fewer, ROUNDS_LESS)
        out = logs - less < penalty[index]
        row = np.repeat(out, sizes)
        index, likely, sizes = index[out], likely[row], sizes[out]
        shares, logs, first = fewer[out], less[out], np.cumsum(sizes) - sizes
    return result


def learnable(key: str = "doc_id") -> Column:
    return crc_mod(F.col(key), 4) != 2


def train(documents: DataFrame, learn: Column, text: str = "text", lang: str = "lang") -> Model:
    """Counts over all rows that `learn` admits. What comes to the driver is BINS numbers for each
    of MOST_LANGUAGES at most."""
    small_batches(documents.sparkSession)
    known = documents.where(learn & F.col(lang).isNotNull() & F.col(text).isNotNull())
    known = known.select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    spoken = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang")
    languages = sorted(row.lang for row in spoken.limit(MOST_LANGUAGES).collect())
    known = known.where(F.col("lang").isin(languages))
    if not languages:
        return Model([], np.zeros((BINS, 0)), np.zeros((BINS, 0)), np.zeros((3, 256)))
    counted = (
        known.mapInArrow(_grams(languages), "language int, gram int, n bigint")
        .groupBy("language", "gram")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    language, gram, n = (counted.column(name).to_numpy() for name in ("language", "gram", "n"))
    counts, single = np.zeros((BINS, len(languages))), np.zeros((3, 256))
    spoken = language >= 0
    counts[gram[spoken], language[spoken]] = n[spoken]
    single[-1 - language[~spoken], gram[~spoken]] = n[~spoken]

    def logs(seen: np.ndarray, smoothing: float, axis: int) -> np.ndarray:
        smooth = seen + smoothing
        return np.log(smooth / smooth.sum(axis=axis, keepdims=True)).astype(np.float32)

    return Model(languages, logs(counts, SMOOTHING, 0), logs(counts, STRICT_SMOOTHING, 0), logs(single, SMOOTHING, 1))


_ANSWER = "struct<lang_pred:string, score:double, shares:map<string,double>>"


def _answer_column(documents: DataFrame, model: Model):
    shared = documents.sparkSession.sparkContext.broadcast(tuple(model))

    @F.arrow_udf(_ANSWER)
    def answered(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = Model(*shared.value)
        kind = pa.struct([
            ("lang_pred", pa.string()), ("score", pa.float64()),
            ("shares", pa.map_(pa.string(), pa.float64())),
        ])
        for batch in batches:
            texts = batch.to_pylist()
            rows = []
            for text, shares in zip(texts, own.shares(texts)):
                if text is None or not shares.any() or not _LETTER.search(text):
                    rows.append({"lang_pred": UNKNOWN, "score": 0.0, "shares": []})
                    continue
                best = int(shares.argmax())
                spoken = [(own.languages[i], float(shares[i])) for i in np.flatnonzero(shares)]
                rows.append({
                    "lang_pred": own.languages[best], "score": min(1.0, float(shares[best])), "shares": spoken,
                })
            yield pa.array(rows, kind)

    return answered


def languages(documents: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Per row: held_out, lang_pred, score (its share) and the shares of the whole set."""
    model = train(documents, learnable(key), text, lang)
    answered = documents.select(
        key, (~learnable(key)).alias("held_out"), _answer_column(documents, model)(F.col(text)).alias("a")
    )
    return answered.select(key, "held_out", "a.lang_pred", "a.score", "a.shares")


def known_only(documents: DataFrame, least_share: float = LEAST_SHARE, key: str = "doc_id", text: str = "text",
               lang: str = "lang") -> DataFrame:
    """The documents of whose words the known languages have at least this share, with all their
    columns."""
    model = train(documents, learnable(key), text, lang)
    shared = documents.sparkSession.sparkContext.broadcast(tuple(model))

    @F.arrow_udf("boolean")
    def known(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = Model(*shared.value)
        for batch in batches:
            texts = batch.to_pylist()
            shares = own.shares(texts, background=True)
            sound = (shares[:, :-1].sum(axis=1) >= least_share) & shares.any(axis=1)
            lettered = [text is not None and _LETTER.search(text) is not None for text in texts]
            yield pa.array(sound & np.array(lettered, dtype=bool))

    answer = free_name(documents, "known_language")
    return documents.withColumn(answer, known(F.col(text))).where(F.col(answer)).drop(answer)
