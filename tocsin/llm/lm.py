"""Language-model scores from a log-bilinear model.

Words are put into classes: the most frequent words are classes of their own, all others share a
class by their ending. Classes grow with the root of the corpus, so the pairs of classes that are
learnt grow with the corpus itself. A class's vector, scaled by a learnt vector for the position
before, predicts the next class's vector; exp of their product plus a bias is the unnormalised
probability. Training is noise-contrastive: pairs of neighbours from the corpus are told from pairs
whose second class is drawn from the class frequencies. With one word of context the corpus enters
only by how often each pair of classes occurs, so Spark counts the pairs over all texts and the
loss is taken over the counts, with the noise in expectation instead of drawn. Pairs are dealt to
blocks by their first class; a block is learnt by steps in numpy in one task, holds a bounded table
however many classes there are, and the vectors that blocks share are averaged by Spark between
rounds.

Scores are normalised: matrix products give what all classes sum up to after each class, in blocks
of classes, and a word gets its class's probability times its smoothed share of the class. Words
never seen have the share of one more word in their class.

Counts of all words are kept in a table and joined to the words of each text; only the most
frequent ones, a bounded number, go along with the tasks.

Null and empty texts are a single end. Repeated rows are counted and scored each on its own, very
long texts as a whole. Equally frequent words are ordered by their letters. Without texts to learn
from every word is as likely as its smoothing makes it. An empty table gives no rows. Nothing
depends on columns other than key and text, whatever their names.
"""

from __future__ import annotations

import sys
from array import array
from collections.abc import Iterator
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tocsin.llm.common import crc_mod, keep_table, small_batches

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SMOOTHING = 0.1

# Classes come in steps, one step for each so many roots of a token, up to a number that leaves
# words with a class of their own among the frequent ones and the vectors small enough to send.
CLASS_STEP = 256
TOKEN_ROOTS = 512
MOST_CLASSES = 131_072

# Words whose counts go along with the tasks; all others are joined.
FREQUENT = 100_000

# Grades of frequency, for each doubling.
GRADES = 16

# Numbers in a block's table of pairs, contexts in a block, and contexts in one step.
BLOCK_CELLS = 1 << 23
BLOCK_CONTEXTS = 512
STEP_CONTEXTS = 256
STEP_CELLS = 1 << 21

# Distinct pairs that a counting task holds before it passes them on.
HELD_PAIRS = 2_000_000

DIMENSIONS = 32
NOISE = 10
ROUNDS = 6
STEPS = 25
RATE = 0.05
SEED = 5

# A class before is held to the middle as if by so many occurrences.
PRIOR = 20.0

# Bytes of words, roughly, that a Python worker remembers before it starts afresh; it may hold what
# one batch brings on top. A word costs some bytes besides its letters.
CACHE_BYTES = 80 << 20
_WORD_BYTES = 160

# The end of a text. Words hold no white space, so no word is spelled like it.
END = " "

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def split(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_LOWER).split()


def words_of(text: Column) -> Column:
    """The same words as an array, with the end."""
    lowered = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = F.regexp_extract_all(lowered, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    return F.concat(found, F.array(F.lit(END)))


class Classes(NamedTuple):
    """How many words have a class of their own, and how many classes there are in all."""

    own: int
    total: int

    def ending(self, word: bytes) -> int:
        """Class by the last three letters, sentence marks left off."""
        return self.own + crc32(word.rstrip(b".,;:!?")[-3:]) % (self.total - self.own)


def classes_for(tokens: int) -> Classes:
    """Classes for a corpus: pairs of classes in proportion to its tokens."""
    steps = min(max(1, round(tokens**0.5 / TOKEN_ROOTS)), MOST_CLASSES // CLASS_STEP)
    total = steps * CLASS_STEP
    return Classes(total * 3 // 4, total)


class Frequent(NamedTuple):
    """The most frequent words: their place in order of frequency, and their counts."""

    place: dict[bytes, int]
    counts: np.ndarray

    def class_of(self, word: bytes, classes: Classes) -> int:
        place = self.place.get(word, classes.own)
        return place if place < classes.own else classes.ending(word)


# --- counting -------------------------------------------------------------------------------


def word_counts(documents: DataFrame, text: str = "text") -> DataFrame:
    """How often each word occurs, ends included: hash, word, n. Counted before the shuffle."""
    each = documents.select(F.explode(words_of(F.col(text))).alias("word"))
    counted = each.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return keep_table(counted.select(F.xxhash64("word").alias("hash"), "word", "n"), "words")


def most_frequent(counts: DataFrame, most: int = FREQUENT) -> Frequent:
    """At most `most` words come to the driver, and those few that share their hash with another
    word: the others can be told apart by it. Words are counted by grade first, the logarithm of
    their frequency, so that only words of grades that are wanted are put in order."""
    grade = F.floor(F.log2("n") * GRADES)
    least, taken = None, 0
    for row in sorted(counts.groupBy(grade.alias("grade")).agg(F.count(F.lit(1)).alias("words")).collect(), reverse=True):
        if taken < most:
            least, taken = row.grade, taken + row.words
    twice = counts.groupBy("hash").agg(F.count(F.lit(1)).alias("words")).where("words > 1").select("hash")
    alike = counts.join(twice, "hash", "left_semi").select("word", "n")
    wanted = counts.where(grade >= F.lit(least))
    first = wanted.orderBy(F.desc("n"), "word").limit(most).select("word", "n")
    rows = first.unionByName(alike).distinct().orderBy(F.desc("n"), "word").toArrow()
    words = [word.encode() for word in rows.column("word").to_pylist()]
    return Frequent({word: i for i, word in enumerate(words)}, rows.column("n").to_numpy())


class _Numbers(dict):
    """Numbers of words; a word not met before gets one when it is looked up."""

    def __init__(self, add) -> None:
        self.add = add

    def __missing__(self, word: bytes) -> int:
        return self.add(word)


class Lexicon:
    """Words met so far in a Python worker, numbered: class, log10 of the smoothed count where the
    word is frequent, else its hash."""

    def __init__(self, frequent: Frequent, classes: Classes) -> None:
        self.frequent, self.of = frequent, classes
        self.logs_by_place = np.log10(frequent.counts + SMOOTHING)
        self._forget()

    def _forget(self) -> None:
        self.held = 0
        self.number = _Numbers(self._add)
        self.classes, self.logs = array("i"), array("d")
        self.hashes, self.common = array("q"), array("b")
        self.end = self._add(END.encode())

    def _add(self, word: bytes) -> int:
        place = self.frequent.place.get(word)
        h = 0 if place is not None else xxh64_intdigest(word, 42)
        self.classes.append(self.frequent.class_of(word, self.of))
        self.logs.append(0.0 if place is None else self.logs_by_place[place])
        self.hashes.append(h - (1 << 64) if h >> 63 else h)
        self.common.append(place is not None)
        number = self.number[word] = len(self.classes) - 1
        self.held += _WORD_BYTES + len(word)
        return number

    def column(self, name: str, kind: type) -> np.ndarray:
        """What is known of the words by number. Not to be held while words are added."""
        return np.frombuffer(getattr(self, name), dtype=kind)

    def sequences(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all words of all texts one after another, an end before and after each text,
        and where the texts stop."""
        if self.held > CACHE_BYTES:
            self._forget()
        find, end = self.number.__getitem__, self.end
        numbers: list[int] = []
        stops = []
        for text in texts:
            numbers.append(end)
            numbers.extend(map(find, split(text)))
            numbers.append(end)
            stops.append(len(numbers))
        return np.array(numbers, dtype=np.int64), np.array(stops, dtype=np.int64)


def _summed(pairs: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs in order, with the sum of each one's counts."""
    found, place = np.unique(np.concatenate(pairs), return_inverse=True)
    return found, np.bincount(place, np.concatenate(counts), len(found)).astype(np.int64)


def _pair_counts(shared):
    """Counts of neighbouring classes, summed in each task over as many pairs as it may hold. A
    pair is one number: first class times number of classes, plus second class."""

    def passed_on(pairs: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        for start in range(0, len(pairs), 100_000):
            part = slice(start, start + 100_000)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[part]), pa.array(counts[part])], names=["pair", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, classes = shared.value
        lexicon = Lexicon(Frequent(*frequent), Classes(*classes))
        total = classes[1]
        pairs, counts, held, distinct = [], [], 0, 0
        for batch in batches:
            numbers, stops = lexicon.sequences(batch.column(0).to_pylist())
            found = lexicon.column("classes", np.int32)[numbers].astype(np.int64)
            # What leads from one text to the next is no pair.
            some, n = np.unique(np.delete(found[:-1] * total + found[1:], stops[:-1] - 1), return_counts=True)
            pairs.append(some)
            counts.append(n)
            held += len(some)
            if held > distinct + HELD_PAIRS:
                some, n = _summed(pairs, counts)
                if len(some) > HELD_PAIRS:
                    yield from passed_on(some, n)
                    some, n = some[:0], n[:0]
                pairs, counts, held, distinct = [some], [n], len(some), len(some)
        if pairs:
            yield from passed_on(*_summed(pairs, counts))

    return count


# --- training -------------------------------------------------------------------------------


class Vectors(NamedTuple):
    """Vectors of a class before (already scaled for its position) and of a class to come, and
    how likely a class is by itself."""

    before: np.ndarray
    after: np.ndarray
    bias: np.ndarray

    def logits(self, first: slice) -> np.ndarray:
        """Natural logarithms, not normalised, one row per class before."""
        return self.before[first] @ self.after.T + self.bias

    def norms(self, first: slice) -> np.ndarray:
        """For some classes before, the logarithm of what all classes after sum up to."""
        logits = self.logits(first)
        most = logits.max(axis=1, keepdims=True)
        return (most[:, 0] + np.log(np.exp(logits - most).sum(axis=1, dtype=np.float64))).astype(np.float64)


def _start(noise: np.ndarray) -> Vectors:
    random = np.random.default_rng(SEED)
    shape = (len(noise), DIMENSIONS)
    return Vectors(
        random.normal(0, 0.1, shape).astype(np.float32),
        random.normal(0, 0.1, shape).astype(np.float32),
        np.log(noise).astype(np.float32),
    )


class _Adam:
    """Steps for one array of numbers."""

    def __init__(self, value: np.ndarray) -> None:
        self.value, self.taken = value.copy(), 0
        self.first, self.second = np.zeros_like(value), np.zeros_like(value)

    def step(self, gradient: np.ndarray) -> None:
        self.taken += 1
        self.first += 0.1 * (gradient - self.first)
        self.second += 0.01 * (gradient * gradient - self.second)
        root = np.sqrt(self.second / (1 - 0.99**self.taken)) + 1e-12
        self.value += RATE / (1 - 0.9**self.taken) * self.first / root


def contrast_steps(vectors: Vectors, own: np.ndarray, pairs: np.ndarray, noise: np.ndarray,
                   steps: int) -> Vectors:
    """Adam steps on the noise-contrastive loss of the classes `own`, given the counts of what
    follows each. The noise of a context is as many draws per occurrence as NOISE says, all of
    them taken at their expected value. Each of the `steps` goes over all contexts, some at a
    time."""
    occurs = pairs.sum(axis=1, keepdims=True)
    shift = np.log(NOISE * noise)
    # Contexts count by the root of their frequency, so that rare ones are learnt too.
    prior = np.sqrt(occurs) / np.maximum(occurs, 1) / max(1.0, float(np.sqrt(occurs).sum()))
    weight = prior / (1 + NOISE)
    at_once = max(1, min(STEP_CONTEXTS, STEP_CELLS // pairs.shape[1]))
    apart = -(-len(own) // at_once)
    after, bias = _Adam(vectors.after), _Adam(vectors.bias)
    parts = []
    for i in range(apart):
        seen = (pairs[i::apart] * weight[i::apart]).astype(np.float32)
        drawn = (NOISE * occurs[i::apart] * weight[i::apart]).astype(np.float32)
        parts.append((_Adam(vectors.before[own[i::apart]]), seen, drawn, (PRIOR * prior[i::apart]).astype(np.float32)))
    with np.errstate(over="ignore"):
        for _ in range(steps):
            for before, seen, drawn, prior_ in parts:
                real = before.value @ after.value.T
                real += bias.value - shift
                np.negative(real, out=real)
                np.exp(real, out=real)
                real += 1
                np.reciprocal(real, out=real)
                error = drawn * noise
                error += seen
                error *= real
                np.subtract(seen, error, out=error)
                towards = error @ after.value - prior_ * before.value
                after.step(error.T @ before.value)
                bias.step(error.sum(axis=0))
                before.step(towards)
    result = vectors.before.copy()
    for i, (before, *_) in enumerate(parts):
        result[own[i::apart]] = before.value
    return Vectors(result, after.value, bias.value)


_LEARNT = "place int, block int, ids binary, numbers binary, weight double"


def _block_round(shared):
    """One round of a block of first classes. Gives their vectors as one row of a place of its own,
    and those of all classes after, times what the block has seen, in rows of CLASS_STEP classes."""

    def learn(block: pa.Table) -> pa.Table:
        vectors, noise = shared.value
        which = block.column("block")[0].as_py()
        total = len(noise)
        pair = block.column("pair").to_numpy()
        own, row = np.unique(pair // total, return_inverse=True)
        pairs = np.zeros((len(own), total), dtype=np.float32)
        pairs[row, pair % total] = block.column("n").to_numpy()
        share = float(np.sqrt(pairs.sum(axis=1)).sum())
        found = contrast_steps(Vectors(*vectors), own, pairs, noise, STEPS)
        after = np.hstack([found.after, found.bias[:, None]]) * np.float32(share)
        rows = [(-1 - which, which, own.astype(np.int32).tobytes(), found.before[own].tobytes(), share)]
        for start in range(0, total, CLASS_STEP):
            rows.append((start // CLASS_STEP, which, b"", after[start : start + CLASS_STEP].tobytes(), share))
        return pa.table(dict(zip(["place", "block", "ids", "numbers", "weight"], map(pa.array, zip(*rows)))), _ARROW)

    return learn


_ARROW = pa.schema([("place", pa.int32()), ("block", pa.int32()), ("ids", pa.binary()), ("numbers", pa.binary()),
                    ("weight", pa.float64())])


def _averaged(rows: pa.Table) -> pa.Table:
    """What blocks have learnt about the same classes, summed in the order of the blocks."""
    if rows.num_rows == 1:
        return rows
    rows = rows.sort_by("block")
    numbers = rows.column("numbers")
    total = np.frombuffer(numbers[0].as_py(), np.float32).astype(np.float64)
    for other in numbers[1:]:
        total += np.frombuffer(other.as_py(), np.float32)
    first = rows.slice(0, 1).to_pylist()[0]
    first |= {"numbers": total.astype(np.float32).tobytes(), "weight": float(np.sum(rows.column("weight").to_numpy()))}
    return pa.Table.from_pylist([first], _ARROW)


def train(pairs: DataFrame, classes: Classes) -> tuple[Vectors, np.ndarray]:
    """Vectors from the counts (pair, n) of neighbouring classes, and each class's count.

    Rounds of local steps in blocks; the vectors that all blocks share are averaged by how much
    each has seen. What reaches the driver is the vectors of all classes, once a round.
    """
    spark = pairs.sparkSession
    total = classes.total
    totals = np.zeros(total)
    for row in pairs.groupBy((F.col("pair") % total).alias("b")).agg(F.sum("n").alias("n")).collect():
        totals[row.b] = row.n
    noise = (totals + 1) / (totals + 1).sum()
    vectors = _start(noise)
    contexts = max(1, min(BLOCK_CONTEXTS, BLOCK_CELLS // total))
    dealt = F.floor(F.col("pair") / total) % -(-total // contexts)
    blocks = pairs.withColumn("block", dealt.cast("int"))
    for _ in range(ROUNDS):
        shared = spark.sparkContext.broadcast((tuple(vectors), noise.astype(np.float32)))
        learnt = blocks.groupBy("block").applyInArrow(_block_round(shared), _LEARNT)
        rows = learnt.groupBy("place").applyInArrow(_averaged, _LEARNT).toArrow().to_pylist()
        if not rows:
            break
        before, both = vectors.before.copy(), np.zeros((total, DIMENSIONS + 1), dtype=np.float32)
        for row in rows:
            numbers = np.frombuffer(row["numbers"], np.float32)
            if row["place"] < 0:
                before[np.frombuffer(row["ids"], np.int32)] = numbers.reshape(-1, DIMENSIONS)
            else:
                start = row["place"] * CLASS_STEP
                both[start : start + CLASS_STEP] = numbers.reshape(-1, DIMENSIONS + 1) / np.float32(row["weight"])
        shared.destroy()
        vectors = Vectors(before, both[:, :-1].copy(), both[:, -1].copy())
    return vectors, totals


def norms(spark: SparkSession, vectors: Vectors) -> np.ndarray:
    """What all classes sum up to after each, as `Vectors.norms`, in tasks of bounded tables."""
    total = len(vectors.bias)
    at_once = max(1, STEP_CELLS // total)
    shared = spark.sparkContext.broadcast(tuple(vectors))

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in batch.column(0).to_pylist():
                found = Vectors(*shared.value).norms(slice(start, start + at_once))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(start, start + len(found)), pa.int64()), pa.array(found)], names=["class", "norm"]
                )

    rows = spark.range(0, total, at_once).mapInArrow(summed, "class bigint, norm double").toArrow()
    result = np.zeros(total)
    result[rows.column("class").to_numpy()] = rows.column("norm").to_numpy()
    return result


# --- scoring --------------------------------------------------------------------------------

# Words whose vectors are looked up at once.
_AT_ONCE = 16_384

_SCORED = "struct<n_tokens:bigint, n_known:bigint, classes:double, words:double, rare:array<bigint>>"


def _score_column(shared):
    """Per text: its tokens, the sum of the class probabilities and class sizes, the sum over its
    frequent words, and the hashes of all others."""

    @F.arrow_udf(_SCORED)
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        held = shared.value
        if "lexicon" not in held:
            held["lexicon"] = Lexicon(Frequent(*held["frequent"]), Classes(*held["of"]))
        vectors, norms_, sizes, lexicon = Vectors(*held["vectors"]), held["norms"], held["sizes"], held["lexicon"]
        for batch in batches:
            numbers, stops = lexicon.sequences(batch.to_pylist())
            starts = np.concatenate([[0], stops[:-1]])
            classes = lexicon.column("classes", np.int32)[numbers].astype(np.int64)
            last, this = classes[:-1], classes[1:]
            step = np.empty(len(this))
            for start in range(0, len(this), _AT_ONCE):
                part = slice(start, start + _AT_ONCE)
                step[part] = np.einsum("ij,ij->i", vectors.before[last[part]], vectors.after[this[part]])
            step += vectors.bias[this] - norms_[last]
            step /= np.log(10)
            step -= sizes[this]
            # What leads from one text to the next is no step; the end before a text no token.
            step[stops[:-1] - 1] = 0
            own = np.ones(len(numbers), dtype=bool)
            own[starts] = False
            common = lexicon.column("common", np.int8)[numbers].astype(bool)
            logs = lexicon.column("logs", np.float64)[numbers] * own
            rare = ~common & own
            yield pa.StructArray.from_arrays(
                [
                    pa.array(stops - starts - 1),
                    pa.array(np.add.reduceat((common & own).astype(np.int64), starts)),
                    pa.array(np.add.reduceat(step, starts)),
                    pa.array(np.add.reduceat(logs, starts)),
                    pa.ListArray.from_arrays(
                        pa.array(np.concatenate([[0], np.cumsum(np.add.reduceat(rare.astype(np.int64), starts))]), pa.int32()),
                        pa.array(lexicon.column("hashes", np.int64)[numbers[rare]], pa.int64()),
                    ),
                ],
                names=["n_tokens", "n_known", "classes", "words", "rare"],
            )

    return scored


def learnable(key: str = "doc_id") -> Column:
    return crc_mod(F.col(key), 10) != 0


def class_sizes(counts: DataFrame, shared, frequent: Frequent, classes: Classes) -> np.ndarray:
    """log10 of each class's smoothed total, unseen words as one more of the class. `shared` is the
    broadcast of the other two."""

    def sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, of = Frequent(*shared.value[0]), Classes(*shared.value[1])
        total = np.zeros((of.total, 2))
        for batch in batches:
            words = map(str.encode, batch.column("word").to_pylist())
            found = np.array([held.class_of(word, of) for word in words], dtype=np.int64)
            total[:, 0] += np.bincount(found, batch.column("n").to_numpy(), of.total)
            total[:, 1] += np.bincount(found, minlength=of.total)
        some = np.flatnonzero(total[:, 1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(some), pa.array(total[some, 0]), pa.array(total[some, 1])], names=["c", "n", "v"]
        )

    totals = np.zeros((classes.total, 2))
    summed = counts.select("word", "n").mapInArrow(sized, "c bigint, n double, v double")
    for row in summed.groupBy("c").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect():
        totals[row.c] = (row.n, row.v)
    # A word of its own class is that class; all others leave room for one unseen word.
    room = np.where(np.arange(classes.total) < classes.own, 0, 1)
    return np.log10(totals[:, 0] + SMOOTHING * np.maximum(totals[:, 1] + room, 1))


def scores(documents: DataFrame, learn: Column | None = None, key: str = "doc_id",
           text: str = "text") -> DataFrame:
    """Per row: held_out, n_tokens, n_known, train_tokens, base_score and score.

    Words beyond the frequent ones are joined with their counts and summed up per row again;
    counts are summed before that shuffle.
    """
    spark = documents.sparkSession
    small_batches(spark)
    learn = learnable(key) if learn is None else learn
    training = documents.where(learn)
    counts = word_counts(training, text)
    train_tokens, distinct = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    train_tokens = train_tokens or 0
    frequent = most_frequent(counts)
    classes = classes_for(train_tokens)
    told = spark.sparkContext.broadcast((tuple(frequent), tuple(classes)))
    pairs = training.select(F.col(text)).mapInArrow(_pair_counts(told), "pair bigint, n bigint")
    pairs = keep_table(pairs.groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    vectors, _ = train(pairs, classes)
    shared = spark.sparkContext.broadcast({
        "vectors": tuple(vectors), "norms": norms(spark, vectors), "frequent": tuple(frequent),
        "of": tuple(classes), "sizes": class_sizes(counts, told, frequent, classes),
    })
    scored = documents.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(key).alias("key"),
        (~learn).alias("held_out"),
        _score_column(shared)(F.col(text)).alias("s"),
    )
    scored = keep_table(scored.select("row", "key", "held_out", "s.*"), "scored")
    rare = scored.select("row", F.explode("rare").alias("hash"))
    seen = counts.select("hash", "n")
    joined = rare.join(seen, "hash", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    summed = joined.groupBy("row").agg(
        F.sum(F.log10(F.col("n") + SMOOTHING)).alias("rare_words"),
        F.count(F.when(F.col("n") > 0, 1)).alias("rare_known"),
    )
    words = F.col("words") + F.coalesce("rare_words", F.lit(0.0))
    norm = float(np.log10(train_tokens + SMOOTHING * (distinct + 1)))
    return scored.join(summed, "row", "left").select(
        F.col("key").alias(key),
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(train_tokens).cast("bigint").alias("train_tokens"),
        (words - F.col("n_tokens") * norm).alias("base_score"),
        (F.col("classes") + words).alias("score"),
    )
