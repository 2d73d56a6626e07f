"""Quality scores: a kernel ridge classifier on document statistics, calibrated.

Each text is described by a few shares and counts (letters, capitals, symbols, repeated words and
lines, ...). Random Fourier features stand in for a Gaussian kernel over them. Every task sums the
normal equations of its rows, the sums are added per row of the matrix, and ridge weights are
solved from them. Isotonic regression on labelled rows that the fit did not see turns the result
into a probability.

The fit takes at most SAMPLE labelled rows, chosen by hash; scores cover every row. Null and empty
texts have all statistics zero and are scored like others. Labels without id or value are left
out; of several labels of an id the mean decides, half counting as good. Labels of one kind only
give that kind's share as every score, no labels 0.5. Repeated rows score alike, equal raw scores too. Texts
of any length are described whole. An empty table gives no rows. Columns other than the key and the
text take no part in a score and pass through `good_only`, whatever their names.
"""

from __future__ import annotations

import math
import sys
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tocsin.llm.common import crc_mod, free_name, keep_table, small_batches

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Labelled rows that the fit may use, features of the kernel, ridge.
SAMPLE = 40_000
FEATURES = 256
RIDGE = 1e-3
SEED = 11

# Tasks that sum the normal equations; the sample is bounded, and so are its tasks.
FIT_TASKS = 12

# A quarter of the sample calibrates.
CALIBRATE_ONE_IN = 4


def _byte_kinds() -> np.ndarray:
    """Kind of each byte: lower, upper, digit, space, line end, sentence mark, bar, other symbol,
    part of a longer character."""
    kinds = np.full(256, 7, dtype=np.uint8)
    kinds[128:] = 8
    for kind, members in enumerate(
        (range(97, 123), range(65, 91), range(48, 58), b" \t", b"\r\n", b".,;:'\"?-()", b"|")
    ):
        kinds[list(members)] = kind
    return kinds


_KINDS = _byte_kinds()
_SPACE = frozenset(" \t\n\r\x0b\x0c")


def _repeats(items: list) -> tuple[float, float]:
    """Share of items that occurred before, and the most frequent one's share."""
    if not items:
        return 0.0, 0.0
    counts = Counter(items)
    return 1 - len(counts) / len(items), max(counts.values()) / len(items)


def statistics(text: str | None) -> list[float]:
    """What a text is judged by. Counts enter as logarithms, all else as shares."""
    if not text:
        return [0.0] * WIDTH
    raw = text.encode()
    kinds = np.bincount(_KINDS[np.frombuffer(raw, np.uint8)], minlength=9) / len(raw)
    words = text.split()
    lines = [line for line in text.split("\n") if line.strip()]
    n = max(1, len(words))
    twice = sum(map(str.__eq__, words, words[1:])) / n
    capitals = sum(map(str.isupper, words)) / n
    wordy = sum(map(str.isalpha, [w.rstrip(".,;:?!") for w in words])) / n
    again, most = _repeats(words)
    pairs_again, _ = _repeats(list(zip(words, words[1:])))
    lines_again, _ = _repeats(lines)
    return [
        *kinds,
        np.log1p(len(words)),
        np.log1p(len(lines)),
        np.log1p(len(words) / max(1, len(lines))),
        len(raw) / n / 10,
        twice,
        capitals,
        wordy,
        again,
        most,
        pairs_again,
        lines_again,
    ]


WIDTH = 20


class Model(NamedTuple):
    """Standardisation, kernel features, weights, and the steps of the calibration."""

    mean: np.ndarray
    spread: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    steps: np.ndarray
    levels: np.ndarray

    def features(self, rows: np.ndarray) -> np.ndarray:
        scaled = np.clip((rows - self.mean) / self.spread, -8, 8)
        waves = np.cos(scaled @ self.directions + self.phases) * np.sqrt(2 / FEATURES)
        return np.hstack([waves, scaled, np.ones((len(rows), 1))])

    def raw(self, rows: np.ndarray) -> np.ndarray:
        return self.features(rows) @ self.weights

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Calibrated, with a trace of the raw value so that equal levels stay in order."""
        if not self.weights.any():
            return np.full(len(rows), self.levels[0])
        raw = self.raw(rows)
        return 0.98 * np.interp(raw, self.steps, self.levels) + 0.02 / (1 + np.exp(-8 * (raw - 0.5)))


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: the mean x and the level of each pool."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []
    for value, target in zip(x[order], y[order]):
        pools.append([value, target, 1.0])
        while len(pools) > 1 and pools[-2][1] >= pools[-1][1]:
            (x2, y2, n2), (x1, y1, n1) = pools.pop(), pools.pop()
            n = n1 + n2
            pools.append([(x1 * n1 + x2 * n2) / n, (y1 * n1 + y2 * n2) / n, n])
    found = np.array(pools)
    return found[:, 0], found[:, 1]


def _statistics_column():
    @F.arrow_udf("array<double>")
    def described(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([statistics(t.as_py()) for t in batch], pa.list_(pa.float64()))

    return described


def _rows(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, WIDTH)


def _normal_equations(model: Model):
    """Each task's sums, a row of the matrix and of the right-hand side at a time."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            features = model.features(_rows(batch.column("statistics")))
            target = batch.column("good").to_numpy()
            sums = np.hstack([features.T @ features, (features.T @ target)[:, None]])
            total = sums if total is None else total + sums
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(total)), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))],
                names=["i", "sums"],
            )

    return add


def _added(rows: pa.Table) -> pa.Table:
    sums = np.array(rows.column("sums").to_pylist()).sum(axis=0)
    return pa.table({
        "i": rows.column("i").slice(0, 1),
        "sums": pa.array([sums.tolist()], pa.list_(pa.float64())),
    })


def _labelled(labels: DataFrame, learn: Column, key: str) -> DataFrame:
    """One row per key that may be learnt from; of several labels most decide."""
    return (
        labels.where(F.col(key).isNotNull() & F.col("quality").isNotNull())
        .groupBy(key)
        .agg((F.avg("quality") >= 0.5).cast("double").alias("good"))
        .where(learn)
    )


def _part(key: str) -> Column:
    """The place of a key in a sample, out of 2 to the 20th."""
    return F.pmod(F.xxhash64(F.col(key), F.lit(SEED)), F.lit(1 << 20))


def _sampled(known: int, sample: int) -> int:
    """Places up to here make a sample of that size."""
    return math.ceil((1 << 20) * min(1.0, sample / max(1, known)))


def fit(described: DataFrame, labels: DataFrame, learn: Column, key: str = "doc_id",
        sample: int = SAMPLE) -> Model:
    """From (key, statistics) of all rows and (key, quality); `learn` says which keys may be
    learnt from."""
    joined = keep_table(described.join(_labelled(labels, learn, key), key), "labelled")
    part = _part(key)
    chosen = joined.where(part < _sampled(joined.count(), sample))
    chosen = chosen.repartition(FIT_TASKS, key).select(
        "statistics", "good", (part % CALIBRATE_ONE_IN == 0).alias("calibrate")
    )
    values = [F.col("statistics")[i] for i in range(WIDTH)]
    moments = chosen.agg(*map(F.avg, values), *map(F.stddev_pop, values), F.avg("good")).first()
    numbers = np.array([m if m is not None else 0.0 for m in moments], dtype=float)
    mean, spread, share = numbers[:WIDTH], numbers[WIDTH:-1], moments[-1]
    random = np.random.default_rng(SEED)
    model = Model(
        mean,
        np.maximum(spread, 1e-6),
        random.normal(0, 1 / np.sqrt(WIDTH), (WIDTH, FEATURES)),
        random.uniform(0, 2 * np.pi, FEATURES),
        np.zeros(FEATURES + WIDTH + 1),
        np.array([0.0]),
        np.array([0.5 if share is None else share]),
    )
    if share is None or share in (0.0, 1.0):
        return model
    parts = chosen.where("NOT calibrate").mapInArrow(_normal_equations(model), "i int, sums array<double>")
    sums = parts.groupBy("i").applyInArrow(_added, "i int, sums array<double>").collect()
    if not sums:
        return model
    system = np.array([row.sums for row in sorted(sums, key=lambda row: row.i)])
    matrix, right = system[:, :-1], system[:, -1]
    rows = matrix[-1, -1]
    model = model._replace(
        weights=np.linalg.solve(matrix + RIDGE * rows * np.eye(len(matrix)), right)
    )
    # At most a quarter of the sample, a bounded number of rows.
    kept = chosen.where("calibrate").select("statistics", "good").toPandas()
    if not len(kept):
        return model._replace(steps=np.array([0.0, 1.0]), levels=np.array([0.0, 1.0]))
    steps, levels = isotonic(model.raw(np.array(kept.statistics.tolist())), kept.good.to_numpy())
    return model._replace(steps=steps, levels=levels)


def _score_column(model: Model):
    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(model.score(_rows(batch)), pa.float64())

    return scored


def learnable(key: str = "doc_id") -> Column:
    return crc_mod(F.col(key), 3) != 1


def train(documents: DataFrame, labels: DataFrame, key: str = "doc_id",
          text: str = "text") -> tuple[Model, DataFrame]:
    """The model, and the statistics of all rows that it was fitted on."""
    small_batches(documents.sparkSession)
    described = keep_table(
        documents.select(F.col(key), _statistics_column()(F.col(text)).alias("statistics")), "statistics"
    )
    return fit(described, labels, learnable(key), key), described


def scores(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Score of each row between 0 and 1, and whether it counts as good."""
    model, described = train(documents, labels, key, text)
    return described.select(
        key,
        (~learnable(key)).alias("held_out"),
        _score_column(model)(F.col("statistics")).alias("score"),
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def good_only(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
              sample: int = SAMPLE) -> DataFrame:
    """The documents that count as good, with all their columns. The fit describes no texts but
    those of its sample; to be scored, each text is described where it is."""
    small_batches(documents.sparkSession)
    known = documents.select(key).join(_labelled(labels, learnable(key), key), key).count()
    some = documents.where(learnable(key) & (_part(key) < _sampled(known, sample)))
    some = some.join(_labelled(labels, learnable(key), key).select(key), key, "left_semi")
    described = some.select(F.col(key), _statistics_column()(F.col(text)).alias("statistics"))
    model = fit(keep_table(described, "statistics"), labels, learnable(key), key, sample)
    score = free_name(documents, "quality_score")
    scored = documents.withColumn(score, _score_column(model)(_statistics_column()(F.col(text))))
    return scored.where(F.col(score) >= 0.5).drop(score)
