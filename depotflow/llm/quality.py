"""Quality by kernel ridge regression on statistics of a document, with random Fourier features, then calibrated.

Every text is reduced to a few statistics once. Random cosines of the standardised statistics approximate a Gaussian
kernel; their normal equations are summed inside the partitions and then over them, so the driver solves a system whose
size is the number of features, however many rows are learned from. An isotonic fit on counts per bin of the raw score
turns it into a probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from depotflow.llm import rules
from depotflow.llm.common import training
from depotflow.llm.words import Slice, mix, slices
from depotflow.session import frozen

FEATURES = 128
WIDTH = 2.5
RIDGE = 1e-3
BINS = 512
LOW, HIGH = -0.5, 1.5

#: Texts from this score on are kept.
KEPT = 0.5

_MARKS = {name: np.isin(np.arange(256), [ord(c) for c in signs]).astype(np.int64)
          for name, signs in (("stops", ".,;:?"), ("cries", "!"), ("bars", "|"), ("digits", "0123456789"))}
STATISTICS = ("words", "word_length", "symbols", "repeated_lines", "repeated_words", "letters", "capitals", "lines",
              "distinct", *_MARKS)


def statistics(part: Slice) -> np.ndarray:
    """Texts by statistics. Ratios of a text without words are 0."""
    found = rules.measure(part)
    words = np.maximum(found["n_words"], 1)
    keys = np.unique(mix(part.hashes() ^ mix(part.owners.astype(np.uint64) + np.uint64(1))), return_index=True)[1]
    columns = [
        np.log1p(found["n_words"]), found["word_chars"] / words, found["n_symbols"] / words,
        found["n_dup_lines"] / np.maximum(found["n_lines"], 1), found["n_repeat_words"] / words,
        found["n_letter_words"] / words, found["n_capital_words"] / words, np.log1p(found["n_lines"]),
        np.bincount(part.owners[keys], minlength=part.rows) / words,
        *(part.per_text(marks[part.data]) / words for marks in _MARKS.values()),
    ]
    return np.stack(columns, axis=1)


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch.column(1)):
            found = statistics(part)
            yield pa.RecordBatch.from_pydict({"id": batch.column(0).slice(part.first, part.rows)} | {
                name: pa.array(found[:, place]) for place, name in enumerate(STATISTICS)})


def measured(docs: DataFrame, identity: str = "doc_id", text: str = "text") -> DataFrame:
    """Statistics of every row, written down once; ``id`` is the row's id."""
    kind = docs.schema[identity].dataType.simpleString()
    rows = docs.select(F.col(identity).alias("id"), F.col(text).cast("string").alias("text"))
    return frozen(rows.mapInArrow(_statistics, f"id {kind}, " + ", ".join(f"{name} double" for name in STATISTICS)))


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    steps: np.ndarray
    chances: np.ndarray

    def raw(self, found: np.ndarray) -> np.ndarray:
        return cosines((found - self.mean) / self.scale) @ self.weights

    def score(self, found: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(found), self.steps, self.chances), 0, 1)


def cosines(found: np.ndarray, features: int = FEATURES, width: float = WIDTH) -> np.ndarray:
    """Random Fourier features of standardised statistics, a constant, and the statistics themselves."""
    draw = np.random.default_rng(7)
    slopes = draw.normal(scale=1 / width, size=(found.shape[1], features))
    phases = draw.uniform(0, 2 * np.pi, size=features)
    held = np.clip(found, -8, 8)
    waves = np.sqrt(2 / features) * np.cos(held @ slopes + phases)
    return np.concatenate([waves, held, np.ones((len(found), 1))], axis=1)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([batch.column(name).to_numpy(zero_copy_only=False) for name in STATISTICS], axis=1)


def _isotonic(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Non-decreasing values next to the given ones, by pooling neighbours that are out of order."""
    blocks: list[list[float]] = []
    for value, weight in zip(values, weights, strict=True):
        blocks.append([value, weight, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            last, before = blocks.pop(), blocks.pop()
            total = last[1] + before[1]
            blocks.append([(last[0] * last[1] + before[0] * before[1]) / total, total, last[2] + before[2]])
    return np.concatenate([np.full(int(n), value) for value, _, n in blocks])


def train(stats: DataFrame, labels: DataFrame, label: str = "quality", identity: str = "doc_id") -> Model | None:
    """A model of ``labels`` (id, label) over ``measured`` statistics, from all labelled rows that the split leaves.

    Null ids and labels are not learned from; repeated labels count as often as they occur. None if there are no rows.
    """
    size = len(STATISTICS)
    known = labels.select(F.col(identity).alias("id"), F.col(label).cast("double").alias("label")).where(
        F.col("id").isNotNull() & F.col("label").isNotNull() & training("id"))
    rows = frozen(stats.join(known, "id").select("label", *STATISTICS))
    moments = rows.agg(F.count(F.lit(1)), *map(F.avg, STATISTICS), *map(F.stddev_pop, STATISTICS)).first()
    if not moments[0]:
        return None
    mean = np.array(moments[1:size + 1], dtype=float)
    scale = np.array(moments[size + 1:], dtype=float)
    scale = np.where(scale > 1e-9, scale, 1.0)
    width = FEATURES + size + 1

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((width, width + 1))
        for batch in batches:
            waves = cosines((_matrix(batch) - mean) / scale)
            labels = batch.column("label").to_numpy(zero_copy_only=False)
            sums += waves.T @ np.concatenate([waves, labels[:, None]], axis=1)
        yield pa.RecordBatch.from_pydict({"cell": pa.array(np.arange(sums.size)), "value": pa.array(sums.ravel())})

    # As many rows as the system has cells, whatever the input.
    cells = rows.mapInArrow(equations, "cell long, value double").groupBy("cell").agg(
        F.sum("value").alias("value")).toPandas().sort_values("cell")["value"].to_numpy().reshape(width, width + 1)
    ridge = np.eye(width) * RIDGE * moments[0]
    ridge[-1, -1] = 1e-9
    weights = np.linalg.lstsq(cells[:, :-1] + ridge, cells[:, -1], rcond=None)[0]
    first = Model(mean, scale, weights, np.array([0.0]), np.array([0.5]))

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"raw": pa.array(first.raw(_matrix(batch))), "label": batch.column("label")})

    place = F.least(F.greatest(F.floor((F.col("raw") - LOW) / (HIGH - LOW) * BINS), F.lit(0)), F.lit(BINS - 1))
    bins = rows.mapInArrow(raw, "raw double, label double").groupBy(place.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("label").alias("share"), F.avg("raw").alias("centre")).toPandas()
    bins = bins.sort_values("bin")
    chances = _isotonic(bins["share"].to_numpy(), bins["n"].to_numpy(dtype=float))
    return Model(mean, scale, weights, bins["centre"].to_numpy(), chances)


def score(stats: DataFrame, model: Model | None, identity: str = "doc_id") -> DataFrame:
    """Id and ``score``, 0 to 1, of every measured row; one half throughout without a model.

    Null and empty texts are scored by their statistics, which are 0. Repeated rows score alike; an empty table stays
    empty.
    """
    kind = stats.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.full(batch.num_rows, 0.5) if model is None else model.score(_matrix(batch))
            yield pa.RecordBatch.from_pydict({"id": batch.column("id"), "score": pa.array(found)})

    return stats.mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", identity)
