"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are presences: of each word, its first four and five bytes, each pair of neighbours and each pair with one word
between. Per-coordinate rates let rare features move fast, and the L1 term leaves most weights at zero, so the model is
a few kilobytes, whatever the corpus holds. Training reads a bounded sample of the labelled rows in a fixed number of
parts, each fitted by one task, and averages their weights; scoring reads every whole text once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from depotflow.llm.common import training
from depotflow.llm.words import Slice, mix, sequences, slices, whole_runs
from depotflow.session import frozen

#: Training rows at most. Rows are taken by a hash of their id, so the sample is the same in every run.
SAMPLE = 24_000
PARTS = 2
PASSES = 8

#: Texts from this score on are rejected.
REJECTED = 0.7


@dataclass(frozen=True)
class Settings:
    bits: int = 20
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 4.0
    l2: float = 1.0


@dataclass(frozen=True)
class Model:
    """Weights of the features that have one, and the bias."""

    bias: float = 0.0
    places: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bits: int = 20

    def dense(self) -> np.ndarray:
        found = np.zeros(1 << self.bits)
        found[self.places] = self.weights
        return found


def features(part: Slice, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Owner and place of every feature of a slice, repetitions included."""
    words, owners = part.hashes(), part.owners
    kinds = [(words, owners)]
    kinds += [(mix(part.hashes(n) + np.uint64(n)), owners) for n in (4, 5)]
    near = whole_runs(part, 2)
    kinds.append((sequences(words, 2)[near], owners[:len(near)][near]))
    skip = whole_runs(part, 3)
    kinds.append((mix(words[:len(skip)] * np.uint64(3) + words[2:])[skip] if len(skip) else words[:0],
                  owners[:len(skip)][skip]))
    return (np.concatenate([own for _, own in kinds]),
            (np.concatenate([found for found, _ in kinds]) >> np.uint64(64 - bits)).astype(np.int64))


def _parted(part: Slice, bits: int) -> list[np.ndarray]:
    """The distinct features of each text of a slice."""
    owners, places = features(part, bits)
    order = np.argsort(owners, kind="stable")
    bounds = np.searchsorted(owners[order], np.arange(part.rows + 1))
    return [np.unique(places[order[a:b]]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def _fit(rows: pd.DataFrame, settings: Settings, passes: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and weights after some passes of FTRL-proximal over some rows; the last place is the bias."""
    size = 1 << settings.bits
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    known = [np.append(places, size).astype(np.int32)
             for part in slices(pa.array(rows["text"], pa.large_string())) for places in _parted(part.folded(), settings.bits)]
    labels, draw = rows["label"].to_numpy(), np.random.default_rng(1)

    def weights(places: np.ndarray) -> np.ndarray:
        own = z[places]
        # The bias, at the end, is free of the L1 term.
        free = np.abs(own) - np.where(places < size, settings.l1, 0.0)
        rate = (settings.beta + np.sqrt(n[places])) / settings.alpha + settings.l2
        return np.where(free > 0, -np.sign(own) * free / rate, 0.0)

    for _ in range(passes):
        for row in draw.permutation(len(known)):
            places = known[row]
            own = weights(places)
            slope = 1 / (1 + np.exp(-np.clip(own.sum(), -35, 35))) - labels[row]
            before = n[places]
            after = before + slope * slope
            z[places] += slope - (np.sqrt(after) - np.sqrt(before)) / settings.alpha * own
            n[places] = after
    found = weights(np.arange(size + 1))
    live = np.flatnonzero(found)
    return live, found[live]


def _fitter(settings: Settings, passes: int):
    def fit(group: pd.DataFrame) -> pd.DataFrame:
        # In an order of its own, so that neither partitioning nor arrival decides the weights.
        places, weights = _fit(group.fillna({"text": ""}).sort_values(["id", "label", "text"]), settings, passes)
        return pd.DataFrame({"place": places, "weight": weights})

    return fit


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", identity: str = "doc_id", text: str = "text",
          settings: Settings = Settings(), sample: int = SAMPLE, parts: int = PARTS, passes: int = PASSES) -> Model:
    """A model of ``labels`` (id, label) over the texts of ``docs``.

    Rows whose label is null or whose id the split holds out are not learned from. At most ``sample`` labelled rows are,
    those with the smallest hash of their id. Repeated labels count once; of several texts under one id the one with
    the smallest hash is learned from, so the bound holds for texts too. Without any row the model gives every text one
    half; with one class only, the bias says so.
    """
    chosen = labels.select(F.col(identity).alias("id"), F.col(label).cast("double").alias("label")).where(
        F.col("id").isNotNull() & F.col("label").isNotNull() & training("id")).distinct()
    chosen = chosen.orderBy(F.xxhash64("id"), "id", "label").limit(sample)
    rows = docs.select(F.col(identity).alias("id"), F.col(text).cast("string").alias("text"))
    # The sample is bounded, so the labels travel to the texts and not the other way round.
    rows = rows.join(F.broadcast(frozen(chosen)), "id").groupBy("id", "label").agg(
        F.min(F.struct(F.xxhash64("text").alias("hash"), F.col("text"))).alias("first"))
    rows = frozen(rows.select("id", "label", "first.text", F.pmod(F.xxhash64("id"), F.lit(parts)).alias("part")))
    fitted = rows.groupBy("part").applyInPandas(_fitter(settings, passes), "place long, weight double")
    size = 1 << settings.bits
    # The L1 term leaves a few hundred to a few thousand weights.
    found = dict(fitted.groupBy("place").agg((F.sum("weight") / parts).alias("weight")).collect())
    places = np.array(sorted(place for place in found if place < size), dtype=np.int64)
    return Model(found.get(size, 0.0), places, np.array([found[place] for place in places.tolist()]), settings.bits)


def chances(part: Slice, dense: np.ndarray, bias: float, bits: int) -> np.ndarray:
    """The model's probability for each text of a slice."""
    owners, places = features(part.folded(), bits)
    live = dense[places] != 0
    pairs = np.unique(owners[live] << bits | places[live])
    sums = np.bincount(pairs >> bits, weights=dense[pairs & ((1 << bits) - 1)], minlength=part.rows)
    return 1 / (1 + np.exp(-np.clip(sums + bias, -35, 35)))


def score(docs: DataFrame, model: Model, identity: str = "doc_id", text: str = "text") -> DataFrame:
    """Id and ``score``, 0 to 1, of every row of ``docs``.

    Null and empty texts have no feature and score what the bias says. Repeated rows score alike; other columns are left
    aside; an empty table stays empty.
    """
    kind = docs.schema[identity].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        dense = own.dense()
        for batch in batches:
            for part in slices(batch.column(1)):
                found = chances(part, dense, own.bias, own.bits)
                yield pa.RecordBatch.from_pydict(
                    {"id": batch.column(0).slice(part.first, part.rows), "score": pa.array(found)})

    rows = docs.select(F.col(identity).alias("id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", identity)


def judged(docs: DataFrame, labels: DataFrame, label: str = "toxic", identity: str = "doc_id", text: str = "text",
           least: float = REJECTED, **fit) -> dict[str, float]:
    """How settings do, told by rows that may be learned from: fitted on the rows whose checksum leaves no remainder by
    three, judged on those that leave 2. Labels of held-out rows are taken away before anything else.

    ``recall`` and ``false`` are the shares of the label's rows and of all others that score ``least`` or more,
    ``log_loss`` the mean over rows; nulls if there are no such rows. Other settings go to ``train``.
    """
    remainder = F.crc32(F.col(identity).cast("string")) % 3
    known = labels.select(identity, F.col(label).cast("int").alias("label")).dropna().where(training(identity)).distinct()
    model = train(docs, known.where(remainder == 0), "label", identity, text, **fit)
    others = known.where(remainder == 2)
    rows = score(docs.join(others, identity, "left_semi"), model, identity, text).join(others, identity)
    own, caught = F.col("label") == 1, F.col("score") >= least
    chance = F.greatest(F.when(own, F.col("score")).otherwise(1 - F.col("score")), F.lit(1e-6))
    return rows.agg(
        F.avg(F.when(own, caught.cast("int"))).alias("recall"), F.avg(F.when(~own, caught.cast("int"))).alias("false"),
        F.avg(-F.log(chance)).alias("log_loss")).first().asDict()


def accepted(docs: DataFrame, model: Model, text: str = "text", least: float = REJECTED) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text scores below ``least``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        dense = own.dense()
        for batch in batches:
            for part in slices(batch.column(place)):
                good = chances(part, dense, own.bias, own.bits) < least
                yield batch.slice(part.first, part.rows).filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)
