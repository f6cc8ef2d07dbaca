import random

import pytest
from pyspark.sql import functions as F

from depotflow.llm import toxicity
from depotflow.llm.common import training
from tests.llm.helpers import collected, documents, plain, sentence

BAD = ["zorp", "glimbo", "snurfing"]


def labelled(spark, n=600, seed=4):
    draw = random.Random(seed)
    docs, labels = [], []
    for number in range(n):
        own = sentence(draw, draw.randint(5, 60)).split(" ")
        toxic = number % 4 == 0
        if toxic:
            for _ in range(3):
                own.insert(draw.randrange(len(own)), draw.choice(BAD))
        docs.append((number, " ".join(own)))
        labels.append((number, int(toxic)))
    return plain(spark, docs), spark.createDataFrame(labels, "doc_id long, toxic int"), dict(labels)


@pytest.fixture(scope="module")
def fitted(spark):
    docs, labels, truth = labelled(spark)
    return docs, labels, truth, toxicity.train(docs, labels, settings=toxicity.Settings(l1=1.0))


def test_held_out_rows_are_told_apart(spark, fitted):
    docs, _, truth, model = fitted
    rows = toxicity.score(docs, model).withColumn("held", ~training()).where("held").collect()
    assert len(rows) > 100
    right = sum((r.score >= 0.5) == truth[r.doc_id] for r in rows)
    assert right / len(rows) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_weights_are_sparse_and_runs_agree(spark, fitted):
    docs, labels, _, model = fitted
    assert 0 < len(model.places) < 1 << 14
    again = toxicity.train(docs.repartition(7), labels.repartition(3), settings=toxicity.Settings(l1=1.0))
    assert collected(toxicity.score(docs, model)) == collected(toxicity.score(docs, again))


def test_held_out_labels_are_not_learned_from(spark, fitted):
    docs, labels, _, model = fitted
    wrong = labels.withColumn("toxic", F.when(training(), F.col("toxic")).otherwise(1 - F.col("toxic")))
    other = toxicity.train(docs, wrong, settings=toxicity.Settings(l1=1.0))
    assert (model.places == other.places).all() and (model.weights == other.weights).all()


def test_accepted_rows_keep_their_columns(spark, fitted):
    *_, model = fitted
    docs = documents(spark)
    kept = toxicity.accepted(docs, model)
    assert kept.columns == docs.columns
    scores = [r.score for r in toxicity.score(docs, model).collect()]
    assert kept.count() == sum(s < toxicity.REJECTED for s in scores)


def test_null_labels_no_labels_and_empty_tables(spark, fitted):
    docs, labels, _, model = fitted
    none = toxicity.train(docs, labels.withColumn("toxic", F.lit(None).cast("int")))
    assert {r.score for r in toxicity.score(documents(spark), none).collect()} == {0.5}
    assert toxicity.score(documents(spark, []), model).count() == 0
    assert toxicity.score(documents(spark), model).count() == documents(spark).count()


def test_one_hot_id_does_not_break_the_bound(spark, fitted):
    docs, labels, _, _ = fitted
    hot = next(r.doc_id for r in labels.where(training()).orderBy(F.xxhash64("doc_id")).limit(1).collect())
    extra = plain(spark, [(hot, f"text number {n}") for n in range(500)])
    seen = []
    original, toxicity.frozen = toxicity.frozen, lambda df: seen.append(original(df)) or seen[-1]
    try:
        toxicity.train(docs.unionByName(extra), labels.unionByName(labels), sample=50)
    finally:
        toxicity.frozen = original
    assert [df.count() for df in seen] == [50, 50]


def test_weights_equal_a_plain_ftrl(spark):
    import numpy as np
    import pandas as pd
    import pyarrow as pa

    docs, _, truth = labelled(spark, 60)
    rows = pd.DataFrame([(r.doc_id, truth[r.doc_id], r.text) for r in docs.collect()], columns=["id", "label", "text"])
    settings, passes = toxicity.Settings(l1=0.5, alpha=0.7, beta=1.3, l2=0.4), 3
    size = 1 << settings.bits
    known = [[*places.tolist(), size] for part in toxicity.slices(pa.array(rows["text"], pa.large_string()))
             for places in toxicity._parted(part.folded(), settings.bits)]
    z, n, draw = {}, {}, np.random.default_rng(1)

    def weight(place):
        own, bound = z.get(place, 0.0), settings.l1 if place < size else 0.0
        if abs(own) <= bound:
            return 0.0
        return -np.sign(own) * (abs(own) - bound) / ((settings.beta + n.get(place, 0.0) ** 0.5) / settings.alpha + settings.l2)

    for _ in range(passes):
        for row in draw.permutation(len(known)):
            own = {place: weight(place) for place in known[row]}
            slope = 1 / (1 + np.exp(-sum(own.values()))) - rows["label"][row]
            for place, w in own.items():
                before = n.get(place, 0.0)
                n[place] = before + slope * slope
                z[place] = z.get(place, 0.0) + slope - (n[place] ** 0.5 - before ** 0.5) / settings.alpha * w
    expected = {place: weight(place) for place in z if weight(place)}
    places, weights = toxicity._fit(rows, settings, passes)
    assert set(places.tolist()) == set(expected)
    assert np.allclose(weights, [expected[place] for place in places.tolist()])


def test_settings_are_judged_without_held_out_labels(spark, fitted):
    docs, labels, _, _ = fitted
    settings = toxicity.Settings(l1=1.0)
    found = toxicity.judged(docs, labels, settings=settings)
    assert found["recall"] > 0.8 and found["false"] < 0.05 and found["log_loss"] < 0.3
    wrong = labels.withColumn("toxic", F.when(training(), F.col("toxic")).otherwise(1 - F.col("toxic")))
    assert toxicity.judged(docs, wrong, settings=settings) == pytest.approx(found)
