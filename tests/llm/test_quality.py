import random

import numpy as np
from pyspark.sql import functions as F

from depotflow.llm import quality
from depotflow.llm.common import training
from tests.llm.helpers import collected, documents, plain, sentence


def labelled(spark, n=500):
    draw = random.Random(8)
    docs, labels = [], []
    for number in range(n):
        own = sentence(draw, draw.randint(20, 80))
        if good := number % 3 != 0:
            text = own
        else:
            text = draw.choice([own.replace(" ", "### "), own.upper(), "buy now " * 30])
        docs.append((number, text))
        labels.append((number, int(good)))
    return plain(spark, docs), spark.createDataFrame(labels, "doc_id long, quality int"), dict(labels)


def test_held_out_rows_are_told_apart(spark):
    docs, labels, truth = labelled(spark)
    stats = quality.measured(docs)
    model = quality.train(stats, labels)
    rows = quality.score(stats, model).withColumn("held", ~training()).where("held").collect()
    assert sum((r.score >= quality.KEPT) == truth[r.doc_id] for r in rows) / len(rows) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)
    wrong = labels.withColumn("quality", F.when(training(), F.col("quality")).otherwise(1 - F.col("quality")))
    assert np.allclose(model.weights, quality.train(stats, wrong).weights)


def test_normal_equations_do_not_depend_on_partitions(spark):
    docs, labels, _ = labelled(spark, 200)
    one, many = (quality.train(quality.measured(docs.repartition(n)), labels) for n in (1, 9))
    found = quality.measured(docs).toPandas()[list(quality.STATISTICS)].to_numpy()
    assert np.allclose(one.score(found), many.score(found), atol=1e-6)


def test_isotonic_fit():
    values, weights = np.array([0.0, 0.4, 0.2, 0.9, 0.7, 0.8]), np.array([1.0, 1.0, 3.0, 1.0, 1.0, 2.0])
    fitted = quality._isotonic(values, weights)
    assert (np.diff(fitted) >= 0).all() and np.isclose((fitted * weights).sum(), (values * weights).sum())
    assert np.allclose(fitted, [0.0, 0.25, 0.25, 0.8, 0.8, 0.8])


def test_awkward_rows_no_labels_and_empty_tables(spark):
    docs, labels, _ = labelled(spark, 200)
    model = quality.train(quality.measured(docs), labels)
    stats = quality.measured(documents(spark))
    assert stats.count() == documents(spark).count()
    assert not any(np.isnan(r.score) for r in quality.score(stats, model).collect())
    assert quality.train(stats, labels.limit(0)) is None
    assert {r.score for r in quality.score(stats, None).collect()} == {0.5}
    assert collected(quality.score(quality.measured(documents(spark, [])), model)) == []
