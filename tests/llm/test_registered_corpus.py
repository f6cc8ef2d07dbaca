"""Registered corpus queries beside their SQL, and the pipeline stage by stage on stored tables."""

from collections import Counter
from pathlib import Path

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from depotflow.llm import mixing, queries, toxicity
from depotflow.session import frozen
from tests.compare import compare, oracle
from tests.llm.helpers import words
from tests.llm.test_ngrams import brute

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no stored tables")


@pytest.fixture(scope="module")
def connection():
    return oracle(FOLDER)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_queries_beside_their_sql(spark, connection, name):
    assert compare(spark, connection, queries.QUERIES[name], queries.SQL[name], FOLDER) is None


def test_all_are_registered():
    names = entry.queries()
    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES} == set(range(1, 14))
    assert set(queries.QUERIES) < set(names) and names["pipeline"] is corpus_pipeline.run


def test_every_stage(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    columns = docs.columns

    model = toxicity.train(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    mild = frozen(stages["toxicity"](spark, docs, FOLDER))
    scores = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert {r.doc_id for r in mild.collect()} == {n for n, s in scores.items() if s < toxicity.REJECTED}

    single = frozen(stages["ngram_jaccard"](spark, mild, FOLDER))
    expected = {n if c is None else c for n, c, _, _ in brute([(r.doc_id, r.text) for r in mild.collect()])}
    assert sorted(r.doc_id for r in single.collect()) == sorted(expected)

    clean = frozen(stages["decontamination"](spark, single, FOLDER))
    items = [" ".join(words(r.text)) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    whole = {r.doc_id for r in single.collect() if any(i in " ".join(words(r.text)) for i in items)}
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in single.collect()} - whole

    mix = frozen(stages["mixing"](spark, clean, FOLDER))
    times = {r.doc_id: int(r.taken / r.size + 0.5) for r in mixing.mix(clean).collect() if r.size}
    assert Counter(r.doc_id for r in mix.collect()) == +Counter(times)
    assert all(df.columns == columns for df in (mild, single, clean, mix))

    shards = stages["sharding"](spark, mix, FOLDER)
    assert Counter(r.doc_id for r in shards.collect()) == Counter(r.doc_id for r in mix.collect())
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, FOLDER).collect()) == sorted(
        tuple(r) for r in shards.collect())
