"""A corpus from raw documents: toxic ones go, one of each group of near duplicates stays, leaks of benchmarks go,
sources are mixed to their targets, and the mix is dealt to shards.

Every stage takes the documents that the stage before it kept and works on all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from depotflow.llm import decontamination, mixing, ngrams, sharding, toxicity
from depotflow.llm.common import ship, table
from depotflow.session import frozen

SHARDS = 40


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.accepted(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return ngrams.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_rows(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.assign(docs, SHARDS)


STAGES = [
    ("toxicity", without_toxic),
    ("ngram_jaccard", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
    ("sharding", sharded),
]

#: Neither the model nor the hashes can be said in SQL; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for place, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = frozen(docs)
    return docs
