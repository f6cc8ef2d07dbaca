"""Registered queries of the corpus operators, and the SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from depotflow.llm import (
    archives, decontamination, extraction, mixing, neighbours, ngrams, passages, prefixes, quality, retrieval, rules,
    sharding, toxicity,
)
from depotflow.llm.common import table, training
from depotflow.llm.words import WORD


def op1_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return ngrams.near_duplicates(table(spark, folder, "documents"))


def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    rows = rules.ledger(table(spark, folder, "documents"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~rules.keeps("base-1")).alias("base_failed"), rules.keeps("web-1").alias("kept"), "failures")


def op3_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.assign(table(spark, folder, "documents"), 40)


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    scores = toxicity.score(docs, toxicity.train(docs, table(spark, folder, "labels")))
    return _predicted(scores, toxicity.REJECTED)


def _predicted(scores: DataFrame, least: float) -> DataFrame:
    return scores.select(
        "doc_id", (~training()).alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted"))


def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.decontaminate(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op6_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return passages.dedup(table(spark, folder, "documents"))


def op7_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return extraction.extract(table(spark, folder, "pages"))


def op8_archive_conversion(spark: SparkSession, folder: str) -> DataFrame:
    return archives.round_trip(table(spark, folder, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    stats = quality.measured(table(spark, folder, "documents"))
    scores = quality.score(stats, quality.train(stats, table(spark, folder, "labels")))
    return _predicted(scores, quality.KEPT)


def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


def op11_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.near_duplicates(table(spark, folder, "embeddings")).drop("recall")


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefixes.trie(table(spark, folder, "conversations")).drop("node")


def op13_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return retrieval.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def _failures() -> str:
    return " + ".join(f"CASE WHEN {rule.broken} THEN {1 << bit} ELSE 0 END" for bit, rule in enumerate(rules.RULES))


RULES_SQL = f"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
split AS (
    SELECT r, doc_id, regexp_extract_all(text, '{WORD}') AS w,
           len(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
           list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines
    FROM docs),
runs AS (
    SELECT r, i, array_to_string(w[i:i + 4], ' ') AS run
    FROM (SELECT r, w, unnest(generate_series(1, len(w) - 4)) AS i FROM split WHERE len(w) >= 5)),
again AS (
    SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, run) AS times FROM runs) WHERE times > 1),
covered AS (
    SELECT r, count(DISTINCT i + j) AS n FROM again, generate_series(0, 4) t(j) GROUP BY r),
measured AS (
    SELECT doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: len(x))), 0) AS word_chars, n_symbols,
           len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
           len(lines) AS n_lines, len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z]|[^\\x00-\\x7F]'))) AS n_letter_words,
           len(list_filter(w, lambda x: regexp_matches(x, '[A-Z]') AND NOT regexp_matches(x, '[a-z]'))) AS n_capital_words
    FROM split LEFT JOIN covered USING (r)),
judged AS (SELECT *, ({_failures()})::BIGINT AS failures FROM measured)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       failures & {rules.POLICIES["base-1"]} <> 0 AS base_failed, failures & {rules.POLICIES["web-1"]} = 0 AS kept, failures
FROM judged
"""

ARCHIVE_SQL = """
WITH sized AS (
    SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
    FROM pages),
firsts AS (
    SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM sized)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND first IS DISTINCT FROM page_id AND first IS NOT NULL
            THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND first IS DISTINCT FROM page_id THEN first END AS refers_to
FROM firsts
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: build for name, build in list(globals().items()) if name.startswith("op")}

SQL = {"op1_ngram_jaccard": ngrams.SQL, "op2_quality_rules": RULES_SQL, "op6_substring_dedup": passages.SQL,
       "op7_html_extraction": extraction.SQL, "op8_archive_conversion": ARCHIVE_SQL, "op10_mixing": mixing.SQL,
       "op11_embedding_near_dedup": neighbours.SQL, "op12_prefix_trie": prefixes.SQL,
       "op13_ranked_search": retrieval.SQL}
