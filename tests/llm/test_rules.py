from collections import Counter

from pyspark.sql import functions as F

from depotflow.llm import rules
from tests.llm.helpers import awkward_rows, collected, documents, words


def brute(text):
    w = words(text)
    runs = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if runs[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines = [line for line in (text or "").split("\n") if words(line)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)),
            len(covered), len(lines))


def test_measurements(spark):
    found = rules.ledger(documents(spark)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
    assert collected(found) == sorted(((r[0], *brute(r[1])) for r in awkward_rows()), key=repr)


def test_policies_and_ablation(spark):
    ledger = rules.ledger(documents(spark)).withColumn("kept", rules.keeps("web-1"))
    for row in ledger.collect():
        broken = row.n_words < 10 or 100 * row.n_repeat_words > 20 * row.n_words
        assert broken == bool(row.failures & rules.POLICIES["base-1"])
        assert row.kept == (row.failures & rules.POLICIES["web-1"] == 0)
    rows = {r.rule: (r.failed, r.only_this) for r in rules.ablation(ledger, "web-1").collect()}
    found = [r.failures & rules.POLICIES["web-1"] for r in ledger.collect()]
    for name, bit in rules.BITS.items():
        if rules.POLICIES["web-1"] >> bit & 1:
            assert rows[name] == (sum(f >> bit & 1 for f in found), sum(f == 1 << bit for f in found))
    assert len(rows) == bin(rules.POLICIES["web-1"]).count("1")


def test_empty_table(spark):
    empty = rules.ledger(documents(spark, []))
    assert empty.count() == 0
    assert rules.ablation(empty, "web-2").agg(F.sum("failed")).first()[0] == 0
