import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from depotflow.llm import retrieval
from tests.llm.helpers import awkward_rows, documents, plain, sentence

TERM = re.compile(retrieval.TERM)
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(FOLD))


def brute(docs, items, k=10):
    held = [(n, Counter(terms(text))) for n, text in docs]
    held = [(n, c) for n, c in held if c]
    count, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    rows = []
    for item, text in sorted(set(items), key=repr):
        scored = []
        for place, (n, c) in enumerate(held):
            m = 25 + 75 * sum(c.values()) * count // total
            score = sum(math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1)))
                        * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms(text) if t in c)
            if score:
                scored.append((-score, n is None, n if n is not None else 0, place))
        rows += [(item, r, None if void else n, -s) for r, (s, void, n, _) in enumerate(sorted(scored)[:k], 1)]
    return sorted(rows, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def items_of(spark, rows):
    return spark.createDataFrame([(n, text, 1, 2) for n, text in rows], "item_id long, text string, rank int, score int")


def test_awkward_rows_beside_brute_force(spark):
    rows = awkward_rows()
    items = [(1, rows[0][1]), (1, rows[0][1]), (1, "line"), (2, "one ONE two. x"), (3, None), (4, ""), (5, "§"), (None, "a b w"),
             (6, "nowhere"), (7, "\x00\x01 line\x7fother"), (8, " ".join(r[1] or "" for r in rows))]
    got = found(retrieval.search(documents(spark, rows), items_of(spark, items)))
    assert got == brute([(r[0], r[1]) for r in rows], items)


@pytest.mark.parametrize("segment", [1, 400, 1 << 20])
def test_ties_segments_and_parts(spark, monkeypatch, segment):
    draw = random.Random(5)
    rows = [(n, sentence(draw, draw.randint(0, 30))) for n in range(300)]
    rows += [(900 + n, rows[7][1]) for n in range(40)] + [(n, rows[3][1]) for n in range(500, 520)]
    items = [(n, " ".join(rows[n * 9][1].split(" ")[:12])) for n in range(30)] + [(77, rows[7][1])]
    monkeypatch.setattr(retrieval, "SEGMENT", segment)
    monkeypatch.setattr(retrieval, "PAIRS", 50)
    assert found(retrieval.search(plain(spark, rows), items_of(spark, items))) == brute(rows, items)


def test_text_ids_and_fewer_results(spark):
    docs = spark.createDataFrame([("b", "red fox"), ("a", "red fox"), ("c", "owl")], "doc_id string, text string")
    items = spark.createDataFrame([("q", "fox")], "item_id string, text string")
    got = retrieval.search(docs, items, k=1).collect()
    assert [(r.item_id, r.rank, r.doc_id) for r in got] == [("q", 1, "a")]


def test_empty_tables(spark):
    docs, items = plain(spark, [(1, "red")]), items_of(spark, [(1, "red")])
    for d, i in ((docs.limit(0), items), (docs, items.limit(0)), (docs.limit(0), items.limit(0))):
        result = retrieval.search(d, i)
        assert result.columns == ["item_id", "rank", "doc_id", "score"] and not result.collect()


def test_best_positions_stop_before_the_end_of_the_lists():
    draw = np.random.default_rng(3)
    n_docs, n_slots = 5000, 6
    at = draw.random((n_slots, n_docs)) < 0.4
    slots, docs = np.nonzero(at)
    # Documents that rank high in one list do so in all: the case in which stopping early pays.
    impacts = (1000 / (1 + docs) * 1000 + draw.integers(0, 50, len(docs))).astype(np.int64)
    segment = retrieval.Segment(slots, docs, impacts, n_slots, n_docs)
    factors = np.array([5, 3, 2, 2, 1, 1])
    best, scores, read = segment.best(np.arange(n_slots), factors, 10, 0)
    whole = np.zeros(n_docs, dtype=np.int64)
    np.add.at(whole, docs, factors[slots] * impacts)
    order = np.lexsort((np.arange(n_docs), -whole))[:10]
    assert best.tolist() == order.tolist() and scores.tolist() == whole[order].tolist()
    assert read < len(docs) / 10
