import random

import numpy as np
import pyarrow as pa
import pytest

from depotflow.llm import decontamination as d
from depotflow.llm.words import slices
from tests.llm.helpers import documents, plain, sentence


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def ascii_upper(text):
    return "".join(c.upper() if c.isascii() else c for c in text)


@pytest.fixture(scope="module")
def planted():
    draw = random.Random(2)
    tests = [(n, f"{sentence(draw, draw.randint(15, 90))}?\n{sentence(draw, draw.randint(1, 8))}.") for n in range(40)]
    docs = [(n, sentence(draw, draw.randint(5, 700))) for n in range(60)]
    truth = set()
    for n, (item, text) in enumerate(tests):
        words = docs[n][1].split(" ")
        place = draw.randrange(len(words))
        docs[n] = (n, " ".join([*words[:place], ascii_upper(text) if n % 3 else text.replace(" ", "  "), *words[place:]]))
        truth.add((n, item))
    return tests, docs, truth


def test_planted_items_are_found_and_nothing_else(spark, planted):
    tests, docs, truth = planted
    rows = d.decontaminate(plain(spark, docs), items(spark, tests)).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == truth
    assert all(r.score >= d.THRESHOLD and r.question_overlap == r.answer_overlap == 1 for r in rows)


def test_parts_of_the_index_give_the_same(spark, planted):
    tests, docs, truth = planted
    parts = d.index_parts(items(spark, tests), part=300)
    assert len(parts) > 3 and sum(len(p.items) for p in parts) == len(tests)
    found = {(r.doc_id, r.item_id) for p in parts for r in d.leaks(plain(spark, docs), p).collect()}
    assert found == truth


def test_pruning_loses_no_passage_above_the_threshold(spark, planted):
    """Every passage against every item, without bounds."""
    tests, docs, _ = planted
    index, = d.index_parts(items(spark, tests))
    weight = {}
    for t, (a, b) in enumerate(zip(index.bounds[:-1], index.bounds[1:])):
        for at in range(a, b):
            weight.setdefault(int(index.terms[t]), {})[int(index.item[at])] = index.share[at]
    for threshold in (0.05, 0.3, 0.7):
        found, expected = set(), set()
        for part in slices(pa.array([t for _, t in docs])):
            folded = part.folded()
            rows, which, _ = d.retrieve(folded, index, threshold)
            found |= {(part.first + int(r), int(i)) for r, i in zip(rows, which)}
            hashes = folded.hashes()
            for row in range(folded.rows):
                own = hashes[folded.words[row]:folded.words[row + 1]]
                for begin in range(0, max(1, len(own)), index.stride):
                    terms = np.unique(own[begin:begin + 2 * index.stride])
                    scores = np.zeros(len(index.items))
                    for term in terms.tolist():
                        for item, share in weight.get(term, {}).items():
                            scores[item] += share
                    expected |= {(part.first + row, int(i)) for i in np.flatnonzero(scores >= threshold + 1e-12)}
        assert expected <= found
        assert len(found) <= len(expected) + 1


def test_question_and_answer():
    assert d.split_item("What is it? A thing.") == ("What is it?", "A thing.")
    assert d.split_item("One.\nTwo three.\nFour") == ("One.\nTwo three.", "Four")
    assert d.split_item("single") == ("single", "")
    assert d.split_item(" \n ") == ("", "")


def test_clean_rows_keep_their_columns(spark, planted):
    tests, docs, truth = planted
    frame = plain(spark, docs)
    kept = d.clean(frame, items(spark, tests))
    assert kept.columns == frame.columns
    assert {r.doc_id for r in kept.collect()} == {n for n, _ in docs} - {n for n, _ in truth}


def test_awkward_rows_and_empty_tables(spark, planted):
    tests, docs, _ = planted
    odd = items(spark, [*tests, (None, "a b c d e f"), (7, None), (8, ""), (9, "?"), tests[0]])
    assert d.decontaminate(documents(spark), odd).where("item_id IS NOT NULL").count() == 0
    assert d.clean(documents(spark), odd).count() == documents(spark).count()
    assert d.decontaminate(documents(spark), items(spark, [])).count() == 0
    assert d.clean(documents(spark), items(spark, [])).count() == documents(spark).count()
    assert d.decontaminate(documents(spark, []), odd).count() == 0
