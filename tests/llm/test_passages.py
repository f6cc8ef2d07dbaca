import hashlib
import random
from collections import Counter

from hypothesis import HealthCheck, given, settings, strategies as st

import pyarrow as pa

from depotflow import session
from depotflow.llm import passages
from depotflow.llm.words import slices
from tests.llm.helpers import awkward_rows, documents, plain, sentence, words

N = passages.WINDOW


def brute(rows):
    counts = Counter(tuple(w[i:i + N]) for w in (words(t) for _, t in rows) for i in range(len(w) - N + 1))
    found = []
    for n, text in rows:
        w = words(text)
        gone = {j for i in range(len(w) - N + 1) if counts[tuple(w[i:i + N])] > 1 for j in range(i, i + N)}
        left = " ".join(x for j, x in enumerate(w) if j not in gone)
        found.append((n, len(w), len(gone), hashlib.sha256(left.encode()).hexdigest()))
    return sorted(found, key=repr)


def found(df):
    return sorted((tuple(r) for r in passages.dedup(df).select(
        "doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=repr)


def test_awkward_rows(spark):
    assert found(documents(spark)) == brute([(r[0], r[1]) for r in awkward_rows()])


def test_overlapping_repeats_with_cut_ends(spark):
    """Pieces of one stream, so that repeats begin and end anywhere and copies share parts with others."""
    draw = random.Random(5)
    stream = sentence(draw, 400).split(" ")
    rows = []
    for n in range(60):
        a = draw.randrange(340)
        rows.append((n, " ".join([sentence(draw, draw.randint(0, 30)), *stream[a:a + draw.randint(30, 90)],
                                  sentence(draw, draw.randint(0, 30))])))
    rows += [(100, rows[0][1]), (101, rows[0][1]), (102, "a b " * 60), (103, "c " * 34), (104, "d " * 35), (105, "e " * 36)]
    assert found(plain(spark, rows)) == brute(rows)


@settings(max_examples=30, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(st.lists(st.sampled_from("ab"), min_size=36, max_size=120), st.integers(0, 40))
def test_equal_windows_choose_the_same_anchor(drawn, shift):
    text = " ".join(drawn)
    moved = " ".join(["z"] * shift + drawn)
    (one,), (two,) = (list(slices(pa.array([t]))) for t in (text, moved))
    places = []
    for part, offset in ((one, 0), (two, shift)):
        first, last, anchor = passages.anchors(part)
        places.append({s - offset: a for f, l, a in zip(first, last, anchor) for s in range(f, l + 1) if s >= offset})
    assert places[0] == places[1]
    assert len(places[0]) == len(drawn) - N + 1


def test_texts_under_one_id_whose_short_hashes_agree(spark):
    """Pairs of these texts share a 32-bit hash, as some do among many rows with null ids."""
    shared = " ".join(f"p{n}" for n in range(40))
    texts = [f"w{n} " * (n % 50 + 1) + shared for n in (42894, 77251, 31434, 118523, 2521, 36020)]
    frame = plain(spark, [(None, t) for t in texts])
    assert frame.selectExpr("hash(text) AS h").distinct().count() == 3
    for n in (None, 7):
        rows = [(n, t) for t in texts]
        assert found(plain(spark, rows)) == brute(rows)


def test_kept_texts(spark):
    draw = random.Random(9)
    shared = sentence(draw, 40)
    rows = [(1, f"begin {shared} end"), (2, f"other {shared}")]
    texts = {r.kid: r.kept_text for r in passages.repeats(plain(spark, rows)).collect()}
    assert texts == {1: "begin end", 2: "other"}


def test_texts_that_share_short_runs_alone_are_no_candidates(spark):
    """Runs of nine words recur, but no window does, so nothing of these texts is written or moved again."""
    draw = random.Random(3)
    shared = [sentence(draw, 9) for _ in range(6)]
    rows = [(n, " ".join(f"{sentence(draw, 40)} {run}" for run in shared)) for n in range(8)]
    docs = plain(spark, rows)
    assert not passages._marked(passages._keyed(docs, "doc_id", "text")).count()
    assert found(docs) == brute(rows)


def test_tables_on_the_way_do_not_stay(spark):
    passage = sentence(random.Random(4), 80)
    rows = [(1, passage), (2, f"some {passage} more"), (3, " ".join(passage.split(" ")[10:60])), (4, "short")]
    before = set(session._folders)
    result = passages.dedup(plain(spark, rows))
    # The candidates' texts and the repeated windows, which the result still reads.
    assert len(set(session._folders) - before) == 2
    assert sorted((tuple(r) for r in result.collect()), key=repr) == brute(rows)


def test_spans_shared_by_some_places_of_an_anchor(spark):
    """Copies whose passages agree around an anchor for a while: each span is had by two texts, the anchor by four."""
    draw = random.Random(8)
    core, one, two = sentence(draw, 50), sentence(draw, 60), sentence(draw, 60)
    rows = [(n, f"{sentence(draw, 20)} {core} {tail} {sentence(draw, 20)}") for n, tail in enumerate([one, one, two, two, ""])]
    assert found(plain(spark, rows)) == brute(rows)


def test_empty_table(spark):
    assert found(documents(spark, [])) == []


def test_text_ids(spark):
    passage = sentence(random.Random(9), 40)
    docs = spark.createDataFrame([("a", f"one {passage}"), ("b", f"{passage} two"), ("c", "three"), (None, passage)],
                                 "doc_id string, text string")
    found = {r.doc_id: (r.n_words, r.n_removed) for r in passages.dedup(docs).collect()}
    assert found == {"a": (41, 40), "b": (41, 40), "c": (1, 0), None: (40, 40)}
