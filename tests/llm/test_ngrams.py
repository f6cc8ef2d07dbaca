import random
from collections import defaultdict

import numpy as np
import pytest

from depotflow.llm import ngrams
from depotflow.llm.components import components
from tests.llm.helpers import awkward_rows, documents, plain, sentence, words


def grams(text):
    w = words(text)
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}


def brute(rows):
    """(class id, links, copies) of each (doc_id, text), by comparing all pairs of texts."""
    texts = sorted({t for _, t in rows if words(t)})
    sets = [grams(t) for t in texts]
    near = defaultdict(set)
    for a in range(len(texts)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if 5 * both >= 4 * (len(sets[a]) + len(sets[b]) - both):
                near[a].add(b)
                near[b].add(a)
    ids = {t: [n for n, u in rows if u == t] for t in texts}
    found = {}
    for start in range(len(texts)):
        seen, open_ = {start}, [start]
        while open_:
            for other in near[open_.pop()] - seen:
                seen.add(other)
                open_.append(other)
        members = [n for t in seen for n in ids[texts[t]] if n is not None]
        found[texts[start]] = (min(members, default=None), len(near[start]), len(ids[texts[start]]))
    return sorted(((n, *(found[t] if words(t) else (n, 0, 1))) for n, t in rows), key=repr)


def found(df, **options):
    rows = ngrams.near_duplicates(df, **options).collect()
    return sorted(((r.doc_id, r.class_id, r.n_links, r.n_copies) for r in rows), key=repr)


@pytest.mark.parametrize("identity", [None, 7])
def test_copies_under_one_id_are_fetched_once(spark, monkeypatch, identity):
    fetched, write = [], ngrams.frozen

    def watched(df):
        kept = write(df)
        if df.columns == ["text_key", "text", "buckets"]:
            fetched.append(kept.count())
        return kept

    monkeypatch.setattr(ngrams, "frozen", watched)
    text = sentence(random.Random(3), 60)
    rows = [(identity, text)] * 20 + [(identity, text + " more")] * 20
    assert found(plain(spark, rows)) == brute(rows)
    assert fetched == [2]


def test_banding_reaches_the_recall():
    plan = ngrams.banding(0.8, 0.9995, 100)
    assert plan.bands * plan.rows <= 100
    assert 1 - (1 - 0.8 ** plan.rows) ** plan.bands >= 0.9995


def test_awkward_rows(spark):
    rows = [(r[0], r[1]) for r in awkward_rows()]
    assert found(documents(spark)) == brute(rows)


@pytest.mark.parametrize("block", [4, 1000])
def test_a_group_of_near_copies_in_blocks(spark, block):
    draw = random.Random(3)
    base = sentence(draw, 80).split(" ")
    rows = [(n, sentence(draw, 60)) for n in range(10)]
    for n in range(40):
        own = list(base)
        for _ in range(draw.randint(0, 3)):
            own[draw.randrange(80)] = sentence(draw, 1)
        rows.append((100 + n, " ".join(own)))
    assert found(plain(spark, rows), block=block) == brute(rows)


def test_one_of_each_class_stays(spark):
    docs = documents(spark)
    rows = [(r[0], r[1]) for r in awkward_rows()]
    kept = ngrams.one_of_each(docs)
    assert kept.columns == docs.columns
    classes = {(n, c) for n, c, _, _ in brute([(n, t) for n, t in rows if words(t)])}
    silent = [(n, t) for n, t in rows if not words(t)]
    own = kept.collect()
    assert len([r for r in own if not words(r.text)]) == len(silent)
    spoken = [r for r in own if words(r.text)]
    assert {r.doc_id for r in spoken} <= {c for _, c in classes}
    texts = [r.text for r in spoken]
    assert len(set(texts)) == len(texts)


def test_links_of_sets():
    sets = [np.arange(10), np.arange(9), np.arange(100, 110), np.arange(0)]
    assert [tuple(map(int, p)) for p in np.argwhere(ngrams.links(sets[:3]))] == [(0, 1), (1, 0)]


def test_components_of_a_path_and_loops(spark):
    edges = [(n, n + 1) for n in range(0, 60)] + [(70, 70), (80, 81), (81, 80), (None, 3)]
    roots = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert roots == {n: 0 for n in range(61)} | {80: 80, 81: 80}


def test_empty_table(spark):
    assert found(documents(spark, [])) == []
    assert ngrams.one_of_each(documents(spark, [])).count() == 0
