from collections import Counter, defaultdict

from pyspark.sql import functions as F

from depotflow.llm import mixing
from depotflow.session import frozen
from tests.llm.helpers import awkward_rows, collected, documents, words


def brute_targets(sizes, share=1.5, most=2):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weights = {name: (5, 2, 1)[n % 3] for n, name in enumerate(names)}
    total, open_, goal = share * sum(sizes.values()), set(names), {}
    while open_:
        level = (total - sum(goal.values())) / sum(weights[n] for n in open_)
        over = [n for n in open_ if level * weights[n] > most * sizes[n]]
        if not over:
            goal |= {n: level * weights[n] for n in open_}
            break
        goal |= {n: most * sizes[n] for n in over}
        open_ -= set(over)
    return goal


def test_targets_and_taken_words(spark):
    rows = awkward_rows()
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(words(r[1]))
    goal = brute_targets(sizes)
    found = mixing.mix(documents(spark).withColumn("source", F.col("source"))).collect()
    assert sorted((repr(r.doc_id), r.size) for r in found) == sorted((repr(r[0]), len(words(r[1]))) for r in rows)
    assert all(0 <= r.taken <= 2 * r.size for r in found)
    by_size = defaultdict(int)
    for r in found:
        by_size[(r.source_size, round(r.target, 6))] += r.taken
    expected = Counter()
    for source, target in goal.items():
        expected[(sizes[source], round(target, 6))] += int(target + 1e-6)
    assert by_size == expected


def test_blocks_cut_documents_like_one_long_stream(spark):
    docs = documents(spark)
    assert collected(mixing.mix(docs, block=7)) == collected(mixing.mix(docs, block=100_000))


def test_schedule_is_even_and_complete(spark):
    sizes = spark.createDataFrame([("=a", 5000), ("=b", 900), ("=c", 70), ("", 40_000)],
                                  "source_key string, source_size long")
    planned = frozen(mixing._planned(mixing.targets(sizes), 16))
    need = {r.source_key: r.slots for r in planned.collect()}
    slots = mixing.schedule(spark, planned, 16).collect()
    ranks = defaultdict(list)
    for r in sorted(slots, key=lambda r: (r.position, r["rank"])):
        ranks[r.source_key].append(r["rank"])
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in need.items()}
    total, seen = sum(need.values()), Counter()
    for place, r in enumerate(sorted(slots, key=lambda r: r.position), start=1):
        seen[r.source_key] += 1
        assert all(abs(seen[k] - place * n / total) < 12 for k, n in need.items())


def test_rows_are_repeated_as_often_as_taken(spark):
    docs = documents(spark)
    taken = [(r.doc_id, round(r.taken / r.size + 1e-9)) for r in mixing.mix(docs).collect() if r.taken]
    found = mixing.mixed_rows(docs)
    assert found.columns == docs.columns
    counts = Counter(r.doc_id for r in found.collect())
    expected = Counter()
    for n, times in taken:
        expected[n] += times
    assert counts == +expected


def test_reruns_agree_and_empty_tables(spark):
    docs = documents(spark)
    assert collected(mixing.mix(docs)) == collected(mixing.mix(docs.repartition(5)))
    assert mixing.mix(documents(spark, [])).count() == 0
    assert mixing.mixed_rows(documents(spark, [])).count() == 0
    silent = documents(spark, [r for r in awkward_rows() if not words(r[1])])
    assert [r.taken for r in mixing.mix(silent).collect()] == [0] * silent.count()


def test_no_python_on_the_path(spark):
    plan = mixing.mix(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
