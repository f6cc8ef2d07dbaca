"""Operators beside brute force, with ties, NULLs and hot keys."""

from collections import Counter
from pathlib import Path
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from depotflow.functions import text
from depotflow.operators import division, grouping, joins, membership, numbering, sets
from depotflow.session import scratch, shared_folder

few = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
maybe = st.one_of(st.none(), st.integers(0, 4))


@few
@given(st.lists(st.integers(0, 30), min_size=1, max_size=60))
def test_numbers_are_gapless(spark, drawn):
    df = spark.createDataFrame([(v, i) for i, v in enumerate(drawn)], "v int, i int").repartition(3)
    found = numbering.number_rows(df, [F.col("v").desc(), F.col("i")], "nr", start=10).collect()
    order = sorted(found, key=lambda r: (-r.v, r.i))
    assert [r.nr for r in order] == list(range(10, 10 + len(drawn)))


@few
@given(st.lists(maybe, min_size=1, max_size=40))
def test_ranks_match_brute_force(spark, drawn):
    df = spark.createDataFrame([(v, i) for i, v in enumerate(drawn)], "v int, i int")
    # NULL sorts last in descending order.
    key = lambda v: (v is None, -(v or 0))
    for row in numbering.rank_values(df, "v").collect():
        before = [v for v in drawn if key(v) < key(row.v)]
        assert row.rang == len(before) + 1
        assert row.rang_dicht == len(set(before)) + 1


def test_numbering_with_a_hot_value(spark):
    df = spark.range(30000).select((F.col("id") % 3).cast("int").alias("rest"), F.col("id")).withColumn(
        "v", F.when(F.col("rest") == 0, 7).otherwise(F.col("id")))
    numbered = numbering.number_rows(df, [F.col("v"), F.col("id")], "nr")
    assert tuple(numbered.agg(F.min("nr"), F.max("nr"), F.countDistinct("nr")).first()) == (1, 30000, 30000)
    ranked = numbering.rank_values(df, "v", descending=False)
    hot = ranked.filter("v = 7").agg(F.count("*"), F.min("rang"), F.max("rang")).first()
    # 1, 2, 4 and 5 come before 7; 7 itself joins the 10000 hot rows.
    assert tuple(hot) == (10001, 5, 5)


@few
@given(st.lists(maybe, max_size=8), st.lists(maybe, max_size=5))
def test_not_in_follows_three_valued_logic(spark, left, right):
    a = spark.createDataFrame([(v,) for v in left], "x int")
    b = spark.createDataFrame([(v,) for v in right], "y int")
    found = Counter(r.x for r in membership.not_in(a, "x", b, "y").collect())
    if not right:
        expected = Counter(left)
    elif None in right:
        expected = Counter()
    else:
        expected = Counter(v for v in left if v is not None and v not in right)
    assert found == expected


@few
@given(st.lists(maybe, max_size=8), st.lists(maybe, max_size=8))
def test_unequal_counts(spark, left, right):
    a = spark.createDataFrame([(v,) for v in left], "k int")
    b = spark.createDataFrame([(v,) for v in right], "k int")
    found = sorted(((r.k, r.n) for r in membership.count_unequal(a, b, "k", "n").collect()), key=repr)
    count = lambda v: 0 if v is None else sum(w is not None and w != v for w in right)
    assert found == sorted(((v, count(v)) for v in left), key=repr)


pairs_of = st.lists(st.tuples(st.integers(0, 4), maybe), max_size=25)


@few
@given(pairs_of, st.lists(maybe, max_size=4))
def test_division_matches_nested_not_exists(spark, pairs, wanted):
    df = spark.createDataFrame(pairs, "c int, e int")
    elements = spark.createDataFrame([(w,) for w in wanted], "e int")
    found = sorted(r.c for r in division.divide(df, "c", "e", elements).collect())
    covers = lambda c: all(any(p == (c, w) and w is not None for p in pairs) for w in wanted)
    assert found == sorted({c for c, _ in pairs if covers(c)})
    assert sorted(r.c for r in division.divide_by_bits(df, "c", "e", elements).collect()) == found


def shuffled_rows(df):
    """Rows that the finished plan of ``df`` has written to shuffles."""
    df.collect()

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if "QueryStage" in name:
            return walk(node.plan())
        own = node.metrics().apply("shuffleRecordsWritten").value() if name == "Exchange" else 0
        children = node.children()
        return own + sum(walk(children.apply(i)) for i in range(children.size()))

    return walk(df._jdf.queryExecution().executedPlan())


def test_division_by_bits_shuffles_words_not_pairs(spark):
    """One candidate holds a third of all pairs; words of several hundred elements."""
    pairs = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40).alias("c"), (F.col("id") % 700).alias("e"))
    wanted = spark.range(700).select(F.col("id").alias("e"))
    plain, bits = (build(pairs, "c", "e", wanted) for build in (division.divide, division.divide_by_bits))
    assert shuffled_rows(bits) * 4 < shuffled_rows(plain)
    assert sorted(r.c for r in bits.collect()) == sorted(r.c for r in plain.collect()) == [0]


def test_written_keys_follow_the_broadcast_limit(spark):
    facts, keys = spark.range(1000), spark.range(0, 1000, 100)
    few = membership.only_in(facts, keys, "id", unique=True, measured=True)
    assert "BroadcastHashJoin" in few._jdf.queryExecution().executedPlan().toString()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        many = membership.only_in(facts, keys, "id", unique=True, measured=True)
        assert "SortMergeJoin" in many._jdf.queryExecution().executedPlan().toString()
        assert few.count() == many.count() == 10
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_texts_meet_whatever_their_case(spark):
    left = spark.createDataFrame([("Hamburg",), ("hamburg ",), ("Ulm",), (None,), ("Jena",)], "ort string")
    right = spark.createDataFrame([("HAMBURG",), ("jena  ",), ("Jena",), (None,)], "ort string")
    found = lambda df: sorted((r.ort for r in df.collect()), key=str)
    assert found(sets.union_texts(left, right, "ort")) == ["HAMBURG", "Jena", None, "Ulm"]
    assert found(sets.except_texts(left, right, "ort")) == ["Ulm"]
    assert found(sets.intersect_texts(left, right, "ort")) == ["Hamburg", "Jena", None]
    met = joins.count_partners(left, right.withColumnRenamed("ort", "wo"), "ort", "wo", "n")
    assert sorted((r.ort, r.n) for r in met.collect()) == [("Hamburg", 1), ("Jena", 2), ("hamburg ", 1)]


def test_german_order(spark):
    names = spark.createDataFrame([(n,) for n in ("Zwickau", "Österreich", "arm", "Ärmel", "Gera", "Hof")], "n string")
    order = [r.n for r in numbering.number_rows(names, [text.alphabetic("n")], "nr").orderBy("nr").collect()]
    assert order == ["arm", "Ärmel", "Gera", "Hof", "Österreich", "Zwickau"]
    assert sorted(r.n for r in names.filter(text.text_between("n", "A", "G")).collect()) == ["arm", "Ärmel"]


def test_scratch_folders_are_removed(spark):
    folder = Path(shared_folder(spark, "x").removeprefix("file:")).parent
    before = set(folder.glob("*"))
    with scratch(spark):
        rows = numbering.number_rows(spark.range(100), [F.col("id").desc()], "nr")
        assert rows.agg(F.max("nr")).first()[0] == 100
        assert len(set(folder.glob("*")) - before) == 1
    assert set(folder.glob("*")) == before


def test_division_by_every_row(spark):
    pairs = spark.createDataFrame([(1, 1), (1, 2), (1, 2), (2, 1)], "c int, e int")
    table = spark.createDataFrame([(1,), (2,)], "e int")
    assert [r.c for r in division.with_every(pairs, "c", "e", table).collect()] == [1]


@few
@given(st.lists(st.tuples(maybe, st.integers(0, 99)), max_size=30, unique_by=lambda t: t[1]))
def test_partners_describe_all_pairs(spark, members):
    found = joins.partners_by_group(spark.createDataFrame(members, "g int, k int"), "g", "k").collect()
    pairs = {(a.k, b.k) for a in found for b in found if a.g == b.g and a.position < b.position}
    assert pairs == {(a[1], b[1]) for a in members for b in members if a[0] is not None and a[0] == b[0] and a[1] < b[1]}
    for row in found:
        assert row.partner == sum(p[0] == row.k for p in pairs)


@few
@given(st.lists(st.integers(0, 6), max_size=12), st.lists(maybe, max_size=5, unique=True))
def test_outer_joins(spark, facts, keys):
    dimension = spark.createDataFrame([(k, f"d{k}") for k in keys], "k int, name string")
    fact = spark.createDataFrame([(k, i) for i, k in enumerate(facts)], "k int, i int")

    def same(found, how):
        expected = dimension.join(fact, "k", how)
        assert Counter(map(tuple, found.select(*expected.columns).collect())) == Counter(map(tuple, expected.collect()))

    same(joins.left_from_dimension(dimension, fact, "k"), "left")
    same(joins.full_outer(dimension, fact, "k"), "full")


def test_cascade_of_levels(spark):
    a = spark.createDataFrame([(1,), (2,), (3,)], "x int")
    b = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "x int, y int")
    c = spark.createDataFrame([(10, 5), (20, 6)], "y int, z int")
    d = spark.createDataFrame([(6,)], "z int")
    assert [r.x for r in membership.in_cascade(a, *(membership.Level(*l) for l in ((b, "x"), (c, "y"), (d, "z", True)))).collect()] == [2]


def test_hot_join_key_is_split(spark):
    """A key that holds a third of the facts is read by several tasks."""
    settings_ = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name, None) for name in settings_}
    try:
        for name, value in settings_.items():
            spark.conf.set(name, value)
        keys = F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 5000)
        fact = spark.range(0, 300000, 1, 16).select(keys.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
        dimension = spark.range(5000).select(F.col("id").alias("k"), F.lit("d").alias("name"))
        for df in (dimension.join(fact, "k"), joins.full_outer(dimension, fact, "k"),
                   joins.left_from_dimension(dimension, fact, "k"), membership.only_in(fact, dimension, "k"), membership.where_exists(fact, dimension, "k")):
            assert df.count() == 300000
            rows = df.select(F.sum(F.length("v")))
            rows.collect()
            assert "skew=true" in rows._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_inner_rows_of_exists_are_reduced(spark):
    """Facts on the inner side are grouped before they are shuffled, so a hot key is one row per task."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = spark.range(1000).select((F.col("id") % 7).alias("k"))
        found = membership.where_exists(spark.range(20).select(F.col("id").alias("k")), fact, "k")
        assert found.count() == 7
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "partial_count" in plan and "LeftSemi" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_subtotals_match_plain_cube(spark):
    df = spark.range(500).select((F.col("id") % 3).alias("a"), (F.col("id") % 4).alias("b"), F.col("id").alias("v"))
    plain = df.cube("a", "b").agg(F.sum("v").alias("s"), F.grouping_id().cast("int").alias("ebene"))
    found = grouping.cube_sum(df, ["a", "b"], "v", "s")
    assert Counter(map(tuple, found.collect())) == Counter(map(tuple, plain.collect()))


def test_invalid_aggregates_are_refused(star):
    with pytest.raises(AnalysisException):
        star.spark.sql("SELECT max(lmenge), lnr FROM {t}", t=star.lieferung)
    with pytest.raises(AnalysisException):
        star.spark.sql("SELECT lstadt, max(status) FROM {t} WHERE avg(status) > 15 GROUP BY lstadt", t=star.lieferant)


def test_subquery_with_two_rows_fails(star):
    place = star.artikel.select("astadt").scalar()
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        star.lieferant.filter(F.col("lstadt") == place).collect()


def test_sketched_levels_are_near_the_exact_counts(spark):
    from depotflow.operators import grouping

    df = spark.range(30000).selectExpr("id % 3 AS a", "id % 4 AS b", "id % 20011 AS x").unionByName(
        spark.createDataFrame([(None, 1, None), (None, 1, 7)], "a long, b long, x long"))
    for how in ("rollup", "cube"):
        exact = {(r.a, r.b, r.g): r.n for r in getattr(df, how)("a", "b").agg(
            F.countDistinct("x").alias("n"), F.grouping_id().alias("g")).collect()}
        found = {(r.a, r.b, r.ebene): r.n for r in grouping.level_distinct(df, ["a", "b"], "x", "n", how).collect()}
        assert found.keys() == exact.keys()
        assert all(abs(found[key] - n) <= 0.08 * n for key, n in exact.items())
        assert found[(None, 1, 0)] == 1
