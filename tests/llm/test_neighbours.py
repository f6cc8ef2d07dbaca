import math

import numpy as np

from depotflow.llm import neighbours
from depotflow.llm.neighbours import Settings, near_duplicates

SMALL = Settings(shard=60, mean=20, fan=6, chunk=64, degree=6, near=10, beam=4, fetch=60)
SCHEMA = "vec_id long, embedding array<float>, label int, point long, block string, copies long, links long"


def embeddings(spark, rows):
    return spark.createDataFrame([(n, v, 1, 2, "x", 3, 4) for n, v in rows], SCHEMA)


def brute(rows, least=0.95):
    unit = []
    for _, v in rows:
        good = v and all(x is not None and math.isfinite(x) for x in v) and any(v)
        unit.append(np.float32(v).astype(float) / np.linalg.norm(np.float32(v).astype(float)) if good else None)
    links = [[b for b in range(len(rows)) if a != b and unit[a] is not None and unit[b] is not None
              and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= least] for a in range(len(rows))]
    result, seen = [None] * len(rows), set()
    for start in range(len(rows)):
        if start not in seen:
            group, todo = {start}, [start]
            while todo:
                for b in links[todo.pop()]:
                    if b not in group:
                        group.add(b)
                        todo.append(b)
            seen |= group
            least_id = min((rows[g][0] for g in group if rows[g][0] is not None), default=None)
            for g in group:
                result[g] = (rows[g][0], len(links[g]), least_id, rows[g][0] == least_id)
    return sorted(result, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.drop("recall").collect()), key=repr)


def clustered(seed, n=150, dims=12):
    draw = np.random.default_rng(seed)
    rows = []
    for _ in range(n):
        centre = draw.normal(size=dims)
        for _ in range(draw.integers(1, 5)):
            rows.append((len(rows), (centre + draw.normal(size=dims) * 0.08).tolist()))
    return rows


def test_awkward_vectors_beside_brute_force(spark):
    rows = clustered(1, 40)
    hot = rows[5][1]
    rows += [(1000 + n, hot) for n in range(60)] + [(2000 + n, [x * (n + 2) for x in hot]) for n in range(90)]
    rows += [(3000, None), (3001, []), (3002, [0.0] * 12), (3003, [float("nan")] + hot[1:]), (3004, [float("inf")] + hot[1:]),
             (3005, [None] + hot[1:]), (3006, hot[:5]), (3007, hot[:5]), (None, hot), (None, None), (5, hot), (7, [1e-30] * 12),
             (3008, [3e38] * 12), (3008, [2.0] * 12)]
    assert found(near_duplicates(embeddings(spark, rows), settings=Settings(fetch=100))) == brute(rows)


def test_many_shards_beside_brute_force(spark):
    rows = clustered(2)
    rows += [(2000 + n, [x * (n + 2) for x in rows[5][1]]) for n in range(90)]
    result = near_duplicates(embeddings(spark, rows), settings=SMALL).cache()
    expected = brute(rows)
    linked = sum(r[1] for r in expected)
    assert linked > 300 and result.first().recall >= 0.97
    assert sum(r.n_links for r in result.collect()) >= 0.97 * linked
    # Nothing is linked that is not within range, and classes are never too large.
    truth = {r[0]: r for r in expected}
    assert all(r.n_links <= truth[r.vec_id][1] and r.component_id >= truth[r.vec_id][2] for r in result.collect())


def test_blocks_fetch_what_is_near_them_alone(spark, monkeypatch):
    """Random vectors have no neighbours to speak of, so a block has no business in most of the graph."""
    draw = np.random.default_rng(6)
    vectors = draw.normal(size=(1000, 24))
    vectors = np.concatenate([vectors, vectors[:150] + draw.normal(size=(150, 24)) * 0.1])
    rows = [(n, v.tolist()) for n, v in enumerate(vectors)]
    fetched, plain = spark.sparkContext.accumulator(0), neighbours._visit

    def counted(*args):
        visit = plain(*args)

        def count(queries, nodes):
            fetched.add(nodes.num_rows)
            return visit(queries, nodes)

        return count

    monkeypatch.setattr(neighbours, "_visit", counted)
    result = found(near_duplicates(embeddings(spark, rows), settings=SMALL))
    linked = sum(r[1] for r in brute(rows))
    assert linked >= 250 and sum(r[1] for r in result) >= 0.97 * linked
    assert fetched.value < 8 * len(rows)


def test_guests_meet_members_that_are_near():
    angles = np.array([0.0, 0.5, 1.0]), np.array([0.52, 3.0])
    members, guests = (np.stack([np.cos(a), np.sin(a)], axis=1) for a in angles)
    member, guest, alike = neighbours.meetings(members, guests, math.cos(0.3))
    assert (member.tolist(), guest.tolist()) == ([1], [0]) and np.allclose(alike, math.cos(0.02))
    assert not len(neighbours.meetings(members, guests[:0], 0.5)[0])


def test_audit_sees_what_a_search_has_missed(spark):
    rows = clustered(4, 60)
    points = embeddings(spark, rows).selectExpr("vec_id AS point", "embedding AS vec", "1L AS copies")
    nothing = points.selectExpr("point", "0L AS links")
    assert neighbours.audit(points, nothing) == 0.0
    whole = {r[0]: r[1] for r in brute(rows)}
    assert neighbours.audit(points, spark.createDataFrame(list(whole.items()), "point long, links long")) == 1.0


def test_empty_tables_and_nothing_usable(spark):
    nothing = embeddings(spark, [(1, None)])
    assert found(near_duplicates(nothing)) == [(1, 0, 1, True)]
    result = near_duplicates(nothing.limit(0))
    assert result.columns == ["vec_id", "n_links", "component_id", "kept", "recall"] and not result.collect()


def test_pruning_keeps_the_nearest_of_each_direction():
    angles = np.array([0.0, 0.1, 0.12, -0.3, 2.0])
    vectors = np.stack([np.cos(angles), np.sin(angles)], axis=1)
    alike = vectors @ vectors.T
    order = neighbours._nearest_first(alike, np.array([[1, 2, 3, 4, 4]] * 5))
    assert order[0].tolist() == [1, 2, 3, 4, -1]
    assert [x for x in neighbours._pruned(alike, order, 4, 1.2)[0] if x >= 0] == [1, 3, 4]
