"""Near duplicates among vectors by one flat proximity graph.

Vectors are dealt to overlapping shards by nearest pivots, again and again until every shard is small. Each shard builds
a graph: every vector's nearest are pruned robustly, so that of several neighbours in one direction the nearest stays
and far ones remain as long edges. Vectors that have a shard among their next nearest are linked into its graph where they
are near a vector of it, so that pairs which a border parts still meet. The adjacency lists of all shards are united. Then the vectors of each shard search
the graph together: the block starts at the medoids of the shards its vectors touch and at its own nodes, and fetches
neighbours in rounds of joins. What a round fetches is compared with the whole block in double precision; it is expanded
if it is within range of some vector of the block, or among the nearest of one so far and within reach of it. Edges know
their length, so neighbours that the triangle inequality puts out of reach are not fetched. So the search goes on as long
as the range grows, and a block fetches what is near it, however large the graph is. Found links are counted where they
are found; of linked pairs only a spanning forest leaves a task.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from depotflow.llm.common import ship
from depotflow.llm.components import components
from depotflow.llm.words import mix
from depotflow.session import frozen

LEAST = 0.95


class Settings(NamedTuple):
    """``shard``: most members of a shard; with its guests it may have four times as many rows. ``mean``: what a split aims at, before overlap. ``fan``: most pivots of a
    split. ``chunk``: rows of a shard that one task deals at a time. ``degree``, ``near``, ``alpha``: edges left by
    pruning, candidates it starts from, and how much nearer a kept neighbour must be to replace another. ``beam``: nearest
    of a vector that are expanded, in range or not. ``fetch``: nodes a block gets in one round; others wait.
    """

    shard: int = 4096
    mean: int = 1024
    fan: int = 64
    chunk: int = 16384
    degree: int = 24
    near: int = 64
    alpha: float = 1.2
    beam: int = 6
    fetch: int = 8192


#: One less the cosine of vectors that are all but equal.
SAME = 1e-5
#: A vector is member of the shards of its two nearest pivots, and guest in those of the next.
MEMBER, NEAREST = 2, 4
#: Edges at most between a guest and members, or a member and some thousand guests.
MET = 4
#: Vectors that the audit compares with all others.
AUDITED = 512
#: Recall below which the search is repeated without a reach, and then with twice the beam, at most so many times.
RECALL, REPEATS = 0.97, 3
#: A reach that leaves nothing out.
ENDLESS = math.pi


def narrow(least: float) -> float:
    """Twice the angle of ``least``: as far may a vector be from what is within range of one it links with."""
    return min(ENDLESS, 2 * math.acos(min(1.0, max(-1.0, least))))


def usable(vector: str = "vec") -> Column:
    """Not null, not empty, no component null or not finite, and not all zero."""
    finite = F.forall(vector, lambda x: F.coalesce((x > float("-inf")) & (x < float("inf")), F.lit(False)))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Unit vectors in double precision; all rows have one length."""
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(whole):
        return np.zeros((0, 1))
    rows = whole.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(whole), -1)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _deal(level: int):
    def deal(rows: pa.Table, pivots: pa.Table) -> pa.Table:
        # The last chunks may be empty by chance of the hash; pivots then come alone.
        if not rows.num_rows:
            return rows.select(["point", "vec", "shard", "home", "member"])
        vectors, centres = _matrix(rows["vec"]), _matrix(pivots["vec"])
        points, places = rows["point"].to_numpy(), pivots["place"].to_numpy()
        centres = centres[np.argsort(places)]
        # Vectors that are as near to several pivots are spread over them.
        salt = mix(points.astype(np.uint64)[:, None] ^ mix(np.arange(len(centres), dtype=np.uint64) + np.uint64(level << 32))[None, :])
        near = vectors @ centres.T + (salt >> np.uint64(44)) * 1e-15
        first, home = near.argmax(axis=1), rows["home"].to_numpy(zero_copy_only=False)
        # Only what is at home here goes to further shards too, so a vector has three copies more for each level.
        member, homes = rows["member"].to_numpy(zero_copy_only=False), np.flatnonzero(home)
        further = np.argsort(-near[homes], axis=1)[:, 1:NEAREST]
        take = np.append(np.arange(len(points)), np.repeat(homes, further.shape[1]))
        at, ranks = np.append(first, further.ravel()), np.tile(np.arange(1, further.shape[1] + 1), len(homes))
        names = rows["shard"].take(pa.array(take)).to_pylist()
        return pa.table({
            "point": pa.array(points[take]), "vec": rows["vec"].take(pa.array(take)),
            "shard": pa.array([f"{name}.{n}" for name, n in zip(names, at.tolist(), strict=True)], pa.string()),
            "home": pa.array(np.append(home, np.zeros(len(ranks), dtype=bool))),
            "member": pa.array(np.append(member, ranks < MEMBER))})

    return deal


def sharded(points: DataFrame, settings: Settings) -> DataFrame:
    """``point``, ``vec``, ``shard``, ``home``, ``member``: every point in its home shard and, for each level of splits, a
    member of one more and a guest of two.

    A shard that is too large is dealt by the nearest of ``fan`` of its own points, in chunks of bounded size; what is at
    home in it goes to the next nearest too, so shards overlap along every border that a split has drawn.
    """
    kind = points.schema["vec"].dataType.simpleString()
    rows = points.select("point", "vec", F.size("vec").cast("string").alias("shard"), F.lit(True).alias("home"),
                         F.lit(True).alias("member"))
    done, level = None, 0
    while True:
        # Guests take part in no comparison of all with all, so they weigh a quarter.
        sizes = frozen(rows.groupBy("shard").agg(F.count("*").alias("n"), F.greatest(
            F.count_if("member"), F.ceil(F.count("*") / 4)).alias("weight")))
        small = rows.join(sizes.where(F.col("weight") <= settings.shard).select("shard"), "shard").select(
            "point", "vec", "shard", "home", "member")
        done = small if done is None else done.unionByName(small)
        large = sizes.where(F.col("weight") > settings.shard)
        if large.isEmpty():
            return done
        large = large.select(
            "shard", F.least(F.lit(settings.fan), F.ceil(F.col("weight") / settings.mean)).alias("fan"),
            F.ceil(F.col("n") / settings.chunk).alias("chunks"))
        mine = rows.join(large, "shard").withColumn("chunk", F.pmod(F.xxhash64("point"), F.col("chunks")))
        drawn = Window.partitionBy("shard").orderBy(F.xxhash64("point", F.lit(level)), "point")
        pivots = mine.withColumn("place", F.row_number().over(drawn)).where(F.col("place") <= settings.fan).where(
            F.col("place") <= F.col("fan")).select(
            "shard", "place", "vec", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"))
        rows = frozen(mine.groupBy("shard", "chunk").cogroup(frozen(pivots).groupBy("shard", "chunk")).applyInArrow(
            _deal(level), f"point long, vec {kind}, shard string, home boolean, member boolean"))
        level += 1


def _pruned(alike: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Of each row's candidates (nearest first, -1 for none) those that robust pruning keeps; -1 fills up.

    Vectors that are all but equal say nothing of a direction: they do not replace each other, but take at most half of
    the edges.
    """
    n = len(candidates)
    own = np.arange(n)[:, None]
    far = 1 - np.where(candidates >= 0, alike[own, candidates], -1)
    alive = (candidates >= 0) & (candidates != own)
    kept = np.full((n, degree), -1)
    for place in range(degree):
        if place == degree // 2:
            alive &= far > SAME
        first = alive.argmax(axis=1)
        some = alive[np.arange(n), first]
        if not some.any():
            break
        chosen = candidates[np.arange(n), first]
        kept[some, place] = chosen[some]
        between = 1 - alike[chosen[:, None], candidates]
        alive &= ~((alpha * alpha * between <= far) & (far > SAME))
        alive[np.arange(n), first] = False
    return kept


def _nearest_first(alike: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Candidates of each row without repeats, nearest first."""
    ordered = np.sort(candidates, axis=1)
    ordered[:, 1:][ordered[:, 1:] == ordered[:, :-1]] = -1
    far = np.where(ordered >= 0, -alike[np.arange(len(ordered))[:, None], ordered], np.inf)
    return np.take_along_axis(ordered, np.argsort(far, axis=1, kind="stable"), axis=1)


def graph_of(vectors: np.ndarray, settings: Settings) -> tuple[list[np.ndarray], np.ndarray, int]:
    """Neighbours of each vector of one shard, the cosines of all these edges in order, and the medoid."""
    n = len(vectors)
    alike = (vectors @ vectors.T).astype(np.float32)
    medoid = int((vectors @ vectors.sum(axis=0)).argmax())
    # Chance decides among vectors that are all but equal, so that edges lead all over a group of such.
    alike += np.random.default_rng(n).random(alike.shape, dtype=np.float32) * np.float32(SAME / 2)
    if n == 1:
        return [np.zeros(0, dtype=np.int64)], np.zeros(0, dtype=np.float32), 0
    near = min(settings.near, n - 1) + 1
    found = np.empty((n, near), dtype=np.int64)
    for a in range(0, n, 512):
        found[a:a + 512] = np.argpartition(-alike[a:a + 512], near - 1, axis=1)[:, :near]
    out = _pruned(alike, _nearest_first(alike, found), settings.degree, settings.alpha)
    # Edges back, the nearest first, then pruned again with those there are.
    source, target = np.nonzero(out >= 0)[0], out[out >= 0]
    order = np.lexsort((-alike[target, source], target))
    source, target = source[order], target[order]
    place = np.arange(len(target)) - np.searchsorted(target, target)
    back = np.full((n, settings.near), -1)
    back[target[place < settings.near], place[place < settings.near]] = source[place < settings.near]
    both = _pruned(alike, _nearest_first(alike, np.concatenate([out, back], axis=1)), settings.degree, settings.alpha)
    # A thread through all vectors in order of their nearness to the medoid keeps the shard in one piece, also where
    # many vectors are as near to each other as to any.
    thread = np.argsort(-alike[medoid], kind="stable")
    side = np.full((n, 2), -1)
    side[thread[1:], 0], side[thread[:-1], 1] = thread[:-1], thread[1:]
    whole = np.concatenate([both, side], axis=1)
    edges = [np.unique(row[row >= 0]) for row in whole]
    return edges, alike[np.repeat(np.arange(n), [len(e) for e in edges]), np.concatenate(edges)], medoid


def meetings(members: np.ndarray, guests: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Members and guests that are near each other, with their cosines: the nearest of each that are not below ``least``."""
    found = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0))]
    for a in range(0, len(guests), 1024):
        alike = members @ guests[a:a + 1024].T
        close = np.zeros(alike.shape, dtype=bool)
        for axis in (0, 1):
            few = min(MET, alike.shape[axis])
            nearest = np.take(np.argpartition(-alike, few - 1, axis=axis), np.arange(few), axis=axis)
            np.put_along_axis(close, nearest, True, axis=axis)
        member, guest = np.nonzero(close & (alike >= least))
        found.append((member, guest + a, alike[member, guest]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _build(settings: Settings, least: float):
    def build(rows: pa.Table) -> pa.Table:
        points, member = rows["point"].to_numpy(), rows["member"].to_numpy(zero_copy_only=False)
        order = np.lexsort((points, ~member))
        points, vectors, n = points[order], _matrix(rows["vec"])[order], int(member.sum())
        source = target = np.zeros(0, dtype=np.int64)
        alike, medoid = np.zeros(0), -1
        if n:
            edges, alike, medoid = graph_of(vectors[:n], settings)
            source, target = np.repeat(np.arange(n), [len(e) for e in edges]), np.concatenate(edges)
            inside, guest, met = meetings(vectors[:n], vectors[n:], least)
            source, target = np.concatenate([source, inside, guest + n]), np.concatenate([target, guest + n, inside])
            alike = np.concatenate([alike, met, met])
        by = np.argsort(source, kind="stable")
        ends = pa.StructArray.from_arrays(
            [pa.array(points[target[by]]), pa.array(alike[by].astype(np.float32))], ["node", "alike"])
        bounds = np.searchsorted(source[by], np.arange(len(points) + 1))
        built = pa.table({
            "shard": pa.array([rows["shard"][0].as_py()] * len(points), pa.string()), "point": pa.array(points),
            "neighbours": pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), ends),
            "medoid": pa.array(np.arange(len(points)) == medoid)})
        # Guests that have met nobody have nothing to say.
        return built.filter(pa.array((np.arange(len(points)) < n) | (np.diff(bounds) > 0)))

    return build


class Graph(NamedTuple):
    nodes: DataFrame  # point, vec, copies, neighbours
    blocks: DataFrame  # block, point, vec
    starts: DataFrame  # block, node


def build(points: DataFrame, settings: Settings, least: float = LEAST) -> Graph:
    """The united graph over ``points(point, vec, copies)``, the blocks of queries and where each block starts."""
    ship(points.sparkSession)
    shards = frozen(sharded(points, settings))
    local = frozen(shards.groupBy("shard").applyInArrow(
        _build(settings, math.cos(narrow(least))), "shard string, point long, neighbours array<struct<node: long, alike: float>>, medoid boolean"))
    united = local.groupBy("point").agg(F.array_distinct(F.flatten(F.collect_list("neighbours"))).alias("neighbours"))
    nodes = frozen(points.select("point", "vec", "copies").join(united, "point"))
    homes = shards.where("home").select("point", F.col("shard").alias("block"))
    medoids = local.where("medoid").select("shard", F.col("point").alias("node"))
    starts = shards.where("member").select("point", "shard").join(homes, "point").select("block", "shard").distinct().join(
        medoids, "shard").select("block", "node").unionByName(homes.select("block", F.col("point").alias("node"))).distinct()
    return Graph(nodes, shards.where("home").select(F.col("shard").alias("block"), "point", "vec"), frozen(starts))


def _angle(alike: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(alike, -1, 1))


def _visit(beam: int, least: float, reach: float):
    # Within rounding, as cosines of edges are single ones and a little raised by chance.
    near = math.cos(reach) - SAME if reach < ENDLESS else -2.0

    def visit(queries: pa.Table, fetched: pa.Table) -> pa.Table:
        own, block = queries["point"].to_numpy(), queries["block"][0].as_py()
        vectors, nodes = _matrix(queries["vec"]), fetched["node"].to_numpy()
        best = np.array(queries["beam"].to_pylist(), dtype=np.float64).reshape(len(own), beam)
        counts = queries["links"].to_numpy().copy()
        # How far neighbours of each node may be from it; nothing is asked of nodes that are not expanded.
        ask = np.full(len(nodes), -1.0)
        label = np.arange(len(own))
        edges = []
        copies = fetched["copies"].to_numpy()
        other = _matrix(fetched["vec"])
        for a in range(0, len(nodes), 1024):
            alike = vectors @ other[a:a + 1024].T
            alike[own[:, None] == nodes[None, a:a + 1024]] = -np.inf
            linked = alike >= least
            counts += linked.astype(np.int64) @ copies[a:a + 1024]
            before = best
            best = -np.sort(-np.concatenate([best, alike], axis=1), axis=1)[:, :beam]
            entered = (alike >= best[:, -1:]) & (alike > before[:, -1:])
            # A node is expanded for the vectors it is near to, the own one among them; its neighbours are to be in reach
            # of one of these, of which the farthest allows most.
            served = linked | (entered & (alike >= near))
            farthest = np.where(served, alike, 1.0).min(axis=0)
            expanded = served.any(axis=0) | np.isin(nodes[a:a + 1024], own)
            ask[a:a + 1024] = np.where(expanded, _angle(farthest) + reach, -1.0)
            for n in np.flatnonzero(linked.any(axis=0)):
                at = np.flatnonzero(linked[:, n])
                edges.append((own[at[0]], nodes[a + n]))
                roots = np.unique(label[at])
                if len(roots) > 1:
                    label[np.isin(label, roots)] = roots[0]
        edges += [(own[root], own[n]) for n, root in enumerate(label.tolist()) if root != n]
        lists, vec = fetched["neighbours"].combine_chunks(), queries["vec"].combine_chunks()
        asked = []
        if len(nodes):
            ends = lists.flatten()
            allowed = np.repeat(ask, lists.value_lengths().to_numpy(zero_copy_only=False)) + SAME
            # Lengths of tiny edges are lost in rounding of the cosine; SAME is a cosine, its angle covers that.
            far = _angle(ends.field("alike").to_numpy(zero_copy_only=False).astype(np.float64))
            asked = np.unique(ends.field("node").to_numpy(zero_copy_only=False)[far <= allowed])
        n, r, e = len(own), len(asked), len(edges)
        return pa.table({
            "block": pa.array([block] * (n + r + e), pa.string()),
            "kind": pa.array(["query"] * n + ["ask"] * r + ["edge"] * e, pa.string()),
            "point": pa.array([*map(int, own), *map(int, asked), *(int(x) for x, _ in edges)], pa.int64()),
            "other": pa.array([None] * (n + r) + [int(x) for _, x in edges], pa.int64()),
            "vec": pa.concat_arrays([vec, pa.nulls(r + e, vec.type)]),
            "beam": pa.array([*(list(x) for x in best), *[None] * (r + e)], pa.list_(pa.float64())),
            "links": pa.array([*map(int, counts), *[None] * (r + e)], pa.int64())})

    return visit


def search(
        graph: Graph, settings: Settings, least: float = LEAST, reach: float = ENDLESS) -> tuple[DataFrame, DataFrame]:
    """``point``, ``links`` (copies of other points within range) and ``a``, ``b``, a forest that spans the links.

    ``reach`` is an angle. Within it from a vector, nodes that are among its nearest are expanded, in range or not.
    """
    kind = graph.nodes.schema["vec"].dataType.simpleString()
    state = graph.blocks.select(
        "block", "point", "vec", F.array_repeat(F.lit(float("-inf")), settings.beam).alias("beam"),
        F.lit(0).cast("long").alias("links"))
    waiting, visited, edges = graph.starts, None, None
    while True:
        turn = Window.partitionBy("block").orderBy("node")
        placed = frozen(waiting.withColumn("place", F.row_number().over(turn)))
        now, later = placed.where(F.col("place") <= settings.fetch).drop("place"), placed.where(F.col("place") > settings.fetch)
        if now.isEmpty():
            return state.select("point", "links"), edges
        visited = now if visited is None else visited.unionByName(now)
        fetched = now.join(graph.nodes.withColumnRenamed("point", "node"), "node")
        step = frozen(state.groupBy("block").cogroup(fetched.groupBy("block")).applyInArrow(
            _visit(settings.beam, least, reach), "block string, kind string, point long, other long, "
            f"vec {kind}, beam array<double>, links long"))
        state = step.where("kind = 'query'").select("block", "point", "vec", "beam", "links")
        found = step.where("kind = 'edge'").select(F.col("point").alias("a"), F.col("other").alias("b"))
        edges = found if edges is None else edges.unionByName(found)
        asked = step.where("kind = 'ask'").select("block", F.col("point").alias("node"))
        waiting = asked.unionByName(later.drop("place")).distinct().join(visited, ["block", "node"], "left_anti")


def audit(points: DataFrame, found: DataFrame, least: float = LEAST, sample: int = AUDITED) -> float:
    """The share of links found, for at most ``sample`` points by hash compared with every point; 1 if they have none."""
    drawn = points.select("point", "vec").orderBy(F.xxhash64("point", F.lit("audit")), "point").limit(sample).toArrow()
    ids, rows = drawn["point"].to_numpy(), drawn["vec"].combine_chunks()
    shared = points.sparkSession.sparkContext.broadcast((ids, rows))

    def compare(batches):
        own, raw = shared.value
        lengths = np.array([len(x) for x in raw])
        for batch in batches:
            size = np.array([len(x) for x in batch.column(1)]) if len(batch) else np.zeros(0, dtype=int)
            total = np.zeros(len(own), dtype=np.int64)
            for length in np.unique(size):
                mine, theirs = np.flatnonzero(lengths == length), np.flatnonzero(size == length)
                if len(mine):
                    part = batch.take(pa.array(theirs))
                    near = _matrix(raw.take(pa.array(mine))) @ _matrix(part.column(1)).T >= least
                    near[own[mine][:, None] == part.column(0).to_numpy()[None, :]] = False
                    total[mine] += near @ part.column(2).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(total)], names=["point", "there"])

    there = points.select("point", "vec", "copies").mapInArrow(compare, "point long, there long").groupBy("point").agg(
        F.sum("there").alias("there"))
    sums = there.join(found, "point").agg(F.sum("there"), F.sum(F.least("there", "links"))).first()
    return 1.0 if not sums[0] else sums[1] / sums[0]


def near_duplicates(embeddings: DataFrame, least: float = LEAST, settings: Settings = Settings()) -> DataFrame:
    """One row per row: ``vec_id``, ``n_links``, ``component_id``, ``kept``, and ``recall``, what the audit has found.

    Vectors are compared by cosine in double precision. Vectors that are null, empty, zero, or hold a null or non-finite
    component link with nothing, and vectors of different lengths never link. Equal vectors are searched for once and
    counted by number, whatever their ids. Repeated ids are vectors of their own. A row without id has its links counted;
    its component is the smallest id there is in it, or null. Other columns are left alone. Very long vectors are only
    bounded by shards: some thousand of them are in a task at once.

    The graph finds nearly all links, not surely all: recall is audited. The first search reaches twice the angle of
    ``least``; a search below 0.97 is repeated without that bound, and then with twice the beam, three times at most. A
    group of N different vectors that are all within range of each other costs
    N*N/1000 fetched rows, as each block of some thousand must see each of them.
    """
    ship(embeddings.sparkSession)
    rows = embeddings.select("vec_id", F.col("embedding").alias("vec"))
    points = rows.where(usable()).groupBy("vec").agg(F.count("*").alias("copies"), F.min("vec_id").alias("least_id"))
    points = frozen(points.withColumn("point", F.monotonically_increasing_id()))
    if points.isEmpty():
        found, edges, recall = None, None, 1.0
        linked = points.select("vec", F.lit(0).cast("long").alias("n_links"), F.col("least_id").alias("component_id"))
    else:
        graph = build(points, settings, least)
        for beam, reach in [(settings.beam, narrow(least)), *((settings.beam << n, ENDLESS) for n in range(REPEATS + 1))]:
            found, edges = search(graph, settings._replace(beam=beam), least, reach)
            recall = audit(points, found, least)
            if recall >= RECALL:
                break
        roots = components(frozen(edges.distinct()))
        placed = frozen(points.join(roots.withColumnRenamed("node", "point"), "point", "left").withColumn(
            "root", F.coalesce("root", "point")))
        smallest = placed.groupBy("root").agg(F.min("least_id").alias("component_id"))
        linked = placed.join(smallest, "root").join(found, "point").select(
            "vec", (F.col("links") + F.col("copies") - 1).alias("n_links"), "component_id")
    # Copies of one vector share a row of ``linked``: the large side may hold a hot vector, and is the one that can be split.
    marked = rows.where(usable()).join(linked, "vec").select("vec_id", "n_links", "component_id")
    alone = rows.where(~usable()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return marked.unionByName(alone).select(
        "vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"),
        F.lit(float(recall)).alias("recall"))


SQL = f"""
WITH RECURSIVE vectors AS (
    SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS v FROM embeddings),
usable AS (
    SELECT r, vec_id, v, sqrt(list_dot_product(v, v)) AS size FROM vectors
    WHERE len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(v, lambda x: x <> 0)) > 0),
links AS (
    SELECT a.r AS a, b.r AS b FROM usable a JOIN usable b
    ON a.r <> b.r AND len(a.v) = len(b.v) AND list_dot_product(a.v, b.v) / (a.size * b.size) >= {LEAST}),
reach AS (
    SELECT r AS a, r AS b FROM vectors UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
counts AS (SELECT a AS r, count(*) AS n_links FROM links GROUP BY a),
roots AS (SELECT reach.a AS r, min(vec_id) AS component_id FROM reach JOIN vectors ON vectors.r = reach.b GROUP BY reach.a)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM vectors JOIN roots USING (r) LEFT JOIN counts USING (r)
"""
