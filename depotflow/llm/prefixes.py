"""Trie of conversation prefixes, with subtree totals by parallel tree contraction.

A node is a sequence of turns. Its key is the depth and the sum of hashes of (place, role, text) over its turns, so keys
are running sums and a conversation of any length is keyed by many tasks. Totals come from contraction in rounds of
joins: rake adds every leaf to its parent and takes it away, compress jumps along chains of nodes with one child until
every node of the chain knows the chain's end, and takes the chain away. What was taken away is written down round by
round and expanded again in reverse order, so that every node gets its total.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from depotflow.llm.common import ship, word_count
from depotflow.llm.words import WORD
from depotflow.operators.numbering import number_rows
from depotflow.session import frozen

FAMILY = 20
HEADS = 4
#: Turns of a conversation that one window sees.
CHUNK = 4096
#: Conversation ids that are joined to one text before they are hashed in order.
IDS = 1 << 16
PIECES = ("s0", "s1", "s2", "s3")


def numbered(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``place`` from 1, ``role``, ``text``: turns by turn (null first), then role, then text.

    All turns are numbered through by ranges, so a conversation of any length is sorted by many tasks.
    """
    rows = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")))
    order = [F.asc("conv_id"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("text")]
    rows = number_rows(rows, order, "number")
    firsts = rows.groupBy("conv_id").agg(F.min("number").alias("first"))
    return rows.join(firsts, "conv_id").select(
        "conv_id", (F.col("number") - F.col("first") + 1).alias("place"), "role", "text")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns (``conv_id``, ``place``, ``role``, ``text``) and every conversation with its length ``n_turns``.

    A conversation c takes the first h turns of conversation c - c % 20 and goes on with its own turns after its first
    h, h being crc32(c as text) % 4. Only the first three turns of a family's head can be taken.
    """
    placed = frozen(numbered(turns))
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")
    convs = placed.groupBy("conv_id").agg(F.max("place").alias("own")).withColumn("h", taken).withColumn(
        "head", F.col("conv_id") - F.col("conv_id") % FAMILY)
    # At most three rows a family, each sent to at most twenty conversations.
    heads = placed.where((F.col("conv_id") % FAMILY == 0) & (F.col("place") < HEADS))
    borrowed = convs.select("conv_id", "head", "h").join(heads.withColumnRenamed("conv_id", "head"), "head").where(
        F.col("place") <= F.col("h")).select("conv_id", "place", "role", "text")
    got = borrowed.groupBy("conv_id").agg(F.max("place").alias("got"))
    lengths = frozen(convs.join(got, "conv_id", "left").select(
        "conv_id", "h", F.coalesce("got", F.lit(0)).cast("long").alias("got"),
        (F.coalesce("got", F.lit(0)) + F.greatest(F.col("own") - F.col("h"), F.lit(0))).cast("long").alias("n_turns")))
    tails = placed.join(lengths.select("conv_id", "h", "got"), "conv_id").where(F.col("place") > F.col("h")).select(
        "conv_id", (F.col("place") - F.col("h") + F.col("got")).alias("place"), "role", "text")
    return borrowed.unionByName(tails), lengths.select("conv_id", "n_turns")


def keyed(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``depth``, ``node``, ``parent``, ``words``: the node that each rebuilt turn leads to."""
    digest = F.md5(F.concat_ws(":", F.col("place"), F.octet_length("role"), "role", "text").cast("binary"))
    rows = turns.select(
        "conv_id", "place", word_count().alias("words"), F.floor((F.col("place") - 1) / CHUNK).alias("bucket"),
        *(F.conv(F.substring(digest, 8 * n + 1, 8), 16, 10).cast("long").alias(s) for n, s in enumerate(PIECES)))
    rows = frozen(rows)
    before = Window.partitionBy("conv_id").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("conv_id", "bucket").agg(*(F.sum(s).alias(s) for s in PIECES)).select(
        "conv_id", "bucket", *(F.coalesce(F.sum(s).over(before), F.lit(0)).alias(f"b{s}") for s in PIECES))
    inside = Window.partitionBy("conv_id", "bucket").orderBy("place")
    here = [F.col(f"b{s}") + F.sum(s).over(inside) for s in PIECES]
    above = [sum_ - F.col(s) for sum_, s in zip(here, PIECES, strict=True)]

    return rows.join(sums, ["conv_id", "bucket"]).select(
        "conv_id", F.col("place").alias("depth"), node_key(F.col("place"), *here).alias("node"),
        node_key(F.col("place") - 1, *above).alias("parent"), "words")


def node_key(depth, *sums):
    return F.md5(F.concat_ws(":", depth, *sums).cast("binary"))


def contracted(tree: DataFrame, values: list[str]) -> DataFrame:
    """``tree`` with ``total_<value>`` for each value: its sum over the node's subtree.

    ``tree`` has one row a node: ``node``, ``parent`` (null for roots) and long values, none null. It must hold no
    cycle. Rounds are as many as the logarithm of the number of nodes, not the depth: a round takes away all leaves and
    all chains. A hot parent's leaves are summed before the shuffle. Nothing comes to the driver but whether rows are
    left. An empty tree gives no rows.
    """
    own, edge, total = ([f"{kind}_{v}" for v in values] for kind in ("own", "edge", "total"))
    # own: the node's value and what was raked into it. edge: what was cut out between the node and its parent.
    live = frozen(tree.select("node", "parent", *(F.col(v).alias(o) for v, o in zip(values, own, strict=True)),
                              *(F.lit(0).cast("long").alias(e) for e in edge)))
    raked: list[DataFrame] = []
    cut: list[tuple[DataFrame, DataFrame]] = []
    while not live.isEmpty():
        # Rake: what has no child is finished; its own sum is its total.
        counts = live.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(
            F.count("*").alias("children"), F.min("node").alias("child"))
        marked = frozen(live.join(counts, "node", "left"))
        leaves = marked.where("children IS NULL")
        raked.append(leaves.select("node", *(F.col(o).alias(t) for o, t in zip(own, total, strict=True))))
        added = leaves.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(
            F.count("*").alias("gone"), *(F.sum(F.col(o) + F.col(e)).alias(f"add_{o}") for o, e in zip(own, edge, strict=True)))
        live = frozen(marked.where("children IS NOT NULL").join(added, "node", "left").select(
            "node", "parent", *((F.col(o) + F.coalesce(f"add_{o}", F.lit(0))).alias(o) for o in own), *edge))
        live, taken = _without_chains(live, own, edge)
        cut.append((taken, raked[-1]))
    # Expansion, last round first: a chain's nodes add what they cut to the total of the chain's end.
    done = None
    for taken, leaves in reversed(cut):
        done = leaves if done is None else done.unionByName(leaves)
        if taken is not None:
            ends = done.select(F.col("node").alias("end"), *(F.col(t).alias(f"end_{t}") for t in total))
            done = done.unionByName(taken.join(ends, "end").select(
                "node", *((F.col(f"sum_{v}") + F.col(f"end_total_{v}")).alias(f"total_{v}") for v in values)))
        done = frozen(done)
    if done is None:
        return tree.select("*", *(F.lit(0).cast("long").alias(t) for t in total))
    return tree.join(done, "node")


def _without_chains(live: DataFrame, own: list[str], edge: list[str]) -> tuple[DataFrame, DataFrame | None]:
    """The tree without its nodes that have one child, and what is needed to expand them: ``node``, ``end`` (the first
    node below that stays) and ``sum_<value>``, the node's own value and all that lies between it and the end."""
    values = [o.removeprefix("own_") for o in own]
    sums = [f"sum_{v}" for v in values]
    counts = live.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(
        F.count("*").alias("children"), F.min("node").alias("child"))
    # The root stays, so that it is raked last.
    unary = frozen(live.join(counts.where("children = 1"), "node").where("parent IS NOT NULL"))
    below = live.select(F.col("node").alias("child"), *(F.col(e).alias(f"c_{e}") for e in edge))
    more = unary.select(F.col("node").alias("child"), F.lit(True).alias("goes_on"))
    active = frozen(unary.join(below, "child").join(more, "child", "left").select(
        "node", F.col("child").alias("end"), F.col("goes_on").isNull().alias("over"),
        *((F.col(o) + F.col(f"c_{e}")).alias(s) for o, e, s in zip(own, edge, sums, strict=True))))
    if active.isEmpty():
        return live, None
    # Pointer jumping: after k steps a pointer has leapt over 2**k nodes, or ends at a node that stays.
    taken, active = active.where("over"), active.where("NOT over")
    while not active.isEmpty():
        targets = active.unionByName(taken).select(
            F.col("node").alias("end"), F.col("end").alias("next"), F.col("over").alias("ends"),
            *(F.col(s).alias(f"n_{s}") for s in sums))
        step = frozen(active.join(targets, "end").select(
            "node", F.col("next").alias("end"), F.col("ends").alias("over"),
            *((F.col(s) + F.col(f"n_{s}")).alias(s) for s in sums)))
        taken, active = taken.unionByName(step.where("over")), step.where("NOT over")
    taken = frozen(taken.drop("over"))
    # The end of a chain hangs on the parent of the chain's top now, over an edge that holds all sums between.
    tops = taken.join(live.select("node", F.col("parent").alias("above"), *(F.col(e).alias(f"t_{e}") for e in edge)), "node")
    tops = tops.join(taken.select(F.col("node").alias("above")), "above", "left_anti").select(
        F.col("end").alias("node"), "above",
        *((F.col(s) + F.col(f"t_{e}")).alias(f"e_{v}") for s, e, v in zip(sums, edge, values, strict=True)))
    rest = live.join(taken.select("node"), "node", "left_anti").join(tops, "node", "left").select(
        "node", F.coalesce("above", "parent").alias("parent"), *own,
        *(F.when(F.col("above").isNull(), F.col(e)).otherwise(F.col(f"e_{v}")).alias(e) for e, v in zip(edge, values, strict=True)))
    return frozen(rest), taken


def _hash_in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's texts, joined by commas, as they come; only the state of one node is held."""
    current, state = None, None
    for batch in batches:
        names, digests = [], []
        for node, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if node != current:
                if state is not None:
                    names.append(current)
                    digests.append(state.hexdigest())
                current, state = node, hashlib.sha256()
            else:
                state.update(b",")
            state.update(text.as_buffer())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(digests, pa.string())], names=["node", "ends_sha256"])
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([current]), pa.array([state.hexdigest()])], names=["node", "ends_sha256"])


def trie(turns: DataFrame) -> DataFrame:
    """One row per distinct sequence of first turns of the rebuilt conversations.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` and ``ends_sha256``, as the contract of the query has them, and ``node``, the key.

    Turns are ordered by turn (null first), then role, then text; repeated rows are repeated turns. Null role or text is
    empty. Rows without conversation id are no conversation. A conversation whose rebuilt form has no turn is a member of
    the root only. No conversations: no nodes, not even the root. Other columns are left alone.

    A node's ends are one SHA-256, which can only be computed in order: ids are joined to texts of at most 65,536 ids by
    many tasks, sorted, and streamed through one task per node, which holds the state of the hash alone.
    """
    ship(turns.sparkSession)
    again, lengths = rebuilt(turns)
    steps = frozen(keyed(again))
    root = node_key(F.lit(0).cast("long"), *(F.lit(0).cast("long") for _ in PIECES))
    top = lengths.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0").select(
        root.alias("node"), F.lit(None).cast("string").alias("parent"), F.lit(0).cast("long").alias("depth"),
        "conv_id", "n_convs", F.lit(0).cast("long").alias("words"))
    nodes = steps.groupBy("node").agg(
        F.min("parent").alias("parent"), F.min("depth").cast("long").alias("depth"), F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"), F.min("words").alias("words")).unionByName(top)
    children = nodes.groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    nodes = frozen(nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))))
    tree = nodes.select("node", "parent", ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
                        (F.col("n_children") == 0).cast("long").alias("leaves"))
    totals = contracted(tree, ["saved", "leaves"]).select("node", "total_saved", "total_leaves")

    last = steps.join(lengths, "conv_id").where("depth = n_turns").select("node", "conv_id")
    last = last.unionByName(lengths.where("n_turns = 0").select(root.alias("node"), "conv_id"))
    joined = last.groupBy("node", F.floor(F.col("conv_id") / IDS).alias("bucket")).agg(F.array_join(
        F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))
    ends = joined.repartition("node").sortWithinPartitions("node", "bucket").select("node", "ids").mapInArrow(
        _hash_in_order, "node string, ends_sha256 string")

    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return nodes.join(totals, "node").join(ends, "node", "left").join(parents, "parent", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("total_leaves").alias("n_leaves"),
        F.col("total_saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"), "node")


SQL = f"""
WITH placed AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place, role, text
    FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
          WHERE conv_id IS NOT NULL)),
convs AS (
    SELECT conv_id, max(place) AS own, conv_id - conv_id % {FAMILY} AS head,
           xor(list_reduce(list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT), lambda c, b:
               list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda x, i: xor(x >> 1, 3988292384 * (x & 1))),
               4294967295::BIGINT), 4294967295) % {HEADS} AS h
    FROM placed GROUP BY conv_id),
borrowed AS (
    SELECT c.conv_id, place, role, text FROM convs c JOIN placed p ON p.conv_id = head WHERE place <= h),
got AS (SELECT conv_id, max(place) AS got FROM borrowed GROUP BY conv_id),
again AS (
    SELECT * FROM borrowed UNION ALL
    SELECT conv_id, place - h + coalesce(got, 0), role, text
    FROM placed JOIN convs USING (conv_id) LEFT JOIN got USING (conv_id) WHERE place > h),
paths AS (
    SELECT conv_id, place AS depth, len(regexp_extract_all(text, '{WORD}'))::BIGINT AS words,
           md5(string_agg(strlen(role) || ':' || role || strlen(text) || ':' || text, '')
               OVER (PARTITION BY conv_id ORDER BY place)) AS node
    FROM again
    UNION ALL SELECT conv_id, 0, 0, 'root' FROM convs),
lengths AS (SELECT conv_id, max(depth) AS n_turns FROM paths GROUP BY conv_id),
nodes AS (
    SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, min(words) AS words FROM paths GROUP BY node, depth),
parents AS (
    SELECT DISTINCT b.node, a.node AS parent FROM paths a JOIN paths b ON a.conv_id = b.conv_id AND a.depth = b.depth - 1),
children AS (SELECT parent AS node, count(*) AS n_children FROM parents GROUP BY parent),
below AS (
    SELECT DISTINCT a.node, b.node AS lower FROM paths a JOIN paths b ON a.conv_id = b.conv_id AND a.depth <= b.depth),
totals AS (
    SELECT below.node, sum((n_convs - 1) * words) AS saved_tokens, sum((n_children IS NULL)::INT) AS n_leaves
    FROM below JOIN nodes ON nodes.node = lower LEFT JOIN children ON children.node = lower GROUP BY below.node),
ends AS (
    SELECT node, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
    FROM paths JOIN lengths USING (conv_id) WHERE depth = n_turns GROUP BY node)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children,
       n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM nodes n JOIN totals USING (node) LEFT JOIN children USING (node) LEFT JOIN ends USING (node)
LEFT JOIN parents USING (node) LEFT JOIN nodes p ON p.node = parent
"""
