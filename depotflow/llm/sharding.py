"""Sharding by a hierarchical weighted hash tree: a row descends through region and rack to a shard.

At each level every child draws an exponential number from a hash of the row's key and the child's name, divided by the
child's weight; the smallest draw wins. A node weighs what its leaves weigh. Where a weight changes, only rows that
enter or leave the changed subtree move.
"""

from __future__ import annotations

from collections.abc import Mapping
from itertools import groupby

from pyspark.sql import Column, DataFrame, functions as F

from depotflow.llm.common import text_of
from depotflow.llm.running import with_starts
from depotflow.session import frozen

#: region -> rack -> shard -> weight
Tree = Mapping[str, Mapping[str, Mapping[int, float]]]

OVERHEAD = 16
BASE, RACK, REGION = 40, 4, 8


def layout(shards: int, base: int = BASE) -> Tree:
    """Racks of four shards, two racks a region, for the first ``base`` shards; each later one is a region of its own.

    A shard that joins an existing rack would raise the weight of its ancestors, and rows drawn to them could reach an
    older sibling. In a region of its own it takes rows only into itself.
    """
    planned = range(min(shards, base))
    tree: dict[str, dict[str, dict[int, float]]] = {}
    for region, members in groupby(planned, key=lambda shard: shard // REGION):
        for rack, own in groupby(members, key=lambda shard: shard // RACK):
            tree.setdefault(f"region{region}", {})[f"rack{rack}"] = {shard: 1.0 for shard in own}
    for shard in range(base, shards):
        tree[f"added{shard}"] = {f"added{shard}": {shard: 1.0}}
    return tree


def _weight(node) -> float:
    return sum(map(_weight, node.values())) if isinstance(node, Mapping) else float(node)


def _children(node: Mapping, path: str = "") -> dict[str, list[tuple[str, float]]]:
    """Path of each inner node: names and weights of its children. A child that weighs nothing takes nothing."""
    live = {str(name): child for name, child in node.items() if _weight(child) > 0}
    found = {path: [(name, _weight(child)) for name, child in live.items()]}
    for name, child in live.items():
        if isinstance(child, Mapping):
            found |= _children(child, f"{path}/{name}")
    return found


def descend(rows: DataFrame, key: str, tree: Tree, shard: str) -> DataFrame:
    """``rows`` with the shard that each key reaches; a null key is a key like any other."""
    known = F.create_map(*[part for path, members in _children(tree).items() for part in (F.lit(path), F.array(*[
        F.struct(F.lit(name).alias("name"), F.lit(weight).alias("weight")) for name, weight in members]))])
    steps = rows.withColumn("_path", F.lit("")).withColumn("_key", F.coalesce(F.col(key).cast("string"), F.lit("")))

    def draw(child: Column) -> Column:
        number = F.shiftrightunsigned(F.xxhash64("_key", "_path", child["name"]), 11).cast("double")
        return F.struct((-F.log((number + 0.5) / float(2**53)) / child["weight"]).alias("draw"), child["name"].alias("name"))

    for _level in ("region", "rack", "shard"):
        steps = steps.withColumn("_best", F.array_min(F.transform(F.element_at(known, F.col("_path")), draw)))
        steps = steps.withColumn("_path", F.concat("_path", F.lit("/"), F.col("_best.name")))
    return steps.withColumn(shard, F.col("_best.name").cast("int")).drop("_path", "_key", "_best")


def assign(docs: DataFrame, shards: int, identity: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row of ``docs`` with its shard, its slot in the shard and the shard it has once there is one more.

    ``size`` is the bytes of the text in UTF-8 and 16 more (null: none and 16), ``text_crc32`` the checksum of those
    bytes. Only the id decides the shard, so rows with equal ids, null ids among them, share one. Slots follow a hash
    of id and text; equal rows take neighbouring slots. Other columns are left aside; an empty table stays empty.
    """
    tree, grown = layout(shards), layout(shards + 1)
    rows = docs.select(F.col(identity).alias("id"), text_of(text).alias("text")).select(
        "id", (F.octet_length("text") + OVERHEAD).cast("long").alias("size"), F.crc32("text").alias("text_crc32"))
    rows = descend(descend(rows, "id", tree, "shard"), "id", grown, "grown_shard")
    rows = frozen(rows.withColumn("order", F.lpad(F.hex(F.xxhash64("id", "text_crc32", "size")), 16, "0")).withColumn(
        "one", F.lit(1)))
    placed = with_starts(rows, "shard", "order", "one")
    return placed.select(
        F.col("id").alias(identity), "size", "text_crc32", F.lit("key").alias("law"), "shard",
        F.col("start").cast("long").alias("slot"), "grown_shard")
