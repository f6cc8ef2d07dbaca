import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from depotflow.llm import sharding
from tests.llm.helpers import awkward_rows, documents


def test_rows_sizes_and_slots(spark):
    rows = sharding.assign(documents(spark), 40).collect()
    data = lambda text: (text or "").encode()
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in rows), key=repr) == sorted(
        ((r[0], len(data(r[1])) + 16, zlib.crc32(data(r[1]))) for r in awkward_rows()), key=repr)
    slots, shards = defaultdict(list), defaultdict(set)
    for r in rows:
        slots[r.shard].append(r.slot)
        shards[r.doc_id].add((r.shard, r.grown_shard))
    assert all(sorted(found) == list(range(len(found))) for found in slots.values())
    assert all(len(found) == 1 for found in shards.values())


def test_one_more_shard_takes_rows_only_into_itself(spark):
    ids = spark.range(20_000)
    for n in (40, 41, 45):
        moved = sharding.descend(sharding.descend(ids, "id", sharding.layout(n), "old"), "id", sharding.layout(n + 1), "new")
        counts = moved.agg(F.count_if((F.col("old") != F.col("new")) & (F.col("new") != n)),
                           F.count_if(F.col("new") == n), F.min("old"), F.max("old"), F.countDistinct("old")).first()
        assert counts[0] == 0 and (counts[2], counts[3], counts[4]) == (0, n - 1, n)
        assert abs(counts[1] - 20_000 / (n + 1)) < 120


def test_movement_stays_in_subtrees_whose_weights_change(spark):
    ids = spark.range(20_000)
    tree = sharding.layout(16)
    heavier = {r: {k: dict(s) for k, s in racks.items()} for r, racks in tree.items()}
    heavier["region0"]["rack1"][5] = 3.0
    moved = sharding.descend(sharding.descend(ids, "id", tree, "old"), "id", heavier, "new").where("old <> new")
    # Rows enter the region, those that were in it enter the rack, those that were in that enter the shard.
    assert moved.where("new > 7 OR old < 8 AND new NOT BETWEEN 4 AND 7 OR old BETWEEN 4 AND 7 AND new <> 5").count() == 0
    assert moved.where("new = 5").count() > 0
    share = sharding.descend(ids, "id", heavier, "new").where("new = 5").count()
    assert abs(share - 20_000 * 3 / 18) < 300


def test_weightless_shards_and_empty_tables(spark):
    tree = {"r": {"k": {0: 1.0, 1: 0.0}}}
    assert {r.s for r in sharding.descend(spark.range(50), "id", tree, "s").collect()} == {0}
    assert sharding.assign(documents(spark, []), 40).count() == 0


def test_no_python_on_the_path(spark):
    plan = sharding.assign(documents(spark), 40)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
