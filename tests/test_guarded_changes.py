"""The stock rule change by change, in batch and as a feed, and key cascades that a primary key would stop."""

import random

from pyspark.sql import functions as F

from depotflow.operators import changes, stock
from depotflow.session import shared_folder
from depotflow.streaming import stock_feed

KIND = "nr long, was string, anr string, lmenge int"


def judged_by_hand(levels, feed):
    """Numbers of the changes that are refused, and the levels after all."""
    levels, out = dict(levels), []
    for number, kind, part, amount in sorted(feed, key=lambda c: (c[0], c[3] if c[1] == "Insert" else -c[3])):
        new = None if levels.get(part) is None else levels[part] + (amount if kind == "Insert" else -amount)
        if new is not None and not stock.LOWEST <= new <= stock.HIGHEST:
            out.append(number)
        elif part in levels:
            levels[part] = new
    return sorted(out), levels


def feed_of(seed, parts, size=300):
    draw = random.Random(seed)
    return [(n // 2, draw.choice(["Insert", "Delete"]), draw.choice(parts), draw.randrange(0, 6000)) for n in range(size)]


def test_every_change_is_judged_in_order(spark):
    parts = spark.createDataFrame([("A", 9000), ("B", 10), ("C", None), ("D", 5000)], "anr string, amenge long")
    # A has half of all changes; C's level is unknown, E has none; numbers come twice.
    feed = feed_of(1, ["A", "A", "A", "A", "B", "C", "D", "E"])
    kept, refused = stock.guarded_changes(parts, spark.createDataFrame(feed, KIND).repartition(5), "nr")
    expected, _ = judged_by_hand({"A": 9000, "B": 10, "C": None, "D": 5000}, feed)
    assert expected and sorted(r.nr for r in refused.collect()) == expected
    assert kept.count() + len(expected) == len(feed)
    none = spark.createDataFrame([], KIND)
    assert [rows.count() for rows in stock.guarded_changes(parts, none, "nr")] == [0, 0]


def test_a_guarded_feed_replays_and_folds(spark):
    parts = spark.createDataFrame([("A", 9000), ("B", 10)], "anr string, amenge long")
    feed, folder = feed_of(2, ["A", "B"], 120), shared_folder(spark, "wacht")
    rule = stock_feed.stock_rule(parts, folder, "nr")
    expected, levels = judged_by_hand({"A": 9000, "B": 10}, feed)
    for batch in range(6):
        rows = spark.createDataFrame(feed[batch * 20:batch * 20 + 20], KIND)
        stock_feed.write_batch(rows, batch, folder, rule, fold=3)
        if batch % 2:
            # What the engine sends again after a failure counts once.
            stock_feed.write_batch(rows, batch, folder, rule, fold=3)
    assert sorted(r.nr for r in stock_feed.refused(spark, folder).collect()) == expected
    assert {r.anr: r.amenge for r in stock_feed.current_stock(spark, parts, folder).collect()} == levels


def test_cascades_onto_taken_keys_change_nothing(spark, rows):
    table = spark.createDataFrame([("L01", 1), ("L02", 2), ("L03", 3)], "lnr string, x int")
    change = lambda *pairs: changes.checked_cascade(table, spark.createDataFrame(pairs, "old string, new string"), "lnr")
    moved, taken = change(("L01", "L09"), ("L07", "L02"))
    assert rows(moved) == [("L02", 2), ("L03", 3), ("L09", 1)] and taken.count() == 0
    for pairs, bad in (
        ([("L01", "L02")], ["L02"]),
        ([("L01", "L09"), ("L02", "L09")], ["L09"]),
        ([("L01", "L08"), ("L01", "L09")], ["L08", "L09"]),
    ):
        kept, taken = change(*pairs)
        assert rows(kept) == rows(table) and [r[0] for r in rows(taken)] == bad
    swapped, taken = change(("L01", "L02"), ("L02", "L01"))
    assert rows(swapped) == [("L01", 2), ("L02", 1), ("L03", 3)] and taken.count() == 0
    same, taken = change(("L01", "L01"))
    assert rows(same) == rows(table) and taken.filter(F.col("lnr").isNotNull()).count() == 0
