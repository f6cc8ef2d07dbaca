"""Mixing sources to target weights by a low-discrepancy schedule.

Every source's documents are shuffled by a hash and laid end to end; the stream of words is cut into blocks of equal
length. Golden-ratio points, mapped through the sources' cumulated shares, say whose turn each slot of the mix is. The
slot of rank r of a source takes block r of its stream, which starts again at its end. A target that ends inside a block
takes that block's first words only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from depotflow.llm.common import text_of, word_count
from depotflow.llm.running import with_starts
from depotflow.session import frozen

BLOCK = 1024
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2

#: Points of the golden-ratio sequence are multiples of 2**-30; the multiplier is odd and next to 2**30 / golden ratio.
POINTS = 1 << 30
GOLDEN = 663608941
CELL = 1 << 18
CHUNK = 4096


def _key(source: str) -> Column:
    """A source as text that is never null: null is below every other."""
    return F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(""))


def targets(sizes: DataFrame, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Targets of ``sizes(source_key, source_size)``: shares by weight, none above ``most`` times its source.

    Weights repeat over the sources by code point, null last. What a capped source cannot take is shared again by
    weight: with the sources sorted by size per weight, all up to some place are capped and the others share the rest.
    """
    by_name = Window.orderBy(F.col("source_key") == "", "source_key")
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.row_number().over(by_name) - 1) % len(WEIGHTS) + 1))
    rows = sizes.withColumn("weight", weight.cast("double"))
    rows = rows.withColumn("cap", F.col("source_size") * float(most)).withColumn("ratio", F.col("cap") / F.col("weight"))
    order = Window.orderBy("ratio", "source_key")
    before, onward = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    rows = rows.withColumn(
        "level", (F.sum("source_size").over(everything) * float(share) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        / F.sum("weight").over(onward))
    # The first source whose cap is above the level fixes the level of all that follow.
    first = F.min(F.when(F.col("ratio") >= F.col("level"), F.struct("ratio", "source_key", "level")))
    rows = rows.withColumn("shared", first.over(everything)["level"])
    capped = F.col("shared").isNull() | (F.col("ratio") < F.col("shared"))
    rows = rows.withColumn("target", F.when(capped, F.col("cap")).otherwise(F.col("shared") * F.col("weight")))
    return rows.select("source_key", "source_size", "target")


def _planned(goals: DataFrame, block: int) -> DataFrame:
    """Per source: words to take, blocks of the stream, slots it needs and its part of the schedule's points."""
    words = F.floor(F.col("target") + 1e-6).cast("long")
    rows = goals.where("source_size > 0").withColumn("words", words).withColumn(
        "blocks", F.expr(f"(source_size + {block - 1}) div {block}")).withColumn(
        "slots", F.expr(f"words div source_size * blocks + (words % source_size + {block - 1}) div {block}"))
    order = Window.orderBy("source_key")
    total = F.sum("slots").over(Window.partitionBy())
    upto = F.sum("slots").over(order.rowsBetween(Window.unboundedPreceding, 0))
    point = lambda count: F.floor(count / F.greatest(total, F.lit(1)) * POINTS).cast("long")
    return rows.withColumn("low", point(upto - F.col("slots"))).withColumn("high", point(upto))


def schedule(spark, planned: DataFrame, block: int = BLOCK) -> DataFrame:
    """Slots of the mix: ``position``, ``source_key``, ``rank``, the block they take and how many of its words.

    Points that fall to a source beyond its need are left out, and slots that a source still lacks follow at the end;
    both are a handful, as the points are evenly spread at every length.
    """
    total = planned.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0]
    point = (F.col("id") % POINTS) * GOLDEN % POINTS
    points = spark.range(total).select(F.col("id").alias("position"), point.alias("point")).withColumn(
        "cell", F.expr(f"point div {CELL}"))
    cells = planned.where("high > low").select("source_key", "slots", "low", "high", F.explode(
        F.sequence(F.expr(f"low div {CELL}"), F.expr(f"(high - 1) div {CELL}"))).alias("cell"))
    turns = points.join(cells, "cell").where("point >= low AND point < high").withColumn(
        "chunk", F.expr(f"position div {CHUNK}")).select("source_key", "chunk", "position")
    counts = turns.groupBy("source_key", "chunk").agg(F.count(F.lit(1)).alias("n"))
    by_chunk = Window.partitionBy("source_key").orderBy("chunk")
    offsets = counts.select("source_key", "chunk", F.coalesce(F.sum("n").over(
        by_chunk.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("source_key", "chunk").orderBy("position")
    ranked = turns.join(offsets, ["source_key", "chunk"]).select(
        "position", "source_key", (F.col("offset") + F.row_number().over(inside) - 1).alias("rank"))
    had = counts.groupBy("source_key").agg(F.sum("n").alias("had"))
    lacking = planned.join(had, "source_key", "left").withColumn("had", F.coalesce("had", F.lit(0))).where(
        "had < slots").select(F.lit(total).alias("position"), "source_key",
                              F.explode(F.sequence(F.col("had"), F.col("slots") - 1)).alias("rank"))
    stream = F.expr(f"rank div blocks * source_size + rank % blocks * {block}")
    return (
        ranked.unionByName(lacking)
        .join(planned.select("source_key", "source_size", "words", "blocks", "slots"), "source_key")
        .where("rank < slots")
        .select("position", "source_key", "rank", F.expr("rank % blocks").alias("block"),
                F.least(F.lit(block), F.col("words") - stream).alias("limit"))
    )


def _order(identity: str, text: str) -> Column:
    return F.md5(F.concat_ws(":", F.coalesce(F.col(identity).cast("string"), F.lit("")), text_of(text)))


def _mixed(docs: DataFrame, identity: str, text: str, source: str, share: float, most: float, block: int) -> DataFrame:
    spark = docs.sparkSession
    rows = frozen(docs.select(
        F.col(identity).alias("id"), _key(source).alias("source_key"), word_count(text).alias("size"),
        _order(identity, text).alias("order")))
    goals = frozen(targets(rows.groupBy("source_key").agg(F.sum("size").alias("source_size")), share, most))
    slots = schedule(spark, frozen(_planned(goals, block)), block)
    placed = with_starts(rows, "source_key", "order", "size", goals)
    pieces = placed.withColumn("block", F.explode_outer(F.when(F.col("size") > 0, F.sequence(
        F.expr(f"start div {block}"), F.expr(f"(start + size - 1) div {block}")))))
    begin = F.greatest(F.col("start") - F.col("block") * block, F.lit(0))
    end = F.least(F.col("start") + F.col("size") - F.col("block") * block, F.lit(block), F.col("limit"))
    drawn = pieces.join(slots, ["source_key", "block"], "left").withColumn("drawn", F.greatest(end - begin, F.lit(0)))
    return drawn.groupBy("source_key", "bucket", "place").agg(
        F.first("id").alias("id"), F.first("order").alias("order"), F.first("size").alias("size"),
        F.first("source_size").alias("source_size"), F.first("target").alias("target"),
        F.coalesce(F.sum(F.when(F.col("limit").isNotNull(), F.col("drawn"))), F.lit(0)).cast("long").alias("taken"))


def mix(docs: DataFrame, identity: str = "doc_id", text: str = "text", source: str = "source", share: float = SHARE,
        most: float = MOST, block: int = BLOCK) -> DataFrame:
    """Every row of ``docs`` with its size, its source's size and target, and the words the mix takes of it.

    Sizes are words; null and empty texts have none and are taken with 0. A null source is a source. Rows are shuffled
    by a digest of id and text, so a rerun gives the same; rows that agree in both may change places with each other.
    Other columns are left aside; an empty table stays empty.
    """
    return _mixed(docs, identity, text, source, share, most, block).select(
        F.col("id").alias(identity), "size", "source_size", "target", "taken")


def mixed_rows(docs: DataFrame, identity: str = "doc_id", text: str = "text", source: str = "source",
               share: float = SHARE, most: float = MOST, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs``, with all their columns, as often as the mix takes them: never, once, or up to ``most`` times.

    A document at the end of its source's target counts as taken once more if at least half of its words are. Texts
    without words are not taken. Which of several equal rows are repeated is not determined, nor does it show.
    """
    times = F.floor(F.col("taken") / F.col("size") + 0.5).cast("int")
    taken = _mixed(docs, identity, text, source, share, most, block).where("taken > 0").select(
        "order", times.alias("times")).where("times > 0")
    # Equal rows share a digest; theirs are put together and dealt out again by place.
    taken = taken.groupBy("order").agg(F.collect_list("times").alias("_times")).withColumnRenamed("order", "_order")
    keyed = docs.withColumn("_digest", _order(identity, text))
    found = keyed.join(taken, F.col("_digest") == F.col("_order"))
    alone = found.where(F.size("_times") == 1).withColumn("_turn", F.lit(1))
    several = found.where(F.size("_times") > 1).withColumn(
        "_turn", F.row_number().over(Window.partitionBy("_digest").orderBy("_digest")))
    dealt = alone.unionByName(several).where(F.col("_turn") <= F.size("_times"))
    return dealt.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.element_at("_times", F.col("_turn"))))).select(
        *docs.columns)


SQL = f"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
           md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS place
    FROM documents),
sources AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight
    FROM sized GROUP BY source),
levels AS (
    SELECT a.*, (SELECT {SHARE}::DOUBLE * sum(source_size) FROM sources) AS total FROM sources a),
tried AS (
    SELECT l.*, (total - (SELECT coalesce(sum({MOST}.0 * b.source_size), 0) FROM levels b
                          WHERE {MOST}.0 * b.source_size / b.weight < {MOST}.0 * l.source_size / l.weight))
                / (SELECT sum(b.weight) FROM levels b
                   WHERE {MOST}.0 * b.source_size / b.weight >= {MOST}.0 * l.source_size / l.weight) AS level
    FROM levels l),
fixed AS (
    SELECT arg_min(level, ratio) FILTER (WHERE ratio >= level) AS shared
    FROM (SELECT *, {MOST}.0 * source_size / weight AS ratio FROM tried)),
goals AS (
    SELECT source, source_size, least({MOST}.0 * source_size, coalesce(shared * weight, {MOST}.0 * source_size))::DOUBLE
           AS target FROM tried, fixed),
streams AS (
    SELECT s.*, g.source_size, g.target, floor(g.target + 1e-6)::BIGINT AS words,
           coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY place
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
    FROM sized s JOIN goals g ON g.source IS NOT DISTINCT FROM s.source)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (CASE WHEN size = 0 THEN 0
             ELSE size * (words // source_size) + greatest(least(start + size, words % source_size) - start, 0)
        END)::BIGINT AS taken
FROM streams
"""
