"""Similarity join of texts by the Jaccard coefficient of their word n-grams.

Candidates come from MinHash banding: as many bands and rows a band as the wanted recall at the threshold asks for. Texts
meet on band hashes, and every pair that meets is verified on the full n-gram sets.

Equal texts are one text with many rows. Buckets with the same members in several bands are kept once. A bucket larger
than a block is cut by hash into blocks, and pairs of blocks are compared in tasks of their own; a pair is counted in the
first of its common buckets. A task puts out one row per text with its number of links and one edge, never a row per
pair, so a group of any size gives as many rows as it has members.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from depotflow.llm.common import HAS_WORD
from depotflow.llm.components import components
from depotflow.llm.words import Slice, mix, sequences, slices, whole_runs
from depotflow.session import frozen

LENGTH = 5
THRESHOLD = 0.8
RECALL = 0.9995
HASHES = 100
BLOCK = 192


@dataclass(frozen=True)
class Plan:
    bands: int
    rows: int


def banding(threshold: float = THRESHOLD, recall: float = RECALL, hashes: int = HASHES) -> Plan:
    """The most selective banding of at most ``hashes`` hashes that finds a pair at the threshold with this chance."""
    found = Plan(hashes, 1)
    for rows in range(1, hashes + 1):
        missed = 1 - threshold ** rows
        bands = math.ceil(math.log(1 - recall) / math.log(missed)) if missed else 1
        if bands * rows <= hashes:
            found = Plan(bands, rows)
    return found


def shingles(part: Slice, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-grams of a slice and the text of each; a text of fewer words has one, of all its words."""
    hashes, counts = part.hashes(), part.counts
    whole = whole_runs(part, length)
    found, owners = sequences(hashes, length)[whole], part.owners[:len(whole)][whole]
    for row in np.flatnonzero((counts > 0) & (counts < length)):
        place = np.searchsorted(owners, row)
        found = np.insert(found, place, sequences(hashes[part.words[row]:part.words[row + 1]], int(counts[row])))
        owners = np.insert(owners, place, row)
    return found, owners


def signatures(part: Slice, plan: Plan) -> tuple[np.ndarray, np.ndarray]:
    """Texts of a slice that have words, and a hash for each of their bands."""
    found, owners = shingles(part)
    if not len(found):
        return np.zeros(0, dtype=int), np.zeros((0, plan.bands), dtype=np.uint64)
    starts = np.flatnonzero(np.append(True, np.diff(owners) > 0))
    factors = np.random.default_rng(11).integers(0, 2**63, size=plan.bands * plan.rows, dtype=np.uint64) * np.uint64(2) \
        + np.uint64(1)
    bands = np.zeros((len(starts), plan.bands), dtype=np.uint64)
    for band in range(plan.bands):
        own = np.full(len(starts), np.uint64(band + 1))
        for factor in factors[band * plan.rows:(band + 1) * plan.rows]:
            own = mix(own ^ np.minimum.reduceat(found * factor, starts))
        bands[:, band] = own
    return owners[starts], bands


def _signed(plan: Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(2)):
                rows, bands = signatures(part, plan)
                held = batch.select([0, 1]).take(pa.array(part.first + rows))
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(rows) + 1) * plan.bands, pa.int32()), pa.array(bands.view(np.int64).ravel()))
                yield pa.RecordBatch.from_arrays([*held.columns, lists], ["id", "text_key", "bands"])

    return run


def links(sets: list[np.ndarray], threshold: float = THRESHOLD) -> np.ndarray:
    """Which pairs of sets, given as sorted distinct hashes, reach the threshold; the diagonal does not."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[column] > 1
    owner, column = owner[shared], np.unique(column[shared], return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((len(sets), len(sets)), dtype=np.float64)
    step = 4096
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, step):
        a, b = np.searchsorted(column, [low, low + step])
        held = np.zeros((len(sets), step), dtype=np.float32)
        held[owner[a:b], column[a:b] - low] = 1
        common += held @ held.T
    share = Fraction(threshold).limit_denominator(10_000)
    union = sizes[:, None] + sizes[None, :] - common
    found = common * share.denominator >= share.numerator * union
    np.fill_diagonal(found, False)
    return found


def _roots(found: np.ndarray) -> np.ndarray:
    """The smallest member that each row of a symmetric relation reaches."""
    roots = np.arange(len(found))
    while True:
        near = np.where(found, roots[None, :], len(roots)).min(axis=1)
        lower = np.minimum(roots, near)
        lower = np.minimum(lower, lower[lower])
        if (lower == roots).all():
            return roots
        roots = lower


def _judge(group: tuple, rows: list[tuple], threshold: float) -> list[tuple]:
    """Links of the texts of one bucket and pair of blocks: text, links counted here, a text it is connected with."""
    bucket, first, second = group
    rows = sorted({row[0]: row for row in rows}.values())
    keys = [row[0] for row in rows]
    if len(rows) < 2:
        return []
    sets = []
    for row in rows:
        parts = [shingles(part)[0] for part in slices(pa.array([row[2]], pa.large_string()))]
        sets.append(np.unique(parts[0]))
    found = links(sets, threshold)
    blocks = np.array([row[1] for row in rows])
    across = (blocks[:, None] == first) & (blocks[None, :] == second)
    found &= across | across.T
    earlier = sorted({b for row in rows for b in row[3] if b < bucket})
    place = {b: n for n, b in enumerate(earlier)}
    seen = np.zeros((len(rows), len(earlier)), dtype=np.float32)
    for n, row in enumerate(rows):
        seen[n, [place[b] for b in row[3] if b < bucket]] = 1
    fresh = found & ~(seen @ seen.T > 0)
    roots = _roots(found)
    counts = fresh.sum(axis=1)
    return [(keys[n], int(counts[n]), keys[roots[n]]) for n in np.flatnonzero(found.any(axis=1))]


def _verified(threshold: float):
    """Verification of rows sorted by group; a group may go on in the next batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held, done = None, [], []
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in range(batch.num_columns)]
            for bucket, first, second, key, block, text, buckets in zip(*columns, strict=True):
                if (bucket, first, second) != group:
                    done += _judge(group, held, threshold) if held else []
                    group, held = (bucket, first, second), []
                held.append((key, block, text, buckets))
            yield _edges(done)
            done = []
        yield _edges(_judge(group, held, threshold) if held else [])

    return run


def _edges(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int64()),
         pa.array([r[2] for r in rows], pa.binary())], ["text_key", "links", "near"])


def _keyed(docs: DataFrame, identity: str, text: str) -> DataFrame:
    return docs.select(F.col(identity).alias("id"), F.col(text).cast("string").alias("text"),
                       _keyed_column(text).alias("text_key"))


def _keyed_column(text: str) -> Column:
    """Digest of a text that has a word."""
    whole = F.col(text).cast("string")
    return F.unhex(F.when(whole.rlike(HAS_WORD), F.md5(whole)))


def texts_linked(rows: DataFrame, plan: Plan, threshold: float, block: int) -> tuple[DataFrame, DataFrame]:
    """Of keyed rows: one row per distinct text, and the links and edges of those that have any."""
    kind = rows.schema["id"].dataType.simpleString()
    known = rows.where("text_key IS NOT NULL")
    signed = known.select("id", "text_key", "text").mapInArrow(
        _signed(plan), f"id {kind}, text_key binary, bands array<long>")
    texts = frozen(signed.groupBy("text_key").agg(
        F.min("id").alias("sample"), F.count(F.lit(1)).alias("n_copies"), F.any_value("bands").alias("bands")))
    members = texts.select("text_key", F.explode("bands").alias("bucket"))
    # A bucket's members are known by their number and the exclusive or of their hashes.
    buckets = members.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("size"), F.bit_xor(F.xxhash64("text_key")).alias("print")).where("size > 1")
    buckets = buckets.groupBy("size", "print").agg(F.min("bucket").alias("bucket")).select("bucket", "size")
    members = frozen(members.join(buckets, "bucket"))
    wanted = members.groupBy("text_key").agg(F.collect_set("bucket").alias("buckets")).join(
        texts.select("text_key", "sample"), "text_key")
    # The sample's id is part of the key, so the rows of a text with very many copies do not meet in one task.
    whole = known.join(wanted.withColumnRenamed("text_key", "key"), (F.col("text_key") == F.col("key"))
                       & F.col("id").eqNullSafe(F.col("sample"))).select("text_key", "text", "buckets")
    # Copies that share the sample's id, or have no id at all, are made one before the shuffle.
    whole = frozen(whole.groupBy("text_key").agg(F.any_value("text").alias("text"), F.any_value("buckets").alias("buckets")))
    blocks = F.ceil(F.col("size") / block).cast("int")
    dealt = members.join(whole, "text_key").withColumn("block", F.pmod(F.xxhash64("text_key"), blocks).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    dealt = dealt.select("bucket", F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"),
                         "text_key", "block", "text", "buckets")
    grouped = dealt.repartition("bucket", "first", "second").sortWithinPartitions("bucket", "first", "second")
    return texts, frozen(grouped.mapInArrow(_verified(threshold), "text_key binary, links long, near binary"))


def near_duplicates(docs: DataFrame, identity: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
                    recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """Per row of ``docs``: id, ``text_key``, ``class_id``, ``class_key``, ``n_links`` and ``n_copies``.

    Texts are linked if the Jaccard coefficient of their five-word n-grams is ``threshold`` or more; a class is what links
    and equal texts connect, and ``class_id`` the smallest id in it, null only if all its ids are. ``n_links`` counts the
    other texts a text is linked with, ``n_copies`` the rows that have this very text. A text of fewer than five words
    has one n-gram, all its words. Texts without words, null among them, are not compared: their keys are null and each
    is a class of its own. Repeated rows are copies. Other columns are left aside; an empty table stays empty.
    """
    rows = _keyed(docs, identity, text)
    texts, verified = texts_linked(rows, banding(threshold, recall), threshold, block)
    counted = verified.groupBy("text_key").agg(F.sum("links").alias("n_links"))
    roots = components(verified.select(F.col("text_key").alias("a"), F.col("near").alias("b")))
    judged = texts.select("text_key", "sample", "n_copies").join(counted, "text_key", "left").join(
        roots.withColumnRenamed("node", "text_key"), "text_key", "left").withColumn(
        "class", F.coalesce("root", "text_key"))
    smallest = judged.groupBy("class").agg(F.min("sample").alias("class_id"))
    judged = judged.join(smallest, "class").select(
        "text_key", "class_id", "class", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "n_copies")
    kept = rows.select("id", "text_key")
    found = kept.where("text_key IS NOT NULL").join(judged, "text_key").unionByName(
        kept.where("text_key IS NULL").select(
            "id", "text_key", F.col("id").alias("class_id"), F.lit(None).cast("binary").alias("class"),
            F.lit(0).cast("long").alias("n_links"), F.lit(1).cast("long").alias("n_copies")))
    return found.select(
        F.col("id").alias(identity), F.lower(F.hex("text_key")).alias("text_key"), "class_id",
        F.lower(F.hex("class")).alias("class_key"), "n_links", "n_copies")


def one_of_each(docs: DataFrame, identity: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that stay: of each class of near duplicates that with its smallest id.

    Of rows that agree in id and text one stays; rows without words all do. Where that id has several texts of the class,
    that with the smallest digest stays.
    """
    classes = near_duplicates(docs, identity, text).where("text_key IS NOT NULL")
    first = classes.where(F.col(identity).eqNullSafe(F.col("class_id"))).groupBy("class_key").agg(
        F.min("text_key").alias("_text_key"), F.first("class_id").alias("_id"))
    rows = classes.groupBy(F.col(identity).alias("_id"), F.col("text_key").alias("_text_key")).agg(
        F.count(F.lit(1)).alias("_rows"))
    kept = first.join(rows, first["_text_key"].eqNullSafe(rows["_text_key"]) & first["_id"].eqNullSafe(rows["_id"])).select(
        first["_text_key"], first["_id"], "_rows")
    keyed = docs.withColumn("_key", F.lower(F.hex(_keyed_column(text))))
    found = frozen(keyed.join(kept, (F.col("_key") == F.col("_text_key")) & F.col(identity).eqNullSafe(F.col("_id"))))
    repeated = found.where("_rows > 1").dropDuplicates(["_key", "_id"])
    return found.where("_rows = 1").unionByName(repeated).select(*docs.columns).unionByName(
        keyed.where("_key IS NULL").select(*docs.columns))


#: All pairs of texts that share an n-gram, counted and then walked through.
SQL = r"""
WITH RECURSIVE docs AS (
    SELECT doc_id, text, regexp_matches(coalesce(text, ''), '[^\x20\x09-\x0D]') AS spoken FROM documents),
texts AS (
    SELECT md5(text) AS t, min(doc_id) AS sample, count(*) AS n_copies,
           regexp_extract_all(any_value(text), '[^\x20\x09-\x0D]+') AS w FROM docs WHERE spoken GROUP BY md5(text)),
grams AS (
    SELECT DISTINCT t, array_to_string(w[i:i + 4], ' ') AS g
    FROM (SELECT t, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM texts)),
sizes AS (SELECT t, count(*) AS n FROM grams GROUP BY t),
shared AS (SELECT a.t AS a, b.t AS b, count(*) AS n FROM grams a JOIN grams b ON a.g = b.g AND a.t <> b.t GROUP BY ALL),
links AS (
    SELECT a, b FROM shared s JOIN sizes x ON x.t = a JOIN sizes y ON y.t = b WHERE 5 * s.n >= 4 * (x.n + y.n - s.n)),
reached AS (
    SELECT t, t AS other FROM texts UNION SELECT r.t, l.b FROM reached r JOIN links l ON l.a = r.other),
classes AS (
    SELECT r.t, min(sample) AS class_id, min(other) AS class_key FROM reached r JOIN texts x ON x.t = r.other GROUP BY r.t),
counted AS (SELECT a AS t, count(*) AS n_links FROM links GROUP BY a)
SELECT doc_id, md5(text) AS text_key, class_id, class_key, coalesce(n_links, 0)::BIGINT AS n_links, n_copies
FROM docs JOIN texts x ON x.t = md5(text) JOIN classes c ON c.t = x.t LEFT JOIN counted k ON k.t = x.t WHERE spoken
UNION ALL
SELECT doc_id, NULL, doc_id, NULL, 0, 1 FROM docs WHERE NOT spoken
"""
