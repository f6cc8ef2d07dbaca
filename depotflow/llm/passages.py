"""Substring dedup by seed and extend: removes every word that a repeated window of words covers.

Seeds are winnowed anchors: of the short runs of words inside a window of ``WINDOW`` words, the one with the smallest
hash. Equal windows choose the same anchor at the same place, so a window occurs twice only where its anchor does, and
anchors are some fourteenth of all places. Documents meet on anchors that occur twice. A seed is then extended both ways to
its span, all windows that chose it: where the whole span occurs twice, so do its windows, and that settles all but the
ends of repeats. There the windows themselves are compared. Overlapping windows add up to the maximal repeats.

Nothing is compared pair by pair: anchors, spans and windows are grouped by hash, counted before the shuffle, and joined
back by joins that adaptive execution can split.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import IntegralType

from depotflow.llm.words import Slice, _powers, _prefix, mix, sequences, slices
from depotflow.session import frozen, scratch, shared_folder

WINDOW = 35
#: Words of an anchor. Shorter runs recur by chance and make texts candidates that share no window; longer ones leave fewer
#: to choose from, so there are more anchors. Results do not depend on it.
RUN = 10

EDGE, WHOLE, SAMPLE = 0, 1, 2
KEY = ["kid", "kth", "ktw"]
NO_ID = -(1 << 63)


def _keyed(docs: DataFrame, identity: str, text: str) -> DataFrame:
    """Id and text with a key of the id and 128 bits of the text. Rows that agree in both share it, and every result."""
    whole = isinstance(docs.schema[identity].dataType, IntegralType)
    number = F.col("id").cast("long") if whole else F.xxhash64(F.col("id").cast("string"))
    return docs.select(F.col(identity).alias("id"), F.col(text).cast("string").alias("text")).select(
        "id", F.when(F.col("id").isNull(), NO_ID).otherwise(number).alias("kid"), F.xxhash64("text").alias("kth"),
        F.xxhash64(F.lit(1), "text").alias("ktw"), "text")


def anchors(part: Slice, window: int = WINDOW, run: int = RUN) -> tuple[np.ndarray, ...]:
    """Spans of a slice: first window, last window, anchor hash; offsets are words of the slice."""
    hashes = part.hashes()
    n = len(hashes) - window + 1
    if n <= 0:
        return np.zeros(0, dtype=int), np.zeros(0, dtype=int), np.zeros(0, dtype=np.uint64)
    runs = sequences(hashes, run)
    # The upper half of the hash decides, then the place: the leftmost of equal ones.
    least = (runs & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(runs), dtype=np.uint64)
    width, target = 1, window - run + 1
    while width * 2 <= target:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < target:
        least = np.minimum(least[:len(least) - (target - width)], least[target - width:])
    chosen = (least[:n] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    starts = np.flatnonzero(np.arange(n) + window <= np.repeat(part.words[1:], part.counts)[:n])
    if not len(starts):
        return np.zeros(0, dtype=int), np.zeros(0, dtype=int), np.zeros(0, dtype=np.uint64)
    new = np.flatnonzero((np.diff(chosen[starts]) != 0) | (np.diff(starts) != 1)) + 1
    first, last = np.append(0, new), np.append(new, len(starts)) - 1
    return starts[first], starts[last], runs[chosen[starts[first]]]


def spans(part: Slice, first: np.ndarray, last: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Hashes of the words from the first window to the end of the last."""
    sums = _prefix(part.hashes(), "word")
    stop = last + window
    held = (sums[stop] - sums[first]) * _powers("word", True, len(sums))[first]
    return mix(held + (stop - first).astype(np.uint64))


def _seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch.column(0)):
            found, times = np.unique(anchors(part)[2], return_counts=True)
            yield pa.RecordBatch.from_pydict({"anchor": pa.array(found.view(np.int64)), "n": pa.array(times)})


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch.column(3)):
            first, last, found = anchors(part)
            whole = spans(part, first, last)
            owners = part.owners[first]
            begin = part.words[owners]
            held = batch.select([0, 1, 2]).take(pa.array(part.first + owners))
            yield pa.RecordBatch.from_arrays(
                [*held.columns, pa.array(found.view(np.int64)), pa.array(whole.view(np.int64)),
                 pa.array((first - begin).astype(np.int32)), pa.array((last - begin).astype(np.int32))],
                [*KEY, "anchor", "span", "first", "last"])


def _marked(rows: DataFrame) -> DataFrame:
    """Per key the spans whose anchor occurs again: ``marks`` of first and last window and kind."""
    seeds = frozen(rows.select("text").mapInArrow(_seeds, "anchor long, n long").groupBy("anchor").agg(
        F.sum("n").alias("total")).where("total > 1"))
    places = rows.select(*KEY, "text").mapInArrow(
        _places, "kid long, kth long, ktw long, anchor long, span long, first int, last int")
    places = frozen(places.join(seeds, "anchor"))
    # Written, so that the join has exchanges of its own and a span that very many places share can be split. Spans that
    # occur once are not there. Should places of a span share the least hash, all are samples, which does no harm.
    place = F.xxhash64(*KEY, "first")
    by_span = frozen(places.groupBy("anchor", "span").agg(
        F.count(F.lit(1)).alias("n"), F.max("total").alias("total"), F.min(place).alias("sample")).where("n > 1").select(
        "anchor", "span", (F.col("n") < F.col("total")).alias("shared"), "sample"))
    judged = places.drop("total").join(by_span, ["anchor", "span"], "left")
    kind = F.when(F.col("shared").isNull(), EDGE).when(F.col("shared") & (F.col("sample") == place), SAMPLE).otherwise(WHOLE)
    return judged.groupBy(*KEY).agg(F.collect_set(F.struct("first", "last", kind.alias("kind"))).alias("marks"))


def _listed(column: pa.Array, first: int, rows: int) -> tuple[np.ndarray, pa.Array]:
    """Of some rows of a list column: the row, from 0, of each element, and the elements. A null list has none."""
    own = column.slice(first, rows)
    return np.repeat(np.arange(rows), pc.list_value_length(own).fill_null(0).to_numpy(zero_copy_only=False)), own.flatten()


def _marks(column: pa.Array, part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, first and last window, and kind of each mark of a slice."""
    owner, marks = _listed(column, part.first, part.rows)
    return owner, *(np.asarray(marks.field(n).to_numpy(zero_copy_only=False), dtype=np.int64) for n in range(3))


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows of edge spans, and of one sample of every repeated span that shares its anchor with others."""
    for batch in batches:
        for part in slices(batch.column(3)):
            row, first, last, kind = _marks(batch.column(4), part)
            asked = kind != WHOLE
            row, first, kind, size = row[asked], first[asked], kind[asked], (last - first + 1)[asked]
            if not len(row):
                continue
            owner = np.repeat(row, size)
            start = np.arange(size.sum()) + np.repeat(first - (np.cumsum(size) - size), size)
            windows = sequences(part.hashes(), WINDOW)
            held = batch.select([0, 1, 2]).take(pa.array(part.first + owner))
            yield pa.RecordBatch.from_arrays(
                [*held.columns, pa.array(windows[part.words[owner] + start].view(np.int64)),
                 pa.array(start.astype(np.int32)), pa.array(np.repeat(np.where(kind == EDGE, 1, 2), size).astype(np.int32))],
                [*KEY, "window", "start", "weight"])


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _untouched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch.column(4)):
            words = [part.text(row).split() for row in range(part.rows)]
            held = batch.select([0, 1, 2, 3]).slice(part.first, part.rows)
            yield pa.RecordBatch.from_arrays(
                [*held.columns, pa.array([len(w) for w in words], pa.int64()), pa.array([_digest(w) for w in words])],
                ["id", *KEY, "n_words", "whole"])


def _cut(with_text: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(3)):
                row, first, last, kind = _marks(batch.column(4), part)
                edge_row, edge = _listed(batch.column(5), part.first, part.rows)
                edge = np.asarray(edge.to_numpy(zero_copy_only=False), dtype=np.int64)
                whole = kind != EDGE
                begin = np.append(part.words[row[whole]] + first[whole], part.words[edge_row] + edge)
                stop = np.append(part.words[row[whole]] + last[whole], part.words[edge_row] + edge) + WINDOW
                steps = np.bincount(begin, minlength=len(part.starts) + 1) - np.bincount(stop, minlength=len(part.starts) + 1)
                stays = np.cumsum(steps)[:-1] <= 0
                left = [b" ".join(compress(part.text(n).split(), stays[part.words[n]:part.words[n + 1]])) for n in range(part.rows)]
                held = batch.select([0, 1, 2]).slice(part.first, part.rows)
                texts = [pa.array(left).cast(pa.string())] if with_text else []
                yield pa.RecordBatch.from_arrays(
                    [*held.columns, pa.array(part.sum_words((~stays).astype(np.int64)), pa.int64()),
                     pa.array([hashlib.sha256(x).hexdigest() for x in left]), *texts],
                    [*KEY, "n_removed", "kept_sha256", *["kept_text"] * with_text])

    return cut


def repeats(docs: DataFrame, identity: str = "doc_id", text: str = "text", with_text: bool = True) -> DataFrame:
    """What is left of every text of ``docs`` that shares a window with another place: key, words removed, digest, and,
    if asked for, ``kept_text``.

    The text is its remaining words joined by one space. Texts without a repeated anchor are not among the rows; of rows
    that agree in id and text there is one.
    """
    rows = _keyed(docs, identity, text)
    folder = shared_folder(docs.sparkSession, "candidates")
    with scratch(docs.sparkSession):
        candidates = frozen(rows.join(_marked(rows), KEY).select(*KEY, "text", "marks"), folder)
    windows = candidates.mapInArrow(_windows, "kid long, kth long, ktw long, window long, start int, weight int")
    again = frozen(windows.groupBy("window").agg(F.sum("weight").alias("n")).where("n > 1").select("window"))
    edges = windows.where("weight = 1").join(again, "window", "left_semi").groupBy(*KEY).agg(
        F.collect_set("start").alias("edges"))
    cut = candidates.join(edges, KEY, "left").select(*KEY, "text", "marks", "edges").mapInArrow(
        _cut(with_text), "kid long, kth long, ktw long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text)
    return cut


def dedup(docs: DataFrame, identity: str = "doc_id", text: str = "text") -> DataFrame:
    """Id, words, removed words and digest of the kept words of every row of ``docs``.

    Words are judged on the input: a window of ``WINDOW`` words counts as repeated if its words start anywhere else, in
    the same text, another one, or a repeated row. Shorter, empty and null texts lose nothing. Rows with null ids take
    part like others. Other columns are left aside; an empty table stays empty. Windows are compared by 64-bit hashes, and
    texts under one id, or without one, are told apart by 128 bits. Ids may have any type that is a text too.
    """
    kind = docs.schema[identity].dataType.simpleString()
    rows = _keyed(docs, identity, text)
    whole = rows.mapInArrow(_untouched, f"id {kind}, kid long, kth long, ktw long, n_words long, whole string")
    cut = repeats(docs, identity, text, with_text=False).dropDuplicates(KEY)
    return whole.join(cut, KEY, "left").select(
        F.col("id").alias(identity), "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("kept_sha256", "whole").alias("kept_sha256"))


#: Every window of every text, counted, and the words that no repeated one covers.
SQL = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents),
runs AS (
    SELECT r, i, md5(array_to_string(w[i:i + {WINDOW - 1}], ' ')) AS run
    FROM (SELECT r, w, unnest(generate_series(1, len(w) - {WINDOW - 1})) AS i FROM docs WHERE len(w) >= {WINDOW})),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY run) AS times FROM runs) WHERE times > 1),
covered AS (SELECT DISTINCT r, i + j AS i FROM again, generate_series(0, {WINDOW - 1}) t(j)),
kept AS (
    SELECT r, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n
    FROM (SELECT r, unnest(w) AS word, unnest(generate_series(1, len(w))) AS i FROM docs) ANTI JOIN covered USING (r, i)
    GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)
"""
