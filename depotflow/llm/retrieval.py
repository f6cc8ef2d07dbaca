"""Ranked lexical search: the best documents for each query text, by the Best Position Algorithm.

A term is a run of characters other than ASCII signs and blanks, with A-Z lower-cased. Every task keeps, for a segment
of its documents, one impact list per query term: the documents that hold it, highest impact first. A query reads its
lists from the top, side by side, and looks up every document it meets in all other lists (direct access). Looked-up
places count as seen, so each list has a best position, the last one before its first unseen place, which is often far
below the last place read. A document not met so far scores at most the sum of the impacts at the best positions; once
that is strictly below the k-th best score, no tie can be missing and the query stops.

Documents are read twice for each part of the queries (statistics, then search) and never shuffled; only the best rows
of each segment are. Terms are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from depotflow.llm.common import ship, text_of
from depotflow.llm.running import with_starts
from depotflow.llm.words import slices
from depotflow.session import frozen

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: (query, term) pairs that are broadcast at once: some 2 MB. A part exceeds it by less than its last query.
PAIRS = 1 << 17
#: Postings held by a task at once: some 40 MB. A segment exceeds it by less than one slice of texts.
SEGMENT = 1 << 20
#: Places read from each list before the first stop test; doubled after each.
STEP = 8


def _counted(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Of each slice: first row, rows, and then row in the slice, term and times of every distinct term of a row; terms
    of each row with repeats."""
    for part in slices(column):
        folded = part.folded()
        owners, hashes = folded.owners, folded.hashes()
        order = np.lexsort((hashes, owners))
        owners, hashes = owners[order], hashes[order]
        new = np.ones(len(owners), dtype=bool)
        new[1:] = (owners[1:] != owners[:-1]) | (hashes[1:] != hashes[:-1])
        at = np.flatnonzero(new)
        yield part.first, part.rows, owners[at], hashes[at], np.diff(np.append(at, len(owners))), folded.counts


def _query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = batch.column(0)
        for first, _, owners, terms, times, _ in _counted(batch.column(1)):
            yield pa.RecordBatch.from_arrays(
                [keys.take(pa.array(owners + first)), pa.array(terms.view(np.int64)), pa.array(times, pa.int64())],
                names=["query", "term", "times"])


def _places(terms: np.ndarray, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each term is in the sorted vocabulary, and whether it is there."""
    if not len(vocabulary):
        return np.zeros(len(terms), dtype=np.int64), np.zeros(len(terms), dtype=bool)
    at = np.minimum(np.searchsorted(vocabulary, terms), len(vocabulary) - 1)
    return at, vocabulary[at] == terms


class Segment:
    """Impact lists of some documents, in order of rank for sorted and in order of document for direct access."""

    def __init__(self, slots: np.ndarray, docs: np.ndarray, impacts: np.ndarray, n_slots: int, n_docs: int):
        by_doc = np.lexsort((docs, slots))
        self.n_docs = n_docs
        self.bounds = np.searchsorted(slots[by_doc], np.arange(n_slots + 1))
        self.docs, self.impacts = docs[by_doc], impacts[by_doc]
        by_rank = np.lexsort((self.docs, -self.impacts, slots[by_doc]))
        self.ranked_docs, self.ranked_impacts = self.docs[by_rank], self.impacts[by_rank]
        # Of each posting in order of document: its place in order of rank, over all lists.
        self.ranks = np.empty(len(by_rank), dtype=np.int64)
        self.ranks[by_rank] = np.arange(len(by_rank))

    def best(self, slots: np.ndarray, factors: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents and scores of the ``k`` best, ties by document, none below ``least``; places read in order."""
        low, high = self.bounds[slots], self.bounds[slots + 1]
        live = (high > low) & (factors > 0)
        low, high, factors = low[live], high[live], factors[live]
        offsets = np.concatenate([[0], np.cumsum(high - low)])
        seen = np.zeros(offsets[-1], dtype=bool)
        known = np.zeros(self.n_docs, dtype=bool)
        found_docs, found_scores = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        depth, step = 0, STEP
        while len(low):
            stop = np.minimum(low + depth + step, high)
            begin = np.minimum(low + depth, high)
            met = np.concatenate([self.ranked_docs[a:b] for a, b in zip(begin, stop, strict=True)])
            for a, b, one, off in zip(begin, stop, low, offsets, strict=False):
                seen[off + a - one:off + b - one] = True
            depth, step = depth + step, step * 2
            met = np.unique(met[~known[met]])
            known[met] = True
            scores = np.zeros(len(met), dtype=np.int64)
            for one, last, off, factor in zip(low, high, offsets, factors, strict=False):
                own = self.docs[one:last]
                at = np.minimum(np.searchsorted(own, met), len(own) - 1)
                hit = own[at] == met
                places = at[hit] + one
                scores[hit] += factor * self.impacts[places]
                seen[self.ranks[places] - one + off] = True
            found_docs, found_scores = np.append(found_docs, met), np.append(found_scores, scores)
            if len(found_docs) > k:
                top = np.lexsort((found_docs, -found_scores))[:k]
                found_docs, found_scores = found_docs[top], found_scores[top]
            kth = max(least, found_scores.min() if len(found_docs) == k else 0)
            unseen = np.append(np.flatnonzero(~seen), offsets[-1])
            best = np.minimum(unseen[np.searchsorted(unseen, offsets[:-1])], offsets[1:]) - offsets[:-1]
            over = best == high - low
            bound = int((factors * np.where(over, 0, self.ranked_impacts[low + best - 1])).sum())
            if bound < kth or over.all():
                break
        good = (found_scores > 0) & (found_scores >= least)
        order = np.lexsort((found_docs[good], -found_scores[good]))
        return found_docs[good][order], found_scores[good][order], int(np.minimum(depth, high - low).sum())


def _statistics(documents: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """``term``, ``docs``, ``terms``: of each term of the vocabulary the documents that hold it; under the null term
    the documents that hold any and all their terms with repeats. Several rows a term."""
    shared = documents.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        held = np.zeros(len(words), dtype=np.int64)
        docs = total = 0
        for batch in batches:
            for _, _, _, terms, _, lengths in _counted(batch.column(0)):
                at, there = _places(terms, words)
                held += np.bincount(at[there], minlength=len(words))
                docs, total = docs + int((lengths > 0).sum()), total + int(lengths.sum())
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array([None, *words[some].view(np.int64).tolist()], pa.int64()),
             pa.array([docs, *held[some].tolist()], pa.int64()), pa.array([total] + [0] * len(some), pa.int64())],
            names=["term", "docs", "terms"])

    return documents.select("text").mapInArrow(count, "term long, docs long, terms long")


def _ranked(documents: DataFrame, rows: list, k: int) -> DataFrame:
    """``query``, ``doc_id``, ``score``: the best of each segment for the queries of one part."""
    spark = documents.sparkSession
    vocabulary = np.unique(np.array([r.term for r in rows], dtype=np.int64).view(np.uint64))
    counts = _statistics(documents, vocabulary).groupBy("term").agg(F.sum("docs").alias("docs"), F.sum("terms").alias("terms"))
    # One row a term of this part and one more: as bounded as the part itself.
    held = {r.term: (r.docs, r.terms) for r in counts.collect()}
    all_docs, all_terms = held.get(None, (0, 0))
    documented = np.array([held.get(t, (0, 0))[0] for t in vocabulary.view(np.int64).tolist()], dtype=np.int64)
    weights = np.floor(1000 * np.log((2 * all_docs + 2) / (2 * documented + 1))).astype(np.int64)
    keys = sorted({r.query for r in rows})
    place = {key: n for n, key in enumerate(keys)}
    owner = np.array([place[r.query] for r in rows])
    order = np.argsort(owner, kind="stable")
    slots = np.searchsorted(vocabulary, np.array([r.term for r in rows], dtype=np.int64).view(np.uint64))[order]
    factors = weights[slots] * np.array([r.times for r in rows], dtype=np.int64)[order]
    cuts = np.searchsorted(owner[order], np.arange(len(keys) + 1))
    shared = spark.sparkContext.broadcast((vocabulary, keys, cuts, slots, factors))
    id_type = documents.schema["doc_id"].dataType.simpleString()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, names, cut, own_slots, own_factors = shared.value
        least = np.zeros(len(names), dtype=np.int64)
        for ids, postings, n_docs in _segments(batches, words, all_docs, all_terms):
            segment = Segment(*postings, len(words), n_docs)
            queries, docs, scores = [], [], []
            for n, name in enumerate(names):
                mine = slice(cut[n], cut[n + 1])
                found, values, _ = segment.best(own_slots[mine], own_factors[mine], k, int(least[n]))
                if len(found) == k:
                    least[n] = max(least[n], values[-1])
                queries += [name] * len(found)
                docs.append(found)
                scores.append(values)
            if queries:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(queries), ids.take(pa.array(np.concatenate(docs))), pa.array(np.concatenate(scores))],
                    names=["query", "doc_id", "score"])

    return documents.select("doc_id", "text").mapInArrow(search, f"query string, doc_id {id_type}, score long")


def _segments(batches: Iterator[pa.RecordBatch], words: np.ndarray, all_docs: int, all_terms: int):
    """Ids, (slots, documents, impacts) and number of documents of each segment; documents stand in order of their id."""
    kept: list[tuple] = []
    held = 0
    for batch in batches:
        for first, rows, owners, terms, times, lengths in _counted(batch.column(1)):
            at, there = _places(terms, words)
            docs, tf = owners[there], times[there].astype(np.int64)
            size = lengths.astype(np.int64)[docs]
            m = 25 + 75 * size * all_docs // max(all_terms, 1)
            kept.append((batch.column(0).slice(first, rows), at[there], docs, 1_000_000_000 * tf // (1000 * tf + 8 * m)))
            held += len(docs)
            if held >= SEGMENT:
                yield _merged(kept)
                kept, held = [], 0
    if held:
        yield _merged(kept)


def _merged(kept: list[tuple]) -> tuple:
    starts = np.cumsum([0, *(len(ids) for ids, *_ in kept)])
    docs = np.concatenate([d + s for (_, _, d, _), s in zip(kept, starts, strict=False)])
    used = np.unique(docs)
    ids = pa.concat_arrays([one[0] for one in kept]).take(pa.array(used))
    order = pc.sort_indices(ids, null_placement="at_end").to_numpy()
    place = np.empty(len(used), dtype=np.int64)
    place[order] = np.arange(len(used))
    return (ids.take(pa.array(order)),
            (np.concatenate([one[1] for one in kept]), place[np.searchsorted(used, docs)],
             np.concatenate([one[3] for one in kept])), len(used))


def search(documents: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score``: the ``k`` best documents with a score above 0 for each item.

    With N documents that hold a term, L their terms with repeats, and df the documents with a term, a term weighs
    floor(1000 ln((2N+2)/(2df+1))). A document of n terms that holds the term tf times adds, for each time it is in the
    item, weight * (10**9 tf div (1000 tf + 8 m)), where m = 25 + 75 n N div L. Equal scores rank by ascending
    ``doc_id``, null last. Ids may have any type that can be ordered.

    Null and empty texts have no terms: such documents are never found, such items find nothing. Every row of
    ``documents`` is a document of its own, also where ids or whole rows repeat. Items are told apart by id and text:
    repeated rows are one item, and one id with two texts is ranked for each. Other columns are left alone.
    """
    ship(documents.sparkSession)
    asked = items.select("item_id", F.md5(text_of().cast("binary")).alias("query"), text_of().alias("text")).distinct()
    texts = asked.groupBy("query").agg(F.first("text").alias("text"))
    terms = frozen(texts.select("query", "text").mapInArrow(_query_terms, "query string, term long, times long"))
    sizes = terms.groupBy("query").agg(F.count("*").alias("pairs")).withColumn("all", F.lit(0))
    parts = frozen(with_starts(sizes, "all", "query", "pairs").select(
        "query", F.floor(F.col("start") / PAIRS).cast("int").alias("part")))
    cut = frozen(terms.join(parts, "query"))
    docs = documents.select("doc_id", text_of().alias("text"))
    found = None
    for part in sorted(r.part for r in parts.select("part").distinct().collect()):
        own = frozen(_ranked(docs, cut.where(F.col("part") == part).collect(), k))
        found = own if found is None else found.unionByName(own)
    if found is None:
        return asked.select("item_id", F.lit(0).alias("rank"), F.lit(0).alias("score")).join(
            docs.select("doc_id"), F.lit(False)).select("item_id", "rank", "doc_id", "score")
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return asked.select("item_id", "query").join(ranked, "query").select("item_id", "rank", "doc_id", "score")


SQL = f"""
WITH found AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TERM}') AS t
    FROM documents),
held AS (SELECT r, doc_id, t, len(t)::BIGINT AS n FROM found WHERE len(t) > 0),
sums AS (SELECT count(*)::BIGINT AS nn, sum(n)::BIGINT AS ll FROM held),
asked AS (
    SELECT DISTINCT item_id, text,
           regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TERM}') AS t
    FROM benchmark),
wanted AS (
    SELECT item_id, text, term, count(*)::BIGINT AS times
    FROM (SELECT item_id, text, unnest(t) AS term FROM asked) GROUP BY ALL),
postings AS (
    SELECT r, doc_id, n, term, count(*)::BIGINT AS tf
    FROM (SELECT r, doc_id, n, unnest(t) AS term FROM held) SEMI JOIN wanted USING (term) GROUP BY ALL),
weighed AS (
    SELECT term, floor(1000 * ln((2 * nn + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM postings, sums GROUP BY term, nn),
scored AS (
    SELECT item_id, text, r, doc_id,
           sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * nn) // ll))))::BIGINT AS score
    FROM wanted JOIN postings USING (term) JOIN weighed USING (term), sums GROUP BY item_id, text, r, doc_id),
ranked AS (
    SELECT item_id, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank,
           doc_id, score
    FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
