"""Benchmark decontamination: a BM25 index of the test items, searched by every passage with block-max pruning.

The items' postings are cut into index parts of bounded size; items of a part stand in blocks of a few, and each term
knows its largest contribution to each block. A passage opens a block only if the sum of these bounds reaches the
threshold, scores the items in it exactly, and keeps all that reach it: with a fixed threshold that is the whole answer,
not a best few. Contributions are divided by the item's score for itself, so one threshold fits short and long items.
Retrieved items are then compared with the whole document: runs of words of the question and of the answer.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from depotflow.llm.words import Slice, sequences, slices
from depotflow.session import frozen

K1, B = 1.2, 0.75
THRESHOLD = 0.7
OVERLAP = 0.5
RUN = 5
BLOCK = 4
STRIDE = 64
#: Postings in one part of the index, of some 20 bytes each; an item with more is a part of its own.
PART = 100_000


@dataclass(frozen=True)
class Index:
    """One part of the index. Postings are sorted by term; ``bounds`` holds each term's first one.

    ``block_bounds`` has the same for blocks: per term the blocks it occurs in and its largest contribution there.
    ``question`` and ``answer`` are each item's word runs, ``lengths`` how many words their runs have.
    """

    items: np.ndarray
    stride: int
    terms: np.ndarray
    bounds: np.ndarray
    item: np.ndarray
    share: np.ndarray
    block_bounds: np.ndarray
    block: np.ndarray
    block_share: np.ndarray
    question: list[np.ndarray]
    answer: list[np.ndarray]
    lengths: list[tuple[int, int]]


def split_item(text: str) -> tuple[str, str]:
    """Question and answer of a test item: the answer is its last line, or else its last sentence; it may be empty."""
    whole = text.strip(" \t\n\x0b\x0c\r")
    for sign in ("\n", "? ", ". ", "! "):
        head, cut, tail = whole.rpartition(sign)
        if cut and head.strip():
            return head + sign.strip(), tail
    return whole, ""


def _runs(text: str) -> tuple[np.ndarray, int]:
    """Distinct runs of five words, or of all words of a shorter text, and the length of the runs."""
    words = [part.folded().hashes() for part in slices(pa.array([text]))][0]
    length = min(RUN, len(words))
    return (np.unique(sequences(words, length)) if length else np.zeros(0, dtype=np.uint64)), length


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch.column(1)):
            folded = part.folded()
            rows = pd.DataFrame({"row": folded.owners, "term": folded.hashes().view(np.int64)})
            found = rows.groupby(["row", "term"], sort=False).size().reset_index(name="n")
            ids = batch.column(0).slice(part.first, part.rows)
            yield pa.RecordBatch.from_pydict({
                "entry": ids.take(pa.array(found["row"])), "term": pa.array(found["term"]),
                "n": pa.array(found["n"], pa.int64()), "words": pa.array(folded.counts[found["row"]], pa.int64())})


def _numbered(benchmark: DataFrame, identity: str, text: str) -> DataFrame:
    """Distinct items with a word, numbered: ``entry`` is a hash, so equal texts under one id are one item."""
    rows = benchmark.select(F.col(identity).alias("item_id"), F.col(text).cast("string").alias("text")).where(
        F.col("text").isNotNull()).distinct()
    return rows.withColumn("entry", F.xxhash64("item_id", "text"))


def index_parts(benchmark: DataFrame, identity: str = "item_id", text: str = "text", part: int = PART,
                block: int = BLOCK) -> list[Index]:
    """The index of a benchmark in parts of at most ``part`` postings, or one item. An empty benchmark has no part."""
    items = frozen(_numbered(benchmark, identity, text))
    postings = frozen(items.select("entry", "text").mapInArrow(_postings, "entry long, term long, n long, words long"))
    sizes = postings.groupBy("entry").agg(F.count(F.lit(1)).alias("n_terms"), F.first("words").alias("words"))
    total = sizes.agg(F.count(F.lit(1)), F.avg("words"), F.sum("n_terms")).first()
    if not total[0]:
        return []
    idf = postings.groupBy("term").agg(F.count(F.lit(1)).alias("df")).select(
        "term", F.log(1 + (total[0] - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf"))
    norm = F.col("n") + K1 * (1 - B + B * F.col("words") / total[1])
    weighted = postings.join(idf, "term").withColumn("weight", F.col("idf") * F.col("n") * (K1 + 1) / norm)
    own = weighted.groupBy("entry").agg(F.sum("weight").alias("own"))
    # Items are dealt to parts by hash; parts are as many as keep them within the bound several times over.
    parts = max(1, -(-2 * total[2] // part))
    dealt = frozen(weighted.join(own, "entry").select(
        "entry", "term", (F.col("weight") / F.col("own")).alias("share"), "words",
        F.pmod(F.xxhash64("entry"), F.lit(parts)).alias("part")))
    texts = items.withColumn("part", F.pmod(F.xxhash64("entry"), F.lit(parts)))
    found = []
    for number in range(parts):
        own_rows = dealt.where(F.col("part") == number).toPandas().sort_values(["entry", "term"])
        own_texts = texts.where(F.col("part") == number).toPandas().drop_duplicates("entry").set_index("entry")
        if len(own_rows):
            found.append(_packed(own_rows, own_texts, block))
    return found


def _packed(rows: pd.DataFrame, texts: pd.DataFrame, block: int) -> Index:
    # Blocks of items that share words have sharper bounds: order the items by their rarest, heaviest term.
    heaviest = rows.sort_values("share").groupby("entry")["term"].last().sort_values()
    place = {entry: n for n, entry in enumerate(heaviest.index)}
    keys = rows["term"].to_numpy(dtype=np.int64).view(np.uint64)
    rows = rows.assign(item=rows["entry"].map(place), key=keys).sort_values(["key", "item"])
    terms, bounds = np.unique(rows["key"].to_numpy(), return_index=True)
    heads = rows.assign(block=rows["item"] // block).groupby(["key", "block"], as_index=False)["share"].max()
    block_bounds = np.searchsorted(heads["key"].to_numpy(), terms)
    ordered = texts.loc[list(heaviest.index)]
    halves = [split_item(text) for text in ordered["text"]]
    question, answer = [_runs(q) for q, _ in halves], [_runs(a) for _, a in halves]
    return Index(
        ordered["item_id"].to_numpy(), max(STRIDE, int(rows["words"].max())), terms, np.append(bounds, len(rows)),
        rows["item"].to_numpy(), rows["share"].to_numpy(), np.append(block_bounds, len(heads)),
        heads["block"].to_numpy(), heads["share"].to_numpy(), [q for q, _ in question], [a for a, _ in answer],
        [(q, a) for (_, q), (_, a) in zip(question, answer, strict=True)])


def _spread(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every place of some ranges, and the number of the range it comes from."""
    counts = stops - starts
    owner = np.repeat(np.arange(len(starts)), counts)
    return owner, np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(starts, counts)


def retrieve(part: Slice, index: Index, threshold: float = THRESHOLD, block: int = BLOCK) -> tuple[np.ndarray, ...]:
    """Text, item and score of every passage and item at or above the threshold. ``part`` has folded words.

    Passages are two strides of words, a stride apart; a stride is no shorter than the longest item, so that each item
    lies whole in some passage.
    """
    hashes = part.hashes()
    place = np.minimum(np.searchsorted(index.terms, hashes), len(index.terms) - 1)
    known = np.flatnonzero(index.terms[place] == hashes)
    counts = part.counts
    chunks = np.maximum(1, -(-counts // index.stride))
    first = np.cumsum(chunks) - chunks
    owners = part.owners
    chunk = first[owners] + (np.arange(len(hashes)) - part.words[:-1][owners]) // index.stride
    # A passage is a chunk and the next one of the same text; a term counts once in it.
    keys = np.unique(chunk[known] * len(index.terms) + place[known])
    own_chunk, term = keys // len(index.terms), keys % len(index.terms)
    blocks, total = int(index.block.max()) + 1, int(chunks.sum())
    which, at = _spread(index.block_bounds[term], index.block_bounds[term + 1])
    bound = np.bincount(own_chunk[which] * blocks + index.block[at], weights=index.block_share[at],
                        minlength=total * blocks).reshape(total, blocks)
    text_of = np.repeat(np.arange(part.rows), chunks)
    both = bound.copy()
    follows = np.flatnonzero(text_of[:-1] == text_of[1:])
    both[follows] += bound[follows + 1]
    opened, open_block = np.nonzero(both >= threshold - 1e-9)
    if not len(opened):
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    # The distinct terms of the opened passages, and their postings in the opened blocks.
    passages = np.unique(opened)
    has_next = (passages + 1 < total) & (text_of[np.minimum(passages + 1, total - 1)] == text_of[passages])
    a, b = np.searchsorted(own_chunk, passages), np.searchsorted(own_chunk, passages + 1 + has_next)
    owner, at = _spread(a, b)
    held = np.unique(owner * len(index.terms) + term[at])
    owner, own_term = held // len(index.terms), held % len(index.terms)
    which, at = _spread(index.bounds[own_term], index.bounds[own_term + 1])
    allowed = np.zeros((len(passages), blocks), dtype=bool)
    allowed[np.searchsorted(passages, opened), open_block] = True
    live = allowed[owner[which], index.item[at] // block]
    which, at = which[live], at[live]
    pairs, pair = np.unique(owner[which] * len(index.items) + index.item[at], return_inverse=True)
    scores = np.bincount(pair, weights=index.share[at], minlength=len(pairs))
    reached = scores >= threshold
    return text_of[passages[pairs[reached] // len(index.items)]], pairs[reached] % len(index.items), scores[reached]


def _overlap(known: dict[int, np.ndarray], runs: np.ndarray, length: int) -> float:
    return float(np.isin(runs, known[length]).mean()) if length else 1.0


def leaks(docs: DataFrame, index: Index, identity: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
          overlap: float = OVERLAP) -> DataFrame:
    """Rows of ``docs`` with the items of one part of the index that they hold: id, item, best score, both overlaps.

    A retrieved item counts if at least ``overlap`` of the runs of its question and of its answer occur in the text.
    Null and empty texts hold nothing, repeated rows are judged alike, other columns are left aside.
    """
    kind = docs.schema[identity].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            for part in slices(batch.column(1)):
                found = list(_judged(part.folded(), own, threshold, overlap))
                ids = batch.column(0).slice(part.first, part.rows).take(pa.array([r[0] for r in found], pa.int64()))
                yield pa.RecordBatch.from_pydict({
                    "id": ids, "item_id": pa.array([r[1] for r in found], pa.int64()),
                    **{name: pa.array([r[n] for r in found], pa.float64())
                       for n, name in ((2, "score"), (3, "question_overlap"), (4, "answer_overlap"))}})

    rows = docs.select(F.col(identity).alias("id"), F.col(text).cast("string").alias("text"))
    schema = f"id {kind}, item_id long, score double, question_overlap double, answer_overlap double"
    return rows.mapInArrow(run, schema).withColumnRenamed("id", identity)


def _judged(part: Slice, index: Index, threshold: float, overlap: float) -> Iterator[tuple]:
    texts, items, scores = retrieve(part, index, threshold)
    best: dict[tuple[int, int], float] = {}
    for row, item, score in zip(texts.tolist(), items.tolist(), scores.tolist(), strict=True):
        best[(row, item)] = max(score, best.get((row, item), 0.0))
    hashes, known, last = part.hashes(), {}, -1
    for (row, item), score in sorted(best.items()):
        if row != last:
            words = hashes[part.words[row]:part.words[row + 1]]
            known, last = {n: np.unique(sequences(words, n)) for n in range(1, RUN + 1)}, row
        asked, answered = index.lengths[item]
        in_question = _overlap(known, index.question[item], asked)
        in_answer = _overlap(known, index.answer[item], answered)
        if in_question >= overlap and in_answer >= overlap:
            yield row, index.items[item], score, in_question, in_answer


def decontaminate(docs: DataFrame, benchmark: DataFrame, identity: str = "doc_id", text: str = "text") -> DataFrame:
    """All leaks of a benchmark into ``docs``, one row per row of ``docs`` and item it holds.

    Parts of the index follow each other over the whole of ``docs``; each is broadcast under its bound. Items without
    words are not searched for; an empty table on either side gives no rows.
    """
    found = [leaks(docs, part, identity, text) for part in index_parts(benchmark)]
    if not found:
        kind = docs.schema[identity].dataType.simpleString()
        schema = f"{identity} {kind}, item_id long, score double, question_overlap double, answer_overlap double"
        return docs.sparkSession.createDataFrame([], schema)
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    return whole


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", threshold: float = THRESHOLD,
          overlap: float = OVERLAP) -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no item of a benchmark."""
    place = docs.columns.index(text)
    for index in index_parts(benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            own = sent.value
            for batch in batches:
                for part in slices(batch.column(place)):
                    good = np.ones(part.rows, dtype=bool)
                    good[[found[0] for found in _judged(part.folded(), own, threshold, overlap)]] = False
                    yield batch.slice(part.first, part.rows).filter(pa.array(good))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
