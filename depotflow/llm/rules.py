"""Quality rules as a ledger of failure bits and measurements, and policies applied to the ledger.

Every rule is evaluated once per text. A policy is a version of the question which failures matter: a mask over the
bits. Another policy, or the count of what one rule alone rejects, is arithmetic on the ledger; no text is read again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from depotflow.llm.words import Slice, mix, sequences, slices, whole_runs

SYMBOLS = "#*$%&|<>"
WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """A rule that a text breaks where ``broken``, an SQL condition on the measurements, is true."""

    name: str
    broken: str


#: The position in this list is the bit. New rules go to the end, so that stored ledgers keep their meaning.
RULES = (
    Rule("few_words", "n_words < 10"),
    Rule("repeated_words", "100 * n_repeat_words > 20 * n_words"),
    Rule("many_words", "n_words > 1000000"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 20 * n_words"),
    Rule("symbols", "10 * n_symbols > 3 * n_words"),
    Rule("repeated_lines", "100 * n_dup_lines > 50 * n_lines"),
    Rule("few_letters", "100 * n_letter_words < 70 * n_words"),
    Rule("capitals", "100 * n_capital_words > 50 * n_words"),
)
BITS = {rule.name: bit for bit, rule in enumerate(RULES)}


def mask(*names: str) -> int:
    return sum(1 << BITS[name] for name in names)


POLICIES = {
    "base-1": mask("few_words", "repeated_words"),
    "web-1": mask("few_words", "repeated_words", "many_words", "word_length", "symbols", "repeated_lines"),
    "web-2": mask(*BITS),
}

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letter_words",
            "n_capital_words")


def _marks(*ranges: tuple[int, int]) -> np.ndarray:
    found = np.zeros(256, dtype=np.int64)
    for low, high in ranges:
        found[low:high + 1] = 1
    return found


_CHARACTERS = 1 - _marks((0x80, 0xBF))
_SYMBOL = sum(_marks((ord(c), ord(c))) for c in SYMBOLS)
_LOWER, _UPPER, _OTHER = _marks((0x61, 0x7A)), _marks((0x41, 0x5A)), _marks((0x80, 0xFF))


def _repeated_words(part: Slice) -> np.ndarray:
    """Words of each text that lie in a run of five words found twice or more in that text."""
    inside = np.flatnonzero(whole_runs(part, WINDOW))
    keys = mix(sequences(part.hashes(), WINDOW)[inside] ^ mix(part.owners[inside].astype(np.uint64) + np.uint64(1)))
    _, which, times = np.unique(keys, return_inverse=True, return_counts=True)
    begins = inside[times[which] > 1]
    covered = np.zeros(len(part.starts) + WINDOW, dtype=np.int64)
    np.add.at(covered, begins, 1)
    np.add.at(covered, begins + WINDOW, -1)
    return part.sum_words((np.cumsum(covered)[:len(part.starts)] > 0).astype(np.int64))


def _lines(text: bytes) -> tuple[int, int]:
    """Lines with a word, and how many of them equal an earlier one."""
    lines = [line for line in text.split(b"\n") if line.strip(b" \t\n\x0b\x0c\r")]
    return len(lines), len(lines) - len(set(lines))


def measure(part: Slice) -> dict[str, np.ndarray]:
    """The measurements of the texts of one slice."""
    lower, upper, other = (part.per_word(kind[part.data]) for kind in (_LOWER, _UPPER, _OTHER))
    lines = np.array([_lines(part.text(row)) for row in range(part.rows)], dtype=np.int64).reshape(-1, 2)
    return {
        "n_words": part.counts,
        "word_chars": part.sum_words(part.per_word(_CHARACTERS[part.data])),
        "n_symbols": part.per_text(_SYMBOL[part.data]),
        "n_dup_lines": lines[:, 1],
        "n_repeat_words": _repeated_words(part),
        "n_lines": lines[:, 0],
        "n_letter_words": part.sum_words((lower + upper + other > 0).astype(np.int64)),
        "n_capital_words": part.sum_words(((upper > 0) & (lower == 0)).astype(np.int64)),
    }


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch.column(1)):
            own = {"id": batch.column(0).slice(part.first, part.rows)}
            found = {name: pa.array(values, pa.int64()) for name, values in measure(part).items()}
            yield pa.RecordBatch.from_pydict(own | found)


def ledger(docs: DataFrame, identity: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, the measurements and ``failures``, a bit for each broken rule.

    Other columns of ``docs`` are left aside, whatever their names. Null and empty texts have no words and measure 0
    throughout; they fail ``few_words``. Repeated rows and null ids are kept as they are; an empty table gives an empty
    ledger. Texts are measured whole.
    """
    kind = docs.schema[identity].dataType.simpleString()
    rows = docs.select(F.col(identity).alias("id"), F.col(text).cast("string").alias("text"))
    schema = f"id {kind}, " + ", ".join(f"{name} long" for name in MEASURES)
    measured = rows.mapInArrow(_measured, schema)
    bits = [F.when(F.expr(rule.broken), F.lit(1 << bit)).otherwise(F.lit(0)) for bit, rule in enumerate(RULES)]
    failures = bits[0]
    for bit in bits[1:]:
        failures = failures.bitwiseOR(bit)
    return measured.withColumn("failures", failures.cast("long")).withColumnRenamed("id", identity)


def keeps(policy: str, failures: str = "failures") -> Column:
    """Whether a policy keeps a row of the ledger."""
    return F.col(failures).bitwiseAND(F.lit(POLICIES[policy])) == 0


def ablation(rows: DataFrame, policy: str) -> DataFrame:
    """For each rule of a policy: texts that break it, and texts that would be kept without it.

    One pass over the ledger with a sum per rule; an empty ledger gives zeros.
    """
    active = POLICIES[policy]
    failed = F.col("failures").bitwiseAND(F.lit(active))
    names = [rule.name for bit, rule in enumerate(RULES) if active >> bit & 1]
    sums = []
    for name in names:
        bit = F.lit(1 << BITS[name])
        sums.append(F.struct(
            F.lit(name).alias("rule"),
            F.count_if(failed.bitwiseAND(bit) != 0).alias("failed"),
            F.count_if(failed == bit).alias("only_this")))
    return rows.agg(F.array(*sums).alias("found")).select(F.inline("found"))
