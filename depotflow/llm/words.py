"""Words of many texts at once: positions and hashes by numpy over the bytes of Arrow columns.

A word is a run of bytes that are no white space, which on UTF-8 is ``[^\\x20\\x09-\\x0D]+``. Hashes have 64 bits and
are the same on every machine. Texts are taken whole; a slice holds about a megabyte, or one longer text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WORD = r"[^\x20\x09-\x0D]+"

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

#: For folded words anything but ASCII letters, digits and bytes of other scripts separates.
SIGNS = np.ones(256, dtype=bool)
for _low, _high in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    SIGNS[_low:_high + 1] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_random = np.random.default_rng(20240501)
_BYTE = _random.integers(1, 2**63, size=256, dtype=np.uint64)
_STEP = {"byte": 0x9E3779B97F4A7C15, "word": 0xD1342543DE82EF95}
_POWERS: dict[tuple[str, bool], np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(kind: str, inverse: bool, n: int) -> np.ndarray:
    """Powers 0 to n-1 of an odd number, or of its inverse, modulo 2**64."""
    known = _POWERS.get((kind, inverse))
    if known is None or len(known) < n:
        base = pow(_STEP[kind], -1, 2**64) if inverse else _STEP[kind]
        known = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        known[0] = 1
        known = np.cumprod(known, dtype=np.uint64)
        _POWERS[(kind, inverse)] = known
    return known[:n]


def _prefix(values: np.ndarray, kind: str) -> np.ndarray:
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * _powers(kind, False, len(values)), out=sums[1:])
    return sums


class Slice:
    """Some consecutive texts of a batch as one array of bytes.

    ``first`` is the row of the first text, ``rows`` their number, ``bounds`` the rows + 1 byte offsets,
    ``starts`` and ``ends`` the byte offsets of the words, ``words`` the rows + 1 offsets into those.
    """

    def __init__(self, first: int, data: np.ndarray, bounds: np.ndarray, separators: np.ndarray):
        self.first, self.data, self.bounds, self.rows = first, data, bounds, len(bounds) - 1
        inside = ~separators[data]
        begins, stops = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        stops[:-1] &= ~inside[1:]
        full = bounds[:-1] < bounds[1:]
        heads, tails = bounds[:-1][full], bounds[1:][full] - 1
        begins[heads] = inside[heads]
        stops[tails] = inside[tails]
        self.starts, self.ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        self.words = np.searchsorted(self.starts, bounds)
        self._sums: np.ndarray | None = None

    @property
    def counts(self) -> np.ndarray:
        """Words of each text."""
        return np.diff(self.words)

    @property
    def owners(self) -> np.ndarray:
        """The text, counted from 0 in this slice, of each word."""
        return np.repeat(np.arange(self.rows), self.counts)

    def hashes(self, longest: int | None = None) -> np.ndarray:
        """A hash of each word, or of at most its first ``longest`` bytes."""
        if self._sums is None:
            self._sums = _prefix(_BYTE[self.data], "byte")
        ends = self.ends if longest is None else np.minimum(self.ends, self.starts + longest)
        found = self._sums[ends] - self._sums[self.starts]
        return mix(found * _powers("byte", True, len(self.data) + 1)[self.starts])

    def per_text(self, marks: np.ndarray) -> np.ndarray:
        """Sum of a number per byte over each text."""
        sums = np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])
        return sums[self.bounds[1:]] - sums[self.bounds[:-1]]

    def per_word(self, marks: np.ndarray) -> np.ndarray:
        """Sum of a number per byte over each word."""
        sums = np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])
        return sums[self.ends] - sums[self.starts]

    def sum_words(self, values: np.ndarray) -> np.ndarray:
        """Sum of a number per word over each text."""
        sums = np.concatenate([[0], np.cumsum(values)])
        return sums[self.words[1:]] - sums[self.words[:-1]]

    def folded(self) -> Slice:
        """The same texts with ASCII letters in lower case, cut into words at every ASCII sign."""
        return Slice(self.first, LOWER[self.data], self.bounds, SIGNS)

    def text(self, row: int) -> bytes:
        return self.data[self.bounds[row]:self.bounds[row + 1]].tobytes()


def sequences(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hashes of every run of ``length`` words; runs that leave a text are among them."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    sums = _prefix(hashes, "word")
    return mix((sums[length:] - sums[:-length]) * _powers("word", True, n))


def whole_runs(part: Slice, length: int) -> np.ndarray:
    """Which of ``sequences`` stay inside one text."""
    n = max(0, len(part.starts) - length + 1)
    last = np.repeat(part.words[1:], part.counts)[:n]
    return np.arange(n) + length <= last


def slices(column: pa.Array | pa.ChunkedArray, separators: np.ndarray = SPACE, size: int = 1 << 20) -> Iterator[Slice]:
    """Cut a column of texts into slices; a null counts as an empty text."""
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    first = 0
    for chunk in chunks:
        texts = chunk.cast(pa.large_string()).fill_null("")
        n = len(texts)
        if not n:
            continue
        _, offsets, data = texts.buffers()
        bounds = np.frombuffer(offsets, dtype=np.int64)[texts.offset:texts.offset + n + 1]
        flat = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
        row = 0
        while row < n:
            stop = int(np.searchsorted(bounds, bounds[row] + size, side="right")) - 1
            stop = min(n, max(stop, row + 1))
            own = bounds[row:stop + 1]
            yield Slice(first + row, flat[own[0]:own[-1]], own - own[0], separators)
            row = stop
        first += n
