"""Scanning of UTF-8 texts in numpy, shared by the operators that read text in tasks.

A block is a run of texts as one byte array with offsets. Words are maximal runs of
bytes of a class; every class used here either holds all bytes above 0x7F or none,
so cutting by bytes is cutting by code points. A null text is an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 2 << 20

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


NOT_SPACE = ~byte_class((0x20, 0x20), (0x09, 0x0D))
ALPHANUMERIC = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


@dataclass
class Block:
    """Texts ``first`` to ``first + len(self)`` of a batch."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def per_text(self, values: np.ndarray) -> np.ndarray:
        """Sum of a value per byte over each text."""
        sums = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
        return sums[self.offsets[1:]] - sums[self.offsets[:-1]]

    def runs(self, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of maximal runs of bytes of a class, none across texts."""
        return self.runs_where(members[self.data])

    def runs_where(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of maximal runs of chosen bytes, none across texts."""
        size = len(inside)
        edges = self.offsets[self.offsets < size]
        new = inside.copy()
        new[1:] &= ~inside[:-1]
        new[edges] = inside[edges]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        before = edges[edges > 0] - 1
        last[before] = inside[before]
        return np.flatnonzero(new), np.flatnonzero(last) + 1


def texts_as_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A text or binary column as one byte array and its offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """The column in blocks of at most ``limit`` bytes, or of one longer text."""
    data, offsets = texts_as_bytes(column)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield Block(row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row])
        row = end


_powers: dict[str, np.ndarray] = {}


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    if "base" not in _powers or len(_powers["base"]) < size:
        count = max(size, BLOCK_BYTES + 1)
        inverse = pow(_BASE, -1, 1 << 64)
        tables = []
        for factor in (_BASE, inverse):
            table = np.full(count, factor, np.uint64)
            table[0] = 1
            tables.append(np.cumprod(table, dtype=np.uint64))
        if count > 4 * BLOCK_BYTES:
            return tables[0], tables[1]
        _powers["base"], _powers["inverse"] = tables
    return _powers["base"], _powers["inverse"]


def mix(values: np.ndarray) -> np.ndarray:
    """Spreads every input bit over all 64 bits."""
    values = (values ^ (values >> np.uint64(30))) * _M1
    values = (values ^ (values >> np.uint64(27))) * _M2
    return values ^ (values >> np.uint64(31))


def random_words(count: int, seed: int) -> np.ndarray:
    """Fixed odd 64-bit multipliers."""
    return mix(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(_BASE) + np.uint64(seed)) | np.uint64(1)


class SpanHash:
    """64-bit hashes of any byte spans of one array, each from two prefix sums."""

    def __init__(self, data: np.ndarray, fold: np.ndarray | None = None, seed: int = 7):
        table = random_words(256, seed)
        if fold is not None:
            table = table[fold]
        powers, self.inverse = _power_tables(len(data) + 1)
        self.prefix = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(table[data] * powers[: len(data)], out=self.prefix[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.prefix[ends] - self.prefix[starts]) * self.inverse[starts])


def window_hashes(words: np.ndarray, length: int, seed: int = 11) -> np.ndarray:
    """Hash of every ``length`` consecutive word hashes."""
    count = max(0, len(words) - length + 1)
    total = np.zeros(count, np.uint64)
    for k, factor in enumerate(random_words(length, seed)):
        total += words[k : k + count] * factor
    return mix(total)


def window_starts(first_word: np.ndarray, length: int) -> np.ndarray:
    """Which word positions start a window that stays in its text.

    ``first_word`` holds the index of each text's first word and, last, the number
    of words.
    """
    words = int(first_word[-1])
    counts = np.diff(first_word)
    left = np.repeat(first_word[1:], counts) - np.arange(words)
    return left >= length


def isin_hashes(values: np.ndarray, wanted: np.ndarray, screen: np.ndarray) -> np.ndarray:
    """Positions of values among sorted ``wanted``, -1 where absent."""
    found = np.full(len(values), -1, np.int64)
    if not len(wanted):
        return found
    maybe = np.flatnonzero(screen[values >> np.uint64(44)])
    at = np.searchsorted(wanted, values[maybe])
    at[at == len(wanted)] = 0
    hit = wanted[at] == values[maybe]
    found[maybe[hit]] = at[hit]
    return found


def screen_of(wanted: np.ndarray) -> np.ndarray:
    """A bitmap by the top 20 bits that lets most absent values be told at once."""
    screen = np.zeros(1 << 20, bool)
    screen[wanted >> np.uint64(44)] = True
    return screen
