"""Vectorised helpers over the bytes of Arrow text columns, used inside tasks.

Texts are UTF-8 bytes. A missing text is empty. A block holds whole texts of
some hundred kilobytes together, so the arrays made from it stay small; a text
longer than that is a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 19

# Word separators of all operators here: space, tab, newline, vertical tab, form feed, carriage return.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
_FOLDED = _BYTES.copy()
_FOLDED[ord("A") : ord("Z") + 1] = _BYTES[ord("a") : ord("z") + 1]
_POWERS: dict[int, np.ndarray] = {}


@dataclass
class Block:
    """Rows ``first`` to ``first + rows`` of a batch; text i is data[offsets[i]:offsets[i + 1]]."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cut a text column into blocks of at most ``limit`` bytes, but at least one text each."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(ends, ends[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), len(column))
        yield Block(first, data[ends[first] : ends[last]], ends[first : last + 1] - ends[first])
        first = last


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(n, BLOCK_BYTES + 1)
        powers = np.full(size, base, dtype=np.uint64)
        powers[0] = 1
        have = np.cumprod(powers)
        if size <= 1 << 22:
            _POWERS[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values; one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Rolling:
    """Polynomial hashes of any byte ranges of one block."""

    def __init__(self, data: np.ndarray, fold_case: bool = False):
        n = len(data)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((_FOLDED if fold_case else _BYTES)[data] * _powers(_BASE, n), out=self.sums[1:])
        self.inverse = _powers(_INVERSE, n + 1)

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start] + (end - start).astype(np.uint64))

    def windows(self, width: int) -> np.ndarray:
        """Hash of every window of ``width`` bytes."""
        n = len(self.sums) - width
        return mix((self.sums[width:] - self.sums[:n]) * self.inverse[:n])


@dataclass
class Words:
    """Words of a block: byte ranges, text number and hash; words of text i are first[i]:first[i + 1]."""

    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    first: np.ndarray
    hash: np.ndarray


def words(block: Block, fold_case: bool = False) -> Words:
    data, n = block.data, len(block.data)
    inside = ~SPACE[data]
    before = np.zeros(n, dtype=bool)
    before[1:] = inside[:-1]
    starts = block.offsets[:-1]
    before[starts[starts < n]] = False
    after = np.zeros(n, dtype=bool)
    after[:-1] = inside[1:]
    full = block.offsets[1:][np.diff(block.offsets) > 0]
    after[full - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    text = np.searchsorted(block.offsets, start, side="right") - 1
    first = np.zeros(block.rows + 1, dtype=np.int64)
    np.cumsum(np.bincount(text, minlength=block.rows), out=first[1:])
    return Words(start, end, text, first, Rolling(data, fold_case).ranges(start, end) if len(start) else np.zeros(0, np.uint64))


def grams(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``size`` words within one text, and the number of its first word."""
    n = len(w.hash) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = np.zeros(n, dtype=np.uint64)
    for j in range(size):
        h = h * np.uint64(0xD6E8FEB86659FD93) + w.hash[j : j + n]
    at = np.flatnonzero(w.text[:n] == w.text[size - 1 :])
    return mix(h[at]), at


def shingle_sets(block: Block, size: int = 5) -> list[np.ndarray]:
    """Per text its sorted distinct ``size``-word shingles, A-Z folded, as 64-bit hashes.

    A text of fewer words has one shingle, its whole sequence; without words, none.
    """
    w = words(block, fold_case=True)
    h, at = grams(w, size)
    counts = np.diff(w.first)
    bounds = np.zeros(block.rows + 1, dtype=np.int64)
    np.cumsum(np.maximum(counts - size + 1, 0), out=bounds[1:])
    out = []
    for i in range(block.rows):
        if counts[i] >= size:
            own = np.sort(h[bounds[i] : bounds[i + 1]])
            keep = np.ones(len(own), dtype=bool)
            np.not_equal(own[1:], own[:-1], out=keep[1:])
            out.append(own[keep])
        elif counts[i]:
            whole = np.full(1, counts[i], dtype=np.uint64)
            for x in w.hash[w.first[i] : w.first[i + 1]]:
                whole = whole * np.uint64(0xD6E8FEB86659FD93) + x
            out.append(mix(whole ^ np.uint64(0xA5A5A5A5A5A5A5A5)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
