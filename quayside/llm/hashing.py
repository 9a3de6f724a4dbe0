"""Texts of an Arrow batch as one byte buffer, and hashes of all their words at once in numpy.

A text stays UTF-8 bytes; a word's 64-bit hash is a polynomial over its bytes, taken from one running sum
over the buffer, so no Python object is made per word. Equal words have equal hashes. Distinct words with
one hash are as likely as for a random 64-bit function; operators that must be exact compare bytes after.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 5  # odd, and 5 modulo 8: its powers have the longest period
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = U(0xD6E8FEB86659FD93)
#: One slice of a batch has at most this many bytes, or is one document.
SLICE_BYTES = 1 << 19
#: And so many documents, so that a document's place in a slice takes 16 bits.
SLICE_TEXTS = 60_000


def _table() -> np.ndarray:
    table = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
    return table * U(2) + U(1)


BYTE_VALUES = _table()
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def letters_only() -> np.ndarray:
    """Word bytes: ASCII digits and lower-case letters, and every byte beyond ASCII."""
    keep = np.zeros(256, dtype=bool)
    keep[48:58] = keep[97:123] = keep[128:] = True
    return keep


def unspaced() -> np.ndarray:
    """Word bytes: all but the blank and the five ASCII control spaces."""
    keep = np.ones(256, dtype=bool)
    keep[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
    return keep


_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2**64."""
    if len(_powers.get("up", ())) < n:
        size = max(n, SLICE_BYTES + 1)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base & ((1 << 64) - 1), dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"][:n], _powers["down"][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every bit of x over the whole word."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


class Texts(NamedTuple):
    """Documents of one slice: their bytes in a row, and where each begins (one more than there are)."""

    data: np.ndarray
    bounds: np.ndarray
    first: int  # index of the first document in the batch


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and bounds of a string or binary column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[Texts]:
    """The documents of a column in slices of bounded bytes (a longer document is a slice of its own)."""
    data, bounds = buffers(column)
    n, at = len(bounds) - 1, 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(bounds, bounds[at] + most, side="right")) - 1)
        end = min(end, at + SLICE_TEXTS)
        own = bounds[at : end + 1]
        yield Texts(data[own[0] : own[-1]], own - own[0], at)
        at = end


class Words(NamedTuple):
    """Words of a slice in order: byte bounds, hashes, and the word bounds of each document."""

    start: np.ndarray
    end: np.ndarray
    value: np.ndarray
    bounds: np.ndarray


def words(texts: Texts, keep: np.ndarray, lower: bool = True) -> Words:
    """All maximal runs of ``keep`` bytes of each document, ASCII letters taken as lower case."""
    raw = LOWER[texts.data] if lower else texts.data
    n = len(raw)
    inside = np.zeros(n + 2, dtype=np.int8)
    inside[1:-1] = keep[raw]
    # a document's end parts words: the same edge is then an end and a start
    edge = np.diff(inside)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    cuts = texts.bounds[1:-1]
    cuts = np.unique(cuts[(cuts > 0) & (cuts < n)])
    if len(cuts):
        cuts = cuts[(inside[cuts] == 1) & (inside[cuts + 1] == 1)]
    if len(cuts):
        start, end = np.sort(np.concatenate([start, cuts])), np.sort(np.concatenate([end, cuts]))
    up, down = powers(n + 1)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(BYTE_VALUES[raw] * up[:n], out=total[1:])
    value = mixed((total[end] - total[start]) * down[start])
    return Words(start, end, value, np.searchsorted(start, texts.bounds, side="left"))


def runs(value: np.ndarray, length: int) -> np.ndarray:
    """Hash of each run of ``length`` neighbouring words; the last length - 1 places have none."""
    n = len(value) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = value[:n].copy()
    for i in range(1, length):
        out *= _STEP
        out += value[i : i + n]
    return mixed(out)


def in_one_document(bounds: np.ndarray, n: int, length: int) -> np.ndarray:
    """Which of the n run starts keep all their words (or bytes) in one document."""
    crossing = np.zeros(max(n, 0) + 1, dtype=np.int32)
    ends = bounds[1:]
    first = np.clip(np.maximum(ends - length + 1, bounds[:-1]), 0, max(n, 0))
    np.add.at(crossing, first, 1)
    np.add.at(crossing, np.clip(ends, first, max(n, 0)), -1)
    return np.cumsum(crossing[:-1]) == 0


def owner(bounds: np.ndarray) -> np.ndarray:
    """The document of each word."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
