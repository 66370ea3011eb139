"""Words of many texts at once, as numpy arrays over the UTF-8 bytes of an Arrow column.

A word is a run of bytes other than space and the control characters 9 to 13.  A hash is a sum of bytes, each times a
pseudo-random number for its place, mixed at the end; so hashes are the same in every process and need no Python strings.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """Each 64-bit number scrambled (the finaliser of a public-domain generator)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _numbers(first: int, count: int) -> np.ndarray:
    """Pseudo-random odd numbers for the places from ``first`` on."""
    return mixed(np.arange(first + 1, first + count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def segment_hashes(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Hash of each segment of the bytes; segments lie end to end and are not empty."""
    if not len(start):
        return np.zeros(0, np.uint64)
    place = np.arange(len(data)) - np.repeat(start, length)
    terms = (data.astype(np.uint64) + np.uint64(1)) * _numbers(0, int(length.max()))[place]
    return mixed(np.add.reduceat(terms, start) + length.astype(np.uint64))


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes, offsets) of a string column without nulls."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8)[offsets[0] : offsets[-1]] if buffer is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


class Words(NamedTuple):
    """Words of some texts end to end: ``first[i]`` to ``first[i + 1]`` are those of text i."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hashes: np.ndarray
    first: np.ndarray


def words_of(column: pa.Array, lower: bool = False) -> Words:
    """Words of a string column without nulls; ``lower`` takes A to Z as a to z."""
    data, offsets = column_bytes(column)
    if lower:
        data = _LOWER[data]
    inside = ~_WHITE[data]
    begins = inside.copy()
    cut = offsets[:-1][offsets[:-1] < len(data)]
    begins[1:] &= ~inside[:-1]
    begins[cut] = inside[cut]  # texts touch without a space between them
    start = np.flatnonzero(begins)
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | begins[1:]
    end = np.flatnonzero(ends) + 1
    first = np.searchsorted(start, offsets)
    if not len(start):
        return Words(data, start, end, np.zeros(0, np.uint64), first)
    length = end - start
    return Words(data, start, end, segment_hashes(data[inside], np.cumsum(length) - length, length), first)


def shingle_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` consecutive hashes."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k, number in enumerate(_numbers(1 << 20, width)):
        total += hashes[k : k + n] * number
    return mixed(total + np.uint64(width))


def text_slices(batch: pa.RecordBatch, column: str = "text", size: int = 400_000) -> Iterator[tuple[int, pa.Array]]:
    """(first row, texts) of consecutive rows with at most ``size`` bytes or one row; null texts are empty.

    Work on words takes some fifty bytes of memory for each byte of a slice.
    """
    texts = batch.column(column).fill_null("")
    if not len(texts):
        return
    lengths = np.diff(np.frombuffer(texts.cast(pa.large_string()).buffers()[1], np.int64)[: len(texts) + 1])
    ends, row = np.cumsum(lengths), 0
    while row < len(texts):
        before = ends[row - 1] if row else 0
        stop = max(row + 1, int(np.searchsorted(ends, before + size, "right")))
        yield row, texts.slice(row, stop - row)
        row = stop
