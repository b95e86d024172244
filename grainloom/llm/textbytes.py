"""Words of many texts at once, on the bytes of an Arrow string column.

A slice of texts becomes one byte array; word starts, hashes and counts are array operations, so nothing runs per word
in Python. Memory follows SLICE_BYTES or the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

#: Bytes of words: digits, ASCII letters and every byte of a non-ASCII character.
WORD = np.zeros(256, bool)
WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
#: Bytes of words that only white space (space, \t-\r) parts.
SOLID = np.ones(256, bool)
SOLID[[0x20, *range(0x09, 0x0E)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


@dataclass
class Texts:
    """Texts first to last of a batch: text i is data[bounds[i]:bounds[i + 1]]."""

    first: int
    last: int
    data: np.ndarray
    bounds: np.ndarray


def slices(column: pa.Array, lower: bool = False, most: int = SLICE_BYTES) -> Iterator[Texts]:
    """Nulls count as empty. lower: in full Unicode. Only a slice at a time is copied."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    to = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(to, (to[i - 1] if i else 0) + most, "right")))
        part = pc.fill_null(column.slice(i, j - i), "")
        part = (pc.utf8_lower(part) if lower else part).cast(pa.large_string())
        _, offsets, data = part.buffers()
        at = np.frombuffer(offsets, np.int64, len(part) + 1 + part.offset)[part.offset :]
        whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        yield Texts(i, j, whole[at[0] : at[-1]], at - at[0])
        i = j


def words(texts: Texts, kind: np.ndarray = WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words in data, and counts: words of text i are counts[i]..counts[i + 1]."""
    inside = kind[texts.data]
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(texts.bounds), np.int64)
    before = np.empty(n, bool)
    before[0], before[1:] = False, inside[:-1]
    edges = texts.bounds[:-1]
    before[edges[edges < n]] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, inside[1:]
    edges = texts.bounds[1:] - 1
    after[edges[edges >= 0]] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, texts.bounds, "left")


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64's)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes: a polynomial in the places of the word, then mixed."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    first = np.concatenate(([0], np.cumsum(lengths)))
    place = np.arange(first[-1]) - np.repeat(first[:-1], lengths)
    powers = np.cumprod(np.full(int(lengths.max()), 0x9E3779B97F4A7C15, np.uint64))
    terms = (data[np.repeat(starts, lengths) + place].astype(np.uint64) + np.uint64(1)) * powers[place]
    return mixed(np.add.reduceat(terms, first[:-1]) + lengths.astype(np.uint64))


def spans(first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices first[i] .. first[i] + lengths[i] - 1 of all i, one after the other."""
    to = np.cumsum(lengths)
    return np.arange(int(to[-1]) if len(to) else 0) - np.repeat(to - lengths - first, lengths)
