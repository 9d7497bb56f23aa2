"""Words of whole Arrow batches, as byte ranges, without a Python object per word.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and carriage return. No byte of a
multi-byte UTF-8 character is one of these, so words of bytes are words of characters.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Bytes of text handled at once inside a task; the arrays made from a piece take about 40 times as much.
PIECE_BYTES = 1 << 20

WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True

_SMALL = np.arange(256, dtype=np.uint8)
_SMALL[0x41:0x5B] += 32

# All that isn't an ASCII letter or digit or a part of a character beyond ASCII.
SIGNS = np.ones(256, dtype=bool)
SIGNS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False

# Fixed pseudorandom 64-bit values, one for each byte, so that words with the same letters differ.
_MIXED = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit over the output."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array and the offsets of its values; a null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``most`` bytes of text, or of one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(np.diff(buffers(batch.column(column))[1]))
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(at, stop - at)
            at = stop
    release()


def release() -> None:
    """Gives memory that a task has freed back to the system: Python workers outlive their tasks, and those that wait keep
    what they have from those that work."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


@dataclass
class Words:
    """All words of a batch: ``raw[starts[i]:ends[i]]`` for word i; row r has words ``first[r]`` to ``first[r + 1]``."""

    raw: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def words_of(texts: pa.Array, between: np.ndarray = WHITE, fold: bool = False) -> Words:
    """Runs of bytes that ``between`` doesn't mark; with ``fold``, A to Z count as a to z."""
    raw, offsets = buffers(texts)
    if fold:
        raw = _SMALL[raw]
    solid = ~between[raw]
    begins = solid.copy()
    if len(raw):
        begins[1:] &= ~solid[:-1]
        edges = offsets[(offsets > 0) & (offsets < len(raw))]
        begins[edges] = solid[edges]
        closes = solid.copy()
        closes[:-1] &= ~solid[1:]
        closes[edges - 1] = solid[edges - 1]
    else:
        closes = solid
    starts, ends = np.flatnonzero(begins), np.flatnonzero(closes) + 1
    return Words(raw, starts, ends, np.searchsorted(starts, offsets))


def word_hashes(words: Words) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    n = len(words.starts)
    out = np.empty(n, dtype=np.uint64)
    lengths = words.ends - words.starts
    at = 0
    total = np.cumsum(lengths)
    while at < n:
        before = total[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(total, before + PIECE_BYTES, side="right")))
        length = lengths[at:stop]
        heads = np.concatenate(([0], np.cumsum(length)[:-1]))
        place = np.arange(length.sum()) - np.repeat(heads, length)
        powers = np.ones(int(length.max()), dtype=np.uint64)
        powers[1:] = _BASE
        np.multiply.accumulate(powers, out=powers)
        terms = _MIXED[words.raw[np.repeat(words.starts[at:stop], length) + place]] * powers[place]
        out[at:stop] = mix(np.add.reduceat(terms, heads) + length.astype(np.uint64))
        at = stop
    return out


def shingle_hashes(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every run of ``size`` words of a row, and its row; of all its words if a row has fewer."""
    rows = len(first) - 1
    counts = np.diff(first)
    runs = np.where(counts == 0, 0, np.maximum(counts - size + 1, 1))
    row = np.repeat(np.arange(rows), runs)
    heads = np.concatenate(([0], np.cumsum(runs)[:-1])) if rows else np.zeros(0, np.int64)
    start = np.arange(runs.sum()) - np.repeat(heads, runs) + first[:-1][row]
    stop = first[1:][row]
    out = np.zeros(len(start), dtype=np.uint64)
    for k in range(size):
        at = start + k
        inside = at < stop
        term = np.where(inside, hashes[np.minimum(at, len(hashes) - 1)], np.uint64(k + 1)) if len(hashes) else out
        out = mix(out * _BASE + term)
    return out, row
