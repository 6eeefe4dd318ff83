"""Texts of an Arrow batch as one byte buffer, and word hashes computed over it with numpy.

All helpers are byte-wise on UTF-8. Separators are given as a table of 256 flags;
bytes from 0x80 on always belong to a word unless the table says otherwise.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

ONE = np.uint64(1)
END_OF_TEXT = np.uint64(0x9E6C63D0876A9A99)  # stands for the end of a text where a model counts it


def flags(pattern_bytes) -> np.ndarray:
    """Table of 256 flags, true for the given byte values."""
    table = np.zeros(256, dtype=bool)
    table[list(pattern_bytes)] = True
    return table


#: complement of ``[^\x20\x09-\x0D]``
SPACES = flags([0x20, *range(0x09, 0x0E)])
#: complement of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]``
NOT_ALNUM = flags([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32


def pack(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and text offsets (one more than texts) of a string array; null counts as empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)
    offsets = offsets[texts.offset:texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.empty(0, np.uint8)
    first = offsets[0] if len(offsets) else 0
    return data[first:offsets[-1]], offsets - first


def slices(batch: pa.RecordBatch, column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Row slices of a batch whose texts hold about ``max_bytes``; a longer text is a slice of its own."""
    if not batch.num_rows:
        return
    _, offsets = pack(batch.column(column))
    start = 0
    while start < batch.num_rows:
        stop = int(np.searchsorted(offsets, offsets[start] + max_bytes, side="right")) - 1
        stop = min(max(stop, start + 1), batch.num_rows)
        yield batch.slice(start, stop - start)
        start = stop


def release() -> None:
    """Give freed memory back to the machine at the end of a task: Spark keeps its Python workers, and each would hold on to its peak."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over a 64-bit hash."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def keys(count: int, salt: int) -> np.ndarray:
    """The first ``count`` numbers of a fixed pseudo-random sequence."""
    return mix((np.arange(count, dtype=np.uint64) + ONE) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt))


def word_spans(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray):
    """Starts and ends of all words, and per text the index of its first word (one more than texts)."""
    inside = ~separators[data]
    before = np.empty_like(inside)
    if len(inside):
        before[0] = False
        before[1:] = inside[:-1]
        edges = offsets[:-1][offsets[:-1] < len(data)]
        before[edges] = False
    starts = np.flatnonzero(inside & ~before)
    if len(inside):
        before[:-1] = inside[1:]
        before[-1] = False
        edges = offsets[1:][offsets[1:] > 0]
        before[edges - 1] = False
    ends = np.flatnonzero(inside & ~before) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, block_bytes: int = 1 << 18) -> np.ndarray:
    """64-bit hash of every (non-empty, ascending, disjoint) byte span: a random key per position.

    Spans are hashed in blocks of about ``block_bytes``, as the work takes some 50 bytes for each byte of them.
    """
    hashes = np.empty(len(starts), np.uint64)
    if not len(starts):
        return hashes
    lengths = ends - starts
    tails = np.cumsum(lengths)
    salt = keys(int(lengths.max()), 0x51)
    first = 0
    while first < len(starts):
        done = int(tails[first - 1]) if first else 0
        stop = max(first + 1, int(np.searchsorted(tails, done + block_bytes, side="right")))
        size = lengths[first:stop]
        heads = np.cumsum(size) - size
        within = np.arange(int(size.sum()), dtype=np.int64) - np.repeat(heads, size)
        values = data[within + np.repeat(starts[first:stop], size)].astype(np.uint64) + ONE
        values *= salt[within]
        hashes[first:stop] = mix(np.add.reduceat(values, heads))
        first = stop
    return hashes


def words(texts: pa.Array, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words after lower-casing A-Z, and the first word of each text."""
    data, offsets = pack(texts)
    data = LOWER[data]
    starts, ends, first = word_spans(data, offsets, separators)
    return span_hashes(data, starts, ends), first


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all ranges one after the other."""
    heads = np.cumsum(lengths) - lengths
    return np.arange(int(lengths.sum()), dtype=np.int64) + np.repeat(starts - heads, lengths)
