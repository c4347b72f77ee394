"""Hashes of words and word shingles, computed with numpy over the text column of an Arrow batch.

The functions see the UTF-8 bytes of many texts at once and run inside Spark tasks. Work arrays are made for
about a megabyte of text at a time; what is kept is eight bytes a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Words of a shingle.
SHINGLE_WORDS = 5
CHUNK_BYTES = 1 << 20

_U = np.uint64


def _table(separators: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(separators)] = True
    return out


#: White space only: words are what other characters stand between.
WHITE_SPACE = _table(b" \t\n\x0b\x0c\r")
#: Everything in ASCII but letters and digits; other characters count as letters.
NOT_WORD = _table(bytes(c for c in range(128) if not chr(c).isalnum()))
SAME = np.arange(256, dtype=np.uint8)
#: ASCII capitals as small letters.
LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], dtype=np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_POWERS = np.multiply.accumulate(np.full(1 << 12, 0x9E3779B97F4A7C15, dtype=np.uint64))


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        _POWERS = np.multiply.accumulate(np.full(1 << (n - 1).bit_length(), 0x9E3779B97F4A7C15, dtype=np.uint64))
    return _POWERS


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, one after another, and where each begins (and the last ends). Null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    where = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[where[0] : where[-1]], where - where[0]


def _cut(buffer: np.ndarray, edges: np.ndarray, low: int, separator: np.ndarray) -> int:
    """Where the piece that begins at ``low`` ends: behind a separator or between texts."""
    high = low + CHUNK_BYTES
    if high >= len(buffer):
        return len(buffer)
    edge = int(edges[np.searchsorted(edges, high, side="right") - 1])
    back = np.flatnonzero(separator[buffer[max(low, high - 4096) : high]])
    found = max(low, high - 4096) + int(back[-1]) + 1 if len(back) else low
    if max(edge, found) > low:
        return max(edge, found)
    next_edge = int(edges[np.searchsorted(edges, high, side="left")])  # a word of over 4096 bytes: go on to its end
    while high < next_edge:
        ahead = np.flatnonzero(separator[buffer[high : min(high + CHUNK_BYTES, next_edge)]])
        if len(ahead):
            return high + int(ahead[0]) + 1
        high += CHUNK_BYTES
    return next_edge


def word_hashes(
    buffer: np.ndarray, edges: np.ndarray, separator: np.ndarray = WHITE_SPACE, fold: np.ndarray = SAME
) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and the number of words of every text; ``buffer`` and ``edges`` as from ``text_bytes``."""
    hashes, places, low = [], [], 0
    while low < len(buffer):
        high = _cut(buffer, edges, low, separator)
        piece = buffer[low:high]
        gap = separator[piece]
        first = np.empty(len(piece), dtype=bool)
        first[0] = True
        first[1:] = gap[:-1]
        inside = edges[np.searchsorted(edges, low) : np.searchsorted(edges, high)]
        first[inside - low] = True
        starts = np.flatnonzero(first & ~gap)
        if len(starts):
            lengths = np.diff(starts, append=len(piece))
            at = np.arange(starts[0], len(piece)) - np.repeat(starts, lengths)
            value = fold[piece[starts[0] :]].astype(np.uint64) + _U(1)
            value[gap[starts[0] :]] = 0
            value *= _powers(int(lengths.max()))[at]
            hashes.append(mix(np.add.reduceat(value, starts - starts[0])))
            places.append(starts + low)
        low = high
    if not hashes:
        return np.zeros(0, dtype=np.uint64), np.zeros(len(edges) - 1, dtype=np.int64)
    return np.concatenate(hashes), np.diff(np.searchsorted(np.concatenate(places), edges))


_STEPS = mix(np.arange(1, 65, dtype=np.uint64)) | _U(1)


def shingle_hashes(words: np.ndarray, counts: np.ndarray, n: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``n`` words within a text, and the number of runs of every text.

    A text of fewer words has one shingle of all of them, a text without words none. Repeated shingles stay.
    """
    ends = np.cumsum(counts)
    end_of = np.repeat(ends, counts)
    at = np.arange(len(words))
    total = np.zeros(len(words), dtype=np.uint64)
    for k in range(n):
        m = len(words) - k
        if m <= 0:
            break
        total[:m] += np.where(at[:m] + k < end_of[:m], words[k:] * _STEPS[k], _U(0))
    short = np.repeat((counts < n) & (counts > 0), counts) & (at == np.repeat(ends - counts, counts))
    kept = (at + n <= end_of) | short
    return mix(total[kept] + np.minimum(end_of - at, n)[kept].astype(np.uint64)), np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))


def shingles_of(column: pa.Array | pa.ChunkedArray, n: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    return shingle_hashes(*word_hashes(*text_bytes(column)), n)


def slices(batch: pa.RecordBatch, text: str, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of at most so many bytes of text, but one row at least."""
    lengths = np.diff(text_bytes(batch.column(text))[1])
    total, low = 0, 0
    for i, n in enumerate(lengths):
        if total and total + n > most_bytes:
            yield batch.slice(low, i - low)
            total, low = 0, i
        total += int(n)
    if low < len(lengths):
        yield batch.slice(low)
