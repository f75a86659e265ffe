"""Vectorised words, shingles and hashes of Arrow text batches (numpy, no per-word Python).

Words are runs of bytes other than space and \\t \\n \\v \\f \\r of the UTF-8 text. Each byte stands for
a random number that depends on its place in the word; up to 64 of them are summed (from running
sums over about a megabyte of text), and the sums of a longer word are mixed with their number
before they are added up. Nothing is a polynomial of the bytes, whose collisions can be built.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_STEP = U(0xD6E8FEB86659FD93)
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_SEGMENT, _AT_ONCE = 64, 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit (splitmix64)."""
    x = x.astype(U, copy=True)
    x += U(0x9E3779B97F4A7C15)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


_BYTES = mix(np.arange(_SEGMENT * 256, dtype=U) * U(3) + U(0x5851F42D4C957F2D)).reshape(_SEGMENT, 256)
_TABLES = {False: _BYTES.ravel(), True: _BYTES[:, _LOWER].ravel()}  # True: upper-case ASCII counts as lower case


def _sums(data: np.ndarray, start: np.ndarray, end: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Sum of the bytes' numbers of every segment (at most 64 bytes each), about a megabyte at a time."""
    out = np.empty(len(start), dtype=U)
    i = 0
    while i < len(start):
        j = max(int(np.searchsorted(end, start[i] + _AT_ONCE, side="right")), i + 1)
        lo, hi = start[i], end[j - 1]
        first = (start[i:j] - lo).astype(np.int32)
        place = np.arange(hi - lo, dtype=np.int32)
        place -= np.repeat(first, np.diff(np.append(first, np.int32(hi - lo))))
        place &= _SEGMENT - 1
        place <<= 8
        place |= data[lo:hi]
        sums = np.zeros(hi - lo + 1, dtype=U)
        np.cumsum(table[place], out=sums[1:])
        out[i:j] = sums[end[i:j] - lo] - sums[first]
        i = j
    return out


class Words:
    """Word hashes of some texts: ``hash`` for all of them, text i at ``bounds[i]:bounds[i+1]``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool):
        n = len(data)
        flag = _IS_WORD[data]
        edge = np.empty(n, dtype=bool)
        edge[1:] = flag[:-1]
        edge[offsets[:-1][offsets[:-1] < n]] = False
        self.start = np.flatnonzero(flag & ~edge)
        edge[:-1] = flag[1:]
        edge[offsets[1:][offsets[1:] > 0] - 1] = False
        self.end = np.flatnonzero(flag & ~edge) + 1
        del flag, edge
        self.bounds = np.searchsorted(self.start, offsets)
        self.data = data
        length = self.end - self.start
        if len(length) and length.max() > _SEGMENT:
            count = -(-length // _SEGMENT)
            begin = np.cumsum(count) - count
            number = np.arange(count.sum()) - np.repeat(begin, count)
            at = np.repeat(self.start, count) + number * _SEGMENT
            sums = _sums(data, at, np.minimum(at + _SEGMENT, np.repeat(self.end, count)), _TABLES[lower])
            mixed = mix(sums + (number.astype(U) + U(1)) * _STEP)
            total = np.where(count > 1, np.add.reduceat(mixed, begin), sums[begin])
        else:
            total = _sums(data, self.start, self.end, _TABLES[lower])
        self.hash = mix(total ^ (length.astype(U) * _STEP))

    def shingles(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the n words from every position, and which positions have n words in their text."""
        h, total = self.hash, len(self.hash)
        acc = np.zeros(total, dtype=U)
        m = total - n + 1
        if m > 0:
            acc[:m] = h[:m]
            for j in range(1, n):
                acc[:m] = acc[:m] * _STEP + h[j:m + j]
            acc[:m] = mix(acc[:m] + U(n))
        room = np.zeros(total, dtype=bool)
        counts = np.diff(self.bounds)
        left = np.repeat(self.bounds[1:], counts) - np.arange(total)
        room[left >= n] = True
        return acc, room

    def whole(self, i: int) -> np.uint64:
        """Hash of all words of text i as one sequence."""
        return sequence_hash(self.hash[self.bounds[i]:self.bounds[i + 1]])

    def shingle_sets(self, n: int) -> Iterator[np.ndarray]:
        """Sorted distinct n-word shingles of each text; shorter texts are one shingle."""
        acc, room = self.shingles(n)
        for i in range(len(self.bounds) - 1):
            a, b = self.bounds[i], self.bounds[i + 1]
            if b - a >= n:
                yield np.unique(acc[a:b - n + 1])
            elif b > a:
                yield np.array([self.whole(i)], dtype=U)
            else:
                yield np.empty(0, dtype=U)


def sequence_hash(h: np.ndarray) -> np.uint64:
    """Order-sensitive hash of a sequence of hashes, its length included."""
    total = np.sum(mix(h + np.arange(1, len(h) + 1, dtype=U) * _STEP), dtype=U, keepdims=True)
    return mix(total + np.array([len(h)], dtype=U) * _STEP)[0]


def chunks(batch: pa.RecordBatch, column: str = "text", max_bytes: int = 1 << 20):
    """Split a batch into (slice, data, offsets) of about ``max_bytes`` of text; null is empty.

    A single longer text is a chunk of its own, so that texts are always whole.
    """
    text = batch.column(batch.schema.get_field_index(column))
    if text.null_count:
        text = text.fill_null("")
    if not pa.types.is_string(text.type):
        text = text.cast(pa.string())
    n = len(text)
    if n == 0:
        return
    buffers = text.buffers()
    off = np.frombuffer(buffers[1], dtype=np.int32)[text.offset:text.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.empty(0, np.uint8)
    at = 0
    while at < n:
        end = int(np.searchsorted(off, off[at] + max_bytes, side="right")) - 1
        end = min(max(end, at + 1), n)
        yield batch.slice(at, end - at), raw[off[at]:off[end]], off[at:end + 1] - off[at]
        at = end


def words_of(batch: pa.RecordBatch, lower: bool, column: str = "text"):
    """(slice, Words) for every chunk of a batch."""
    for part, data, offsets in chunks(batch, column):
        yield part, Words(data, offsets, lower)


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)
