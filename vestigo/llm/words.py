"""Vectorised kernels over Arrow text: words, shingles and their 64-bit hashes.

A word is a run of bytes outside space and 0x09-0x0D, compared after A-Z is
lower-cased. Word hashes are polynomials over random byte values, modulo 2**64,
taken as differences of prefix sums, so a block of texts costs a few passes of
NumPy whatever its words are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
_U = np.uint64
_SEED = np.random.default_rng(20240229)
_BYTE = _SEED.integers(1, 2**64 - 1, 256, dtype=np.uint64)
_BASE = int(_SEED.integers(2**62, 2**63)) | 1
_INVERSE = pow(_BASE, -1, 2**64)
_PLACE = _SEED.integers(1, 2**64 - 1, 64, dtype=np.uint64) | _U(1)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: tuple[np.ndarray, np.ndarray] | None = None


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if _powers is None or len(_powers[0]) < n:
        size = max(n, BLOCK_BYTES + BLOCK_BYTES // 4)
        out = []
        for base in (_BASE, _INVERSE):
            x = np.full(size, _U(base))
            x[0] = 1
            out.append(np.cumprod(x))
        if n > 4 * BLOCK_BYTES:  # one huge text: not kept for the rest of the worker's life
            return out[0], out[1]
        _powers = out[0], out[1]
    return _powers


def raw_texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and each text's bounds; null counts as empty."""
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    bounds = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def blocks(batch: pa.RecordBatch, column: str = "text", size: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of about ``size`` bytes of text; a longer text is a slice of its own."""
    if not batch.num_rows:
        return
    _, bounds = raw_texts(batch.column(batch.schema.get_field_index(column)))
    start = 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(bounds, bounds[start] + size, "right")) - 1)
        yield batch.slice(start, stop - start)
        start = stop


class Words:
    """The words of a block of texts: byte bounds, owner text and hash of each."""

    def __init__(self, column: pa.Array, lower: bool = True):
        data, bounds = raw_texts(column)
        n = len(bounds) - 1
        buf = np.full(len(data) + n + 1, 10, np.uint8)  # a separator before each text and at the end
        self.first = bounds[:-1] + np.arange(1, n + 1)
        for at, a, b in zip(self.first.tolist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            buf[at : at + b - a] = data[a:b]
        self.raw = buf
        if lower:
            buf = _LOWER[buf]
        self.buf = buf
        edge = np.diff((~_SPACE[buf]).view(np.int8))
        self.start = np.flatnonzero(edge == 1) + 1
        self.end = np.flatnonzero(edge == -1) + 1
        self.texts = n
        self.bound = np.append(np.searchsorted(self.start, self.first), len(self.start))  # words of text i: bound[i]..bound[i+1]
        self.count = np.diff(self.bound)
        self._hash: np.ndarray | None = None

    def take(self, rows: np.ndarray) -> Words:
        """The words of some of the texts, in the given order."""
        out = object.__new__(Words)
        start, stop = self.first - 1, np.append(self.first[1:] - 1, len(self.buf) - 1)
        size = (stop - start)[rows]
        pick = lambda buf: np.concatenate([*(buf[a:b] for a, b in zip(start[rows].tolist(), stop[rows].tolist(), strict=True)), buf[-1:]])
        out.buf = pick(self.buf)
        out.raw = out.buf if self.raw is self.buf else pick(self.raw)
        out.texts, out.count = len(rows), self.count[rows]
        at = np.concatenate([[0], np.cumsum(size)])
        out.first = at[:-1] + 1
        out.bound = np.concatenate([[0], np.cumsum(out.count)])
        word = np.arange(out.bound[-1]) + np.repeat(self.bound[:-1][rows] - out.bound[:-1], out.count)
        shift = np.repeat(at[:-1] - start[rows], out.count)
        out.start, out.end = self.start[word] + shift, self.end[word] + shift
        out._hash = None if self._hash is None else self._hash[word]
        return out

    @property
    def hash(self) -> np.ndarray:
        if self._hash is None:
            power, inverse = _power(len(self.buf))
            c = _BYTE[self.buf]
            c *= power[: len(c)]
            np.cumsum(c, out=c)
            h = c[self.end - 1] - c[self.start - 1]  # position 0 is a separator
            h *= inverse[self.start]
            self._hash = mix(h ^ (self.end - self.start).astype(np.uint64))
        return self._hash

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the ``size`` words from each word on, and whether that many belong to its text."""
        h = self.hash
        if len(h) < size:
            return np.zeros(len(h), np.uint64), np.zeros(len(h), bool)
        out = np.zeros(len(h), np.uint64)
        valid = np.zeros(len(h), bool)
        part = out[: len(h) - size + 1]
        for k in range(size):
            part += h[k : len(h) - size + 1 + k] * _PLACE[k]
        part[:] = mix(part)
        last = np.repeat(self.bound[1:], self.count)
        valid[:] = np.arange(len(h)) + size <= last
        return out, valid

    def shingles(self, size: int, whole_if_short: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Distinct sorted shingle hashes of each text, and the bounds of each text's.

        A text with fewer words has its whole sequence as the one shingle, or none.
        """
        h, valid = self.windows(size)
        bound, count = self.bound, np.maximum(self.count - size + 1, 0)
        h = h[valid]
        at = np.concatenate([[0], np.cumsum(count)])
        for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            if b - a > 1:
                h[a:b].sort()
        if len(h):
            keep = np.ones(len(h), bool)
            keep[1:] = h[1:] != h[:-1]
            keep[at[:-1][count > 0]] = True
            kept = np.concatenate([[0], np.cumsum(keep)])
            h, at = h[keep], kept[at]
        if whole_if_short and (short := np.flatnonzero((self.count > 0) & (self.count < size))).size:
            one = np.zeros(len(short), np.uint64)
            for k, i in enumerate(short.tolist()):
                w = self.hash[bound[i] : bound[i + 1]]
                one[k] = mix(np.array([(w * _PLACE[: len(w)]).sum(dtype=np.uint64) ^ _U(len(w))], np.uint64))[0]
            size_of = np.diff(at)
            h = np.insert(h, at[short], one)
            size_of[short] = 1
            at = np.concatenate([[0], np.cumsum(size_of)])
        return h, at
