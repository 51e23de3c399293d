"""Words of Arrow string columns as numpy arrays.

Word classes here are sets of ASCII characters plus everything from U+0080 on, so they can be
told byte by byte in UTF-8. A column is read through its Arrow buffers, without a Python string
for each row or word.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_U = np.uint64
_ALL = np.arange(256)
#: Anything but white space: [^\x20\x09-\x0D]+
NOT_SPACE = ~((_ALL == 0x20) | ((_ALL >= 0x09) & (_ALL <= 0x0D)))
#: Digits, lower-case ASCII letters and everything beyond ASCII.
ALNUM = (((_ALL >= 0x30) & (_ALL <= 0x39)) | ((_ALL >= 0x61) & (_ALL <= 0x7A)) | (_ALL >= 0x80))
#: A-Z to a-z, other bytes as they are.
LOWER = np.where((_ALL >= 0x41) & (_ALL <= 0x5A), _ALL + 32, _ALL).astype(np.uint8)

_BLOCK = 1 << 16
_BASE = 0x9E3779B97F4A7C15 | 1


def _powers(base: int) -> np.ndarray:
    out = np.full(_BLOCK, base & (2**64 - 1), dtype=_U)
    out[0] = 1
    return np.multiply.accumulate(out)


_POW, _INV = _powers(_BASE), _powers(pow(_BASE, -1, 2**64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Words:
    """The words of some rows. ``first[i]`` is the index of row i's first word and ``first[-1]``
    the number of all words; ``starts`` and ``ends`` are byte positions in ``data``."""

    def __init__(self, column: pa.Array, is_word: np.ndarray = NOT_SPACE, lower: bool = True):
        data, bounds = _buffers(column)
        self.data = LOWER[data] if lower else data
        flag = is_word[self.data]
        start, end = flag.copy(), flag.copy()
        if len(flag) > 1:
            start[1:] &= ~flag[:-1]
            end[:-1] &= ~flag[1:]
            inner = bounds[(bounds > 0) & (bounds < len(flag))]
            start[inner] = flag[inner]           # no word runs from one row into the next
            end[inner - 1] = flag[inner - 1]
        self.starts = np.flatnonzero(start)
        self.ends = np.flatnonzero(end) + 1
        self.first = np.searchsorted(self.starts, bounds)
        self.counts = np.diff(self.first)

    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        out = np.empty(len(self.starts), dtype=_U)
        i = 0
        while i < len(out):
            base = int(self.starts[i])
            j = int(np.searchsorted(self.ends, base + _BLOCK, side="right"))
            if j <= i:                           # one word longer than a block
                word = self.data[base:self.ends[i]].tobytes()
                out[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
                i += 1
                continue
            part = self.data[base:self.ends[j - 1]].astype(_U) + _U(1)
            total = np.zeros(len(part) + 1, dtype=_U)
            np.cumsum(part * _POW[:len(part)], out=total[1:])
            a, b = self.starts[i:j] - base, self.ends[i:j] - base
            out[i:j] = mix((total[b] - total[a]) * _INV[a])
            i = j
        return out

    def text(self, start: int, n: int) -> bytes:
        """n words from word ``start`` on, joined by one space."""
        data = self.data
        return b" ".join(data[a:b].tobytes() for a, b in
                         zip(self.starts[start:start + n], self.ends[start:start + n], strict=True))


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all rows, and the n + 1 positions where rows begin and end."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]] if data else np.zeros(0, np.uint8)
    return data, bounds - bounds[0]


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of n consecutive words, from each word that has n - 1 more after it (in any row)."""
    if len(hashes) < n:
        return np.zeros(0, dtype=_U)
    size = len(hashes) - n + 1
    out = np.zeros(size, dtype=_U)
    for j in range(n):
        out *= _U(_BASE)
        out += hashes[j:j + size]
    return mix(out)


def sliding(values: np.ndarray, n: int, op) -> np.ndarray:
    """op (np.minimum or np.maximum) over each n consecutive values."""
    if len(values) < n:
        return values[:0]
    out, width = values, 1
    while width < n:
        step = min(width, n - width)
        out = op(out[:len(out) - step], out[step:])
        width += step
    return out


#: Bytes of text in a slice where several operators share a Python worker, whose memory stays with it.
SLICE = 1 << 20


def slices(batch: pa.RecordBatch, text_col: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with about ``limit`` bytes of text each (a longer text is a
    part of its own), so that numpy's temporary arrays stay small."""
    _, bounds = _buffers(batch.column(batch.schema.get_field_index(text_col)))
    i = 0
    while i < batch.num_rows:
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + limit, side="right")) - 1)
        yield batch.slice(i, j - i)
        i = j
