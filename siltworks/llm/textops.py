"""Word handling over Arrow string columns, vectorised with numpy.

A word is a maximal run of bytes other than ``0x20`` and ``0x09``-``0x0D`` of the UTF-8 text, unchanged
(no case folding).  Texts are taken in chunks of whole documents, so memory follows the chunk and not the
batch; a document longer than a chunk is a chunk of its own.  Null texts count as empty.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 21
_SLICE = 1 << 17
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (two xor-multiply rounds), element by element."""
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(max(n, 1), base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_BASE = 0x9E3779B97F4A7C15
_PLACE = powers(_BASE, _SLICE)
_BACK = powers(pow(_BASE, -1, 1 << 64), _SLICE)
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _U(0xA0761D6478BD642F))


@dataclass
class Chunk:
    """Documents ``first`` .. ``first + size`` of a batch, with the words of all of them in one row."""

    first: int
    size: int
    data: np.ndarray  # bytes of the documents, one after another
    offsets: np.ndarray  # size + 1 byte offsets of the documents in data
    starts: np.ndarray  # byte offset of each word
    ends: np.ndarray
    bounds: np.ndarray  # size + 1 offsets of the documents in starts

    def words_of(self, i: int) -> list[bytes]:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes().split()

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.size), np.diff(self.bounds))

    def hashes(self) -> np.ndarray:
        return word_hashes(self.data, self.starts, self.ends)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and the offsets of a string or binary column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), at


def chunks(column: pa.Array, budget: int = CHUNK_BYTES) -> Iterator[Chunk]:
    data, at = buffers(column)
    i, n = 0, len(at) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + budget, "right")) - 1)
        own = data[at[i] : at[j]]
        offsets = at[i : j + 1] - at[i]
        starts, ends = spans(own, offsets)
        yield Chunk(i, j - i, own, offsets, starts, ends, np.searchsorted(starts, offsets))
        i = j


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words start and end; no word reaches over the edge of a document."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = ~_SPACE[data]
    before, after = np.empty_like(word), np.empty_like(word)
    before[0], before[1:] = False, word[:-1]
    after[-1], after[:-1] = False, word[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    before[inner] = False
    after[inner - 1] = False
    return np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words: equal for equal bytes, wherever they stand."""
    out = np.empty(len(starts), dtype=np.uint64)
    i, n = 0, len(starts)
    while i < n:
        lo = starts[i]
        j = int(np.searchsorted(ends, lo + _SLICE, "right"))
        if j <= i:  # one word longer than a slice
            out[i] = int.from_bytes(hashlib.blake2b(data[lo : ends[i]].tobytes(), digest_size=8).digest(), "little")
            i += 1
            continue
        total = np.empty(ends[j - 1] - lo + 1, dtype=np.uint64)
        total[0] = 0
        np.cumsum(_BYTE[data[lo : ends[j - 1]]] * _PLACE[: len(total) - 1], out=total[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = mix((total[e] - total[s]) * _BACK[s] + (e - s).astype(np.uint64))
        i = j
    return out


def grams(words: np.ndarray, n: int, base: int = 0xC2B2AE3D27D4EB4F) -> np.ndarray:
    """Hashes of the len(words) - n + 1 runs of n words (also those over the edge of a document)."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = words[:m].copy()
    for j in range(1, n):
        out *= _U(base)
        out += words[j : j + m]
    return mix(out)


def run_hashes(words: np.ndarray, lo: np.ndarray, hi: np.ndarray, base: int = 0x9FB21C651E98DF25) -> np.ndarray:
    """Hashes of words[lo:hi] for many ranges."""
    place, back = powers(base, len(words) + 1), powers(pow(base, -1, 1 << 64), len(words) + 1)
    total = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(words * place[:-1], out=total[1:])
    return mix((total[hi] - total[lo]) * back[lo] + (hi - lo).astype(np.uint64))


def within(bounds: np.ndarray, n: int) -> np.ndarray:
    """Which of the words start a run of n words inside their document."""
    count = np.diff(bounds)
    left = np.repeat(bounds[1:], count) - np.arange(bounds[-1] if len(bounds) else 0)
    return left >= n
