"""Word spans and hashes of whole texts, computed on Arrow buffers with numpy.

A batch of texts is handled in chunks of about ``CHUNK_BYTES`` of UTF-8, so that memory
follows the longest single text and never the batch. Words are runs of anything but
ASCII blanks (``[^\\x20\\x09-\\x0D]+``); code points are counted, not bytes, where asked.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

BLANK = np.zeros(256, dtype=bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values (the finishing steps of splitmix64)."""
    # One new array and one for the shifts; every further step is in place.
    y = x >> np.uint64(30)
    y ^= x
    y *= _M1
    y ^= y >> np.uint64(27)
    y *= _M2
    y ^= y >> np.uint64(31)
    return y


def unit(x: np.ndarray) -> np.ndarray:
    """Uniform numbers in (0, 1] from scattered 64-bit values."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1.0) * (1.0 / (1 << 53))


@dataclass
class Chunk:
    """Texts ``first`` to ``first + n`` of a batch as one padded byte array."""

    first: int
    data: np.ndarray
    offsets: np.ndarray
    padded: np.ndarray

    @property
    def n(self) -> int:
        return len(self.offsets) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; missing texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    body = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return body, ends


def chunks(column: pa.Array, lower: bool = False, size: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Cut a column into runs of whole texts of about ``size`` bytes."""
    if len(column) == 0:
        return
    body, ends = utf8(column)
    first = 0
    while first < len(ends) - 1:
        last = int(np.searchsorted(ends, ends[first] + size, side="right")) - 1
        last = min(max(last, first + 1), len(ends) - 1)
        own = body[ends[first] : ends[last]]
        padded = np.zeros(len(own) + 8, dtype=np.uint8)
        padded[: len(own)] = LOWER[own] if lower else own
        yield Chunk(first, padded[: len(own)], (ends[first : last + 1] - ends[first]), padded)
        first = last


def word_spans(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every word of a chunk."""
    inside = ~BLANK[chunk.data]
    size = len(inside)
    if not size:
        empty = np.empty(0, np.int64)
        return empty, empty, empty
    cut = np.zeros(size + 1, dtype=bool)
    cut[chunk.offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | cut[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | cut[1:-1]
    start = np.flatnonzero(starts)
    owner = np.searchsorted(chunk.offsets, start, side="right") - 1
    return start, np.flatnonzero(ends) + 1, owner


def span_hashes(chunk: Chunk, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, eight bytes of all spans at a time."""
    eights = np.ndarray((len(chunk.padded) - 7,), "<u8", chunk.padded.tobytes(), 0, (1,))
    length = (end - start).astype(np.int64)
    hashed = mix(length.astype(np.uint64) * _GOLDEN + np.uint64(1))
    active, at = np.arange(len(start)), 0
    while len(active):
        left = np.minimum(length[active] - at, 8).astype(np.uint64)
        value = eights[start[active] + at]
        value &= np.uint64(0xFFFFFFFFFFFFFFFF) >> ((np.uint64(8) - left) * np.uint64(8))
        hashed[active] = mix((hashed[active] ^ value) + _GOLDEN)
        at += 8
        active = active[length[active] > at]
    return hashed


def span_heads(chunk: Chunk, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The first eight bytes of spans (zeros after a shorter one)."""
    eights = np.ndarray((len(chunk.padded) - 7,), "<u8", chunk.padded.tobytes(), 0, (1,))
    short = np.uint64(8) - np.minimum(end - start, 8).astype(np.uint64)
    return eights[start] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (short * np.uint64(8)))


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` neighbouring word hashes."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    factor = np.uint64(1)
    for k in range(size):
        factor = np.uint64((int(factor) * int(_M1) + 2 * k + 1) & 0xFFFFFFFFFFFFFFFF) | np.uint64(1)
        total += words[k : k + n] * factor
    return mix(total)


def shingles(words: np.ndarray, owner: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes with their texts. A text of fewer words has one shingle of all its words."""
    whole = window_hashes(words, size)
    own = owner[: len(whole)]
    fits = own == owner[size - 1 :] if len(whole) else np.empty(0, bool)
    value, texts = whole[fits], own[fits]
    if len(owner):
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        count = np.diff(np.r_[first, len(owner)])
        for at, n in zip(first[count < size], count[count < size], strict=True):
            value = np.append(value, mix(window_hashes(words[at : at + n], int(n)) + np.uint64(n)))
            texts = np.append(texts, owner[at])
    return value, texts


def held_out(ids: pa.Array, modulus: int, remainder: int) -> np.ndarray:
    """Whether crc32 of the id written as text leaves the remainder (a missing id: as ``""``)."""
    import zlib

    values = ids.to_pylist()
    return np.array(
        [zlib.crc32(b"" if v is None else str(v).encode()) % modulus == remainder for v in values],
        dtype=bool,
    )
