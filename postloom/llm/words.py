"""Words of whole texts as arrays, straight from Arrow's UTF-8 buffers.

A word is a run of bytes that are digits, ASCII letters (lower-cased) or part of a
non-ASCII character.  That is the pattern ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` over the
text with A-Z lower-cased, and it can be decided byte by byte.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

# Bytes of text worked on at a time; a longer single text is one piece of its own.
PIECE_BYTES = 2 << 20
_LONG = 64
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_KEEP = np.array([(1 << (8 * n)) - 1 for n in range(9)], dtype=np.uint64)


def _lower_table() -> np.ndarray:
    table = np.zeros(256, dtype=np.uint8)
    for b in [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]:
        table[b] = b
    for b in range(0x41, 0x5B):
        table[b] = b + 32
    return table


_LOWER = _lower_table()


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; one to one."""
    h = (h ^ (h >> np.uint64(30))) * _M2
    h = (h ^ (h >> np.uint64(27))) * _M3
    return h ^ (h >> np.uint64(31))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of the texts end to end, and where each begins (null: empty)."""
    texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, (offsets - offsets[0]).astype(np.int64)


def pieces(batch: pa.RecordBatch, column: str = "text", limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows of about ``limit`` bytes of text each."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    begin, held = 0, 0
    for i, size in enumerate(sizes):
        if i > begin and held + size > limit:
            yield batch.slice(begin, i - begin)
            begin, held = i, 0
        held += int(size)
    if begin < len(sizes):
        yield batch.slice(begin)


def load_words(data: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """``width`` bytes from each start on, as rows of 64-bit numbers (width a multiple of 8)."""
    window = np.lib.stride_tricks.sliding_window_view(data, width)
    return np.ascontiguousarray(window[starts]).view("<u8")


def hash_runs(padded: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each run of bytes; ``padded`` has at least 8 bytes after the last run."""
    lengths = ends - starts
    h = mix(lengths.astype(np.uint64) * _M1 + _M3)
    short = np.flatnonzero(lengths <= _LONG)
    at = 0
    while short.size:
        key = load_words(padded, starts[short] + at, 8)[:, 0]
        key &= _KEEP[np.minimum(lengths[short] - at, 8)]
        h[short] = mix((h[short] ^ key) * _M1 + _M2)
        at += 8
        short = short[lengths[short] > at]
    for i in np.flatnonzero(lengths > _LONG):
        h[i] = xxhash.xxh64_intdigest(padded[starts[i] : ends[i]].tobytes())
    return h


@dataclass
class Words:
    """Words of some texts: bytes, bounds, hashes, and where each text's words begin."""

    low: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    def joined(self, begin: int, end: int) -> str:
        """Words [begin, end) with one space between."""
        return b" ".join(self.low[self.starts[i] : self.ends[i]].tobytes() for i in range(begin, end)).decode()


def words_of(texts: pa.Array) -> Words:
    data, offsets = text_bytes(texts)
    low = np.zeros(len(data) + 8, dtype=np.uint8)
    np.take(_LOWER, data, out=low[: len(data)])
    inside = low[: len(data)] != 0
    before = np.zeros(len(data) + 1, dtype=bool)  # a word goes on from place i - 1 to place i
    before[1:-1] = inside[1:] & inside[:-1]
    before[offsets] = False
    starts = np.flatnonzero(inside & ~before[:-1])
    ends = np.flatnonzero(inside & ~before[1:]) + 1
    return Words(low, starts, ends, hash_runs(low, starts, ends), np.searchsorted(starts, offsets))


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of words i to i + k for every i; grams across texts are the caller's to leave out."""
    n = max(0, len(hashes) - k + 1)
    powers = np.cumprod(np.full(k, _M1, dtype=np.uint64))
    total = np.full(n, k, dtype=np.uint64) * _M3
    for j in range(k):
        total += hashes[j : j + n] * powers[j]
    return mix(total)


def in_filter(bits: bytes, hashes: np.ndarray) -> np.ndarray:
    """Which hashes the Bloom filter of ``shared.key_filter`` may hold."""
    field = np.frombuffer(bits, dtype=np.uint8)
    mask = np.uint64(len(bits) * 8 - 1)
    out = np.ones(len(hashes), dtype=bool)
    for place in (hashes & mask, (hashes >> np.uint64(32)) & mask):
        out &= (field[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0
    return out


def owner(first: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Number of the text that holds each word place."""
    return np.searchsorted(first, places, side="right") - 1


def lists(values: pa.Array, counts: np.ndarray) -> pa.Array:
    """A list column whose rows take ``counts`` values each."""
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values)
