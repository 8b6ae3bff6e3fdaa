"""Words of whole texts as numpy arrays, in blocks of bounded size.

Word classes are sets of bytes. Bytes of multi-byte UTF-8 characters are all above 0x7F, so a
class that is closed under them finds the same words in bytes as in code points.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20  # texts handled at once; a longer single text is a block of its own
_HASHED_AT_ONCE = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

# [^\x20\x09-\x0D]+
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False

# [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

_RANDOM = np.random.default_rng(20240601)
_BYTE_CODES = _RANDOM.integers(1, 2**63, size=256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SHINGLE_BASE = np.uint64(0xC2B2AE3D27D4EB4F)


class Words(NamedTuple):
    """Words in order; ``doc`` is the row of the block, ``start`` and ``end`` are byte offsets."""

    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray


def blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, row offsets into them) for runs of rows; nulls count as empty texts."""
    for chunk in texts.chunks if isinstance(texts, pa.ChunkedArray) else [texts]:
        values = pc.fill_null(chunk, "").cast(pa.large_string())
        if not len(values):
            continue
        _, offsets, data = values.buffers()
        at = np.frombuffer(offsets, dtype=np.int64)[values.offset : values.offset + len(values) + 1]
        raw = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, dtype=np.uint8)
        row = 0
        while row < len(values):
            last = max(row + 1, int(np.searchsorted(at, at[row] + limit, side="right")) - 1)
            yield row, raw[at[row] : at[last]], at[row : last + 1] - at[row]
            row = last


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the entropy of 64-bit values over all their bits."""
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def find_words(data: np.ndarray, offsets: np.ndarray, word_class: np.ndarray) -> tuple:
    """(row, start, end) of every maximal run of word bytes inside one row."""
    inside = word_class[data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    filled = offsets[:-1][offsets[1:] > offsets[:-1]]
    opens[filled] = inside[filled]
    last = offsets[1:][offsets[1:] > offsets[:-1]] - 1
    closes[last] = inside[last]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return np.searchsorted(offsets, start, side="right") - 1, start, end


def hashed_words(
    data: np.ndarray, offsets: np.ndarray, word_class: np.ndarray, lower: bool = False
) -> Words:
    """Words with a 64-bit hash of their bytes."""
    folded = LOWER[data] if lower else data
    doc, start, end = find_words(folded, offsets, word_class)
    size = end - start
    hashes = np.empty(len(start), dtype=np.uint64)
    if len(start):
        powers = np.full(int(size.max()), _BASE, dtype=np.uint64)
        powers[0] = 1
        powers = np.multiply.accumulate(powers)
        total = np.cumsum(size)
        cuts = np.unique(np.searchsorted(total, np.arange(0, total[-1], _HASHED_AT_ONCE)))
        for lo, hi in zip(cuts, [*cuts[1:], len(start)], strict=True):
            first = np.cumsum(size[lo:hi]) - size[lo:hi]
            within = np.arange(int(size[lo:hi].sum())) - np.repeat(first, size[lo:hi])
            codes = _BYTE_CODES[folded[within + np.repeat(start[lo:hi], size[lo:hi])]]
            hashes[lo:hi] = np.add.reduceat(codes * powers[within], first)
        hashes = mixed(hashes + size.astype(np.uint64))
    return Words(doc, start, end, hashes)


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of the first word, hash) of every run of ``size`` words inside one row."""
    count = len(words.hash) - size + 1
    if count <= 0:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    value = words.hash[:count].copy()
    for step in range(1, size):
        value = value * _SHINGLE_BASE + words.hash[step : step + count]
    first = np.flatnonzero(words.doc[:count] == words.doc[size - 1 :])
    return first, mixed(value[first] + np.uint64(size))


def strings(data: np.ndarray, offsets: np.ndarray) -> Iterator[str]:
    """The texts of a block."""
    raw = data.tobytes()
    for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        yield raw[lo:hi].decode("utf-8", "replace")
