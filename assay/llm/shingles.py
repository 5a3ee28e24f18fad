"""Word shingles of texts as sorted arrays of 64-bit hashes, computed on whole Arrow buffers.

Words are the runs outside ``[\\x20\\x09-\\x0D]`` with A-Z lower-cased; a shingle is ``k``
consecutive words; a text of fewer words, but not none, has its whole sequence as its one
shingle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 18   # of texts hashed at once: each byte takes some 30 bytes of arrays meanwhile
ODD = np.uint64(0x9E3779B97F4A7C15)     # any odd multiplier will do

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_IS_WORD = np.ones(256, bool)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = False


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits in which every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def word_hashes(data: np.ndarray, doc_starts: np.ndarray, word_bytes: np.ndarray = _IS_WORD) -> tuple[np.ndarray, np.ndarray]:
    """Hash and byte place of each run of ``word_bytes``; ``doc_starts`` are the texts' first bytes (ascending)."""
    inside = word_bytes[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    at = doc_starts[doc_starts < len(data)]
    begins[at] = inside[at]
    places = np.flatnonzero(begins)
    if not len(places):
        return np.zeros(0, np.uint64), places
    used = np.flatnonzero(inside)
    first = np.searchsorted(used, places)
    sizes = np.diff(np.r_[first, len(used)])
    powers = np.cumprod(np.r_[np.uint64(1), np.full(int(sizes.max()), ODD)], dtype=np.uint64)
    offset = np.arange(len(used)) - np.repeat(first, sizes)
    values = (_FOLD[data[used]].astype(np.uint64) + np.uint64(1)) * powers[offset]
    return mix(np.add.reduceat(values, first) + sizes.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), places


def _sets(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, k: int) -> Iterator[np.ndarray]:
    words, places = word_hashes(data, starts)
    low, high = np.searchsorted(places, starts), np.searchsorted(places, ends)
    joined = np.zeros(max(len(words) - k + 1, 0), np.uint64)
    for j in range(k if len(joined) else 0):
        joined = mix(joined * ODD + words[j:j + len(joined)])
    for a, b in zip(low.tolist(), high.tolist(), strict=True):
        if b - a >= k:
            shingles = np.sort(joined[a:b - k + 1])
            yield shingles[np.r_[True, shingles[1:] != shingles[:-1]]]
        elif b > a:
            one = np.array([b - a], np.uint64)      # seeded by the count: never equal to a shingle of k words
            for w in words[a:b]:
                one = mix(one * ODD + w)
            yield mix(one + np.uint64(k))
        else:
            yield np.zeros(0, np.uint64)


def shingle_sets(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text of an Arrow string array."""
    texts = texts.cast(pa.large_string())
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    start = 0
    while start < len(texts):
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + SLICE_BYTES, "right")) - 1)
        stop = min(stop, len(texts))
        base = offsets[start]
        yield from _sets(data[base:offsets[stop]], offsets[start:stop] - base, offsets[start + 1:stop + 1] - base, k)
        start = stop
