"""Vectorised 64-bit hashes of words and shingles over Arrow text columns."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

#: Bytes that are hashed at once; the working arrays are eight times as large.
CHUNK = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_STEPS = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)


def values(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; nulls are empty."""
    import pyarrow as pa

    if column.null_count:
        column = column.cast(pa.large_binary()).fill_null(b"")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if offsets else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data and data.size else np.zeros(0, np.uint8)), at


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9FB21C651E98DF25)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


@lru_cache(4)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    inverse = pow(_BASE, -1, 1 << 64)
    out = []
    for base in (_BASE, inverse):
        p = np.full(n, base, np.uint64)
        p[:1] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """A random number for each byte, A-Z like a-z; and which bytes are in words."""
    numbers = np.random.Generator(np.random.PCG64(17)).integers(1, 1 << 63, 256, np.uint64)
    numbers[65:91] = numbers[97:123]
    inside = np.ones(256, bool)
    inside[[0x20, 9, 10, 11, 12, 13]] = False
    return numbers, inside


def _words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, start) of the words of one chunk; no word reaches over one of ``starts``."""
    numbers, inside = _tables()
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    up, down = powers(CHUNK if n <= CHUNK else 1 << int(n - 1).bit_length())
    held = inside[data]
    opens = held.copy()
    opens[1:] &= ~held[:-1]
    first = starts[starts < n]
    opens[first] = held[first]
    closes = held.copy()
    closes[:-1] &= ~held[1:]
    before = first[first > 0] - 1
    closes[before] = held[before]
    a, b = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(numbers[data] * up[:n], out=sums[1:])
    return mix((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64)), a


def word_hashes(data: np.ndarray, offsets: np.ndarray):
    """Yields (first document, word hashes, words before each document and at the end) for runs of documents.

    Runs hold about CHUNK bytes. A longer document is a run of its own, hashed in slices that end between words.
    """
    _, inside = _tables()
    doc, n = 0, len(offsets) - 1
    while doc < n:
        last = int(np.searchsorted(offsets, offsets[doc] + CHUNK, "right")) - 1
        last = min(max(last, doc + 1), n)
        part = data[offsets[doc] : offsets[last]]
        if len(part) <= CHUNK:
            starts = offsets[doc:last] - offsets[doc]
            hashes, at = _words(part, starts)
            yield doc, hashes, np.append(np.searchsorted(at, starts), len(at))
        else:
            found, at = [], 0
            while at < len(part):
                end = min(at + CHUNK, len(part))
                while end < len(part):
                    gaps = np.flatnonzero(~inside[part[at:end]])
                    if len(gaps):
                        end = at + int(gaps[-1]) + 1
                        break
                    end = min(end + CHUNK, len(part))
                found.append(_words(part[at:end], np.zeros(1, np.int64))[0])
                at = end
            hashes = np.concatenate(found)
            yield doc, hashes, np.array([0, len(hashes)])
        doc = last


def shingles(words: np.ndarray, bounds: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds) of every document's shingles of ``size`` words; fewer words make one shingle."""
    counts = np.diff(bounds)
    total = len(words)
    made = np.zeros(max(total, 1), np.uint64)
    for k in range(size):
        made[: max(total - k, 0)] += words[k:] * _STEPS[k % 5] if k < total else 0
    keep = np.zeros(total, bool)
    outs = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    new = np.concatenate([[0], np.cumsum(outs)])
    if total:
        place = np.arange(total) - np.repeat(bounds[:-1], counts)
        keep = place < np.repeat(outs, counts)
    short = np.flatnonzero((counts > 0) & (counts < size))
    for d in short:
        own = words[bounds[d] : bounds[d + 1]]
        made[bounds[d]] = (own * _STEPS[: len(own)]).sum(dtype=np.uint64) + np.uint64(len(own))
    return mix(made[:total][keep]), new


def shingle_sets(column, size: int = 5):
    """Yields (document, sorted distinct shingle hashes) for every row of an Arrow column, empty ones included."""
    data, offsets = values(column)
    for first, words, bounds in word_hashes(data, offsets):
        hashes, at = shingles(words, bounds, size)
        for d in range(len(bounds) - 1):
            yield first + d, np.unique(hashes[at[d] : at[d + 1]])
