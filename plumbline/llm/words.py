"""Words of many texts at once: boundaries and 64-bit hashes by array operations on UTF-8 bytes."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

from plumbline.llm.common import text_bytes

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x2545F4914F6CDD1D  # odd, so that its powers have inverses modulo 2**64
_INVERSE = pow(_BASE, -1, 2**64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: white space of the word pattern [^\x20\x09-\x0D]+
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit words."""
    x = x + GOLDEN
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_OF_BYTE = mix(np.arange(256, dtype=np.uint64))
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(16, int(n).bit_length())
    if size not in _powers:
        up, down = np.full(size, _BASE, np.uint64), np.full(size, _INVERSE, np.uint64)
        up[0] = down[0] = 1
        found = np.cumprod(up), np.cumprod(down)
        if size > 1 << 22:  # of a very long text: used once, not kept
            return found
        _powers[size] = found
    return _powers[size]


class Words(NamedTuple):
    data: np.ndarray  # lower-cased bytes of all texts
    starts: np.ndarray  # first byte of each word
    ends: np.ndarray  # byte behind each word
    first: np.ndarray  # number of words before each text, and of all words
    hashes: np.ndarray  # of the words' bytes


def find_words(texts: pa.Array, space: np.ndarray = SPACE, lower: bool = True) -> Words:
    """Words of the texts (no nulls), A-Z lower-cased; a word never spans two texts."""
    raw, offsets = text_bytes(texts)
    data = LOWER[raw] if lower else raw
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(data, none, none, np.zeros(len(offsets), np.int64), np.zeros(0, np.uint64))
    inside = ~space[data]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | cut[:n]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    up, down = _power_tables(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_OF_BYTE[data] * up[:n], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    return Words(data, starts, ends, np.searchsorted(starts, offsets), hashes)


_STEP = np.uint64(0xD6E8FEB86659FD93)


def chain(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive entries, by the position of its first entry."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    found = hashes[:n].copy()
    for k in range(1, size):
        found = found * _STEP + hashes[k : k + n]
    return mix(found)


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets per text) of distinct shingles, sorted inside each text.

    A text of fewer words has its whole sequence as one shingle, a text without words none.
    """
    per_text = np.diff(words.first)
    counts = np.where(per_text >= size, per_text - size + 1, (per_text > 0).astype(np.int64))
    offsets = np.concatenate(([0], np.cumsum(counts)))
    at = np.arange(offsets[-1]) - np.repeat(offsets[:-1], counts) + np.repeat(words.first[:-1], counts)
    whole = chain(words.hashes, size)
    found = np.empty(len(at), np.uint64)
    long = np.repeat(per_text >= size, counts)
    found[long] = whole[at[long]]
    for text in np.flatnonzero((per_text > 0) & (per_text < size)):
        a, b = words.first[text], words.first[text + 1]
        found[offsets[text]] = chain(words.hashes[a:b], int(b - a))[0] ^ np.uint64(b - a)
    for text in np.flatnonzero(counts > 1):
        found[offsets[text] : offsets[text + 1]].sort()
    fresh = np.ones(len(found), bool)
    fresh[1:] = found[1:] != found[:-1]
    fresh[offsets[:-1][counts > 0]] = True
    kept = np.concatenate(([0], np.cumsum(fresh)))[offsets]
    return found[fresh], kept


def gathered(size: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, offsets) that read runs of ``size`` entries from ``begin`` on, one after the other."""
    offsets = np.concatenate(([0], np.cumsum(size)))
    return np.arange(offsets[-1]) + np.repeat(begin - offsets[:-1], size), offsets


def cut_strings(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.Array:
    """The strings data[begin[i]:end[i]]."""
    at, offsets = gathered(end - begin, begin)
    return pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[at].tobytes()))
