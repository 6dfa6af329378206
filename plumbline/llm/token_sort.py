"""Sorting of pointers to the tokens of many texts by multikey quicksort, and the runs of equal tokens."""

from __future__ import annotations

import numpy as np

LETTERS = np.zeros(256, bool)
LETTERS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True  # bytes of [^\x00-\x40\x5B-\x60\x7B-\x7F]+
SMALL = 16384  # pointers sorted at once, as a last step

#: masks of the first k of 8 bytes
_HEAD = np.array([2**64 - 2 ** (64 - 8 * k) for k in range(9)], np.uint64)


def token_pointers(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray = LETTERS) -> tuple[np.ndarray, np.ndarray]:
    """(first byte, byte behind) of every token; a token never spans two of the texts that ``offsets`` bound."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    flags = np.zeros(n + 2, bool)
    flags[1:-1] = inside[data]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    starts = np.flatnonzero(flags[1:-1] & (~flags[:-2] | cut[:-1]))
    ends = np.flatnonzero(flags[1:-1] & (~flags[2:] | cut[1:])) + 1
    return starts, ends


class Letters:
    """The bytes of tokens read in letters of 8: unsigned numbers that sort like the bytes, zero behind the end.

    No token holds a zero byte, so a letter whose last byte is zero is the last of its token.
    """

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        padded = np.concatenate((data, np.zeros(8, np.uint8)))
        self._at = np.ndarray((len(data) + 1,), ">u8", padded, strides=(1,))
        self.starts, self.ends = starts, ends

    def read(self, pointers: np.ndarray, depth: int) -> np.ndarray:
        """Letter number ``depth`` of the pointed tokens that are longer than 8 * depth bytes, else 0."""
        at = self.starts[pointers] + 8 * depth
        left = np.clip(self.ends[pointers] - at, 0, 8)
        return self._at[np.minimum(at, len(self._at) - 1)].astype(np.uint64) & _HEAD[left]


def _sort_small(letters: Letters, order: np.ndarray, fresh: np.ndarray, low: int, depth: int, letter: np.ndarray) -> None:
    """Sort the pointers order[low:low + len(letter)], all their open runs letter by letter together."""
    by = np.argsort(letter, kind="stable")
    order[low : low + len(letter)], letter = order[low + by], letter[by]
    fresh[low] = True
    at = np.arange(low, low + len(letter))
    run = np.zeros(len(at), np.int64)
    while True:
        opens = np.ones(len(at), bool)
        opens[1:] = (letter[1:] != letter[:-1]) | (run[1:] != run[:-1])
        fresh[at[opens]] = True
        run = np.cumsum(opens) - 1
        more = (letter & np.uint64(255) != 0) & (np.bincount(run)[run] > 1)
        if not more.any():
            return
        at, run, depth = at[more], run[more], depth + 1
        letter = letters.read(order[at], depth)
        by = np.lexsort((letter, run))
        order[at], letter = order[at[by]], letter[by]  # runs are in order, so only letters move


def multikey_sort(letters: Letters, pointers: np.ndarray, small: int = SMALL) -> tuple[np.ndarray, np.ndarray]:
    """(pointers in the order of their tokens, whether each begins a run of equal tokens); equal tokens keep their order.

    A slice whose tokens agree up to a letter is split by that letter into less, equal and greater than a pivot; the equal part
    goes on with the next letter, and is a run once the letter was the last. Small slices are sorted by
    their letters at once. What is open is kept on a list, so depth costs no stack.
    """
    order = pointers.copy()
    fresh = np.zeros(len(order), bool)
    open_ = [(0, len(order), 0, None)]
    while open_:
        low, high, depth, known = open_.pop()
        if low == high:
            continue
        part = order[low:high]
        letter = letters.read(part, depth) if known is None else known
        if high - low <= small:
            _sort_small(letters, order, fresh, low, depth, letter)
            continue
        sample = np.sort(letter[:: max(1, len(letter) // 63)])
        pivot = sample[len(sample) // 2]
        less, equal = letter < pivot, letter == pivot
        greater = ~(less | equal)
        a = low + int(np.count_nonzero(less))
        b = a + int(np.count_nonzero(equal))
        parts, keys = (part[less], part[equal], part[greater]), (letter[less], letter[greater])
        order[low:a], order[a:b], order[b:high] = parts
        open_ += [(low, a, depth, keys[0]), (b, high, depth, keys[1])]
        if pivot & np.uint64(255):
            open_.append((a, b, depth + 1, None))
        else:
            fresh[a] = True
    return order, fresh
