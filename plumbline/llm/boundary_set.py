"""A set of positions in containers of 65,536, read by rank: which position is the k-th?"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

SPAN = 1 << 16  # positions one container covers
WORDS = SPAN // 64

ARRAY, BITMAP, RUN = "array", "bitmap", "run"


class Container(NamedTuple):
    """The members of one span, in the form of the least bytes: sorted list, bit per position, or runs."""

    kind: str
    members: np.ndarray  # ARRAY: members; BITMAP: 64-bit words; RUN: first member of each run
    before: np.ndarray  # BITMAP: members before each word; RUN: before each run; ARRAY: empty

    @property
    def nbytes(self) -> int:
        return self.members.nbytes + self.before.nbytes

    def select(self, k: np.ndarray) -> np.ndarray:
        """The members of the ranks ``k``, from 0."""
        if self.kind == ARRAY:
            return self.members[k].astype(np.int64)
        at = np.searchsorted(self.before, k, side="right") - 1
        rest = k - self.before[at]
        if self.kind == RUN:
            return self.members[at].astype(np.int64) + rest
        bits = np.unpackbits(self.members[at].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        return at * 64 + np.argmax(np.cumsum(bits, axis=1) > rest[:, None], axis=1)


def container(members: np.ndarray) -> Container:
    """The smallest container of sorted distinct members below SPAN (at least one)."""
    opens = np.flatnonzero(np.diff(members, prepend=-2) != 1)
    sizes = {ARRAY: 2 * len(members), BITMAP: 10 * WORDS, RUN: 6 * len(opens)}
    kind = min(sizes, key=lambda k: sizes[k])
    if kind == ARRAY:
        return Container(ARRAY, members.astype(np.uint16), np.zeros(0, np.uint16))
    if kind == RUN:
        return Container(RUN, members[opens].astype(np.uint16), opens.astype(np.uint32))
    flags = np.zeros(SPAN, np.uint8)
    flags[members] = 1
    words = np.packbits(flags, bitorder="little").view(np.uint64)
    counts = np.cumsum(np.bitwise_count(words), dtype=np.int64) - np.bitwise_count(words)
    return Container(BITMAP, words, counts.astype(np.uint16))


class BoundarySet:
    """Sorted distinct positions, held in containers with their cumulative cardinalities."""

    def __init__(self, positions: np.ndarray):
        high = positions >> 16
        opens = np.flatnonzero(np.diff(high, prepend=-1))
        edges = np.append(opens, len(positions))
        self.spans = high[opens]
        self.before = edges  # members before each container, and all
        self.containers = [container(positions[a:b] & (SPAN - 1)) for a, b in zip(edges[:-1], edges[1:], strict=True)]

    def __len__(self) -> int:
        return int(self.before[-1])

    @property
    def nbytes(self) -> int:
        return sum(c.nbytes for c in self.containers)

    def select(self, ranks: np.ndarray) -> np.ndarray:
        """The positions of the given ranks, from 0 and below the size of the set, in any order.

        The container is searched in the cumulative cardinalities, the member inside it by its own rank.
        """
        found = np.empty(len(ranks), np.int64)
        at = np.searchsorted(self.before, ranks, side="right") - 1
        order = np.argsort(at, kind="stable")
        edges = np.append(np.flatnonzero(np.diff(at[order], prepend=-1)), len(order))
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            asked = order[a:b]
            k = at[asked[0]]
            found[asked] = (self.spans[k] << 16) + self.containers[k].select(ranks[asked] - self.before[k])
        return found
