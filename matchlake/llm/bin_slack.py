"""Minimum bin slack: windows filled as close to their capacity as the remaining lengths allow.

The state is a multiset of lengths (how many are left of each), so that equal lengths cost nothing. A window starts with the
longest one; a subset-sum program over bitsets, in which bit s says that a sum of s can be reached, finds the best filling of the
rest, and going back over the bitsets gives how many of each length are in it.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterable


class Lengths:
    """How many pieces of each length are left."""

    def __init__(self, lengths: Iterable[int] = ()) -> None:
        self.counts: dict[int, int] = {}
        for length in lengths:
            self.counts[length] = self.counts.get(length, 0) + 1
        self.keys = sorted(self.counts)

    def add(self, length: int) -> None:
        if length not in self.counts:
            insort(self.keys, length)
        self.counts[length] = self.counts.get(length, 0) + 1

    def take(self, length: int, times: int) -> None:
        self.counts[length] -= times
        if not self.counts[length]:
            del self.counts[length]
            del self.keys[bisect_right(self.keys, length) - 1]

    def longest(self) -> int:
        return self.keys[-1]

    def best(self, capacity: int) -> dict[int, int]:
        """Lengths and counts of the multiset with the largest sum up to ``capacity``.

        A length with count c enters as 1, 2, 4, ... of its pieces at once, so a step for each power of two is enough.
        """
        full, reached = 1 << capacity, 1
        steps: list[tuple[int, int, int]] = []
        for at in range(bisect_right(self.keys, capacity) - 1, -1, -1):
            length = self.keys[at]
            left, power = min(self.counts[length], capacity // length), 1
            while left and not reached & full:
                pieces = min(power, left)
                steps.append((reached, length, pieces))
                reached |= (reached << length * pieces) & ((full << 1) - 1)
                left, power = left - pieces, 2 * power
            if reached & full:
                break
        total, picked = reached.bit_length() - 1, {}
        for before, length, pieces in reversed(steps):
            if not before >> total & 1:
                picked[length] = picked.get(length, 0) + pieces
                total -= length * pieces
        return picked

    def window(self, capacity: int) -> tuple[dict[int, int], int]:
        """The next window, longest piece first, and how often it can be filled in this way; takes all of these."""
        longest = self.longest()
        self.take(longest, 1)
        picked = self.best(capacity - longest)
        self.add(longest)
        picked = {longest: picked.pop(longest, 0) + 1, **picked}
        # a window with slack is topped up by its caller, which changes what is left
        exact = sum(length * n for length, n in picked.items()) == capacity
        times = min(self.counts[length] // n for length, n in picked.items()) if exact else 1
        for length, n in picked.items():
            self.take(length, n * times)
        return picked, times


def powers(fill: int) -> list[int]:
    """The powers of two that add up to ``fill``, largest first."""
    return [1 << b for b in range(fill.bit_length() - 1, -1, -1) if fill >> b & 1]
