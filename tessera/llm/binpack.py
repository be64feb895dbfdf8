"""Best-fit-decreasing packing of integer lengths, and its lower bound.

Pure functions on one bounded group of lengths; Spark deals the groups.
"""

from __future__ import annotations

import numpy as np


class CapacityTree:
    """Segment tree over remaining capacities 0..capacity: finds the smallest
    capacity >= need that some open bin has."""

    def __init__(self, capacity: int):
        self.size = 1 << (capacity + 1).bit_length()
        self.count = [0] * (2 * self.size)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, index: int) -> None:
        self.bins[room].append(index)
        node = room + self.size
        while node:
            self.count[node] += 1
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove and return (room, bin) of a best-fitting bin, or None."""
        count, node = self.count, need + self.size
        if not count[node]:
            # Up to the first right sibling that holds a bin, then down to its least leaf.
            while node > 1 and (node & 1 or not count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node <<= 1
                if not count[node]:
                    node += 1
        room = node - self.size
        index = self.bins[room].pop()
        while node:
            count[node] -= 1
            node >>= 1
        return room, index


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of every length (1..capacity) and the number of bins.

    Longest first, ties in the order given; each goes into the fullest bin
    that has room, right behind what the bin holds already.
    """
    bins = np.zeros(len(lengths), np.int64)
    offsets = np.zeros(len(lengths), np.int64)
    tree, opened = CapacityTree(capacity), 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        found = tree.take(n)
        if found is None:
            room, index = capacity, opened
            opened += 1
        else:
            room, index = found
        bins[i], offsets[i] = index, capacity - room
        if room > n:
            tree.add(room - n, index)
    return bins, offsets, opened


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """The largest bound that three families of dual feasible functions give.

    A dual feasible function keeps every set that fits into one bin at a total
    of at most 1, so the total over all lengths bounds the bins from below.
    All work is on the histogram of lengths, in integers.
    """
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    value = np.arange(capacity + 1, dtype=np.int64)
    best = -(-int((count * value).sum()) // capacity)
    at_least = count[::-1].cumsum()[::-1]                  # lengths >= v
    mass = np.concatenate([[0], (count * value).cumsum()])  # sum of lengths < v
    for eps in range(1, capacity // 2 + 1):
        # Lengths over capacity - eps count as whole bins, those below eps as nothing.
        whole = int(at_least[capacity - eps + 1])
        middle = int(mass[capacity - eps + 1] - mass[eps])
        best = max(best, whole + -(-middle // capacity))
        # Over one half: 1 - floor((C - v) / eps) / floor(C / eps); else from eps on: 1 / floor(C / eps).
        parts = capacity // eps
        big = value > capacity // 2 if capacity % 2 else value > capacity // 2
        total = (count[big] * (parts - (capacity - value[big]) // eps)).sum()
        small = (~big) & (value >= eps)
        best = max(best, -(-int(total + count[small].sum()) // parts))
    for k in range(1, 101):
        # v if (k + 1) v / C is whole, else floor((k + 1) v / C) C / k; in units of 1 / (k C).
        scaled = (k + 1) * value
        units = np.where(scaled % capacity == 0, value * k, (scaled // capacity) * capacity)
        best = max(best, -(-int((count * units).sum()) // (k * capacity)))
    return best
