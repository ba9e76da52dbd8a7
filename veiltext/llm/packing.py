"""Best-fit decreasing on the lengths of one partition, and lower bounds on the number of bins."""

from __future__ import annotations

import numpy as np


class Capacities:
    """A segment tree over the free space of open bins: each node holds how many bins its range has."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.tree = [0] * (2 * self.size)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def put(self, free: int, bin_: int) -> None:
        self.bins[free].append(bin_)
        at = free + self.size
        while at:
            self.tree[at] += 1
            at >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """Removes a bin with the least free space of at least `need`; None if there is none."""
        tree, at = self.tree, need + self.size
        while not tree[at]:
            while at & 1:  # a right child: nothing further right below this parent
                at >>= 1
            if not at:
                return None
            at += 1
        while at < self.size:
            at = 2 * at if tree[2 * at] else 2 * at + 1
        free = at - self.size
        bin_ = self.bins[free].pop()
        while at:
            tree[at] -= 1
            at >>= 1
        return free, bin_


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The bin and the offset in it of each length. Longest first, equal lengths in the given order; 0 fits anywhere."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_bins, used = Capacities(capacity), 0
    values = lengths.tolist()
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = values[i]
        found = open_bins.take(need)
        if found is None:
            found = (capacity, used)
            used += 1
        free, bin_ = found
        bins[i], offsets[i] = bin_, capacity - free
        open_bins.put(free - need, bin_)
    return bins, offsets


def lower_bound(lengths: np.ndarray, capacity: int, counts: np.ndarray | None = None) -> int:
    """The largest bound that dual-feasible functions give for the bins of these lengths (times counts).

    Two families: for a threshold t, lengths above capacity - t count whole, those below t nothing, the rest as they
    are; for k, a length counts floor((k + 1) x / capacity) / k, or x / capacity where that product is whole.
    """
    if counts is None:
        lengths, counts = np.unique(lengths, return_counts=True)
    keep = lengths > 0
    x, n = lengths[keep].astype(np.int64), counts[keep].astype(np.int64)
    if not len(x):
        return int(counts.sum() > 0)
    best = -(-int((x * n).sum()) // capacity)
    for t in np.unique(np.concatenate([x[2 * x <= capacity], capacity - x[2 * x > capacity] + 1])).tolist():
        if 0 < t and 2 * t <= capacity:
            whole = np.where(x > capacity - t, capacity, np.where(x < t, 0, x))
            best = max(best, -(-int((whole * n).sum()) // capacity))
    for k in range(1, 41):
        product = (k + 1) * x
        value = np.where(product % capacity == 0, k * x, product // capacity * capacity)  # in units of 1 / (k capacity)
        best = max(best, -(-int((value * n).sum()) // (k * capacity)))
    return best
