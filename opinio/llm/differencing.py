"""Multiway number partitioning by largest differencing (Karmarkar and Karp)."""

from __future__ import annotations

import heapq

import numpy as np


def partition(sizes: list[int], ways: int) -> list[list[int]]:
    """Places every item into one of ``ways`` parts of near-equal sums; returns item numbers.

    A partial partition is a row of part sums, smallest first, less its smallest sum.
    The two with the largest imbalance are merged with opposing ends together: the
    largest part of one with the smallest of the other. Only parts that differ from the
    smallest are stored, so a single item is a row of one. Ties go by item number.
    """
    if ways == 1:
        return [list(range(len(sizes)))]
    # (-imbalance, number of the partition, sums descending, items of each)
    heap = [(-size, i, [size], [[i]]) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    # items of parts that are level with the smallest and hold something
    level: dict[int, list[list[int]]] = {}
    while len(heap) > 1:
        _, a, sums_a, parts_a = heapq.heappop(heap)
        _, b, sums_b, parts_b = heapq.heappop(heap)
        low_a, low_b = level.pop(a, []), level.pop(b, [])
        # full rows of both, largest first, padded with level parts that have items, then none
        parts_a = parts_a + low_a + [[]] * (ways - len(parts_a) - len(low_a))
        parts_b = parts_b + low_b + [[]] * (ways - len(parts_b) - len(low_b))
        whole_a = np.zeros(ways, np.int64)
        whole_a[: len(sums_a)] = sums_a
        whole_b = np.zeros(ways, np.int64)
        whole_b[: len(sums_b)] = sums_b
        sums = whole_a + whole_b[::-1]
        order = np.argsort(-sums, kind="stable")
        sums = sums[order]
        sums -= sums[-1]
        joined = [
            x + y if x and y else x or y
            for x, y in zip(parts_a, reversed(parts_b))
        ]
        joined = [joined[i] for i in order.tolist()]
        above = int(np.count_nonzero(sums))
        rest = [p for p in joined[above:] if p]
        if rest:
            level[a] = rest
        heapq.heappush(heap, (-int(sums[0]), a, sums[:above].tolist(), joined[:above]))
    _, a, _, parts = heap[0] if heap else (0, 0, [], [])
    parts = parts + level.pop(a, [])
    return parts + [[] for _ in range(ways - len(parts))]


def windows(sizes: list[int], capacity: int) -> list[list[int]]:
    """Near-equal windows of at most ``capacity``: as few as the sum needs, one more while one overflows.

    Every size is at most ``capacity``. Ends: with as many ways as items, each has its own.
    """
    ways = max(1, -(-sum(sizes) // capacity))
    while True:
        parts = partition(sizes, ways)
        if max((sum(sizes[i] for i in part) for part in parts), default=0) <= capacity:
            return [part for part in parts if part]
        ways += 1
