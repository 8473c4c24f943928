"""Byte-pair merging with a heap of pairs over a linked list of symbols."""

from __future__ import annotations

from heapq import heapify, heappop, heappush

_POSITION = (1 << 32) - 1


def merge(symbols: list, rank: dict) -> list:
    """Merge adjacent ``symbols`` (strings or bytes) by the ranks of their
    concatenations: always the lowest rank, the leftmost of equal ranks.

    Heap entries are rank and position in one integer; an entry whose pair has
    changed since is recognised by its rank and skipped. O(n log n) for n symbols.
    """
    n = len(symbols)
    if n < 2:
        return symbols
    look = rank.get
    heap = []
    for i in range(n - 1):
        r = look(symbols[i] + symbols[i + 1])
        if r is not None:
            heap.append(r << 32 | i)
    if not heap:
        return symbols
    if len(heap) == 1:
        i = heap[0] & _POSITION
        if n == 2:
            return [symbols[0] + symbols[1]]
    heapify(heap)
    live = list(symbols)
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    while heap:
        top = heappop(heap)
        i = top & _POSITION
        left = live[i]
        j = after[i]
        if left is None or j >= n:
            continue
        joined = left + live[j]
        if look(joined) != top >> 32:
            continue
        live[i], live[j] = joined, None
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            r = look(joined + live[k])
            if r is not None:
                heappush(heap, r << 32 | i)
        h = before[i]
        if h >= 0:
            r = look(live[h] + joined)
            if r is not None:
                heappush(heap, r << 32 | h)
    return [s for s in live if s is not None]
