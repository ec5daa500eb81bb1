"""Pair merging shared by the tokenizer operators.

Repeatedly joins the adjacent pair whose joined string has the lowest rank, leftmost first on
ties, until no pair is in the vocabulary.
"""

from __future__ import annotations

import heapq

#: Up to this many parts a plain scan per merge is quicker than a heap.
SCAN_PARTS = 48
NEVER = 1 << 62
#: Of a cache entry beside its bytes: two objects and the slot.
ENTRY_BYTES = 200


def merge(parts: list, rank: dict) -> list:
    """Merge ``parts`` (strings or bytes); ``rank`` maps joined strings to their rank."""
    if len(parts) > SCAN_PARTS:
        return _merge_heap(parts, rank)
    parts = list(parts)
    get = rank.get
    ranks = [get(a + b, NEVER) for a, b in zip(parts, parts[1:])]
    while ranks:
        best = min(ranks)
        if best == NEVER:
            break
        at = ranks.index(best)
        joined = parts[at] + parts[at + 1]
        parts[at:at + 2] = [joined]
        del ranks[at]
        if at:
            ranks[at - 1] = get(parts[at - 1] + joined, NEVER)
        if at < len(ranks):
            ranks[at] = get(joined + parts[at + 1], NEVER)
    return parts


def _merge_heap(parts: list, rank: dict) -> list:
    n = len(parts)
    text, before, after = list(parts), list(range(-1, n - 1)), list(range(1, n + 1))
    get = rank.get
    heap = []

    def offer(i: int) -> None:
        j = after[i]
        if j < n:
            r = get(text[i] + text[j])
            if r is not None:
                heapq.heappush(heap, (r, i, j, len(text[i]), len(text[j])))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, j, li, lj = heapq.heappop(heap)
        if text[i] is None or after[i] != j or text[j] is None or len(text[i]) != li or len(text[j]) != lj:
            continue
        text[i] += text[j]
        text[j] = None
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        if before[i] >= 0:
            offer(before[i])
        offer(i)
    return [t for t in text if t is not None]


class Costs(dict):
    """Cache filled by ``make`` on a miss; holds short keys of at most ``most`` bytes, the objects
    around them included, beside its seed, and starts anew when full."""

    def __init__(self, seed: dict, make, most: int = 32 << 20):
        super().__init__(seed)
        self.make, self.room, self.seed, self.most = make, most, seed, most

    def __missing__(self, key):
        value = self.make(key)
        if len(key) <= 64:
            if self.room <= 0:
                self.clear()
                self.update(self.seed)
                self.room = self.most
            self[key] = value
            self.room -= ENTRY_BYTES + len(key) + (len(value) if isinstance(value, bytes) else 0)
        return value
