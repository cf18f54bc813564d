"""Byte-pair merges of one pre-token, kept as a linked symbol list with a priority queue of merges."""

from __future__ import annotations

from heapq import heapify, heappop, heappush


def symbol_count(piece: bytes, ranks: dict[bytes, int]) -> int:
    """How many symbols survive when the lowest-ranked adjacent pairs of piece are merged first.

    Each symbol knows its left and right neighbour; the queue holds (rank, left symbol, length of the
    merged pair). A pair whose symbols have changed since it was queued is skipped.
    O(n log n) in the length of the piece, so a run of a million signs is no hazard.
    """
    n = len(piece)
    if n < 2 or piece in ranks:
        return min(n, 1)
    begin = list(range(n))  # first byte of the symbol that starts here
    end = list(range(1, n + 1))
    left = list(range(-1, n - 1))
    right = [*range(1, n), -1]
    alive = bytearray(b"\1") * n
    queue = []
    rank = ranks.get
    for i in range(n - 1):
        r = rank(piece[i : i + 2])
        if r is not None:
            queue.append((r, i, 2))
    heapify(queue)
    count = n
    while queue:
        _, i, length = heappop(queue)
        if not alive[i]:
            continue
        j = right[i]
        if j < 0 or end[j] - begin[i] != length:
            continue
        alive[j] = 0
        end[i] = end[j]
        k = right[i] = right[j]
        count -= 1
        if k >= 0:
            left[k] = i
            r = rank(piece[begin[i] : end[k]])
            if r is not None:
                heappush(queue, (r, i, end[k] - begin[i]))
        h = left[i]
        if h >= 0:
            r = rank(piece[begin[h] : end[i]])
            if r is not None:
                heappush(queue, (r, h, end[i] - begin[h]))
    return count
