"""Content-defined anchors of byte strings.

Every window of ``LENGTH`` bytes is given an anchor inside it that depends on
the window's bytes only: the place of the smallest 8-byte-gram hash (leftmost
on a tie) among the ``SPAN`` grams in its middle. Equal windows have equal
anchors, so occurrences of a string can be brought together by the anchor's
surroundings, and neighbouring windows mostly share an anchor.
"""

from __future__ import annotations

import numpy as np

LENGTH = 200
GRAM = 8
SPAN = 65                       # grams a window's anchor is chosen from
LEAD = (LENGTH - GRAM + 1 - SPAN) // 2      # bytes of a window before them: 64
BACK = SPAN + LEAD - 1          # an anchor stands at LEAD to BACK in its window
# All windows of an anchor at c hold the core [c - LEAD, c - BACK + LENGTH).
CORE = LENGTH - (BACK - LEAD)
_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_HIGH = np.uint64(0xFFFFFFFF00000000)
_ODD = 0xD6E8FEB86659FD93


class Powers:
    """Powers of an odd base modulo 2^64 and their inverses, grown on demand."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> None:
        if len(self.up) < n:
            base, inverse = _ODD, pow(_ODD, -1, 1 << 64)
            n = max(n, 1 << 16)
            self.up, self.down = (np.cumprod(np.append(np.ones(1, np.uint64), np.full(n, b, np.uint64)))
                                  for b in (base, inverse))


def windows_by_anchor(data: bytes, powers: Powers) -> tuple[np.ndarray, ...]:
    """(anchor, first window, last window, core hash, context hash): the windows
    [first, last] of each anchor; the context is all their bytes, and its hash
    also covers where the anchor stands in it."""
    n = len(data)
    if n < LENGTH:
        return tuple(np.zeros(0, np.int64) for _ in range(3)) + (np.zeros(0, np.uint64),) * 2
    h = np.ndarray(n - GRAM + 1, "<u8", data, strides=(1,)) * _K1
    h ^= h >> np.uint64(32)
    h *= _K2
    h ^= h >> np.uint64(29)
    least = (h & _HIGH) | np.arange(len(h), dtype=np.uint64)
    width = 1
    while width * 2 <= SPAN:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < SPAN:
        least = np.minimum(least[:len(least) - (SPAN - width)], least[SPAN - width:])
    at = (least[LEAD:LEAD + n - LENGTH + 1] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.diff(at, prepend=-1))
    last = np.append(first[1:], len(at)) - 1
    c = at[first]
    powers.upto(len(h) + 1)
    total = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * powers.up[:len(h)], out=total[1:])

    def hashed(start: np.ndarray, size) -> np.ndarray:
        x = (total[start + size - GRAM + 1] - total[start]) * powers.down[start]
        x ^= x >> np.uint64(31)
        return x * _K2

    core = hashed(c - LEAD, CORE)
    size = last - first + LENGTH
    context = hashed(first, size) ^ (((c - first) * 1009 + size).astype(np.uint64) * _K1)
    return c, first, last, core, context
