"""In-task helper of the counting join (numpy): how many points are dominated by each query point."""

from __future__ import annotations

import numpy as np


class Dominance:
    """Counts of points ``(a, b)`` with ``a`` before a query's ``a`` and ``b`` before its ``b``.

    The points' ranks by ``b``, in the order of ``a``, are kept as one array of prefix
    counts per bit (a wavelet matrix): a query walks the bits, whatever it counts.
    """

    def __init__(self, a: np.ndarray, b: np.ndarray):
        order = np.argsort(a, kind="stable")
        self.a, self.b = a[order], np.sort(b, kind="stable")
        rank = np.empty(len(b), np.int64)
        rank[np.argsort(b, kind="stable")] = np.arange(len(b))
        now, self.levels = rank[order], []
        for bit in range(max(1, int(len(b)).bit_length()) - 1, -1, -1):
            low = (now >> bit) & 1 == 0
            before = np.zeros(len(now) + 1, np.int32 if len(now) < 1 << 31 else np.int64)
            np.cumsum(low, out=before[1:])
            self.levels.append((bit, before))
            now = np.concatenate([now[low], now[~low]])

    def count(self, a: np.ndarray, b: np.ndarray, a_closed: bool, b_closed: bool) -> np.ndarray:
        """``a_closed``: an equal ``a`` counts as before; likewise ``b_closed``."""
        right = np.searchsorted(self.a, a, "right" if a_closed else "left")
        below = np.searchsorted(self.b, b, "right" if b_closed else "left")
        left, found = np.zeros(len(right), np.int64), np.zeros(len(right), np.int64)
        for bit, before in self.levels:
            zeros = int(before[-1])
            l0, r0 = before[left].astype(np.int64), before[right].astype(np.int64)
            one = (below >> bit) & 1 == 1
            found += np.where(one, r0 - l0, 0)
            left, right = np.where(one, zeros + left - l0, l0), np.where(one, zeros + right - r0, r0)
        return found


def strip_of(first: np.ndarray, second: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many of the borders ``(first, second)``, sorted, are at or before each point ``(a, b)``."""
    before, after = np.searchsorted(first, a, "left"), np.searchsorted(first, a, "right")
    out, tied = before.copy(), np.flatnonzero(after > before)
    for k in np.unique(before[tied]):  # at most one round per border
        rows = tied[before[tied] == k]
        out[rows] = k + np.searchsorted(second[k:after[rows[0]]], b[rows], "right")
    return out


def borders(a: np.ndarray, b: np.ndarray, strips: int) -> tuple[np.ndarray, np.ndarray]:
    """Borders that cut sampled points, sorted by ``(a, b)``, into ``strips`` even parts."""
    order = np.lexsort((b, a))
    at = order[(np.arange(1, strips) * len(order)) // strips] if len(order) else order
    return a[at], b[at]
