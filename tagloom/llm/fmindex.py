"""FM-index over a shard of word symbols: a suffix order, a wavelet matrix and sampled positions.

Symbol 0 separates: it stands for words outside the alphabet and for document ends. Two separators
compare by position, so no phrase reaches across one and suffixes need no order beyond it.
"""

from __future__ import annotations

import numpy as np

#: Every so many positions of the text keep their place; a walk to a kept one is shorter than this.
SAMPLE = 8


def suffix_order(symbols: np.ndarray, bits: int) -> np.ndarray:
    """Start positions in the order of their suffixes; the last symbol is 0."""
    n = len(symbols)
    depth = max(1, 62 // bits)
    padded = np.concatenate((symbols.astype(np.int64), np.zeros(depth, dtype=np.int64)))
    key = np.zeros(n, dtype=np.int64)
    ended = np.zeros(n, dtype=bool)
    for d in range(depth):
        key <<= bits
        key |= np.where(ended, 0, padded[d : d + n])
        ended |= padded[d : d + n] == 0
    order = np.argsort(key)
    new = np.ones(n + 1, dtype=bool)
    new[1:-1] = key[order[1:]] != key[order[:-1]]
    group = np.maximum.accumulate(np.where(new[:-1], np.arange(n), 0))
    rank = np.empty(n, dtype=np.int64)
    rank[order] = group
    # What has ended ranks by position; after that a tie can only be broken further on.
    tied = np.flatnonzero(~(new[:-1] & new[1:]))
    tied = tied[ended[order[tied]]]
    step = 0
    while True:
        at = order[tied]
        following = rank[at + step] if step else at
        inner = np.argsort(group[tied] * n + following)
        key = (group[tied] * n + following)[inner]
        order[tied] = at = at[inner]
        fresh = np.ones(len(tied), dtype=bool)
        fresh[1:] = key[1:] != key[:-1]
        new[tied] = fresh
        group[tied] = np.maximum.accumulate(np.where(fresh, tied, 0))
        rank[at] = group[tied]
        step = step * 2 or depth
        tied = np.flatnonzero(~(new[:-1] & new[1:]))
        if not len(tied):
            break
    return order


class FMIndex:
    """Counts and places of phrases in ``symbols`` (values below 2**bits, the first and the last one 0)."""

    def __init__(self, symbols: np.ndarray, bits: int) -> None:
        order = suffix_order(symbols, bits)
        self.bits = bits
        self.n = len(symbols)
        before = symbols[order - 1].astype(np.int32)
        self.before = before
        counts = np.bincount(symbols, minlength=1 << bits)
        self.first = np.concatenate(([0], np.cumsum(counts)))[:-1].astype(np.int64)
        self.kept = (order % SAMPLE == 0) | (before == 0)
        self.place = np.where(self.kept, order, -1)
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        level = before
        for b in range(bits - 1, -1, -1):
            bit = (level >> b) & 1
            sums = np.zeros(self.n + 1, dtype=np.int32)
            np.cumsum(bit, out=sums[1:])
            self.ones.append(sums)
            self.zeros.append(self.n - int(sums[-1]))
            high = bit.astype(bool)
            level = np.concatenate((level[~high], level[high]))
        everything = np.arange(1 << bits)
        self.base = self._down(everything, np.zeros(len(everything), dtype=np.int64))

    def _down(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for depth, b in enumerate(range(self.bits - 1, -1, -1)):
            ones = self.ones[depth][i]
            i = np.where((symbol >> b) & 1, self.zeros[depth] + ones, i - ones)
        return i

    def step(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Row of the suffix that ``symbol`` and the i-th suffix make: its first row plus a rank."""
        return self.first[symbol] + self._down(symbol, i) - self.base[symbol]

    def ranges(self, phrases: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) of each phrase; phrases are rows of symbols, the unused ends ignored."""
        low = np.zeros(len(phrases), dtype=np.int64)
        high = np.full(len(phrases), self.n, dtype=np.int64)
        for k in range(phrases.shape[1] - 1, -1, -1):
            now = np.flatnonzero((sizes > k) & (low < high))
            symbol = phrases[now, k]
            low[now], high[now] = self.step(symbol, low[now]), self.step(symbol, high[now])
        return low, np.maximum(low, high)

    def places(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: each walks back to a kept position."""
        rows = rows.copy()
        out = np.empty(len(rows), dtype=np.int64)
        waiting = np.arange(len(rows))
        walked = 0
        while len(waiting):
            here = rows[waiting]
            done = self.kept[here]
            out[waiting[done]] = self.place[here[done]] + walked
            waiting, here = waiting[~done], here[~done]
            rows[waiting] = self.step(self.before[here], here)
            walked += 1
        return out
