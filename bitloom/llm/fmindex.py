"""FM-index over a sequence of word codes: suffix array, Burrows-Wheeler transform, wavelet matrix."""

from __future__ import annotations

import numpy as np

SAMPLE = 16


def suffix_array(text: np.ndarray, bits: int) -> np.ndarray:
    """Suffixes of ``text`` (codes of at most ``bits`` bits) in order, by prefix doubling.

    Only suffixes whose order is still open are sorted again; a suffix that ends sorts first.
    """
    n = len(text)
    if n == 0:
        return np.zeros(0, np.int64)
    h = max(1, 62 // bits)
    key = np.zeros(n, np.int64)
    for j in range(h):
        key <<= bits
        if j < n:
            key[: n - j] |= text[j:]
    order = np.argsort(key, kind="stable")
    new = np.empty(n, bool)
    new[0] = True
    s = key[order]
    np.not_equal(s[1:], s[:-1], out=new[1:])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    ends = np.append(new[1:], True)
    slots = np.flatnonzero(~(new & ends))
    # A padded key may tie a short suffix with one that goes on in zeros; the later rounds settle that.
    while len(slots):
        at = order[slots]
        ahead = at + h
        second = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        pair = rank[at] * (n + 1) + second
        by = np.argsort(pair, kind="stable")
        at, pair = at[by], pair[by]
        order[slots] = at
        new = np.empty(len(slots), bool)
        new[0] = True
        np.not_equal(pair[1:], pair[:-1], out=new[1:])
        rank[at] = np.maximum.accumulate(np.where(new, slots, 0))
        slots = slots[~(new & np.append(new[1:], True))]
        h *= 2
    return order


class FMIndex:
    def __init__(self, text: np.ndarray, bits: int, sample: int = SAMPLE) -> None:
        """``text``: codes above 0; 0 is the end mark that is added here."""
        text = np.append(text, 0).astype(np.int64)
        self.n, self.bits = len(text), bits
        order = suffix_array(text, bits)
        last = text[order - 1]
        self.first = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=1 << bits))))
        # Wavelet matrix: from the highest bit down, zeros go before ones, each in stable order.
        self.ranks, self.zeros = [], []
        level = last
        for b in range(bits - 1, -1, -1):
            bit = (level >> b) & 1
            self.ranks.append(np.concatenate((np.zeros(1, np.int32), np.cumsum(bit, dtype=np.int32))))
            self.zeros.append(self.n - int(self.ranks[-1][-1]))
            level = np.concatenate((level[bit == 0], level[bit == 1]))
        marked = (order % sample == 0) | (order == 0)
        self.marks = np.concatenate((np.zeros(1, np.int32), np.cumsum(marked, dtype=np.int32)))
        self.sampled = order[marked]

    def rank(self, code: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of ``code`` in the transform before ``at``."""
        low, high = np.zeros_like(at), at
        for k, b in enumerate(range(self.bits - 1, -1, -1)):
            one = ((code >> b) & 1).astype(bool)
            r = self.ranks[k]
            lo, hi = r[low], r[high]
            low, high = np.where(one, self.zeros[k] + lo, low - lo), np.where(one, self.zeros[k] + hi, high - hi)
        return high - low

    def step(self, row: np.ndarray) -> np.ndarray:
        """The row of the suffix one word longer (LF mapping)."""
        at, low, code = row, np.zeros_like(row), np.zeros_like(row)
        for k in range(self.bits):
            r = self.ranks[k]
            one = (r[at + 1] - r[at]).astype(bool)
            code = (code << 1) | one
            at, low = np.where(one, self.zeros[k] + r[at], at - r[at]), np.where(one, self.zeros[k] + r[low], low - r[low])
        return self.first[code] + at - low

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last+1 row of each phrase (a row of codes), by backward search."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        live = np.arange(len(phrases))
        for j in range(phrases.shape[1] - 1, -1, -1):
            code = phrases[live, j]
            low[live] = self.first[code] + self.rank(code, low[live])
            high[live] = self.first[code] + self.rank(code, high[live])
            live = live[low[live] < high[live]]
            if not len(live):
                break
        return low, np.maximum(high, low)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: steps back to the nearest sampled position."""
        out, open_, row, steps = np.empty(len(rows), np.int64), np.arange(len(rows)), rows.copy(), 0
        while len(open_):
            done = (self.marks[row + 1] - self.marks[row]).astype(bool)
            out[open_[done]] = self.sampled[self.marks[row[done]]] + steps
            open_, row, steps = open_[~done], row[~done], steps + 1
            if len(open_):
                row = self.step(row)
        return out
