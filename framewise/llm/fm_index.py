"""Compressed FM-index over word numbers: BWT in a wavelet tree of packed bits, searched for many patterns at once."""

from __future__ import annotations

import numpy as np


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; the end sorts before every symbol."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64) + 1
    order, k = np.argsort(rank, kind="stable"), 1
    while n > 1:
        after = np.zeros(n, np.int64)
        after[:-k] = rank[k:]
        key = rank * (n + 2) + after
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        fresh = np.concatenate([[1], (sorted_key[1:] != sorted_key[:-1]).astype(np.int64)])
        rank[order] = np.cumsum(fresh)
        k *= 2
        if rank[order[-1]] == n or k >= n:
            break
    return order


class BitRanks:
    """Packed bits with the number of ones before each 64-bit word."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])[:-1]

    def ones(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletTree:
    """One level of bits for each bit of the symbols, the highest first; at each level the zeros go before the ones."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.levels, self.zeros = [], []
        self.bits = max(1, int(n_symbols - 1).bit_length())
        for b in range(self.bits - 1, -1, -1):
            bit = ((symbols >> b) & 1).astype(np.uint8)
            self.levels.append(BitRanks(bit))
            self.zeros.append(int(len(bit) - bit.sum()))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])
        self.base = self._descend(np.arange(n_symbols), np.zeros(n_symbols, np.int64))

    def _descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for b, level, zeros in zip(range(self.bits - 1, -1, -1), self.levels, self.zeros, strict=True):
            ones = level.ones(at)
            at = np.where((symbol >> b) & 1, zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        return self._descend(symbol, at) - self.base[symbol]


class FMIndex:
    """``text``: numbers from 0 to ``n_symbols - 1``."""

    def __init__(self, text: np.ndarray, n_symbols: int):
        order = suffix_order(text)
        # the row of the empty suffix comes first and holds the text's last symbol; the row of the whole text holds none
        last = np.concatenate([[text[-1]], np.where(order > 0, text[order - 1], n_symbols)])
        self.size = len(last)
        self.tree = WaveletTree(last, n_symbols + 1)
        self.first = 1 + np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n_symbols))])

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward step: from the rows of patterns to those of symbol + pattern."""
        both = self.tree.rank(np.concatenate([symbol, symbol]), np.concatenate([lo, hi])) + np.tile(self.first[symbol], 2)
        return both[:len(lo)], both[len(lo):]

    def repeats(self, text: np.ndarray, starts: np.ndarray, ends: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(segment, from, to): maximal stretches of at least ``window`` symbols of the segments
        ``text[starts:ends]`` that occur twice or more in the indexed text.

        Matching statistics by backward search, all segments in step: from the end of a segment's last
        undecided window the match is extended to the left while it occurs twice. If it covers the window,
        it decides all windows it holds; if not, that window occurs once only."""
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        seg = np.flatnonzero(ends - starts >= window)
        left, at = starts[seg], ends[seg] - window
        i, lo, hi = at + window, np.zeros(len(seg), np.int64), np.full(len(seg), self.size, np.int64)
        while len(seg):
            new_lo, new_hi = self.extend(text[i - 1], lo, hi)
            more = new_hi - new_lo >= 2
            i = i - more
            lo, hi = np.where(more, new_lo, lo), np.where(more, new_hi, hi)
            ended = ~more | (i == left)
            if not ended.any():
                continue
            hit = ended & (i <= at)
            out.append((seg[hit], i[hit], at[hit] + window))
            at = np.where(ended, np.where(hit, i, at) - 1, at)
            i = np.where(ended, at + window, i)
            lo, hi = np.where(ended, 0, lo), np.where(ended, self.size, hi)
            going = at >= left
            if not going.all():
                seg, left, at, i, lo, hi = (x[going] for x in (seg, left, at, i, lo, hi))
        return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (list(zip(*out, strict=True)) or ((), (), ())))
