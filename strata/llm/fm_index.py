"""A compressed FM-index over many short sequences, searched in lock-step.

The index is the Burrows-Wheeler transform of the sequences, one separator
behind each, in a wavelet matrix: one bit vector per bit of the alphabet, as
64-bit words with a running count, so that a rank is two look-ups and a bit
count.  All searches of a batch advance together, one symbol per round.
"""
from __future__ import annotations

import numpy as np


class BitVector:
    """Bits with rank in constant time: 64 bits a word, one count a word."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        counts = np.bitwise_count(self.words)
        self.before = np.zeros(len(self.words), np.int64)
        np.cumsum(counts[:-1], out=self.before[1:])

    def rank1(self, i: np.ndarray) -> np.ndarray:
        """Ones among the first i bits."""
        word = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletMatrix:
    def __init__(self, values: np.ndarray, n_symbols: int):
        self.levels: list[tuple[int, BitVector, int]] = []
        for shift in reversed(range(max(1, int(n_symbols - 1).bit_length()))):
            bits = (values >> shift) & 1
            zeros = int(len(bits) - bits.sum())
            self.levels.append((shift, BitVector(bits.astype(np.uint8)), zeros))
            values = np.concatenate([values[bits == 0], values[bits == 1]])

    def walk(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Where position i comes out after following the symbol's bits; the
        difference of two such positions is the symbol's count between them."""
        for shift, bits, zeros in self.levels:
            ones = bits.rank1(i)
            i = np.where((symbol >> shift) & 1, zeros + ones, i - ones)
        return i


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling.  Separators (0) are made unlike each
    other by their place, so the doubling ends behind the longest sequence."""
    n = len(symbols)
    apart = np.flatnonzero(symbols == 0)
    rank = symbols.astype(np.int64) + len(apart)
    rank[apart] = np.arange(len(apart))
    step, order = 0, np.zeros(0, np.int64)
    while True:
        if step:
            after = np.zeros(n, np.int64)
            after[: n - step] = rank[step:] + 1
            key = rank * (n + len(apart) + 2) + after
        else:
            key = rank
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        new = np.empty(n, np.int64)
        new[order] = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
        rank = new
        if rank[order[-1]] == n - 1:
            return order
        step = max(1, step * 2)


class FMIndex:
    """Index of sequences of symbols 1 .. n_symbols - 1, each ended by a 0."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        order = suffix_order(symbols)
        last = symbols[order - 1]  # the symbol before each suffix
        self.n = len(symbols)
        self.matrix = WaveletMatrix(last, n_symbols)
        smaller = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=n_symbols))[:-1]])
        every = np.arange(n_symbols)
        self.shift = smaller - self.matrix.walk(every, np.zeros(n_symbols, np.int64))

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges of symbol + pattern, from those of the pattern."""
        both = self.matrix.walk(np.concatenate([symbol, symbol]), np.concatenate([lo, hi]))
        shift = self.shift[symbol]
        return both[: len(lo)] + shift, both[len(lo) :] + shift


def repeated_windows(index: FMIndex, symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray, width: int) -> np.ndarray:
    """For each sequence a 64-bit mask: does the window at k occur twice or more?

    Matching statistics at the threshold 2: from an end ``e`` the match grows
    to the left as long as it occurs twice.  A match that reaches the next open
    window settles all windows under it.  One that stops at ``f`` settles those
    right of ``f`` as repeated and those holding ``f .. e`` as not.
    """
    n_windows = lengths - width + 1
    mask = np.zeros(len(starts), np.uint64)
    seq = np.flatnonzero(n_windows > 0)
    i = np.zeros(len(seq), np.int64)  # next open window
    e = lengths[seq].astype(np.int64)  # end of the current match
    p, lo, hi = e.copy(), np.zeros(len(seq), np.int64), np.full(len(seq), index.n, np.int64)

    def settle(which: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
        """Windows a .. b - 1 are repeated."""
        some = b > a
        a, n = a[some].astype(np.uint64), (b - a)[some].astype(np.uint64)
        run = np.where(n >= 64, ~np.uint64(0), (np.uint64(1) << (n & np.uint64(63))) - np.uint64(1)) << a
        mask[which[some]] |= run  # a sequence has one match at a time

    while len(seq):
        nlo, nhi = index.extend(symbols[starts[seq] + p - 1], lo, hi)
        grown = nhi - nlo >= 2
        p = p - grown
        lo, hi = np.where(grown, nlo, lo), np.where(grown, nhi, hi)
        done = p == i
        stop = ~grown | done
        if not stop.any():
            continue
        f = p - 1
        last = e - width + 1  # windows before this end within the match
        settle(seq[stop], p[stop], last[stop])
        # All windows from i on are settled up to `last`, unless the match
        # stopped right of i while it was longer than one window.
        partly = stop & ~done & (e - width > i)
        whole = stop & ~partly
        i = np.where(whole, np.maximum(np.where(done, last, f + 1), last), i)
        e = np.where(whole, lengths[seq], np.where(partly, i + width, e))
        p = np.where(stop, e, p)
        lo, hi = np.where(stop, 0, lo), np.where(stop, index.n, hi)
        open_ = i < n_windows[seq]
        if not open_.all():
            seq, i, e, p, lo, hi = (x[open_] for x in (seq, i, e, p, lo, hi))
    return mask
