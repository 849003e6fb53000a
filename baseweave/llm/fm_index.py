"""A compressed full-text index over sequences of 64-bit symbols, in numpy.

The Burrows-Wheeler transform of all sequences is kept in a wavelet matrix, and
so are the owners of the suffixes in their order. Where neighbouring suffixes
part within their first 1, 2, ... symbols is kept in one bit vector each. The
text itself is not kept. Suffixes are sorted by their first 16 symbols, which is
as far as matches are followed here.
"""

from __future__ import annotations

import numpy as np


class Bits:
    """A bit vector with a popcount directory; queries are for many places at once."""

    def __init__(self, bits: np.ndarray):
        self.n = len(bits)
        packed = np.packbits(bits, bitorder="little")
        self.words = np.concatenate([packed, np.zeros(16 - len(packed) % 8, np.uint8)]).view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int32)]).astype(np.int32)
        self.ones = int(self.before[-1])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)

    def select(self, nth: np.ndarray) -> np.ndarray:
        """Where the nth one stands, counted from 1; the length of the vector if there are fewer."""
        known = nth <= self.ones
        word = np.searchsorted(self.before, np.where(known, nth, 1), "left") - 1
        left, bits, at = nth - self.before[word], self.words[word], np.zeros(len(nth), np.int64)
        for half in (32, 16, 8, 4, 2, 1):
            low = np.bitwise_count((bits >> at.astype(np.uint64)) & np.uint64((1 << half) - 1))
            beyond = left > low
            left, at = left - low * beyond, at + half * beyond
        return np.where(known, word * 64 + at, self.n)

    def last_to(self, at: np.ndarray) -> np.ndarray:
        """The last one at or before each place; there is one."""
        return self.select(self.rank(at + 1))

    def first_from(self, at: np.ndarray) -> np.ndarray:
        """The first one at or after each place, or the length of the vector."""
        return self.select(self.rank(at) + 1)


class WaveletMatrix:
    """Rank and range-minimum queries over symbols from 0 to ``n_symbols`` - 1."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.levels = []
        for shift in range(max(1, int(n_symbols - 1).bit_length()) - 1, -1, -1):
            ones = (symbols >> shift) & 1 == 1
            self.levels.append((shift, Bits(ones), int(len(ones) - ones.sum())))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])
        self.begin = self._walk(np.arange(n_symbols), np.zeros(n_symbols, np.int64))

    def _walk(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for shift, bits, zeros in self.levels:
            rank = bits.rank(at)
            at = np.where((symbols >> shift) & 1, zeros + rank, at - rank)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its place."""
        return self._walk(symbols, at) - self.begin[symbols]

    def least(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The smallest symbol from each ``low`` to its ``high``, which is larger."""
        value = np.zeros(len(low), np.int64)
        for shift, bits, zeros in self.levels:
            from_one, to_one = bits.rank(low), bits.rank(high)
            some = high - to_one > low - from_one  # a symbol with a zero here
            low = np.where(some, low - from_one, zeros + from_one)
            high = np.where(some, high - to_one, zeros + to_one)
            value |= np.where(some, 0, 1 << shift)
        return value


class FMIndex:
    """Sequences, given one after the other with their lengths, searched for matches of up to ``width`` symbols."""

    def __init__(self, sequences: np.ndarray, lengths: np.ndarray, owners: np.ndarray, width: int):
        """``owners`` has a small number for each sequence; searches tell the smallest owner of each match."""
        assert 2 <= width <= 15
        self.width = width
        self.alphabet, ids = np.unique(sequences, return_inverse=True)
        n = self.n = len(sequences) + len(lengths)
        text = np.zeros(n, np.int64)  # symbols from 1 on; 0 ends each sequence
        inside = np.ones(n, bool)
        inside[np.cumsum(lengths + 1) - 1] = False
        text[inside] = ids.ravel() + 1
        ranks, rank = {1: text}, text
        for step in (1, 2, 4, 8):
            following = np.zeros(n, np.int64)
            following[: n - step] = rank[step:] + 1
            _, rank = np.unique(rank * (rank.max(initial=0) + 2) + following, return_inverse=True)
            rank = ranks[2 * step] = rank.ravel()
        order = np.argsort(rank, kind="stable")
        # What neighbouring suffixes have in common, up to 15 symbols, by halving.
        common = np.zeros(max(0, n - 1), np.int64)
        for step in (8, 4, 2, 1):
            padded = np.concatenate([ranks[step], np.full(16, -1)])
            common += step * (padded[order[:-1] + common] == padded[order[1:] + common])
        #: For each k below ``width`` where suffixes begin that differ from the one before within k symbols.
        self.borders = [Bits(np.append(True, common < k)[:n]) for k in range(width)]
        n_symbols = len(self.alphabet) + 1
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n_symbols))])
        self.tree = WaveletMatrix(text[order - 1], n_symbols)
        self.owners = WaveletMatrix(np.repeat(owners, lengths + 1)[order], int(owners.max(initial=0)) + 1)

    def _symbols(self, sequences: np.ndarray) -> np.ndarray:
        """Symbols as numbers from 1 on; 0 for those that the index has not."""
        if not len(self.alphabet):
            return np.zeros(len(sequences), np.int64)
        at = np.minimum(np.searchsorted(self.alphabet, sequences), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == sequences, at + 1, 0)

    def _narrowed(self, low: np.ndarray, high: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of all suffixes that share the first ``length`` symbols of those in each interval."""
        low, high = low.copy(), high.copy()
        for k in np.unique(length):
            own = np.flatnonzero(length == k)
            low[own], high[own] = (self.borders[k].last_to(low[own]), self.borders[k].first_from(high[own])) if k else (0, self.n)
        return low, high

    def matches(self, sequences: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Matching statistics of sequences: for each place the longest match from there on, up to ``width``, and its smallest owner.

        The owner is told of matches of ``width`` symbols and else -1. Sequences
        stream through the index side by side, each from its end. A backward step
        puts a symbol before the match; where that occurs nowhere, or the match
        has its full width, the match gives up its last symbol first.
        """
        symbols = self._symbols(sequences)
        longest, owner = np.zeros(len(symbols), np.int8), np.full(len(symbols), -1, np.int64)
        by_length = np.argsort(-lengths, kind="stable")
        ends, lengths = np.cumsum(lengths)[by_length], lengths[by_length]
        low, high, length = np.zeros(len(ends), np.int64), np.full(len(ends), self.n), np.zeros(len(ends), np.int64)
        full: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for step in range(int(lengths[0]) if len(lengths) else 0):
            live = np.arange(np.searchsorted(-lengths, -step, "left"))  # sequences longer than ``step``
            place = ends[live] - 1 - step
            todo = live
            while len(todo):
                symbol = symbols[ends[todo] - 1 - step]
                both = self.tree.rank(np.concatenate([symbol, symbol]), np.concatenate([low[todo], high[todo]]))
                down, up = self.before[symbol] + both[: len(todo)], self.before[symbol] + both[len(todo) :]
                found = (down < up) & (symbol > 0)
                own = todo[found]
                low[own], high[own] = down[found], up[found]
                length[own] += 1
                todo = todo[~found & (length[todo] > 0)]
                length[todo] -= 1
                low[todo], high[todo] = self._narrowed(low[todo], high[todo], length[todo])
            longest[place] = length[live]
            whole = live[length[live] == self.width]
            full.append((ends[whole] - 1 - step, low[whole], high[whole]))
            length[whole] -= 1
            low[whole], high[whole] = self._narrowed(low[whole], high[whole], length[whole])
        if full:
            place, low, high = (np.concatenate(x) for x in zip(*full, strict=True))
            owner[place] = self.owners.least(low, high)
        return longest, owner
