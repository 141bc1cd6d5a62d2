"""A full-text index over a sequence of symbols: Burrows-Wheeler transform, wavelet ranks, sampled suffix positions."""

from __future__ import annotations

import numpy as np

from accrue.llm.words import ragged


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Where the suffixes begin, in order, by doubling the compared length; `text` ends with its only 0."""
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    n, length = len(text), 1
    while True:
        key = rank * (n + 1)
        key[: n - length] += rank[length:] + 1
        order = np.argsort(key, kind="stable")
        key = key[order]
        rank[order] = np.concatenate(([0], np.cumsum(key[1:] != key[:-1])))
        if rank[order[-1]] == n - 1:
            return order
        length *= 2


class Wavelet:
    """Symbols by their bits, highest first; at each level those with a 0 come before those with a 1."""

    def __init__(self, symbols: np.ndarray):
        self.bits = max(1, int(symbols.max()).bit_length())
        self.ones, self.zeros = [], []
        for level in range(self.bits - 1, -1, -1):
            bit = (symbols >> level & 1).astype(bool)
            self.ones.append(np.concatenate(([0], np.cumsum(bit, dtype=np.int32))))
            self.zeros.append(len(bit) - int(self.ones[-1][-1]))
            symbols = np.concatenate((symbols[~bit], symbols[bit]))

    def _walk(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for k, (ones, zeros) in enumerate(zip(self.ones, self.zeros, strict=True)):
            bit = symbol >> (self.bits - 1 - k) & 1
            before = ones[at]
            at = np.where(bit, zeros + before, at - before)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its position."""
        return self._walk(symbol, at) - self._walk(symbol, np.zeros_like(at))

    def symbol(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros(len(at), dtype=np.int64)
        for ones, zeros in zip(self.ones, self.zeros, strict=True):
            before = ones[at]
            bit = ones[at + 1] - before
            out = out << 1 | bit
            at = np.where(bit, zeros + before, at - before)
        return out


class FMIndex:
    """Finds phrases in `text`, symbols from 1; every `sample`-th text position is kept to locate them."""

    def __init__(self, text: np.ndarray, sample: int = 8):
        text = np.append(text, 0).astype(np.int64)
        order = suffix_order(text)
        last = text[order - 1]
        self.size = len(text)
        self.wavelet = Wavelet(last)
        self.below = np.concatenate(([0], np.cumsum(np.bincount(text))))
        marked = order % sample == 0
        self.marked = np.concatenate(([0], np.cumsum(marked, dtype=np.int32)))
        self.places = order[marked]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each phrase (a row of symbols, `lengths` of them) the range of suffixes that begin with it."""
        first, end = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.size)
        for step in range(int(lengths.max(initial=0))):
            live = np.flatnonzero((lengths > step) & (first < end))
            symbol = phrases[live, lengths[live] - 1 - step]
            known = symbol < len(self.below) - 1
            first[live[~known]] = end[live[~known]] = 0
            live, symbol = live[known], symbol[known]
            first[live] = self.below[symbol] + self.wavelet.rank(symbol, first[live])
            end[live] = self.below[symbol] + self.wavelet.rank(symbol, end[live])
        return first, np.maximum(first, end)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The text positions of suffixes, by stepping backwards to the next one that is kept."""
        out, rows = np.zeros(len(rows), np.int64), rows.copy()
        open_, steps = np.arange(len(rows)), 0
        while len(open_):
            here = rows[open_]
            kept = self.marked[here + 1] > self.marked[here]
            out[open_[kept]] = self.places[self.marked[here[kept]]] + steps
            open_, here = open_[~kept], here[~kept]
            symbol = self.wavelet.symbol(here)
            rows[open_] = self.below[symbol] + self.wavelet.rank(symbol, here)
            steps += 1
        return out

    def find(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All occurrences: the phrase's number and its text position."""
        first, end = self.search(phrases, lengths)
        rows = ragged(first, end - first)
        return np.repeat(np.arange(len(phrases)), end - first), self.locate(rows)
