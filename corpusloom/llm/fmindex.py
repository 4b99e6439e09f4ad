"""An FM-index over one shard of integer symbols: suffix array, wavelet-matrix ranks, sampled positions."""

from __future__ import annotations

import numpy as np

#: Every so manieth text position is kept for the rows that hold it.
SAMPLE = 8


def suffix_array(text: np.ndarray, symbols: int) -> np.ndarray:
    """The suffix order of ``text`` (values 0..symbols-1); a suffix that ends first is the smaller.

    The first key packs as many symbols as 63 bits hold; after that only suffixes that still tie are sorted
    again, by the rank of what follows, twice as far each time.
    """
    n = len(text)
    bits = int(symbols).bit_length()
    depth = max(1, 63 // bits)
    padded = np.concatenate([text.astype(np.int64) + 1, np.zeros(depth, dtype=np.int64)])
    key = np.zeros(n, dtype=np.int64)
    for i in range(depth):
        key = (key << bits) | padded[i : n + i]
    order = np.argsort(key)
    key = key[order]
    new = np.r_[True, key[1:] != key[:-1]]
    del key, padded
    rank = np.empty(n, dtype=np.int64)
    head = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank[order] = head
    alone = new & np.r_[new[1:], True]
    slots = np.flatnonzero(~alone)
    while len(slots):
        at = order[slots]
        after = at + depth
        key = rank[at] * (n + 1) + np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        again = np.argsort(key)
        key, at = key[again], at[again]
        order[slots] = at
        new = np.r_[True, key[1:] != key[:-1]]
        rank[at] = np.maximum.accumulate(np.where(new, slots, 0))
        slots = slots[~(new & np.r_[new[1:], True])]
        depth *= 2
    return order


class Bits:
    """A bit vector with ranks: a count before each word of 64 bits."""

    def __init__(self, bit: np.ndarray):
        packed = np.packbits(bit, bitorder="little")
        words = np.zeros(len(bit) // 64 + 1, dtype=np.uint64)
        words.view(np.uint8)[: len(packed)] = packed
        counts = np.bitwise_count(words)
        self.words = words
        self.before = np.cumsum(counts, dtype=np.int64) - counts

    def rank(self, i: np.ndarray) -> np.ndarray:
        """How many of the first ``i`` bits are set."""
        word, rest = i >> 6, (i & 63).astype(np.uint64)
        below = self.words[word] & ((np.uint64(1) << rest) - np.uint64(1))
        return self.before[word] + np.bitwise_count(below)

    def at(self, i: np.ndarray) -> np.ndarray:
        return ((self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64)


class FMIndex:
    """Counts and locates phrases in ``text``, an array of symbols 0..symbols-1; n: rows of the index."""

    def __init__(self, text: np.ndarray, symbols: int):
        text, symbols = np.r_[text + 1, 0].astype(np.int32), symbols + 1  # 0 ends the text, so steps back are exact
        order = suffix_array(text, symbols)
        self.n = len(text)
        self.starts = np.r_[0, np.cumsum(np.bincount(text, minlength=symbols))]
        kept = order % SAMPLE == 0
        self.sampled, self.samples = Bits(kept), order[kept]
        rest = text[order - 1]  # the Burrows-Wheeler transform
        self.width = max(1, int(symbols - 1).bit_length())
        self.levels: list[tuple[Bits, int]] = []
        for level in reversed(range(self.width)):
            bit = (rest >> level & 1).astype(bool)
            self.levels.append((Bits(bit), int(len(bit) - bit.sum())))
            rest = np.concatenate([rest[~bit], rest[bit]])
        every = np.arange(symbols)
        self.origin = self._descend(every, np.zeros(symbols, dtype=np.int64))

    def _descend(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for level, (bits, zeros) in zip(reversed(range(self.width)), self.levels, strict=True):
            ones = bits.rank(i)
            i = np.where(symbol >> level & 1, zeros + ones, i - ones)
        return i

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol stands in the first ``i`` symbols of the transform."""
        return self._descend(symbol, i) - self.origin[symbol]

    def access(self, i: np.ndarray) -> np.ndarray:
        symbol = np.zeros(len(i), dtype=np.int64)
        for level, (bits, zeros) in zip(reversed(range(self.width)), self.levels, strict=True):
            one, ones = bits.at(i), bits.rank(i)
            symbol |= one << level
            i = np.where(one, zeros + ones, i - ones)
        return symbol

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix-array ranges [low, high) of the phrases, one a row, right-aligned."""
        return self.search_places(phrases.ravel(), np.arange(1, len(phrases) + 1) * phrases.shape[1], lengths)

    def search_places(self, row: np.ndarray, ends: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix-array ranges [low, high) of phrases that end before places of ``row``; by backward search."""
        low = np.zeros(len(ends), dtype=np.int64)
        high = np.full(len(ends), self.n, dtype=np.int64)
        live = np.arange(len(ends))
        for back in range(int(lengths.max(initial=0))):
            live = live[(lengths[live] > back) & (low[live] < high[live])]
            if not len(live):
                break
            symbol = row[ends[live] - 1 - back].astype(np.int64) + 1
            low[live] = self.starts[symbol] + self.rank(symbol, low[live])
            high[live] = self.starts[symbol] + self.rank(symbol, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The text positions of suffix-array rows: steps back to a sampled row."""
        out = np.zeros(len(rows), dtype=np.int64)
        open_, row, steps = np.arange(len(rows)), rows.copy(), 0
        while len(open_):
            done = self.sampled.at(row) == 1
            out[open_[done]] = self.samples[self.sampled.rank(row[done])] + steps
            open_, row, steps = open_[~done], row[~done], steps + 1
            symbol = self.access(row)
            row = self.starts[symbol] + self.rank(symbol, row)
        return out
