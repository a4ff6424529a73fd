"""A compressed full-text index over sequences of words: wavelet matrix, backward search, matching statistics.

The sequences stand one after another, a separator behind each.  Suffixes are ordered up to their separator, those alike by place; the
symbol before each suffix makes the transform, and the transform is kept as one bit vector for each bit of the symbols, with counts at
every 64th place.  Of the suffixes' places only those are kept that are a multiple of ``SAMPLE`` or start a sequence; any other is found by
walking back through the transform.  Neither the text nor the suffix array is part of the index; patterns are streamed
through it from outside.  All queries advance together, a word at a time.
"""

from __future__ import annotations

import numpy as np

#: Every so many places of the text one is kept.
SAMPLE = 4


class Bits:
    """A bit vector with rank."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = (np.cumsum(ones) - ones).astype(np.uint32)

    def ones(self, places: np.ndarray) -> np.ndarray:
        """Set bits before each place."""
        word, bit = places >> 6, (places & 63).astype(np.uint64)
        mask = (np.uint64(1) << bit) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask).astype(np.int64)

    def at(self, places: np.ndarray) -> np.ndarray:
        """Whether each bit is set."""
        return (self.words[places >> 6] >> (places & 63).astype(np.uint64) & np.uint64(1)).astype(bool)

    @property
    def nbytes(self) -> int:
        return self.words.nbytes + self.before.nbytes


class WaveletMatrix:
    """Ranks of symbols in a sequence over an alphabet of ``size`` symbols."""

    def __init__(self, symbols: np.ndarray, size: int):
        self.levels, current = [], symbols
        for shift in range(max(1, int(size - 1).bit_length()) - 1, -1, -1):
            bits = (current >> shift & 1).astype(bool)
            self.levels.append((shift, Bits(bits), int(len(bits) - bits.sum())))
            current = np.concatenate([current[~bits], current[bits]])
        self.origin = self._descend(np.arange(size), np.zeros(size, np.int64)).astype(np.uint32)

    def _descend(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        for shift, bits, zeros in self.levels:
            ones = bits.ones(places)
            places = np.where(symbols >> shift & 1, zeros + ones, places - ones)
        return places

    def rank(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        return self._descend(symbols, places) - self.origin[symbols]

    def access(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place, and how often it stands before."""
        symbols = np.zeros(len(places), np.int64)
        for shift, bits, zeros in self.levels:
            ones, here = bits.ones(places), bits.at(places)
            places = np.where(here, zeros + ones, places - ones)
            symbols |= here.astype(np.int64) << shift
        return symbols, places - self.origin[symbols]

    @property
    def nbytes(self) -> int:
        return self.origin.nbytes + sum(bits.nbytes for _, bits, _ in self.levels)


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffixes in the order of their symbols up to the first separator (0), by doubling; those alike in order of place."""
    ends = np.flatnonzero(text == 0)
    left = ends[np.searchsorted(ends, np.arange(len(text)))] - np.arange(len(text))  # symbols before the separator
    rank, width = text.astype(np.int64), 1
    while width <= left.max():  # beyond its separator a suffix has nothing to compare
        ahead = np.zeros(len(rank), np.int64)
        ahead[:-width] = np.where(left[:-width] >= width, rank[width:] + 1, 0)
        rank = np.unique(rank * (len(rank) + 2) + ahead, return_inverse=True)[1]
        width *= 2
    return np.argsort(rank, kind="stable")


def encode(sequences: list[list[str]]) -> tuple[np.ndarray, np.ndarray, int]:
    """The sequences as one text of symbols with separators, where each starts, and the number of symbols."""
    ids: dict[str, int] = {}
    flat = [ids.setdefault(word, len(ids) + 1) for words in sequences for word in [*words, ""]]
    end = ids[""]
    text = np.array(flat, np.int64)
    text[text == end], text[text > end] = 0, text[text > end] - 1  # the separator is the smallest symbol
    return text, np.cumsum([0] + [len(words) + 1 for words in sequences])[:-1], len(ids)


class FMIndex:
    """The index of a text of sequences (see ``encode``), without the text."""

    def __init__(self, text: np.ndarray, starts: np.ndarray, size: int):
        order = suffix_order(text)
        self.length = len(text)
        self.matrix = WaveletMatrix(text[order - 1], size)
        self.below = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=size))]).astype(np.uint32)
        kept = np.arange(len(text)) % SAMPLE == 0
        kept[starts] = True
        self.marked = Bits(kept[order])
        self.places = order[kept[order]].astype(np.uint32)

    @property
    def nbytes(self) -> int:
        return self.matrix.nbytes + self.below.nbytes + self.marked.nbytes + self.places.nbytes

    def step(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffix intervals of the patterns that one more symbol opens."""
        both = np.concatenate([symbols, symbols])
        found = self.below[both] + self.matrix.rank(both, np.concatenate([low, high]))
        return found[: len(low)], found[len(low) :]

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The place in the text of each suffix, by its rank: back to the next place that is kept."""
        rows, steps = rows.copy(), np.zeros(len(rows), np.int64)
        going = np.flatnonzero(~self.marked.at(rows))
        while len(going):
            symbols, ranks = self.matrix.access(rows[going])
            rows[going] = self.below[symbols] + ranks
            steps[going] += 1
            going = going[~self.marked.at(rows[going])]
        return self.places[self.marked.ones(rows)] + steps

    def statistics(self, stream: np.ndarray, ends: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For the words that end at each place of a streamed text: the longest stretch, up to ``most`` words, that occurs twice in the index.

        Gives its length and its interval of suffixes.
        """
        length = np.zeros(len(ends), np.int64)
        low, high = np.zeros(len(ends), np.int64), np.full(len(ends), self.length, np.int64)
        going = np.arange(len(ends))
        for step in range(most):
            symbols = stream[ends[going] - step]
            new_low, new_high = self.step(symbols, low[going], high[going])
            repeated = (new_high - new_low > 1) & (symbols > 0)
            going = going[repeated]
            low[going], high[going] = new_low[repeated], new_high[repeated]
            length[going] += 1
        return length, low, high

    def first_places(self, stream: np.ndarray, windows: np.ndarray, size: int) -> np.ndarray:
        """For each place of the indexed text, streamed again, where a window of ``size`` words starts, the first that has the same words."""
        length, low, high = self.statistics(stream, windows + size - 1, size)
        first, reported = windows.copy(), np.flatnonzero(length == size)
        if len(reported):
            lows, back = np.unique(low[reported], return_inverse=True)
            highs = np.zeros(len(lows), np.int64)
            highs[back] = high[reported]
            # intervals of one length do not overlap
            counts = highs - lows
            before = np.cumsum(counts) - counts
            rows = np.arange(counts.sum()) + np.repeat(lows - before, counts)
            first[reported] = np.minimum.reduceat(self.locate(rows), before)[back]
        return first
