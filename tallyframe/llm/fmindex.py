"""FM-index over a sequence of word ids: wavelet matrix, backward search, location."""

from __future__ import annotations

import numpy as np

#: Every so many positions of a run, and at its start, a suffix position is kept.
SAMPLE = 8


def suffix_order(sequence: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes in ascending order.

    Every 0 is a separator that differs from all others, smaller than any word and
    ordered by position; the last element has to be one. Ranks by twice as many words
    in each round (prefix doubling), until all differ.
    """
    separators = sequence == 0
    rank = np.where(separators, np.cumsum(separators) - 1, sequence + separators.sum())
    n, step = len(sequence), 1
    while True:
        after = np.zeros(n, dtype=np.int64)
        after[:-step] = rank[step:] + 1
        key = rank * (int(after.max()) + 1) + after
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        steps = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        rank = np.empty(n, dtype=np.int64)
        rank[order] = steps
        if steps[-1] == n - 1:
            return order
        step = min(2 * step, n - 1)


class WaveletMatrix:
    """Ranks of symbols in a sequence, one row of bits per binary digit."""

    def __init__(self, sequence: np.ndarray, digits: int):
        self.levels = []
        for digit in range(digits - 1, -1, -1):
            bits = (sequence >> digit & 1).astype(bool)
            packed = np.packbits(bits, bitorder="little")
            packed = np.concatenate([packed, np.zeros(16 - len(packed) % 8, np.uint8)]).view("<u8")
            before = np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)])
            self.levels.append((digit, packed, before, len(bits) - int(bits.sum())))
            sequence = np.concatenate([sequence[~bits], sequence[bits]])

    @staticmethod
    def _ones(packed: np.ndarray, before: np.ndarray, at: np.ndarray) -> np.ndarray:
        word, rest = at >> 6, (at & 63).astype(np.uint64)
        below = packed[word] & ((np.uint64(1) << rest) - np.uint64(1))
        return before[word] + np.bitwise_count(below)

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each ``symbol`` stands before ``at``, whose last axis is theirs."""
        place = np.concatenate([np.zeros((1, len(symbol)), np.int64), np.atleast_2d(at)])
        for digit, packed, before, zeros in self.levels:
            ones = self._ones(packed, before, place)
            place = np.where(symbol >> digit & 1, zeros + ones, place - ones)
        return (place[1:] - place[0]).reshape(at.shape)

    def symbol_and_rank(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place, and how often it stands before."""
        start, place, symbol = np.zeros_like(at), at, np.zeros_like(at)
        for digit, packed, before, zeros in self.levels:
            bit = (packed[place >> 6] >> (place & 63).astype(np.uint64) & np.uint64(1)).astype(np.int64)
            symbol |= bit << digit
            there, here = self._ones(packed, before, start), self._ones(packed, before, place)
            start = np.where(bit, zeros + there, start - there)
            place = np.where(bit, zeros + here, place - here)
        return symbol, place - start


class FMIndex:
    """Finds phrases in runs of word ids (positive), each run ended by a 0."""

    def __init__(self, sequence: np.ndarray):
        sequence = sequence.astype(np.int64)
        order = suffix_order(sequence)
        self.size, largest = len(sequence), int(sequence.max())
        self.bwt = WaveletMatrix(sequence[order - 1], max(1, largest.bit_length()))
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(sequence, minlength=largest + 1))])
        # Walking back from any word meets a kept position before the run's separator.
        starts_run = np.concatenate([[True], sequence[:-1] == 0])
        self.kept = (order % SAMPLE == 0) | starts_run[order]
        self.kept_place = np.cumsum(self.kept) - 1
        self.positions = order[self.kept]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of the suffixes that start with each phrase (rows, left-aligned)."""
        lo, hi = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.size)
        lo[phrases.max(1) >= len(self.smaller) - 1] = self.size  # words that are not here
        for step in range(int(lengths.max(initial=0))):
            live = np.flatnonzero((step < lengths) & (lo < hi))
            if not len(live):
                continue
            word = phrases[live, lengths[live] - 1 - step].astype(np.int64)
            ends = self.smaller[word] + self.bwt.rank(word, np.stack([lo[live], hi[live]]))
            lo[live], hi[live] = ends
        return lo, np.maximum(hi, lo)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions in the sequence of suffixes given by their place in the order."""
        found = np.empty(len(rows), np.int64)
        walking, rows, steps = np.arange(len(rows)), rows.astype(np.int64), 0
        while len(rows):
            here = self.kept[rows]
            found[walking[here]] = self.positions[self.kept_place[rows[here]]] + steps
            walking, rows = walking[~here], rows[~here]
            if len(rows):
                symbol, before = self.bwt.symbol_and_rank(rows)
                rows = self.smaller[symbol] + before
            steps += 1
        return found
