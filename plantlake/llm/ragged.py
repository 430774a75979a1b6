"""BPE merges over many sequences at once, held as one flat array of symbols and row lengths."""

from __future__ import annotations

import numpy as np

NO_RANK = np.iinfo(np.int32).max
SPREAD = np.uint64(0x9E3779B97F4A7C15)


class PairTable:
    """Rank and new symbol of mergeable pairs: an open hash table probed for whole arrays."""

    def __init__(self, left: np.ndarray, right: np.ndarray, made: np.ndarray):
        self.bits = max(8, int(np.ceil(np.log2(len(left) * 16 + 1))))
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, NO_RANK, np.int32)
        self.made = np.zeros(1 << self.bits, np.int32)
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        waiting, at = np.arange(len(keys)), self._slot(keys)
        while len(waiting):
            free = np.flatnonzero(self.keys[at] < 0)
            _, one = np.unique(at[free], return_index=True)
            put = free[one]
            self.keys[at[put]] = keys[waiting[put]]
            self.ranks[at[put]] = waiting[put]
            self.made[at[put]] = made[waiting[put]]
            rest = np.ones(len(waiting), bool)
            rest[put] = False
            waiting, at = waiting[rest], (at[rest] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * SPREAD >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Slot of each pair; slots of unknown pairs have no rank."""
        keys = left.astype(np.int64) << 32 | right
        at = self._slot(keys)
        there = self.keys[at]
        wrong = np.flatnonzero((there != keys) & (there >= 0))
        while len(wrong):
            at[wrong] = (at[wrong] + 1) & ((1 << self.bits) - 1)
            there = self.keys[at[wrong]]
            wrong = wrong[(there != keys[wrong]) & (there >= 0)]
        return at


def merge_rows(symbols: np.ndarray, lengths: np.ndarray, table: PairTable) -> tuple[np.ndarray, np.ndarray]:
    """Symbols and lengths of all rows after all merges; every row has one symbol at least.

    Each round merges, in every row at the same time, all occurrences of that row's lowest-rank pair.
    Rows without a mergeable pair leave.
    """
    rows, lengths = np.arange(len(lengths)), lengths.astype(np.int64)
    symbols = symbols.astype(np.int32)
    done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while len(rows):
        ends = np.cumsum(lengths)
        starts = ends - lengths
        slot = table.find(symbols[:-1], symbols[1:])
        ranks = np.append(table.ranks[slot], NO_RANK)
        ranks[ends - 1] = NO_RANK
        lowest = np.minimum.reduceat(ranks, starts)
        stay = lowest != NO_RANK
        if not stay.all():
            out = np.repeat(~stay, lengths)
            done.append((rows[~stay], lengths[~stay], symbols[out]))
            if not stay.any():
                break
            symbols, ranks = symbols[~out], ranks[~out]
            slot = np.append(slot, 0)[~out]
            rows, lengths, lowest = rows[stay], lengths[stay], lowest[stay]
            starts = np.cumsum(lengths) - lengths
        chosen = ranks == np.repeat(lowest, lengths)
        first = np.flatnonzero(chosen)
        touching = np.flatnonzero(np.diff(first) == 1)
        if len(touching):
            # Of overlapping occurrences (a a a) every other one counts, from the left.
            index = np.arange(len(first))
            fresh = np.ones(len(first), bool)
            fresh[touching + 1] = False
            first = first[(index - np.maximum.accumulate(np.where(fresh, index, 0))) % 2 == 0]
        symbols[first] = table.made[slot[first]]
        kept = np.ones(len(symbols), bool)
        kept[first + 1] = False
        lengths = np.add.reduceat(kept, starts, dtype=np.int64)
        symbols = symbols[kept]
    if not done:
        return symbols, lengths
    order = np.concatenate([d[0] for d in done])
    sizes = np.concatenate([d[1] for d in done])
    flat = np.concatenate([d[2] for d in done])
    result = np.empty(len(order), np.int64)
    result[order] = sizes
    target = np.cumsum(result) - result
    shift = np.repeat(target[order] - (np.cumsum(sizes) - sizes), sizes)
    placed = np.empty_like(flat)
    placed[np.arange(len(flat)) + shift] = flat
    return placed, result
