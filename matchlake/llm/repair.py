"""Re-Pair grammar compression of token ids, per shard.

Frequent pairs of neighbouring ids are replaced by nonterminals, round after round: a round counts
all pairs, gives a nonterminal to those seen at least ``least`` times (most frequent first, up to a
third of the rules a shard may have, so that later rounds can pair nonterminals) and
replaces their occurrences from left to right. No pair crosses the end of a document, so a document
is a whole number of symbols. ``expansions`` holds the number of ids behind every nonterminal: with
it a position is found by adding lengths, and only the symbol that covers it is expanded.
"""

from __future__ import annotations

import numpy as np


class Grammar:
    """Rules in creation order: nonterminal ``base + i`` stands for the symbols ``left[i], right[i]``."""

    def __init__(self, base: int, left: np.ndarray, right: np.ndarray, expansions: np.ndarray) -> None:
        self.base, self.left, self.right, self.expansions = base, left, right, expansions

    def lengths(self, symbols: np.ndarray) -> np.ndarray:
        """Number of ids behind each symbol."""
        return np.concatenate([np.ones(self.base, np.int64), self.expansions])[symbols]

    def opened(self) -> np.ndarray:
        """The ids behind all rules, one after the other: nonterminals are opened level by level."""
        symbols = self.base + np.arange(len(self.left), dtype=np.int64)
        while (rule := symbols >= self.base).any():
            size = np.where(rule, 2, 1)
            at = np.cumsum(size) - size
            opened = np.empty(int(size.sum()), np.int64)
            opened[at[~rule]] = symbols[~rule]
            numbers = symbols[rule] - self.base
            opened[at[rule]] = self.left[numbers]
            opened[at[rule] + 1] = self.right[numbers]
            symbols = opened
        return symbols

    def decode(self, symbols: np.ndarray) -> np.ndarray:
        """All ids behind a sequence of symbols: a rule is opened once, and its ids are copied to wherever it stands."""
        ids = np.concatenate([np.arange(self.base, dtype=np.int64), self.opened()])
        heads = np.concatenate([ids[:self.base], self.base + np.cumsum(self.expansions) - self.expansions])
        lengths = self.lengths(symbols)
        ends = np.cumsum(lengths)
        place = np.repeat(heads[symbols] - (ends - lengths), lengths)
        place += np.arange(len(place), dtype=np.int64)
        return ids[place]

    def at(self, symbols: np.ndarray, position: int) -> int:
        """The id at one position, without decoding the rest."""
        ends = np.cumsum(self.lengths(symbols))
        slot = int(np.searchsorted(ends, position, side="right"))
        symbol = int(symbols[slot])
        position -= int(ends[slot - 1]) if slot else 0
        while symbol >= self.base:
            left, right = int(self.left[symbol - self.base]), int(self.right[symbol - self.base])
            width = int(self.expansions[left - self.base]) if left >= self.base else 1
            symbol, position = (left, position) if position < width else (right, position - width)
        return symbol


def compress(ids: np.ndarray, last: np.ndarray, base: int, least: int = 8, rounds: int = 8,
             rules: int = 15_000) -> tuple[np.ndarray, np.ndarray, Grammar]:
    """Symbols, their end-of-document flags and the grammar.

    ``last`` flags the final id of each document; ``base`` is larger than every id. ``rules`` bounds
    the grammar of a shard, ``rounds`` the passes over it; both affect size only.
    """
    symbols, last = ids.astype(np.uint32), last.copy()
    lefts, rights, sizes = [], [], []
    expansions = np.empty(0, np.int64)
    # two symbols side by side in one number, the narrower kind where every symbol has 16 bits
    wide, half = (np.uint32, 16) if base + rules <= 1 << 16 else (np.uint64, 32)
    for _ in range(rounds):
        if len(symbols) < 2 or len(expansions) >= rules:
            break
        pairs = (symbols[:-1].astype(wide) << wide(half)) | symbols[1:].astype(wide)
        open_ = ~last[:-1]
        ordered = np.sort(pairs[open_])
        if not len(ordered):
            break
        heads = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        counts = np.diff(np.append(heads, len(ordered)))
        often = counts >= least
        chosen, counts = ordered[heads[often]], counts[often]
        if not len(chosen):
            break
        best = np.sort(np.argsort(-counts, kind="stable")[:min(rules // 3, rules - len(expansions))])
        chosen = chosen[best]
        # a small table by hash tells most pairs that have no rule from the rest, and of the rules that share a place it names one
        spread, shift = wide(0x9E3779B97F4A7C15 >> (64 - 2 * half)) | wide(1), wide(2 * half - 20)
        table = np.full(1 << 20, -1, np.int16 if len(chosen) < 1 << 15 else np.int32)
        table[(chosen * spread) >> shift] = np.arange(len(chosen))
        named = table[(pairs * spread) >> shift]
        at = np.flatnonzero((named >= 0) & open_)
        slot, found = named[at].astype(np.int64), pairs[at]
        other = np.flatnonzero(chosen[slot] != found)
        slot[other] = np.minimum(np.searchsorted(chosen, found[other]), len(chosen) - 1)
        hit = chosen[slot] == found
        at, slot = at[hit], slot[hit]
        # in a run of overlapping occurrences every other one is replaced
        fresh = np.concatenate([[True], np.diff(at) != 1])
        head = np.maximum.accumulate(np.where(fresh, at, 0))
        keep = (at - head) % 2 == 0
        at, slot = at[keep], slot[keep]
        # number the rules that are used at all
        some = np.bincount(slot, minlength=len(chosen)) > 0
        used, slot = np.flatnonzero(some), (np.cumsum(some) - 1)[slot]
        left = (chosen[used] >> wide(half)).astype(np.int64)
        right = (chosen[used] & wide((1 << half) - 1)).astype(np.int64)
        width = [np.where(side >= base, np.append(expansions, 0)[np.maximum(side - base, -1)], 1) for side in (left, right)]
        first = base + len(expansions)
        symbols[at] = (first + slot).astype(np.uint32)
        last[at] |= last[at + 1]
        stay = np.ones(len(symbols), dtype=bool)
        stay[at + 1] = False
        symbols, last = symbols[stay], last[stay]
        lefts.append(left)
        rights.append(right)
        expansions = np.concatenate([expansions, width[0] + width[1]])
    none = np.empty(0, np.int64)
    grammar = Grammar(base, np.concatenate(lefts) if lefts else none, np.concatenate(rights) if rights else none, expansions)
    return symbols, last, grammar
