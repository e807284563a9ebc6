"""Re-Pair over arrays of ids: frequent neighbours become new symbols until no pair repeats often enough.

A grammar holds its rules in the order they were made (a rule refers to ids and earlier rules only), the length of
each rule's expansion, and the remaining symbols. Lengths make any stretch of the ids readable without the rest.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Fewest uses that make a rule worth its bytes.
LEAST = 8
#: A round takes the pairs that occur at least this fraction of the most frequent one's count.
SHARE = 32


@dataclass
class Grammar:
    """ids below `terminals` stand for themselves; symbol terminals + k is rule k."""

    terminals: int
    rules: np.ndarray
    lengths: np.ndarray
    symbols: np.ndarray

    def ends(self) -> np.ndarray:
        """Where the expansion of each remaining symbol ends."""
        n, long = np.ones(len(self.symbols), np.int64), self.symbols >= self.terminals
        n[long] = self.lengths[self.symbols[long].astype(np.int64) - self.terminals]
        return np.cumsum(n)

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """The ids of some symbols; memory is bounded by the result, a pass for each level of rules."""
        while (long := symbols >= self.terminals).any():
            place = np.cumsum(long) + np.arange(len(symbols))  # where the last half of each symbol goes
            out = np.empty(place[-1] + 1, symbols.dtype)
            out[place] = symbols
            halves, right = self.rules[symbols[long].astype(np.int64) - self.terminals], place[long]
            out[right - 1], out[right] = halves[:, 0], halves[:, 1]
            symbols = out
        return symbols

    def ids(self) -> np.ndarray:
        """All ids. The rules are expanded once and copied from, unless their expansions are longer than the ids."""
        ends = self.ends()
        if not len(ends) or self.lengths.sum() > ends[-1]:
            return self.expand(self.symbols)
        flat = self.expand(np.arange(self.terminals, self.terminals + len(self.rules)).astype(self.symbols.dtype))
        long = np.flatnonzero(self.symbols >= self.terminals)
        rule = self.symbols[long].astype(np.int64) - self.terminals
        size = self.lengths[rule]
        out = np.repeat(self.symbols, np.diff(ends, prepend=0))
        step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        begin = np.cumsum(self.lengths) - self.lengths
        out[np.repeat(ends[long] - size, size) + step] = flat[np.repeat(begin[rule], size) + step]
        return out

    def stretch(self, first: int, end: int, ends: np.ndarray | None = None) -> np.ndarray:
        """The ids at first..end, from the symbols that cover them only."""
        if first >= end:
            return self.symbols[:0]
        ends = self.ends() if ends is None else ends
        a, b = int(np.searchsorted(ends, first, "right")), int(np.searchsorted(ends, end - 1, "right"))
        before = int(ends[a - 1]) if a else 0
        return self.expand(self.symbols[a : b + 1])[first - before : end - before]


def kind(terminals: int) -> np.dtype:
    """The narrowest symbols that leave room for rules beside the ids."""
    return np.dtype("<u2") if terminals < 60_000 else np.dtype("<u4")


def _halves(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    half = 4 * keys.dtype.itemsize
    return (keys >> keys.dtype.type(half)).astype(np.int64), (keys & keys.dtype.type((1 << half) - 1)).astype(np.int64)


def _pairs(s: np.ndarray) -> np.ndarray:
    wide = np.dtype(np.uint32 if s.dtype.itemsize == 2 else np.uint64).type
    return s[:-1].astype(wide) << wide(8 * s.dtype.itemsize) | s[1:]


def _frequent(keys: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The keys that occur `least` times, in order, and their counts."""
    keys = np.sort(keys)
    if len(keys) < least:
        return keys[:0], np.zeros(0, np.int64)
    seen = keys[: len(keys) - least + 1][keys[: len(keys) - least + 1] == keys[least - 1 :]]
    seen = seen[np.diff(seen, prepend=~seen[:1]) != 0]
    return seen, np.searchsorted(keys, seen, "right") - np.searchsorted(keys, seen)


class _Places:
    """Which of the chosen keys each key is: a hash table of one key a slot; a key that finds its slot taken waits a round."""

    def __init__(self, chosen: np.ndarray, counts: np.ndarray) -> None:
        self.bits = 17
        slots = self._slot(chosen)
        order = np.argsort(counts, kind="stable")  # the most frequent is written last and stays
        self.at = np.full(1 << self.bits, -1, np.int16 if len(chosen) < 32768 else np.int32)
        self.at[slots[order]] = order
        self.chosen = chosen

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        if keys.dtype.itemsize == 4:
            return (keys * np.uint32(2654435769)) >> np.uint32(32 - self.bits)
        return (keys * np.uint64(11400714819323198485)) >> np.uint64(64 - self.bits)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places of keys that are chosen, and which one each is."""
        which = self.at[self._slot(keys)]
        at = np.flatnonzero(which >= 0)
        which = which[at].astype(np.int64)
        right = self.chosen[which] == keys[at]
        return at[right], which[right]


def compress(ids: np.ndarray, terminals: int, least: int = LEAST) -> Grammar:
    """The grammar of ids (all below `terminals`); expanding it gives exactly them.

    Each round replaces the pairs near the greatest count, leftmost first where two overlap, and drops those whose
    uses are too few then. It ends when no pair occurs `least` times or no symbol is left (all ids stay either way).
    """
    s = ids.astype(kind(terminals))
    room = int(np.iinfo(s.dtype).max) + 1 - terminals
    rules: list[np.ndarray] = []
    lengths: list[np.ndarray] = []
    size = np.ones(terminals, np.int64)
    poor = np.zeros(0, np.uint64)  # pairs of which overlaps leave too few uses, for good
    while room and len(s) > 1:
        keys = _pairs(s)
        found, n = _frequent(keys, least)
        fresh = ~np.isin(found, poor, assume_unique=True)
        found, n = found[fresh], n[fresh]
        if not len(found):
            break
        enough = n >= max(least, -(-int(n.max()) // SHARE))
        found, n = found[enough], n[enough]
        if len(found) > room:
            first = np.sort(np.argsort(-n, kind="stable")[:room])
            found, n = found[first], n[first]
        at, which = _Places(found, n).find(keys)
        begins = np.concatenate(([True], np.diff(at) != 1))
        even = (at - at[begins][np.cumsum(begins) - 1]) & 1 == 0
        at, which = at[even], which[even]
        uses = np.bincount(which, minlength=len(found))
        used = uses >= least
        poor = np.concatenate((poor, found[(uses > 0) & ~used].astype(np.uint64)))
        if not used.any():
            continue
        keep = used[which]
        at, which = at[keep], (np.cumsum(used) - 1)[which[keep]]
        new = np.stack(_halves(found[used]), 1)
        s[at] = (len(size) + which).astype(s.dtype)
        stay = np.ones(len(s), bool)
        stay[at + 1] = False
        s = s[stay]
        rules.append(new.astype(s.dtype))
        lengths.append(size[new].sum(1))
        size = np.concatenate((size, lengths[-1]))
        room -= len(new)
    flat = np.concatenate(rules) if rules else np.zeros((0, 2), s.dtype)
    return Grammar(terminals, flat, np.concatenate(lengths) if lengths else np.zeros(0, np.int64), s)
