"""Double-array tries over numbered symbols, packed and walked with numpy.

A state is a slot. ``base[state] + digit`` is the slot of the next state, and
``check`` of that slot names the state it belongs to, so one gather and one
comparison advance any number of states at once. A symbol is a fixed number of
digits of 10 bits: the children of a state span at most 1,024 slots, which keeps
the arrays dense however many symbols there are.
"""

from __future__ import annotations

import numpy as np

from rollcall.llm.support import by_value

by_value(__name__)

BITS = 10
RADIX = 1 << BITS
ROOT = 0
# Places tried, all over the array, for the children of one state before they go behind the last used slot.
TRIES = 128


def width_of(symbols: int) -> int:
    """Digits needed for symbols 0 to ``symbols`` - 1."""
    width = 1
    while symbols > 1 << (BITS * width):
        width += 1
    return width


class DoubleArray:
    """A trie that is built level by level: every state is extended in one call.

    Slots below RADIX are the root's and empty, so a state without children
    (base 0) leads nowhere.
    """

    def __init__(self, symbols: int):
        self.width = width_of(symbols)
        self.base = np.zeros(4 * RADIX, dtype=np.int32)
        self.check = np.full(4 * RADIX, -1, dtype=np.int32)
        self.end, self.hint = RADIX, 0

    def extend(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The states reached from ``states`` by ``symbols``, added where missing."""
        for place in reversed(range(self.width)):
            digit = (symbols >> (BITS * place)) & (RADIX - 1)
            keys, back = np.unique(states.astype(np.int64) * RADIX + digit, return_inverse=True)
            states = self._settle(keys >> BITS, keys & (RADIX - 1))[back]
        return states

    def _room(self, slots: int) -> None:
        """Let every slot below ``slots`` exist, with RADIX empty ones behind."""
        size = len(self.base)
        if slots + RADIX > size:
            more = max(slots + 2 * RADIX, size + size // 2) - size
            self.base = np.concatenate([self.base, np.zeros(more, np.int32)])
            self.check = np.concatenate([self.check, np.full(more, -1, np.int32)])

    def _settle(self, parents: np.ndarray, digits: np.ndarray) -> np.ndarray:
        """Slots for edges in ascending order of (parent, digit)."""
        slots = np.empty(len(parents), dtype=np.int64)
        if not len(parents):
            return slots
        first = np.flatnonzero(np.concatenate([[True], parents[1:] != parents[:-1]]))
        counts = np.diff(np.append(first, len(parents)))
        # Large families first, while there is room; only children fill the gaps at last.
        many = np.flatnonzero(counts > 1)
        for i in many[np.argsort(-counts[many], kind="stable")]:
            at, parent = slice(first[i], first[i] + counts[i]), parents[first[i]]
            base = self._fit(digits[at])
            slots[at] = base + digits[at]
            self.base[parent] = base
            self.check[slots[at]] = parent
        only = first[counts == 1]
        if len(only):
            free = np.flatnonzero(self.check[RADIX : self.end] < 0)[: len(only)] + RADIX
            missing = len(only) - len(free)
            self._room(self.end + missing)
            free = np.concatenate([free, np.arange(self.end, self.end + missing)])
            self.end += missing
            slots[only] = free
            self.base[parents[only]] = free - digits[only]
            self.check[free] = parents[only]
        return slots

    def _fit(self, digits: np.ndarray) -> int:
        """A base whose slots for ``digits`` are free."""
        if self.end > RADIX:
            spots = RADIX + (self.hint + np.arange(TRIES) * max(1, (self.end - RADIX) // TRIES)) % (self.end - RADIX)
            self.hint += 1
            free = spots[self.check[spots] < 0]
            bases = free - digits[0]
            fits = np.flatnonzero((self.check[bases[:, None] + digits] < 0).all(axis=1))
            if len(fits):
                base = int(bases[fits[0]])
                self.end = max(self.end, base + int(digits[-1]) + 1)
                self._room(self.end)
                return base
        base = self.end - int(digits[0])
        self.end = base + int(digits[-1]) + 1
        self._room(self.end)
        return base

    def packed(self) -> tuple[np.ndarray, np.ndarray]:
        """BASE and CHECK, with RADIX empty slots behind the last state."""
        return self.base[: self.end + RADIX], self.check[: self.end + RADIX]


def step(
    base: np.ndarray, check: np.ndarray, width: int, states: np.ndarray, symbols: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Advance all states by one symbol each: places of those that go on, and their new states."""
    live = np.flatnonzero(symbols >= 0)
    states, symbols = states[live], symbols[live]
    for place in reversed(range(width)):
        onward = base[states] + ((symbols >> (BITS * place)) & (RADIX - 1))
        found = check[onward] == states
        live, states, symbols = live[found], onward[found], symbols[found]
    return live, states
