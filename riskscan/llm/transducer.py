"""A minimal acyclic transducer: sorted terms, each with its lexicographic ordinal.

Terms are added in ascending byte order; a state is finished when no further term
can pass through it, and then shared with an equal finished state.  The number of
terms that can follow a state gives every edge an output, the terms that come before
all terms through that edge: the outputs along a term add up to its ordinal.

For reading, the edges stand in a hash table, so that many terms of a text are
followed at once, a byte of each at a time.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def build(terms: Iterable[bytes]) -> dict[str, np.ndarray]:
    """The edges (``code``: state * 256 + byte, ascending; ``target``; ``output``), ``final`` by state and the ``start``."""
    known: dict[tuple, int] = {}  # (final, bytes, targets) of the finished states
    made: list[tuple] = []
    follow: list[int] = []  # terms from each finished state on
    # the states along the last term: is it final, bytes and targets of its edges (the last target is still open)
    path: list[list] = [[False, [], []]]

    def finish(down_to: int) -> None:
        while len(path) > down_to + 1:
            final, labels, targets = path.pop()
            key = (final, bytes(labels), tuple(targets))
            state = known.get(key)
            if state is None:
                state = known[key] = len(made)
                made.append(key)
                follow.append(final + sum(follow[t] for t in targets))
            path[-1][2].append(state)

    last = None
    for term in terms:
        if last is not None and term <= last:
            raise ValueError("terms have to ascend")
        common = 0
        for a, b in zip(last or b"", term):
            if a != b:
                break
            common += 1
        finish(common)
        for byte in term[common:]:
            path[-1][1].append(byte)
            path.append([False, [], []])
        path[-1][0] = True
        last = term
    finish(0)
    final, labels, targets = path[0]
    made.append((final, bytes(labels), tuple(targets)))
    codes, ends, outputs = [], [], []
    for state, (final, labels, targets) in enumerate(made):
        output = int(final)
        for byte, target in zip(labels, targets):
            codes.append(state << 8 | byte)
            ends.append(target)
            outputs.append(output)
            output += follow[target]
    return {
        "code": np.array(codes, dtype=np.int64), "target": np.array(ends, dtype=np.int32),
        "output": np.array(outputs, dtype=np.int64), "final": np.array([key[0] for key in made], dtype=bool),
        "start": np.array([len(made) - 1], dtype=np.int64),
    }


class Transducer:
    """Reads terms.  Takes what `build` gives."""

    def __init__(self, code: np.ndarray, target: np.ndarray, output: np.ndarray, final: np.ndarray, start: np.ndarray):
        self.target, self.output, self.final, self.start = target, output, final, int(start[0])
        bits = max(4, int(4 * len(code)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.edge = np.full(1 << bits, -1, dtype=np.int32)  # by slot: the edge there
        self.code = np.full(1 << bits, -1, dtype=np.int64)
        left, slot = np.arange(len(code), dtype=np.int32), self.slots(code)
        while len(left):
            free = self.edge[slot] < 0
            self.edge[slot[free]] = left[free]
            open_ = self.edge[slot] != left  # a slot that several wanted keeps one of them
            left, slot = left[open_], (slot[open_] + 1) & self.mask
        filled = self.edge >= 0
        self.code[filled] = code[self.edge[filled]]

    def slots(self, code: np.ndarray) -> np.ndarray:
        return ((code.view(np.uint64) * MULTIPLIER) >> self.shift).astype(np.int64)

    def edges(self, code: np.ndarray) -> np.ndarray:
        """The edge of each code, -1 if there is none."""
        slot = self.slots(code)
        there = self.code[slot]
        found = np.where(there == code, self.edge[slot], -1)
        open_ = np.flatnonzero((there != code) & (there >= 0))
        while len(open_):  # another code has the slot: the next one
            slot[open_] = (slot[open_] + 1) & self.mask
            there = self.code[slot[open_]]
            hit = there == code[open_]
            found[open_[hit]] = self.edge[slot[open_[hit]]]
            open_ = open_[~hit & (there >= 0)]
        return found

    def ordinals(self, text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The ordinal of each term ``text[start:end]`` of a text's bytes, -1 for those that are not held."""
        out = np.full(len(starts), -1, dtype=np.int64)
        live, at, ends = np.arange(len(starts)), starts, ends
        state, total = np.full(len(starts), self.start, dtype=np.int64), np.zeros(len(starts), dtype=np.int64)
        while len(live):
            done = at == ends
            if done.any():
                held = done & self.final[state]
                out[live[held]] = total[held]
                on = ~done
                live, at, ends, state, total = live[on], at[on], ends[on], state[on], total[on]
            edge = self.edges((state << 8) | text[at])
            on = edge >= 0
            edge = edge[on]
            live, at, ends = live[on], at[on] + 1, ends[on]
            state, total = self.target[edge].astype(np.int64), total[on] + self.output[edge]
        return out
