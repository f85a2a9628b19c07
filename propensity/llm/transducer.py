"""A minimal acyclic transducer from sorted terms to their ordinals.

States that accept the same endings are one state. A transition carries how many terms come before
those that go on through it, so the sum along a term's path is the term's place in byte order.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np


class Transducer:
    """Transitions sorted by (state, byte), with target and number of terms passed over; final states; the start."""

    def __init__(self, key: np.ndarray, target: np.ndarray, passed: np.ndarray, final: np.ndarray, start: int):
        self.key, self.target, self.passed, self.final, self.start = key, target, passed, final, start

    @staticmethod
    def build(terms: Iterable[bytes]) -> Transducer:
        """From distinct terms in ascending byte order, one at a time: of the automaton so far only the path
        of the last term is still open, all other states are final and stand in the register once."""
        register: dict[tuple, int] = {}
        path: list[tuple[bool, list[tuple[int, int]]]] = [(False, [])]
        last = b""

        def close(depth: int) -> None:
            while len(path) > depth + 1:
                ends, edges = path.pop()
                state = register.setdefault((ends, *edges), len(register))
                path[-1][1].append((last[len(path) - 1], state))

        for i, term in enumerate(terms):
            if i and term <= last:
                raise ValueError("terms must be distinct and ascending")
            same = next((k for k, (a, b) in enumerate(zip(term, last)) if a != b), min(len(term), len(last)))
            close(same)
            path += [(False, []) for _ in term[same:]]
            path[-1] = (True, path[-1][1])
            last = term
        close(0)
        ends, edges = path[0]
        start = register.setdefault((ends, *edges), len(register))
        below = np.zeros(len(register), np.int64)  # terms from a state on; targets come before their sources
        key, target, passed = [], [], []
        for state, (ends, *edges) in enumerate(register):
            n = int(ends)
            for byte, to in edges:
                key.append(state << 8 | byte)
                target.append(to)
                passed.append(n)
                n += int(below[to])
            below[state] = n
        final = np.fromiter((s[0] for s in register), bool, len(register))
        return Transducer(np.array(key, np.int64), np.array(target, np.int32), np.array(passed, np.int64), final, start)

    def ordinals(self, text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Of each slice of ``text`` (bytes) its ordinal, -1 where it is no term. All slices take a step at a time."""
        out = np.full(len(starts), -1, np.int64)
        live, at, stop = np.arange(len(starts)), starts.astype(np.int64), ends
        state, place = np.full(len(starts), self.start, np.int64), np.zeros(len(starts), np.int64)
        while len(live):
            over = at == stop
            if over.any():
                good = over & self.final[state]
                out[live[good]] = place[good]
                go = ~over
                live, at, stop, state, place = live[go], at[go], stop[go], state[go], place[go]
            if not len(live) or not len(self.key):
                break
            want = state << 8 | text[at]
            edge = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
            go = self.key[edge] == want
            edge = edge[go]
            live, at, stop = live[go], at[go] + 1, stop[go]
            state, place = self.target[edge].astype(np.int64), place[go] + self.passed[edge]
        return out

    def pack(self) -> dict[str, bytes | int]:
        return {"key": self.key.tobytes(), "target": self.target.tobytes(), "passed": self.passed.tobytes(),
                "final": self.final.tobytes(), "start": self.start}

    @staticmethod
    def unpack(row) -> Transducer:
        read = np.frombuffer
        return Transducer(read(row["key"], np.int64), read(row["target"], np.int32), read(row["passed"], np.int64),
                          read(row["final"], bool), row["start"])
