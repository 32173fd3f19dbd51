"""Minimal acyclic transducers from byte strings to id sequences.

Words arrive sorted and the automaton stays minimal while it grows: once no later word can
change a state, it is replaced by the equal state met before, if there is one, so words share
suffixes as well as prefixes. Outputs stand as near to the start as all words through an arc
allow. The finished automaton is a few flat arrays in one block of bytes, which workers map
into memory instead of loading it.
"""

from __future__ import annotations

import mmap
from collections.abc import Iterable

import numpy as np

_MAGIC = 0x54524E53
_HEADER = 8  # longs: magic, root, arcs, states, pool, three spare


class _State:
    __slots__ = ("arcs", "final")

    def __init__(self) -> None:
        self.arcs: dict[int, list] = {}  # byte -> [output, target]
        self.final: tuple[int, ...] | None = None


class _Builder:
    def __init__(self) -> None:
        self.known: dict[tuple, int] = {}
        self.outputs: dict[tuple[int, ...], int] = {(): 0}
        self.pool: list[int] = []
        self.arcs: list[tuple[int, int, int, int]] = []  # key, target, output's start and length
        self.finals: list[tuple[int, int]] = []  # output's start and length, -1 if no word ends here

    def output(self, ids: tuple[int, ...]) -> int:
        at = self.outputs.get(ids)
        if at is None:
            at = self.outputs[ids] = len(self.pool)
            self.pool += ids
        return at

    def settle(self, state: _State) -> int:
        """Number of the state equal to this one, whose targets are settled; a new one if there is none."""
        arcs = tuple((byte, target, out) for byte, (out, target) in sorted(state.arcs.items()))
        number = self.known.get((state.final, arcs))
        if number is None:
            number = self.known[state.final, arcs] = len(self.finals)
            for byte, target, out in arcs:
                self.arcs.append((number << 8 | byte, target, self.output(out), len(out)))
            self.finals.append((0, -1) if state.final is None else (self.output(state.final), len(state.final)))
        return number


def _shared(a, b) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def compiled(words: Iterable[tuple[bytes, tuple[int, ...]]]) -> bytes:
    """The transducer of ``(word, ids)``: words sorted by their bytes, different and not empty."""
    build, path, before = _Builder(), [_State()], b""
    for word, ids in words:
        kept = _shared(before, word)
        if word <= before:
            raise ValueError("words must be sorted, different and not empty")
        for at in range(len(before), kept, -1):
            path[at - 1].arcs[before[at - 1]][1] = build.settle(path[at])
        del path[kept + 1 :]
        for at in range(kept, len(word)):
            path.append(_State())
            path[at].arcs[word[at]] = [(), path[at + 1]]
        path[len(word)].final = ()
        for at in range(kept):  # what differs moves one arc further
            arc, below = path[at].arcs[word[at]], path[at + 1]
            n = _shared(arc[0], ids)
            if rest := arc[0][n:]:
                for later in below.arcs.values():
                    later[0] = rest + later[0]
                if below.final is not None:
                    below.final = rest + below.final
                arc[0] = arc[0][:n]
            ids = ids[n:]
        path[kept].arcs[word[kept]][0] = ids
        before = word
    for at in range(len(before), 0, -1):
        path[at - 1].arcs[before[at - 1]][1] = build.settle(path[at])
    root = build.settle(path[0])
    arcs = np.array(sorted(build.arcs), np.int64).reshape(-1, 4)
    finals = np.array(build.finals, np.int64).reshape(-1, 2)
    header = np.array([_MAGIC, root, len(arcs), len(finals), len(build.pool), 0, 0, 0], np.int64)
    narrow = [arcs[:, 1], arcs[:, 2], arcs[:, 3], finals[:, 0], finals[:, 1], np.array(build.pool, np.int64)]
    return b"".join([header.tobytes(), np.ascontiguousarray(arcs[:, 0]).tobytes(), *(a.astype(np.int32).tobytes() for a in narrow)])


class Transducer:
    """A compiled transducer over any buffer, as a memory map."""

    def __init__(self, data: bytes | mmap.mmap):
        magic, self.root, arcs, states, pool = np.frombuffer(data, np.int64, 5).tolist()
        if magic != _MAGIC:
            raise ValueError("no compiled transducer")
        at = 8 * _HEADER
        self.keys = np.frombuffer(data, np.int64, arcs, at)
        at += 8 * arcs
        parts = []
        for n in (arcs, arcs, arcs, states, states, pool):
            parts.append(np.frombuffer(data, np.int32, n, at))
            at += 4 * n
        self.target, self.start, self.length, self.final_start, self.final_length, self.pool = parts

    @classmethod
    def mapped(cls, path: str) -> Transducer:
        with open(path, "rb") as file:
            return cls(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ))

    def outputs(self, words: list[bytes], longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(ids, size, known)``: ids of the known words one after another, and how many each word has.

        All words go along in step, one arc each; one of more than ``longest`` bytes is not known.
        """
        length = np.fromiter(map(len, words), np.int64, len(words))
        first = np.cumsum(length) - length
        data = np.frombuffer(b"".join(words), np.uint8)
        known = np.zeros(len(words), bool)
        at = np.flatnonzero((length > 0) & (length <= longest)) if len(self.keys) else np.empty(0, np.int64)
        state, step, met = np.full(len(at), self.root, np.int64), 0, []
        while len(at):
            key = state << 8 | data[first[at] + step]
            arc = np.searchsorted(self.keys, key)
            arc[arc == len(self.keys)] = 0
            there = self.keys[arc] == key
            at, arc = at[there], arc[there]
            state, step = self.target[arc].astype(np.int64), step + 1
            says = self.length[arc] > 0
            met.append((at[says], self.start[arc[says]], self.length[arc[says]]))
            over = length[at] == step
            ends = over & (self.final_length[state] >= 0)
            known[at[ends]] = True
            met.append((at[ends], self.final_start[state[ends]], self.final_length[state[ends]]))
            at, state = at[~over], state[~over]
        whose, start, n = (np.concatenate([np.empty(0, np.int64), *x]).astype(np.int64) for x in zip(*met, strict=True)) if met else (np.empty(0, np.int64),) * 3
        of_known = known[whose]
        whose, start, n = whose[of_known], start[of_known], n[of_known]
        order = np.argsort(whose, kind="stable")
        size = np.bincount(whose, n, len(words)).astype(np.int64)
        return ragged(self.pool, start[order], n[order]), size, known


def ragged(values: np.ndarray, first: np.ndarray, width: np.ndarray) -> np.ndarray:
    """``values[first:first + width]`` of every row, one after another."""
    at = np.repeat(first - (np.cumsum(width) - width), width)
    at += np.arange(len(at))
    return values[at]
