"""Wagner-Fischer alignment of turns with the alternating grammar ``(s?(ua)+)?``.

A conversation is cut into blocks of turns, so that a long one is many small tables. A block is
aligned with every feasible length of the alternating string that may stand between the state
it is entered in and the state it is left in. All lengths with one last character read the same
table from its end, a cell being (turns left, characters left), so one banded table per last
character holds them all.

The incumbent is the cost of a greedy alignment, with room for any entry and exit. Every path
that costs no more stays in Ukkonen's band around the diagonal: the excess over what faulty
turns cost anyway bounds how many turns more are deleted, and how many are inserted.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

#: States between turns: nothing written yet, or the last initial written.
START, SYSTEM, USER, ASSISTANT = range(4)
DELETE, REROLE, INSERT, UNENDED = 2, 1, 5, 5
#: Cost and audit of ending in a state: what is missing is inserted.
END_COST = (0, 2 * INSERT, INSERT, 0)
END_AUDIT = ("", "II", "I", "")
NEVER = 1 << 40
#: Codes of turns: ``x`` must go; otherwise the initial, ``o`` for any other, upper case if it lacks its end.
GONE = "x"
_EXITS = (USER, ASSISTANT)


class Block:
    """The alignments of a block of turns, given as codes."""

    def __init__(self, codes: str):
        self.codes, self.n = codes, len(codes)
        self.kept = [c != GONE for c in codes]
        self.unended = [c.isupper() for c in codes]
        self.initial = codes.lower()
        faulty = DELETE * sum(u or not k for u, k in zip(self.unended, self.kept, strict=True))
        # another first character: one insertion; another last one: one more and a role
        excess = _greedy(codes) + 2 * INSERT + REROLE - faulty
        self.fewer = sum(self.unended) + excess // DELETE
        self.width = self.fewer + excess // INSERT + 1
        left = [0]
        for k in reversed(self.kept):
            left.append(left[-1] + k)
        #: Kept turns from each place on; the band's middle is as many characters.
        self.left = left[::-1]
        self._fill()

    def _fill(self) -> None:
        n, width = self.n, self.width
        table = np.full((2, n + 1, width), NEVER, np.int64)  # last character, turn, characters left in the band
        table[:, n, self.fewer] = 0
        slope = INSERT * np.arange(width)
        at = np.arange(width)
        for i in range(n - 1, -1, -1):
            below = table[:, i + 1]
            if not self.kept[i]:
                best = below + DELETE
            else:
                best = np.full((2, width), NEVER, np.int64)
                best[:, :-1] = below[:, 1:] + DELETE
                odd = (self.left[i] - self.fewer + at) % 2 == 1  # an odd number of characters begins with the last one
                as_user, as_assistant = (REROLE * (self.initial[i] != c) + UNENDED * self.unended[i] for c in "ua")
                placed = np.stack([np.where(odd, as_user, as_assistant), np.where(odd, as_assistant, as_user)])
                best = np.minimum(best, below + placed)
            table[:, i] = np.minimum(np.minimum.accumulate(best - slope, axis=1) + slope, NEVER)
        self.table = table

    def cell(self, last: int, i: int, characters: int) -> int:
        """Least cost of the turns from ``i`` on as the last ``characters`` characters of a string that ends in ``last``."""
        k = characters - self.left[i] + self.fewer
        return int(self.table[last - USER, i, k]) if 0 <= k < self.width else NEVER

    def _lengths(self, last: int, i: int, first: int, least: int) -> range:
        """Feasible lengths, ``least`` or more, from turn ``i`` on, of strings from initial ``first`` to ``last``."""
        low = max(least, self.left[i] - self.fewer)
        return range(low + (low % 2 != (first == last)), self.left[i] - self.fewer + self.width, 2)

    def ways(self, entry: int) -> list[tuple[int, int, str, int, int]]:
        """``(cost, exit, audit so far, turn, characters)`` of every feasible length from a state."""
        n = self.n
        if not n:
            return [(0, entry, "", 0, 0)]
        found = []
        first, least = (ASSISTANT, 0) if entry == USER else (USER, 0 if entry == ASSISTANT else 1)
        for last in _EXITS:
            found += [(self.cell(last, 0, r), last, "", 0, r) for r in self._lengths(last, 0, first, least)]
        if entry in (START, SYSTEM):
            found.append((DELETE * n, entry, "D" * n, n, 0))
        if entry == START:
            for p in range(n):
                if self.initial[p] != "s":
                    continue
                cost, audit = DELETE * p + UNENDED * self.unended[p], "D" * p + "K"
                found.append((cost + DELETE * (n - 1 - p), SYSTEM, audit + "D" * (n - 1 - p), n, 0))
                for last in _EXITS:
                    found += [(cost + self.cell(last, p + 1, r), last, audit, p + 1, r) for r in self._lengths(last, p + 1, USER, 1)]
        return [way for way in found if way[0] < NEVER]

    def traced(self, last: int, i: int, characters: int) -> str:
        """The ASCII-least audit of a cell's cost: delete before insert before keep before rerole."""
        out = []
        while i < self.n:
            cost = self.cell(last, i, characters)
            if self.cell(last, i + 1, characters) + DELETE == cost:
                out.append("D")
                i += 1
            elif self.cell(last, i, characters - 1) + INSERT == cost:
                out.append("I")
                characters -= 1
            else:
                wanted = "ua"[(last == ASSISTANT) == (characters % 2 == 1)]
                out.append("K" if self.initial[i] == wanted else "R")
                i, characters = i + 1, characters - 1
        return "".join(out)


def _greedy(codes: str) -> int:
    """Cost of a simple alignment: turns without an end go, a turn out of order goes if the next one fits, else it changes its role."""
    cost, wanted = 0, "u"
    rest = [c for c in codes if c.islower() and c != GONE]
    cost += DELETE * (len(codes) - len(rest))
    for at, initial in enumerate(rest):
        if initial != wanted:
            if at + 1 < len(rest) and rest[at + 1] == wanted:
                cost += DELETE
                continue
            cost += REROLE
        wanted = "a" if wanted == "u" else "u"
    return cost


@lru_cache(maxsize=4096)
def _short(codes: str) -> Block:
    return Block(codes)


def block(codes: str) -> Block:
    return _short(codes) if len(codes) <= 16 else Block(codes)


def costs(codes: str) -> list[list[int]]:
    """Least cost of a block by the state it is entered in and the state it is left in."""
    own = block(codes)
    out = [[NEVER] * 4 for _ in range(4)]
    for entry in range(4):
        for cost, left, *_ in own.ways(entry):
            out[entry][left] = min(out[entry][left], cost)
    return out


def before(cost: list[list[int]], after: list[int]) -> list[int]:
    """Least cost from each entry of a block to the conversation's end, given those from its exits."""
    return [min(c + a for c, a in zip(row, after, strict=True)) for row in cost]


def audit(codes: str, entry: int, after: list[int]) -> tuple[str, int]:
    """The cheapest edits of a block, ties ASCII-least, and the state they leave, given the costs from its exits.

    Of each length that is as cheap as any the least audit is traced back, and the audits are
    compared. Every audit ends in the block's last turn and has as many edits of turns, so none
    begins another, and the order of the whole audits is decided by the first block that differs.
    """
    own = block(codes)
    ways = own.ways(entry)
    least = min(cost + after[left] for cost, left, *_ in ways)
    found = []
    for cost, left, so_far, turn, characters in ways:
        if cost + after[left] == least:
            found.append((so_far + (own.traced(left, turn, characters) if turn < own.n else ""), left))
    return min(found)
