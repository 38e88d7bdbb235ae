"""Cheapest repair of a role sequence: depth-first branch and bound.

A sequence is two letters a row: the role's initial (``s``, ``u``, ``a``, any
other ``x``) and its fault (``b`` blank, ``d`` duplicate, ``t`` truncated, ``.``
none).  Edits and their prices: keep 0, rerole 3, delete 4 (the only edit of a
blank or duplicate row), insert 3; a truncated row that stays costs 3 more.
What remains must read ``(s?(ua)+)?``; of equally cheap repairs the one whose
audit (the initials of its edits) is least in ASCII wins.

The search keeps an explicit stack of (row, state, cost, audit).  A branch ends
when its cost plus the lower bound of its suffix passes the incumbent (cost,
audit), or when the node's dominance entry is no worse: two prefixes that reach
one node at one cost have the same number of row edits, so neither audit is a
prefix of the other and the lesser stays the lesser whatever follows.  The
stack running empty proves the incumbent optimal.

The lower bound of a suffix is the price of its cheapest repair in a relaxed
format (``Bounds``).  Branches are taken in order of bound, then letter.
"""

from __future__ import annotations

from functools import lru_cache
from math import inf

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: States: nothing yet, after the system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
STEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: The user or assistant row that fits each state.
FITS = ("u", "u", "a", "u")
WHOLE = (0.0, inf, inf, 0.0)

Found = tuple[float, str, int]


def after(state: int) -> int:
    return STEP[state, FITS[state]]


class Bounds:
    """Lower bounds of every suffix: the price of its cheapest repair in a
    relaxed format, in which only the role that comes next is known.  Whether
    the opening was a system row, and that a system row needs a dialogue after
    it, is forgotten, and ties are not told apart."""

    def __init__(self, rows: list[str], exits: tuple[float, ...], last: bool):
        self.n, self.exits = len(rows), exits
        user = min(exits[START], exits[SYSTEM], exits[ASSISTANT])
        assistant = exits[USER]
        if last:
            user, assistant = min(user, INSERT + assistant), min(assistant, INSERT + user)
        self.next_user, self.next_assistant, self.at_start = [user], [assistant], [user]
        for role, fault in reversed(rows):
            stays = TRUNCATED * (fault == "t")
            none, user, assistant = self.at_start[-1], self.next_user[-1], self.next_assistant[-1]
            gone = fault in "bd"
            as_user = inf if gone else stays + assistant + (KEEP if role == "u" else REROLE)
            as_assistant = inf if gone else stays + user + (KEEP if role == "a" else REROLE)
            of_user, of_assistant = min(DELETE + user, as_user), min(DELETE + assistant, as_assistant)
            self.next_user.append(min(of_user, INSERT + of_assistant))
            self.next_assistant.append(min(of_assistant, INSERT + of_user))
            as_system = stays + user if role == "s" and not gone else inf
            self.at_start.append(min(self.next_user[-1], as_system, DELETE + none))

    def __call__(self, i: int, state: int) -> float:
        if i == self.n and self.exits[state] < inf:
            return self.exits[state]
        side = self.at_start if state == START else self.next_assistant if state == USER else self.next_user
        return side[self.n - i]


def search(codes: str, entry: int, exits: tuple[float, ...], last: bool) -> Found | None:
    """The best (cost, audit, exit state) from state ``entry``, an exit costing
    ``exits[state]`` on top (not part of the cost returned).  Insertions after
    the last row belong to the piece that follows, unless this is the last."""
    rows = [codes[k : k + 2] for k in range(0, len(codes), 2)]
    n, low = len(rows), Bounds(rows, exits, last)
    best: tuple[float, str] = (inf, "")
    found: Found | None = None
    table: dict[tuple[int, int], tuple[float, str]] = {}
    stack: list[tuple[int, int, float, str]] = [(0, entry, 0.0, "")]
    while stack:
        i, state, cost, audit = stack.pop()
        reached = cost + low(i, state)
        if reached > best[0] or reached == inf or (reached == best[0] and audit > best[1][: len(audit)]):
            continue
        seen = table.get((i, state))
        if seen is not None and seen <= (cost, audit):
            continue
        table[i, state] = (cost, audit)
        fits, turned = FITS[state], after(state)
        if i == n:
            total = cost + exits[state]
            if (total, audit) < best or found is None and total < inf:
                best, found = (total, audit), (cost, audit, state)
            if last and exits[state] == inf:
                stack.append((n, turned, cost + INSERT, audit + "I"))
            continue
        role, fault = rows[i]
        ahead = [("D", i + 1, state, cost + DELETE), ("I", i, turned, cost + INSERT)]
        if fault not in "bd":
            stays = cost + TRUNCATED * (fault == "t")
            kept = STEP.get((state, role))
            if kept is not None:
                ahead.append(("K", i + 1, kept, stays + KEEP))
            if role != fits:
                ahead.append(("R", i + 1, turned, stays + REROLE))
        ahead.sort(key=lambda x: (x[3] + low(x[1], x[2]), x[0]), reverse=True)
        stack += [(j, q, c, audit + letter) for letter, j, q, c in ahead]
    return found


@lru_cache(maxsize=1 << 16)
def repair(codes: str) -> tuple[int, str]:
    """(cost, audit) of a whole sequence."""
    cost, audit, _ = search(codes, START, WHOLE, True)
    return int(cost), audit


def matrix(codes: str, last: bool) -> list[float]:
    """Cheapest costs of a piece from every entry to every exit state, row by row."""
    costs = []
    for entry in range(4):
        for leave in range(4):
            found = search(codes, entry, tuple(0.0 if q == leave else inf for q in range(4)), last)
            costs.append(inf if found is None else found[0])
    return costs
