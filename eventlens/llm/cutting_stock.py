"""One-dimensional cutting stock by column generation.

Demands are counts per length class 1..capacity.  The linear program over
patterns (how many pieces of each class one sequence holds) is solved by the
revised simplex method; each round a knapsack dynamic program prices the best
new pattern from the duals.  Everything here is bounded by the number of
classes, never by the number of pieces.
"""

from __future__ import annotations

import numpy as np

TOLERANCE = 1e-7


def best_pattern(values: np.ndarray, sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Unbounded knapsack: counts per class with the largest total value."""
    worth = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        fit = np.searchsorted(sizes, room, "right")
        worth[room] = worth[room - 1]
        if fit:
            options = worth[room - sizes[:fit]] + values[:fit]
            top = int(options.argmax())
            if options[top] > worth[room] + 1e-12:
                worth[room], choice[room] = options[top], top
    counts, room = np.zeros(len(sizes)), capacity
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            counts[choice[room]] += 1
            room -= sizes[choice[room]]
    return counts


def solve(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (columns) and how often each is used, as a basic solution."""
    m = len(sizes)
    basis = np.diag(np.floor(capacity / sizes))
    inverse = np.diag(1 / np.diag(basis))
    cost = np.ones(m)
    # a hair more than asked for, different by class: no ties in the ratio test
    target = demand * (1 + 1e-7 * np.random.default_rng(1).random(m))
    x = inverse @ target
    for _ in range(30 * m):
        duals = cost @ inverse
        worst = int(duals.argmin())
        if duals[worst] < -TOLERANCE:
            column, price = -np.eye(m)[worst], 0.0
        else:
            column, price = best_pattern(np.maximum(duals, 0), sizes, capacity), 1.0
            if duals @ column <= 1 + TOLERANCE:
                break
        step = inverse @ column
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(step > 1e-9, x / step, np.inf)
        out = int(ratio.argmin())
        if not np.isfinite(ratio[out]):
            break
        row = inverse[out] / step[out]
        inverse -= np.outer(step, row)
        inverse[out] = row
        x -= ratio[out] * step
        x[out] = ratio[out]
        basis[:, out], cost[out] = column, price
    real = cost > 0
    return basis[:, real].T, np.maximum(x[real], 0)


def rest_patterns(sizes: np.ndarray, rest: np.ndarray, capacity: int) -> list[np.ndarray]:
    """Best-fit decreasing for the few pieces that whole patterns leave over."""
    rooms: list[int] = []
    made: list[np.ndarray] = []
    for i in np.argsort(-sizes):
        for _ in range(int(rest[i])):
            fits = [(room, j) for j, room in enumerate(rooms) if room >= sizes[i]]
            if fits:
                j = min(fits)[1]
            else:
                rooms.append(capacity)
                made.append(np.zeros(len(sizes)))
                j = len(rooms) - 1
            rooms[j] -= sizes[i]
            made[j][i] += 1
    return made


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (class, from rank, to rank, per sequence, first sequence, first
    slot): the pieces of a class whose rank falls in a range go to these
    sequences, so many to each, at slots from the first."""
    sizes = np.array(sorted(s for s, n in histogram.items() if n > 0), dtype=np.int64)
    if not len(sizes):
        return []
    demand = np.array([histogram[int(s)] for s in sizes], dtype=float)
    patterns, x = solve(sizes, demand, capacity)
    uses = [(p, int(n + 1e-6)) for p, n in zip(patterns, x, strict=True) if n + 1e-6 >= 1]
    rest = demand - sum((p * n for p, n in uses), np.zeros(len(sizes)))
    uses += [(p, 1) for p in rest_patterns(sizes, np.maximum(rest, 0), capacity)]
    given = np.zeros(len(sizes), dtype=np.int64)
    rows, sequence = [], 0
    for pattern, n in uses:
        slot = 0
        for i in np.flatnonzero(pattern)[::-1]:
            each = int(pattern[i])
            last = min(int(given[i]) + each * n, int(demand[i]))
            if last > given[i]:
                rows.append((int(sizes[i]), int(given[i]), last, each, sequence, slot))
            given[i] = last
            slot += each
        sequence += n
    return rows
