"""Cutting-stock patterns over a length histogram, by column generation.

The linear program chooses how often to use each pattern, a multiset of length classes
that fits a sequence. It starts from patterns of one class each; a knapsack by dynamic
programming prices new patterns with the dual values until none can lower the number of
sequences by more than a tolerance. The fractional uses are rounded down and the rest is
packed into patterns that fit what is left. The work depends on the number of classes,
not on the number of documents.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Use:
    """A pattern as (class, how many of it), and how many sequences follow it."""

    pattern: tuple[tuple[int, int], ...]
    copies: int


def _best_pattern(values: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the multiset of classes that fits and is worth most."""
    best = np.zeros(capacity + 1)
    taken = np.full(capacity + 1, -1)
    smallest = int(sizes[0])
    for room in range(smallest, capacity + 1):
        fitting = int(np.searchsorted(sizes, room, side="right"))
        worth = best[room - sizes[:fitting]] + values[:fitting]
        k = int(worth.argmax())
        if worth[k] > best[room - 1]:
            best[room], taken[room] = worth[k], k
        else:
            best[room] = best[room - 1]
    pattern = np.zeros(len(sizes))
    room = capacity
    while room >= smallest:
        if taken[room] < 0:
            room -= 1
        else:
            pattern[taken[room]] += 1
            room -= int(sizes[taken[room]])
    return float(best[capacity]), pattern


def _generate(sizes: np.ndarray, demand: np.ndarray, capacity: int, tolerance: float, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Basic patterns (columns) and their uses: revised simplex, patterns priced on demand."""
    start = capacity // sizes
    patterns = np.diag(start.astype(float))
    inverse = np.diag(1.0 / start)
    # Slightly uneven demands: equal ones would let a step leave all uses as they are.
    uneven = demand * (1.0 + 1e-4 * ((np.arange(len(demand)) * 0.6180339887) % 1.0))
    uses = uneven / start
    bound = 0.0
    for step in range(steps):
        duals = inverse.sum(axis=0)
        worth, pattern = _best_pattern(np.maximum(duals, 0.0), sizes, capacity)
        # The present total divided by the worth bounds the optimum from below.
        total = float(uses.sum())
        bound = max(bound, total / max(worth, 1.0))
        if total <= bound * (1.0 + tolerance) or math.ceil(total) <= math.ceil(bound):
            break
        held = np.flatnonzero(pattern)
        direction = (inverse[:, held] * pattern[held]).sum(axis=1)
        steps_left = np.where(direction > 1e-9, uses / np.where(direction > 1e-9, direction, 1.0), np.inf)
        leaving = int(steps_left.argmin())
        amount = steps_left[leaving]
        if not np.isfinite(amount):
            break
        uses = uses - amount * direction
        uses[leaving] = amount
        patterns[:, leaving] = pattern
        row = inverse[leaving] / direction[leaving]
        inverse = inverse - np.outer(direction, row)
        inverse[leaving] = row
        if step % 200 == 199:
            missed = np.abs((patterns * uses).sum(axis=1) - uneven).max()
            if missed > 1e-6 * uneven.max():  # rounding errors have added up
                inverse = np.linalg.inv(patterns)
                uses = (inverse * uneven).sum(axis=1)
    return patterns, np.maximum(uses, 0.0)


def _fill(sizes: np.ndarray, left: np.ndarray, capacity: int) -> np.ndarray:
    """The fullest pattern that the remaining pieces allow, around the largest of them."""
    largest = int(np.flatnonzero(left)[-1])
    room = capacity - int(sizes[largest])
    pattern = np.zeros(len(sizes), dtype=np.int64)
    pattern[largest] = 1
    available = left - pattern
    # reach[r]: the last class used to fill exactly r, so that sums can be traced back.
    reach = np.full(room + 1, -1)
    used = np.zeros(room + 1, dtype=np.int64)
    reach[0] = len(sizes)
    for k in np.flatnonzero(available)[::-1]:
        size = int(sizes[k])
        used[:] = 0
        for total in range(size, room + 1):
            before = total - size
            if reach[total] < 0 and reach[before] >= 0 and used[before] < available[k]:
                reach[total] = k
                used[total] = used[before] + 1
        if reach[room] >= 0:
            break
    total = int(np.flatnonzero(reach >= 0)[-1])
    while total > 0:
        k = int(reach[total])
        pattern[k] += 1
        total -= int(sizes[k])
    return pattern


def solve(histogram: dict[int, int], capacity: int, tolerance: float = 0.0005, steps: int = 3000) -> list[Use]:
    """Patterns and copies that take exactly ``histogram[size]`` pieces of every size.

    Sizes are whole numbers from 1 to ``capacity``. ``tolerance`` bounds how far the linear
    program may stay above its optimum, ``steps`` the patterns priced.
    """
    left = {size: count for size, count in histogram.items() if count > 0}
    if not left:
        return []
    sizes = np.array(sorted(left), dtype=np.int64)
    remaining = np.array([left[s] for s in sizes.tolist()], dtype=np.int64)
    patterns, uses = _generate(sizes, remaining.astype(float), capacity, tolerance, steps)
    result: list[Use] = []

    def take(pattern: np.ndarray, most: int) -> None:
        held = np.flatnonzero(pattern)
        copies = min(most, int((remaining[held] // pattern[held]).min()))
        if copies > 0:
            remaining[held] -= copies * pattern[held]
            result.append(Use(tuple((int(sizes[k]), int(pattern[k])) for k in held), copies))

    for k in np.argsort(-uses, kind="stable"):
        take(patterns[:, k].round().astype(np.int64), int(uses[k] + 1e-6))
    while remaining.any():
        take(_fill(sizes, remaining, capacity), int(remaining.max()))
    return result
