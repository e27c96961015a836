"""How often to use which pattern of lengths, so that few sequences hold all
pieces of a histogram.

Works on the histogram alone: at most ``room`` lengths with their numbers,
whatever the number of pieces.  Patterns are two or three lengths that fill a
sequence exactly; a length that does so alone needs no fit.  Non-negative least squares fits their repeat counts to the
histogram, long pieces weighing more, since short ones find a place anyway.
The counts are rounded as far as pieces last; the residual is packed best-fit,
longest first, by groups of equal sequences and runs of equal lengths.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

#: Patterns that join the fit in one step, the most steps, and the share of pieces that may be left to the residual.
JOIN, STEPS, LEFT = 48, 120, 0.002
#: Turns and relative exactness of a least squares solution.
TURNS, EXACT = 60, 1e-4


def patterns(lengths: np.ndarray, room: int) -> np.ndarray:
    """All multisets of two or three of ``lengths`` whose sum is ``room``, one a
    row, pairs with a zero."""
    present = np.zeros(room + 1, bool)
    present[lengths] = True
    found = [np.zeros((0, 3), np.int64)]
    for a in lengths[3 * lengths <= room].tolist():
        b = lengths[(lengths >= a) & (2 * lengths <= room - a)]
        b = b[present[room - a - b]]
        found.append(np.stack([np.full_like(b, a), b, room - a - b], axis=1))
    pairs = lengths[2 * lengths <= room]
    pairs = pairs[present[room - pairs]]
    found.append(np.stack([pairs, room - pairs, np.zeros_like(pairs)], axis=1))
    return np.concatenate(found)


def _least_squares(at: np.ndarray, weight: np.ndarray, goal: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Least squares over some patterns by conjugate gradients from ``x``;
    ``at`` are their rows (``len(goal)``: none)."""
    spread, m = at.ravel(), len(goal)

    def times(v: np.ndarray) -> np.ndarray:
        return np.bincount(spread, np.repeat(v, at.shape[1]), m + 1)[:m] * weight

    def back(r: np.ndarray) -> np.ndarray:
        return np.append(r * weight, 0.0)[at].sum(axis=1)

    left = goal - times(x)
    slope = back(left)
    way, size = slope.copy(), float(slope @ slope)
    enough = size * EXACT ** 2
    for _ in range(TURNS):
        if size <= enough:
            break
        seen = times(way)
        step = size / max(float(seen @ seen), 1e-300)
        x = x + step * way
        left -= step * seen
        slope = back(left)
        size, before = float(slope @ slope), size
        way = slope + size / before * way
    return x


def fit(rows: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Repeat counts of the patterns, none negative, in the least squares
    sense: patterns of the steepest descent join an active set, some at a
    time, and leave when they turn negative; ends when what is left to fit is
    a share of ``LEFT`` of the pieces, or after ``STEPS``."""
    room = len(counts) - 1
    used = np.unique(rows[rows > 0])
    place = np.full(room + 1, len(used))
    place[used] = np.arange(len(used))
    place[0] = len(used)
    at = place[rows]
    # a piece weighs as much as the room it needs
    weight = used / room
    goal = counts[used] * weight
    out, closest = np.zeros(len(rows)), np.inf
    active, x, left = np.zeros(0, np.int64), np.zeros(0), goal.copy()
    for _ in range(STEPS):
        slope = np.append(left * weight, 0.0)[at].sum(axis=1)
        slope[active] = 0.0
        best = np.argpartition(-slope, 64 * JOIN)[:64 * JOIN] if len(slope) > 64 * JOIN else np.arange(len(slope))
        best = best[np.lexsort((best, -slope[best]))]
        join, taken = [], np.zeros(len(used) + 1, bool)
        for p in best.tolist():  # no two of a step share a length
            if slope[p] <= 0 or len(join) == JOIN:
                break
            if not taken[at[p]].any():
                join.append(p)
                taken[at[p]] = True
                taken[-1] = False
        if not join:
            break
        active, x = np.concatenate([active, join]), np.concatenate([x, np.zeros(len(join))])
        while len(active):
            x = _least_squares(at[active], weight, goal, x)
            stay = x > 0
            if stay.all():
                break
            active, x = active[stay], x[stay]
        left = goal - np.bincount(at[active].ravel(), np.repeat(x, at.shape[1]), len(used) + 1)[:-1] * weight
        if float(left @ left) < closest:
            closest, out = float(left @ left), np.zeros(len(rows))
            out[active] = x
        if np.abs(left / weight).sum() <= LEFT * counts.sum():
            break
    return out


def best_fit(counts: np.ndarray) -> list[tuple[int, tuple[tuple[int, int], ...]]]:
    """Best-fit decreasing over a histogram: (number of sequences, their
    (length, times) in order).  Sequences with equal contents are one group; a
    length meets the group with the least sufficient room."""
    room = len(counts) - 1
    groups: dict[int, list[tuple[int, tuple]]] = {}  # free room -> groups
    for length in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[length])
        free = length
        while left:
            while free <= room and not groups.get(free):
                free += 1
            times = (free if free <= room else room) // length
            if free <= room:
                number, held = groups[free].pop()
            else:
                free, number, held = room, -(-left // times), ()
            whole = min(number, left // times)
            rest = left - whole * times if whole < number else 0
            rest = min(rest, times)
            for n, t in ((whole, times), (1 if rest else 0, rest), (number - whole - (1 if rest else 0), 0)):
                if n:
                    now = (*held, (length, t)) if t else held
                    groups.setdefault(free - length * t, []).append((n, now))
            left -= whole * times + rest
            free = length
    return [g for some in groups.values() for g in some]


def plan(histogram: Iterable[tuple[int, int]], room: int) -> list[tuple[int, tuple[tuple[int, int], ...]]]:
    """(number of sequences, their (length, times) in order) for all pieces of
    the histogram, (length, number) with lengths of 1 to ``room``."""
    counts = np.zeros(room + 1, np.int64)
    for length, number in histogram:
        counts[length] += number
    found = []
    if counts[room]:
        found.append((int(counts[room]), ((room, 1),)))
        counts[room] = 0
    rows = patterns(np.flatnonzero(counts), room)
    if len(rows):
        repeats = fit(rows, counts.astype(float))
        for p in np.argsort(-repeats, kind="stable")[:int((repeats >= 0.5).sum())].tolist():
            lengths, times = np.unique(rows[p][rows[p] > 0], return_counts=True)
            number = int(min(np.rint(repeats[p]), (counts[lengths] // times).min()))
            if number:
                counts[lengths] -= number * times
                found.append((number, tuple(zip(lengths.tolist(), times.tolist(), strict=True))))
    return found + best_fit(counts)
