"""The packing plan: linear grouping, few-size configurations, best fit.

Works on the histogram of lengths alone (at most ``capacity`` numbers), so its
cost does not depend on how many pieces there are. The result says, for runs of
equal pieces, which run of sequences takes them and at which offset.

1. Lengths above a stated part of the capacity are large. Sorted by length they are cut
   into groups of equal cardinality; each length is rounded up to its group's
   largest, which leaves few sizes.
2. The configurations (how many of each size fill one sequence) that need the
   fewest sequences solve a linear program, found by column generation: a
   simplex basis of one configuration per size, priced by an exact knapsack.
   Configurations are used a whole number of times, rounded down.
3. The actual lengths take the places of their group, longest first.
4. What is left and the small lengths go, longest first, where they leave the
   least room.

The scheme's guarantee holds for any part and number of groups; which does best
depends on the lengths, so a few are tried until one needs no more sequences than
the tokens fill.
"""

from __future__ import annotations

import heapq
from collections import defaultdict, deque
from dataclasses import dataclass, field

import numpy as np

#: (d, k): lengths above capacity / d are large and form about k groups. The plan
#: with the fewest sequences stays.
SHAPES = ((2, 16), (3, 16), (4, 48), (8, 48))
#: A configuration must improve the program by this much to enter it.
GAIN = 1e-7


@dataclass
class Runs:
    """Run i: pieces of ``length`` with ranks from ``rank``, ``count`` of them, the
    j-th at ``offset`` of sequence ``first + j``."""

    length: list[int] = field(default_factory=list)
    rank: list[int] = field(default_factory=list)
    count: list[int] = field(default_factory=list)
    first: list[int] = field(default_factory=list)
    offset: list[int] = field(default_factory=list)

    def add(self, length: int, rank: int, count: int, first: int, offset: int) -> None:
        self.length.append(length)
        self.rank.append(rank)
        self.count.append(count)
        self.first.append(first)
        self.offset.append(offset)


class _Packing:
    """Sequences as runs of equal room, and the pieces placed so far."""

    def __init__(self, counts: np.ndarray, capacity: int):
        self.capacity = capacity
        self.left = counts.astype(np.int64).copy()
        self.next_rank = np.zeros(capacity + 1, dtype=np.int64)
        self.runs = Runs()
        self.used = 0
        self.room: dict[int, deque[tuple[int, int]]] = defaultdict(deque)

    def place(self, length: int, count: int, first: int, offset: int) -> None:
        self.runs.add(length, int(self.next_rank[length]), count, first, offset)
        self.next_rank[length] += count
        self.left[length] -= count

    def open(self, count: int) -> int:
        first, self.used = self.used, self.used + count
        return first

    def best_fit(self) -> None:
        """All pieces left, longest first, each where it leaves the least room."""
        rooms = sorted(r for r, runs in self.room.items() if runs)
        for length in range(self.capacity, 0, -1):
            if not self.left[length]:
                continue
            heap = [r for r in rooms if r >= length]
            heapq.heapify(heap)
            while self.left[length] and heap:
                room = heapq.heappop(heap)
                runs = self.room[room]
                while runs and self.left[length]:
                    first, count = runs.popleft()
                    n = min(count, int(self.left[length]))
                    self.place(length, n, first, self.capacity - room)
                    if n < count:
                        runs.appendleft((first + n, count - n))
                    rest = room - length
                    if rest:
                        if rest >= length and not self.room[rest]:
                            heapq.heappush(heap, rest)
                        self.room[rest].append((first, n))
            each = self.capacity // length
            for per, sequences in ((each, int(self.left[length]) // each), (int(self.left[length]) % each, 1)):
                if not (per and sequences):
                    continue
                first = self.open(sequences)
                for k in range(per):
                    self.place(length, sequences, first, k * length)
                if rest := self.capacity - per * length:
                    self.room[rest].append((first, sequences))
            rooms = sorted(r for r, runs in self.room.items() if runs)


def groups_of(counts: np.ndarray, smallest: int, k: int) -> list[tuple[int, int, int]]:
    """(shortest, longest, pieces) of groups of about equal cardinality, longest first."""
    lengths = [n for n in range(len(counts) - 1, smallest, -1) if counts[n]]
    total = int(sum(int(counts[n]) for n in lengths))
    out: list[tuple[int, int, int]] = []
    seen = 0
    for n in lengths:
        c = int(counts[n])
        if out and seen * k // total == (seen + c - 1) * k // total and seen * k // total == group:
            out[-1] = (n, out[-1][1], out[-1][2] + c)
        else:
            group = seen * k // total
            out.append((n, n, c))
        seen += c
    return out


def best_configuration(
    sizes: np.ndarray, worth: np.ndarray, capacity: int
) -> tuple[float, np.ndarray]:
    """The configuration of most worth: an exact unbounded knapsack."""
    value = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1)
    at = np.arange(capacity + 1) - sizes[:, None]
    fits = at >= 0
    at = np.where(fits, at, 0)
    gain = np.where(fits, worth[:, None], -np.inf)
    # No configuration has more places than this.
    for _ in range(capacity // int(sizes.min())):
        offer = value[at] + gain
        best = offer.argmax(axis=0)
        top = offer[best, np.arange(capacity + 1)]
        up = top > value + 1e-12
        if not up.any():
            break
        value, choice = np.where(up, top, value), np.where(up, best, choice)
    out = np.zeros(len(sizes), dtype=np.int64)
    room = int(np.argmax(value >= value[capacity] - 1e-12))
    worth_left = value[room]
    while room > 0 and worth_left > 1e-12 and choice[room] >= 0:
        g = choice[room]
        out[g] += 1
        room -= int(sizes[g])
        worth_left = value[room]
    return float(out @ worth), out


def configurations(sizes: np.ndarray, need: np.ndarray, capacity: int) -> list[tuple[np.ndarray, float]]:
    """Configurations and how often each is used: the linear program's optimum."""
    k = len(sizes)
    basis = np.diag((capacity // sizes).astype(float))
    for _ in range(20 * k):
        inverse = np.linalg.inv(basis)
        duals = inverse.sum(axis=0)
        worth, column = best_configuration(sizes, np.maximum(duals, 0), capacity)
        if worth <= 1 + GAIN:
            break
        uses, direction = inverse @ need, inverse @ column
        up = direction > 1e-9
        if not up.any():
            break
        ratio = np.where(up, uses / np.where(up, direction, 1), np.inf)
        basis[:, int(np.argmin(ratio))] = column
    uses = np.linalg.inv(basis) @ need
    return [(basis[:, i].round().astype(np.int64), float(u)) for i, u in enumerate(uses) if u > 0]


def grouped(counts: np.ndarray, capacity: int, part: int, k: int) -> _Packing:
    """The plan for one choice of what is large and how many groups it forms."""
    packing = _Packing(counts, capacity)
    groups = groups_of(counts, capacity // part, k)
    if groups:
        sizes = np.array([longest for _, longest, _ in groups])
        need = np.array([n for _, _, n in groups], dtype=float)
        columns = configurations(sizes, need, capacity)
        for column, uses in sorted(columns, key=lambda x: -x[1]):
            times = int(uses + 1e-9)
            if times:
                _substitute(packing, groups, column, times)
    packing.best_fit()
    return packing


def _substitute(packing: _Packing, groups: list, column: np.ndarray, times: int) -> None:
    """Open ``times`` sequences of one configuration and fill its places with the
    actual lengths of each group; a place that finds none stays free."""
    first = packing.open(times)
    filled = [(0, times, 0)]  # from, to, tokens so far
    for (shortest, longest, _), places in zip(groups, column):
        for _ in range(int(places)):
            parts, at = [], 0
            for start, end, tokens in filled:
                at = start
                for length in range(longest, shortest - 1, -1):
                    if at == end:
                        break
                    if n := min(end - at, int(packing.left[length])):
                        packing.place(length, n, first + at, tokens)
                        parts.append((at, at + n, tokens + length))
                        at += n
                if at < end:
                    parts.append((at, end, tokens))
            filled = parts
    for start, end, tokens in filled:
        if room := packing.capacity - tokens:
            packing.room[room].append((first + start, end - start))


def plan(counts: np.ndarray, capacity: int) -> tuple[int, Runs]:
    """(sequences, runs) that place ``counts[n]`` pieces of every length ``n``."""
    tokens = int(counts @ np.arange(capacity + 1))
    best: _Packing | None = None
    for part, k in SHAPES:
        packing = grouped(counts, capacity, part, k)
        if best is None or packing.used < best.used:
            best = packing
        if best.used * capacity < tokens + capacity:
            break
    assert best is not None
    return best.used, best.runs
