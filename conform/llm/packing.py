"""Packing of pieces into sequences, planned on the histogram of their lengths.

There are at most ``capacity`` different lengths, so the histogram is bounded however many pieces there are. A plan never
names a piece or lists sequences: it consists of moves, each of which puts a run of pieces of one length into a run of
sequences, one piece each, at one offset. Spark numbers the pieces of a length and looks up the move of each.
"""

from __future__ import annotations

from collections import defaultdict, deque
from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from conform.llm.staging import staged

#: Moves and bases up to this many rows are broadcast (at most some 30 MB); beyond it they are joined by a shuffle.
_SMALL = 500_000

Move = tuple[int, int, int, int, int]


class CapacityTree:
    """A segment tree over the free capacities: which is the smallest one, at least as large as asked for, that occurs?"""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.used = [False] * (2 * self.leaves)

    def mark(self, value: int, used: bool) -> None:
        node = value + self.leaves
        self.used[node] = used
        while node > 1:
            node //= 2
            self.used[node] = self.used[2 * node] or self.used[2 * node + 1]

    def at_least(self, value: int) -> int | None:
        node = value + self.leaves
        while not self.used[node]:
            while node & 1:  # a right child: what is larger lies right of its parent
                node //= 2
            if node == 0:
                return None
            node += 1
            if node & (node - 1) == 0:  # the first of a level: the search ran out at the right
                return None
        while node < self.leaves:
            node = 2 * node if self.used[2 * node] else 2 * node + 1
        return node - self.leaves


class Plan:
    """Runs of sequences with the same free capacity, and the moves so far."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.sequences = 0
        self.moves: list[Move] = []
        self.free: dict[int, deque[tuple[int, int]]] = defaultdict(deque)
        self.tree = CapacityTree(capacity)
        self.next_rank: dict[int, int] = defaultdict(int)

    def add_run(self, first: int, count: int, free: int) -> None:
        self.free[free].append((first, count))
        self.tree.mark(free, True)

    def new_run(self, count: int) -> int:
        first, self.sequences = self.sequences, self.sequences + count
        return first

    def put(self, length: int, count: int, first: int, offset: int) -> None:
        """The next ``count`` pieces of the length, one into each sequence from ``first`` on."""
        rank = self.next_rank[length]
        self.next_rank[length] = rank + count
        self.moves.append((length, rank, rank + count, first, offset))

    def best_fit(self, length: int, count: int) -> None:
        """Every piece goes where it leaves least room, into a new sequence if it fits nowhere.

        A sequence that has taken a piece leaves less room than its neighbours had, so it takes the next ones of
        that length too: as many as fit, run by run.
        """
        while count:
            free = self.tree.at_least(length)
            if free is None:
                free, each = self.capacity, self.capacity // length
                run = -(-count // each)
                first = self.new_run(run)
            else:
                first, run = self.free[free].popleft()
                each = free // length
            full = min(run, count // each)
            self._fill(length, each, first, full, free)
            count -= full * each
            first, run = first + full, run - full
            if count and run:  # fewer than one sequence takes
                self._fill(length, count, first, 1, free)
                first, run, count = first + 1, run - 1, 0
            if run:
                self.free[free].appendleft((first, run))
            self.tree.mark(free, bool(self.free[free]))

    def _fill(self, length: int, each: int, first: int, run: int, free: int) -> None:
        if run:
            for layer in range(each):
                self.put(length, run, first, self.capacity - free + layer * length)
            self.add_run(first, run, free - each * length)


def best_fit_decreasing(histogram: dict[int, int], capacity: int) -> Plan:
    """Best-fit-decreasing over all pieces, each capacity found in the segment tree."""
    plan = Plan(capacity)
    for length in sorted(histogram, reverse=True):
        if length:
            plan.best_fit(length, histogram[length])
    return plan


def linear_grouping(histogram: dict[int, int], capacity: int, groups: int = 1024, small: float = 1 / 4) -> Plan:
    """Linear grouping: few sizes for the large lengths, good configurations of these, then best fit for the rest.

    Pieces longer than ``small`` of the capacity are sorted and cut into ``groups`` of equal cardinality; each counts as
    large as the largest of its group, so there are few sizes. Configurations of sizes are chosen one after another: the
    largest size left and, by a subset sum over all sizes left, what fills the rest of the sequence best; each is used as
    often as its sizes last. Then the actual pieces take their places, and what rounding left free
    goes to the small pieces by best fit in falling order.
    """
    plan = Plan(capacity)
    large = [length for length in sorted(histogram, reverse=True) if length > capacity * small]
    grouped, left = _groups(histogram, large, groups)
    while True:
        size = next((size for size in sorted(left, reverse=True) if left[size]), None)
        if size is None:
            break
        configuration = _configuration(size, left, capacity)
        times = min(left[part] // many for part, many in configuration.items())
        for part, many in configuration.items():
            left[part] -= many * times
        _substitute(plan, grouped, [part for part, many in configuration.items() for _ in range(many)], times)
    for length in sorted(histogram, reverse=True):
        if 0 < length <= capacity * small:
            plan.best_fit(length, histogram[length])
    return plan


def _groups(histogram: dict[int, int], large: list[int], groups: int) -> tuple[dict[int, deque], dict[int, int]]:
    """By rounded size, the runs (length, count) of its pieces; and the pieces that are left of each size."""
    total = sum(histogram[length] for length in large)
    most = max(1, -(-total // groups))
    runs: dict[int, deque] = {}
    left: dict[int, int] = {}
    size, room = 0, 0
    for length in large:
        count = histogram[length]
        while count:
            if not room:
                size, room = length, most
                # A group that begins within a length joins the one that the length gave its size to.
                runs.setdefault(size, deque())
                left.setdefault(size, 0)
            taken = min(count, room)
            runs[size].append((length, taken))
            left[size] += taken
            count, room = count - taken, room - taken
    return runs, left


def _configuration(first: int, left: dict[int, int], capacity: int) -> dict[int, int]:
    """The sizes of one sequence: ``first`` and the sizes left that fill the remaining capacity best."""
    room = capacity - first
    reach, steps = 1, []
    mask = (1 << (room + 1)) - 1
    for size in sorted(left, reverse=True):
        available = left[size] - (size == first)
        for _ in range(min(available, room // size)):
            wider = (reach | reach << size) & mask
            if wider == reach:
                break
            steps.append((size, reach))
            reach = wider
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    chosen = {first: 1}
    for size, before in reversed(steps):
        if not before >> total & 1:
            chosen[size] = chosen.get(size, 0) + 1
            total -= size
    return chosen


def _substitute(plan: Plan, grouped: dict[int, deque], sizes: list[int], times: int) -> None:
    """``times`` sequences of one configuration get actual pieces; runs break where an actual length changes."""
    first = plan.new_run(times)
    slots: list[list[tuple[int, int]]] = []
    for size in sizes:
        slot, need, runs = [], times, grouped[size]
        while need:
            length, count = runs.popleft()
            taken = min(count, need)
            slot.append((length, taken))
            need -= taken
            if count > taken:
                runs.appendleft((length, count - taken))
        slots.append(slot)
    while times:
        run, offset = min(slot[-1][1] for slot in slots), 0
        for slot in slots:
            length, count = slot.pop()
            plan.put(length, run, first, offset)
            offset += length
            if count > run:
                slot.append((length, count - run))
        plan.add_run(first, run, plan.capacity - offset)
        first, times = first + run, times - run


def packed(pieces: DataFrame, capacity: int, planner: Callable[[dict[int, int], int], Plan]) -> DataFrame:
    """``pieces`` with sequence_id and offset.

    ``pieces`` is a staged table with length, and with part and place: a number of its task and one within part
    and length, as ``token_pieces`` gives them. Pieces of length 0 need no room and go to sequence 0.
    The histogram, at most one row per length, is all that the driver sees. Ranks come from counts per length and
    part, never from a sort of the pieces, so a length may hold any part of all rows.
    """
    spark = pieces.sparkSession
    counts = staged(pieces.groupBy("length", "part").agg(F.count("*").alias("n")), "length-counts")
    histogram = {row.length: row.n for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = planner(histogram, capacity)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    moves = spark.createDataFrame(
        plan.moves or [(-1, 0, 0, 0, 0)],
        "move_length int, rank_from long, rank_to long, first long, offset long",
    )
    ranked = pieces.join(F.broadcast(bases) if counts.count() <= _SMALL else bases, ["length", "part"])
    rank = F.col("base") + F.col("place")
    fits = (F.col("length") == F.col("move_length")) & (rank >= F.col("rank_from")) & (rank < F.col("rank_to"))
    moved = ranked.join(F.broadcast(moves) if len(plan.moves) <= _SMALL else moves, fits, "left")
    return moved.select(
        *pieces.columns,
        F.coalesce(F.col("first") + rank - F.col("rank_from"), F.lit(0)).alias("sequence_id"),
        F.coalesce("offset", F.lit(0)).cast("long").alias("offset"),
    )
