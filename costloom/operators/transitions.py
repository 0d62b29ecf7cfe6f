"""Chunks of rising costs as records that compose.

A cost c is taken over at the current cost x when x is 0 or x + tolerance <= c.
A chunk of rising costs is entered with some x that is at most the peak so far
and above that peak less the tolerance. Which cost of the chunk is taken first
depends on x alone, by one bound per cost, and only bounds within the tolerance
above the peak can matter. From there on the way is fixed, and ways that meet
stay together. So a record has one bound for each distinct cost inside one
tolerance, however long the chunk is, and one outcome for each way.

Both functions work on rows that arrive in order and hold one product's record
at a time; Spark deals the rows out.
"""

from __future__ import annotations

import sys
from bisect import bisect_left
from collections import deque
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle

# These functions travel with the job, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FIELDS = ["cost", "price", "is_primary", "is_last"]
TAKEN = "cost double, price double, is_primary boolean, is_last boolean"
RECORD = f"tmpl_id long, chunk int, start double, bounds array<double>, ways array<int>, taken array<struct<{TAKEN.replace(' ', ':').replace(',:', ',')}>>"
OUTCOME = f"tmpl_id long, {TAKEN}"
Batches = Iterator[pd.DataFrame]


class Chunk:
    """Outcome of a chunk for every cost it may be entered with."""

    def __init__(self, start: float, above: float, tolerance: float):
        self.tolerance, self.above = tolerance, above
        self.exact = above == start  # nothing was taken before: it is entered with ``start`` itself
        self.bounds: list[float] = []
        self.open = not self.exact
        # Ways by rising cost: (current cost, event, numbers of the bounds that lead here).
        self.ways: deque[tuple[float, tuple, list[int]]] = deque()
        self.cost = start

    def add(self, event: tuple) -> None:
        cost = event[0]
        if self.exact:
            if self.cost == 0 or not self.cost + self.tolerance > cost:
                self.cost = cost
                self.ways = deque([(cost, event, [])])
            return
        joined: list[int] = []
        while self.ways and not self.ways[0][0] + self.tolerance > cost:
            more = self.ways.popleft()[2]
            joined, more = (joined, more) if len(joined) >= len(more) else (more, joined)
            joined.extend(more)
        if self.open:
            joined.append(len(self.bounds))
            self.bounds.append(cost)
            self.open = self.above + self.tolerance > cost
        if joined:
            self.ways.append((cost, event, joined))

    def record(self) -> tuple[list[float], list[int], list[dict]]:
        """(bounds, the way of each, the event each way ends with); without bounds the only way is always taken."""
        way = [0] * len(self.bounds)
        for n, (_, _, numbers) in enumerate(self.ways):
            for i in numbers:
                way[i] = n
        return self.bounds, way, [dict(zip(FIELDS, event, strict=True)) for _, event, _ in self.ways]


def composed(tolerance: float) -> Callable[[Batches], Batches]:
    """Rows of rising costs, in order by product, chunk and cost, to one record a product and chunk."""

    def compose(batches: Batches) -> Batches:
        key, chunk, done = None, None, []
        for pdf in batches:
            for tmpl, number, start, above, *event in pdf[["tmpl_id", "chunk", "start", "above", *FIELDS]].itertuples(index=False, name=None):
                if (tmpl, number) != key:
                    if chunk is not None and chunk.ways:
                        done.append((*key, first, *chunk.record()))
                    key, chunk, first = (tmpl, number), Chunk(start, above, tolerance), start
                chunk.add(tuple(event))
            if done:
                yield pd.DataFrame(done, columns=["tmpl_id", "chunk", "start", "bounds", "ways", "taken"])
                done = []
        if chunk is not None and chunk.ways:
            yield pd.DataFrame([(*key, first, *chunk.record())], columns=["tmpl_id", "chunk", "start", "bounds", "ways", "taken"])

    return compose


def followed(tolerance: float) -> Callable[[Batches], Batches]:
    """Records, in order by product and chunk, to the last event each product takes over."""

    def follow(batches: Batches) -> Batches:
        key, cost, event, done = None, 0.0, None, []
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                if r.tmpl_id != key:
                    if event is not None:
                        done.append((key, *event))
                    key, cost, event = r.tmpl_id, r.start, None
                at = bisect_left(r.bounds, True, key=lambda b: not cost + tolerance > b)  # noqa: B023
                if not len(r.bounds) or at < len(r.bounds):
                    found = r.taken[r.ways[at] if len(r.bounds) else 0]
                    event = tuple(found[f] for f in FIELDS)
                    cost = event[0]
            if done:
                yield pd.DataFrame(done, columns=["tmpl_id", *FIELDS])
                done = []
        if event is not None:
            yield pd.DataFrame([(key, *event)], columns=["tmpl_id", *FIELDS])

    return follow
