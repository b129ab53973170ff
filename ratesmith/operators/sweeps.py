"""Spread of the rates that are near enough in time, for questions and rates of many buckets in the order of days."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter, deque
from collections.abc import Callable, Iterator
from math import inf, nextafter

import pyarrow as pa

from ratesmith.functions.text import WHITE_SPACE

SPREAD = "_s1 long, _s2 long, _at long, n long, payer_min double, payer_median double, payer_max double, networks array<string>, near_plan string, near_day long, near_product string"
_SCHEMA = pa.schema([
    ("_s1", pa.int64()), ("_s2", pa.int64()), ("_at", pa.int64()), ("n", pa.int64()), ("payer_min", pa.float64()), ("payer_median", pa.float64()), ("payer_max", pa.float64()),
    ("networks", pa.list_(pa.string())), ("near_plan", pa.string()), ("near_day", pa.int64()), ("near_product", pa.string()),
])
#: Entries of a block of the ordered window, before it is split.
_BLOCK = 2000


class _Window:
    """Rates in order, (rate, plan, day, ...) tuples, in blocks: entering and leaving move one block's entries."""

    def __init__(self) -> None:
        self.blocks: list[list[tuple]] = [[]]
        self.lasts: list[tuple] = []  # of each block but the last one
        self.n = 0

    def add(self, x: tuple) -> None:
        i = bisect_left(self.lasts, x)
        block = self.blocks[i]
        insort(block, x)
        self.n += 1
        if len(block) > _BLOCK:
            self.blocks[i : i + 1] = [block[: _BLOCK // 2], block[_BLOCK // 2 :]]
            self.lasts.insert(i, self.blocks[i][-1])

    def remove(self, x: tuple) -> None:
        i, j = self._place(x)
        block = self.blocks[i]
        del block[j]
        self.n -= 1
        if not block and len(self.blocks) > 1:
            del self.blocks[i]
            del self.lasts[min(i, len(self.lasts) - 1)]

    def _place(self, x: tuple) -> tuple[int, int]:
        """Block and place of the first entry that isn't less than x; the last block's end if there is none."""
        i = bisect_left(self.lasts, x)
        j = bisect_left(self.blocks[i], x)
        if j == len(self.blocks[i]) and i + 1 < len(self.blocks):  # a block's last entry may have left; no block but the last is empty
            return i + 1, 0
        return i, j

    def at(self, place: int) -> tuple:
        for block in self.blocks:
            if place < len(block):
                return block[place]
            place -= len(block)
        raise IndexError

    def first(self, x: tuple) -> tuple | None:
        """The first entry that isn't less than x."""
        i, j = self._place(x)
        return self.blocks[i][j] if j < len(self.blocks[i]) else None

    def first_over(self, rate: float) -> tuple | None:
        x = self.first((nextafter(rate, inf),))
        return x if x is not None and x[0] > rate else None

    def last_below(self, x: tuple) -> tuple | None:
        i, j = self._place(x)
        return self.blocks[i][j - 1] if j else self.blocks[i - 1][-1] if i else None


def _median(window: _Window) -> tuple[float, tuple, tuple]:
    """The median and the entries on both sides of it."""
    at = window.at if len(window.blocks) > 1 else window.blocks[0].__getitem__
    low = at((window.n - 1) // 2)
    high = low if window.n % 2 else at(window.n // 2)
    return (low[-1] if low[0] == high[0] else 0.5 * low[-1] + 0.5 * high[-1]), low, high


def _nearest(window: _Window, median: float, low: tuple, high: tuple) -> tuple:
    """The entry nearest to the median; of ties the first by plan, rate and day. Of one rate's entries the first is the one."""

    def far(x: tuple) -> float:
        d = abs(x[-1] - median)
        return inf if d != d else d

    if len(window.blocks) == 1:
        block = window.blocks[0]
        i, over = bisect_left(block, (low[0],)), bisect_left(block, (nextafter(high[0], inf),)) if high[0] < inf else len(block)
        least = far(low) if high[0] == low[0] else min(far(low), far(high))
        if (i == 0 or far(block[i - 1]) > least) and (over == len(block) or far(block[over]) > least):  # no other rate is as near
            return block[i] if high[0] == low[0] else min((block[i], high), key=lambda x: (far(x), x[1], x[0], x[2:]))
    found = [window.first((low[0],))]
    if high[0] != low[0]:
        found.append(window.first((high[0],)))
    least = min(map(far, found))
    below, over = window.last_below((low[0],)), window.first_over(high[0])
    while below is not None and far(below) <= least:  # other rates are as near only where doubles can't tell
        found.append(window.first((below[0],)))
        below = window.last_below((below[0],))
    while over is not None and far(over) <= least:
        found.append(over)
        over = window.first_over(over[0])
    return min(found, key=lambda x: (far(x), x[1], x[0], x[2:]))


def spreads(days: int, always: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows in the order of bucket, day and kind, rates before questions: a rate enters on its day and leaves once a question's day is
    over 2 * days later, one that enters at `always` stays. A question gets the spread of the rates that are there, as others of its day do."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last1, last2, day_of, window, leaving, networks, named, answer = None, None, None, _Window(), deque(), Counter(), None, None
        for batch in batches:
            out = []
            for b1, b2, at, asks, s1, s2, rate, plan, day, product in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if b1 != last1 or b2 != last2:
                    last1, last2, day_of, window, leaving, networks, named = b1, b2, None, _Window(), deque(), Counter(), None
                if not asks:
                    entry = (rate if rate == rate else inf, plan or "", -inf if day is None else day, plan is not None, product or "", product is not None, rate)
                    network = plan if plan and plan.strip(WHITE_SPACE) else None
                    window.add(entry)
                    if at != always:
                        leaving.append((at, entry, network))
                    if network is not None:
                        networks[network] += 1
                        named = named if networks[network] > 1 else None
                    continue
                if at != day_of:
                    day_of = at
                    while leaving and leaving[0][0] < at - 2 * days:
                        _, entry, network = leaving.popleft()
                        window.remove(entry)
                        if network is not None:
                            networks[network] -= 1
                            if not networks[network]:
                                del networks[network]
                                named = None
                    if window.n:
                        named = sorted(networks) if named is None else named
                        median, low, high = _median(window)
                        near = _nearest(window, median, low, high)
                        answer = (window.n, window.at(0)[-1], median, window.at(window.n - 1)[-1], named, near[1] if near[3] else None, None if near[2] == -inf else near[2], near[4] if near[5] else None)
                if window.n:
                    out.append((s1, s2, at, *answer))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA)

    return run
