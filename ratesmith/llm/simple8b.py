"""Simple-8b word-aligned coding in numpy: a 4-bit selector and 60 bits of equal fields in each 64-bit word."""

from __future__ import annotations

import numpy as np

# Fields in a word, and bits of a field, by selector. Selector 14 is one value of up to 60 bits. Selector 15 is an
# escape: the word that follows is one value of 64 bits.
COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 1, 1])
BITS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 40, 60, 64])
ESCAPE = 15
#: Values of one sub-block, which begins a new word; its word offset is kept for decoding all sub-blocks at once.
SUB_BLOCK = 1024
_60 = np.uint64(60)


_SMALL = np.searchsorted(1 << BITS[:12], np.arange(1 << 16), "right").astype(np.uint8)


def _kind(values: np.ndarray) -> np.ndarray:
    """The first selector whose fields hold each value."""
    if not values.size or int(values.max()) < len(_SMALL):
        return _SMALL[values]
    return np.searchsorted(np.uint64(1) << BITS[:15].astype(np.uint64), values, "right").astype(np.uint8)


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words, and the word at which each sub-block begins. Sub-blocks are rows that advance side by side."""
    n = len(values)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32)
    lanes = -(-n // SUB_BLOCK)
    grid = np.zeros((lanes, SUB_BLOCK + COUNTS[0]), np.uint64)  # what stands beyond a row's end are zeros, which fit everywhere
    full = n - n % SUB_BLOCK
    grid[: full // SUB_BLOCK, :SUB_BLOCK] = values[:full].reshape(-1, SUB_BLOCK)
    if n > full:
        grid[-1, : n - full] = values[full:]
    kind = _kind(grid)
    most, reach = {1: kind}, 1  # the largest kind of the next so many values
    for c in sorted(set(COUNTS.tolist())):
        while reach < c:
            step = min(c - reach, reach)
            wide = most[reach].copy()
            np.maximum(wide[:, :-step], most[reach][:, step:], out=wide[:, :-step])
            reach += step
            most[reach] = wide
    selector = np.full(grid.shape, ESCAPE, np.uint8)
    for s in range(ESCAPE - 1, -1, -1):
        if int(most[int(COUNTS[s])][:, :SUB_BLOCK].min()) > s:
            continue  # nowhere do so many values in a row fit
        np.minimum(selector, np.where(most[int(COUNTS[s])] <= s, np.uint8(s), np.uint8(ESCAPE)), out=selector)
    stop = np.full(lanes, SUB_BLOCK)
    stop[-1] = n - (lanes - 1) * SUB_BLOCK
    lane, pos, size, steps = np.arange(lanes), np.zeros(lanes, np.int64), np.zeros(lanes, np.int64), []
    while len(lane):
        sel = selector[lane, pos]
        steps.append((lane, pos, sel, size[lane]))
        size[lane] += 1 + (sel == ESCAPE)
        pos = pos + COUNTS[sel]
        go = pos < stop[lane]
        lane, pos = lane[go], pos[go]
    offsets = np.cumsum(size) - size
    lane, pos, sel, rank = (np.concatenate(x) for x in zip(*steps, strict=True))
    out, at, flat = np.zeros(int(size.sum()), np.uint64), offsets[lane] + rank, lane * grid.shape[1] + pos
    grid = grid.ravel()
    for s in range(ESCAPE + 1):
        of = np.flatnonzero(sel == s)
        word, first = np.full(len(of), np.uint64(s) << _60, np.uint64), flat[of]
        if s == ESCAPE:
            out[at[of] + 1] = grid[first]
        else:
            for j in range(COUNTS[s]):
                word |= grid[first + j] << np.uint64(j * BITS[s])
        out[at[of]] = word
    return out, offsets.astype(np.uint32)


def decode(words: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """The n values of encode(). Words are sorted out by selector and unpacked together."""
    if not n:
        return np.zeros(0, np.uint64)
    selector = (words >> _60).astype(np.uint8)
    raw = np.zeros(len(words), bool)  # words after an escape hold no selector; an escaped value may look like one
    sub = np.searchsorted(offsets, np.arange(len(words)), "right") - 1
    for i in np.flatnonzero(selector == ESCAPE):
        if not raw[i]:
            raw[i + 1] = True
    count = np.where(raw, 1, np.where(selector == ESCAPE, 0, COUNTS[selector]))
    total = np.cumsum(count) - count
    first = total - total[offsets][sub]  # before the word, in its sub-block
    size = np.minimum(SUB_BLOCK, n - sub * SUB_BLOCK)
    start = sub * SUB_BLOCK + first
    count = np.minimum(count, size - first)
    out = np.zeros(n, np.uint64)
    out[start[raw]] = words[raw]
    for s in range(ESCAPE):
        of = np.flatnonzero((selector == s) & ~raw)
        mask = np.uint64((1 << int(BITS[s])) - 1)
        for j in range(COUNTS[s]):
            own = of[count[of] > j]
            out[start[own] + j] = words[own] >> np.uint64(j * BITS[s]) & mask
    return out
