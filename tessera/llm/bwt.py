"""Threshold-bounded interval expansion: common-prefix values by breadth-first backward extension on a
Burrows-Wheeler transform, in increasing order, stopping at a minimum length."""

from __future__ import annotations

import numpy as np

#: Ends every string. No UTF-8 text has this byte.
END = 0xFF


def suffix_order(x: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of the bytes ``x`` in the order of their first ``depth`` bytes at least, by prefix doubling."""
    n = len(x)
    key = np.zeros(n, np.uint64)
    padded = np.concatenate([x, np.full(8, END, np.uint8)])
    for j in range(8):
        key <<= np.uint64(8)
        key |= padded[j : j + n]
    have = 8
    while True:
        order = np.argsort(key, kind="quicksort")
        if have >= min(depth, n):
            return order
        ordered = key[order]
        step = np.empty(n, np.uint64)
        step[0] = 1
        step[1:] = ordered[1:] != ordered[:-1]
        rank = np.empty(n, np.uint64)
        rank[order] = np.cumsum(step)
        if int(rank[order[-1]]) == n:
            return order
        key = rank << np.uint64(32)
        key[: n - have] |= rank[have:]  # a suffix that ends sooner has rank 0 there, the end of all strings
        have *= 2


def short_prefixes(x: np.ndarray, order: np.ndarray, least: int) -> np.ndarray:
    """For each place i > 0 of ``order``: is the common prefix of suffixes i-1 and i known to be under ``least``?

    An interval is the block of suffixes that begin with a string. All intervals of one length are extended backwards by
    each byte before them, which gives the intervals of the next length. An interval's right end is a place where the
    common prefix is one shorter than its string, if no shorter string ended there; only such intervals are extended
    again, so each place is set once, in increasing order of its value. Strings with an end mark are not followed: the
    answer is meant for places whose two suffixes have ``least`` bytes before the next mark.
    """
    n = len(x)
    last = x[order - 1]  # the byte before each suffix; the first suffix is preceded by the final mark
    grouped = np.argsort(last, kind="stable")
    leap = np.empty(n, np.int64)  # where the suffix one byte longer stands
    leap[grouped] = np.arange(n)
    same = last[grouped[1:]] == last[grouped[:-1]]
    before = np.full(n, -1, np.int64)  # the previous and the next place with the same byte before it
    before[grouped[1:][same]] = grouped[:-1][same]
    after = np.full(n, n, np.int64)
    after[grouped[:-1][same]] = grouped[1:][same]
    follow = last != END
    known = np.zeros(n + 1, bool)
    lo, hi = np.zeros(1, np.int64), np.full(1, n - 1, np.int64)
    for _ in range(least):
        one = lo == hi
        at = lo[one]
        at = leap[at[follow[at]]]
        lows, highs = [at], [at]
        if not one.all():
            a, b = lo[~one], hi[~one]
            size = b - a + 1
            ends = np.cumsum(size)
            place = np.arange(ends[-1]) + np.repeat(a - (ends - size), size)
            low, high = np.repeat(a, size), np.repeat(b, size)
            usable = follow[place]
            first = place[usable & (before[place] < low)]
            final = place[usable & (after[place] > high)]
            # both lists have one place for each interval and byte, and a byte's places leap to one ascending block
            owner_f = np.searchsorted(a, first, "right")
            owner_l = np.searchsorted(a, final, "right")
            f, g = np.lexsort((last[first], owner_f)), np.lexsort((last[final], owner_l))
            lows.append(leap[first[f]])
            highs.append(leap[final[g]])
        lo, hi = np.concatenate(lows), np.concatenate(highs)
        new = ~known[hi + 1]
        lo, hi = lo[new], hi[new]
        if not len(lo):
            break
        known[hi + 1] = True
        by = np.argsort(lo)
        lo, hi = lo[by], hi[by]
    return known[:n]


def repeated_starts(x: np.ndarray, least: int) -> np.ndarray:
    """For each byte of ``x``, strings that each end in a mark: does a run of ``least`` bytes without a mark start there
    that also starts elsewhere?"""
    n = len(x)
    out = np.zeros(n, bool)
    if n < 2:
        return out
    order = suffix_order(x, least)
    marks = np.flatnonzero(x == END)
    room = marks[np.searchsorted(marks, np.arange(n))] - np.arange(n)  # bytes before the next mark
    whole = room[order] >= least
    shared = np.zeros(n, bool)
    shared[1:] = whole[1:] & whole[:-1] & ~short_prefixes(x, order, least)[1:]
    hit = shared.copy()
    hit[:-1] |= shared[1:]
    out[order[hit]] = True
    return out
