"""Aggregates over sliding frames of an ordered column, for all rows at once.

A frame is a range of positions. Sums and moments are put together from blocks whose length is a
power of two, so nothing is subtracted and nothing cancels; extremes are the larger of two
overlapping blocks; medians descend a wavelet matrix of ranks. Each takes n log n steps of numpy,
whatever the frames' lengths are, and memory for a few columns.

NaN is missing. Infinities are missing for all aggregates but the count.
"""

from __future__ import annotations

import numpy as np


def frame_bounds(us: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted times: for each the positions of [time - width, time)."""
    return np.searchsorted(us, us - width, "left"), np.searchsorted(us, us, "left")


def block_sums(x: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The sum of x[low:high] for each frame."""
    length, at, out, level, step = high - low, low.copy(), np.zeros(len(low)), x.astype(float), 1
    longest = int(length.max(initial=0))
    while step <= longest:
        some = np.flatnonzero(length & step)
        out[some] += level[at[some]]
        at[some] += step
        level = level[:-step] + level[step:]
        step *= 2
    return out


def block_moments(x: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean, and sum of squared distances from it, of x[low:high] for each frame."""
    length, at, step = high - low, low.copy(), 1
    n, mean, spread = np.zeros(len(low)), np.zeros(len(low)), np.zeros(len(low))
    level_mean, level_spread = x.astype(float), np.zeros(len(x))
    longest = int(length.max(initial=0))
    while step <= longest:
        some = np.flatnonzero(length & step)
        off, total = level_mean[at[some]] - mean[some], n[some] + step
        spread[some] += level_spread[at[some]] + off * off * n[some] * step / total
        mean[some] += off * step / total
        n[some] = total
        at[some] += step
        off = level_mean[step:] - level_mean[:-step]
        level_spread = level_spread[:-step] + level_spread[step:] + off * off * (step / 2)
        level_mean = level_mean[:-step] + off / 2
        step *= 2
    return mean, spread


def block_extremes(x: np.ndarray, low: np.ndarray, high: np.ndarray, larger: bool) -> np.ndarray:
    """The largest (smallest) of x[low:high] for each frame; NaN for an empty one."""
    pick = np.maximum if larger else np.minimum
    length, out, level, step = high - low, np.full(len(low), np.nan), x, 1
    longest = int(length.max(initial=0))
    while step <= longest:
        some = np.flatnonzero((length >= step) & (length < 2 * step))
        out[some] = pick(level[low[some]], level[high[some] - step])
        level = pick(level[:-step], level[step:])
        step *= 2
    return out


def kth_smallest(x: np.ndarray, low: np.ndarray, high: np.ndarray, k: np.ndarray) -> np.ndarray:
    """The k-th smallest (from 0) of x[low:high] for each frame, none of which is empty.

    Ranks are read from their highest bit; at each bit those with 0 come before those with 1, and a frame
    goes on as the part of it in which the k-th smallest is.
    """
    values, rank = np.unique(x, return_inverse=True)
    low, high, k, found = low.copy(), high.copy(), k.copy(), np.zeros(len(low), np.int64)
    for bit in reversed(range(max(1, (len(values) - 1).bit_length()))):
        ones = (rank >> bit) & 1 == 1
        zeros = np.concatenate(([0], np.cumsum(~ones)))
        to_low, to_high = zeros[low], zeros[high]
        up = k >= to_high - to_low
        found |= up.astype(np.int64) << bit
        k = np.where(up, k - (to_high - to_low), k)
        low, high = np.where(up, zeros[-1] + low - to_low, to_low), np.where(up, zeros[-1] + high - to_high, to_high)
        rank = np.concatenate((rank[~ones], rank[ones]))
    return values[found]


def medians(x: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    out, n = np.full(len(low), np.nan), high - low
    some = np.flatnonzero(n)
    if len(some):
        below = kth_smallest(x, low[some], high[some], (n[some] - 1) // 2)
        above = kth_smallest(x, low[some], high[some], n[some] // 2)
        out[some] = below + (above - below) * 0.5
    return out


def over_frames(v: np.ndarray, low: np.ndarray, high: np.ndarray, agg: str) -> np.ndarray:
    """One aggregate of v[low:high] for each frame; NaN where there is none."""
    kept = ~np.isnan(v) if agg == "count" else np.isfinite(v)
    before = np.concatenate(([0], np.cumsum(kept)))
    a, b, x = before[low], before[high], v[kept]
    n = (b - a).astype(float)
    none = np.nan
    if agg == "count":
        return np.where(high > low, n, none)
    if agg == "median":
        return medians(x, a, b)
    if agg in ("max", "min"):
        return block_extremes(x, a, b, agg == "max")
    if agg == "std":
        _, spread = block_moments(x, a, b)
        return np.where(n > 1, np.sqrt(spread / np.maximum(n - 1, 1)), none)
    total = block_sums(x, a, b)
    return np.where(n > 0, total if agg == "sum" else total / np.maximum(n, 1), none)


def rolled(us: np.ndarray, asked: list[tuple[np.ndarray, int, str]]) -> list[np.ndarray]:
    """For (values, width, aggregate) each the aggregate over [time - width, time), in the rows' own order."""
    order = np.argsort(us, kind="stable")
    times, bounds, out = us[order], {}, []
    for values, width, agg in asked:
        if width not in bounds:
            bounds[width] = frame_bounds(times, width)
        found = np.empty(len(us))
        found[order] = over_frames(values[order], *bounds[width], agg)
        out.append(found)
    return out
