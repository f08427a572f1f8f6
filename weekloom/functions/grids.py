"""Smoothing over a grid of constants for many short series side by side.

A batch is a left-aligned table of values with the length of each row. A recursion steps through the weeks once, for all rows and all constants
together; each row sees the same operations in the same order as alone.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np


def over_lists(work: Callable[[np.ndarray, np.ndarray], np.ndarray], lists, several: bool = False):
    """``work`` over an Arrow array of lists: NULL and empty lists, and NaN results, give NULL. ``several``: ``work`` gives a list for each row."""
    import pyarrow as pa
    import pyarrow.compute as pc

    size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    rows = np.flatnonzero(size)
    n = size[rows]
    values = np.zeros((len(rows), n.max(initial=0)))
    # NULL lists may still own values, flatten leaves them out
    values[np.arange(values.shape[1]) < n[:, None]] = lists.flatten().to_numpy(zero_copy_only=False).astype(float)
    made = work(values, n) if len(rows) else np.empty((0, 0) if several else 0)
    if made.ndim == 1:
        out = np.full(len(size), np.nan)
        out[rows] = made
        return pa.array(out, mask=np.isnan(out))
    width = np.zeros(len(size), np.int64)
    width[rows] = made.shape[1]
    flat = pa.array(made.ravel(), mask=np.isnan(made.ravel()))
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(width)).astype(np.int32)), flat, mask=pa.array(width == 0))


def _longest_first(values: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row order, values by week, and how many rows reach each week, rows sorted by falling length."""
    order = np.argsort(-n, kind="stable")
    reach = np.searchsorted(-n[order], -np.arange(values.shape[1]), "left")
    return order, np.ascontiguousarray(values[order].T), reach


def best_level(values: np.ndarray, n: np.ndarray, alphas: Sequence[float]) -> np.ndarray:
    """Last level of each row under the alpha with the smallest one-step squared error (first alpha on ties); NaN if empty."""
    if not values.shape[1]:
        return np.full(len(n), np.nan)
    order, by_week, reach = _longest_first(values, n)
    a = np.array(alphas)[:, None]
    b = np.array([1.0 - v for v in alphas])[:, None]
    level, error = np.repeat(by_week[:1], len(alphas), axis=0), np.zeros((len(alphas), len(n)))
    for t in range(1, len(by_week)):
        m, v = reach[t], by_week[t]
        off = v[:m] - level[:, :m]
        error[:, :m] += off * off
        level[:, :m] = a * v[:m] + b * level[:, :m]
    out = np.empty(len(n))
    out[order] = level[error.argmin(axis=0), np.arange(len(n))]
    out[n == 0] = np.nan
    return out


def best_line(values: np.ndarray, n: np.ndarray, pairs: Sequence[tuple[float, float]], h: int) -> np.ndarray:
    """``h`` weeks ahead by level and trend of the pair (alpha, beta) with the smallest squared error (first pair on ties)."""
    order, by_week, reach = _longest_first(values, n)
    a, b = (np.array(c)[:, None] for c in zip(*pairs))
    level = np.repeat(by_week[:1], len(pairs), axis=0)
    trend, error = np.zeros_like(level), np.zeros_like(level)
    for t in range(1, len(by_week)):
        m, v = reach[t], by_week[t]
        before = level[:, :m]
        guess = before + trend[:, :m]
        now = a * v[:m] + (1 - a) * guess
        trend[:, :m] = b * (now - before) + (1 - b) * trend[:, :m]
        error[:, :m] += (v[:m] - guess) * (v[:m] - guess)
        level[:, :m] = now
    best, rows = error.argmin(axis=0), np.arange(len(n))
    out = np.empty((len(n), h))
    out[order] = level[best, rows][:, None] + trend[best, rows][:, None] * np.arange(1, h + 1)
    return out


def sales(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positive values of each row, the weeks between them (the first from the start), and their number."""
    row, week = np.nonzero(values > 0)
    count = np.bincount(row, minlength=len(values))
    place = np.arange(len(row)) - (np.cumsum(count) - count)[row]
    shape = (len(values), count.max(initial=0))
    sold, gaps = np.zeros(shape), np.zeros(shape)
    sold[row, place] = values[row, week]
    before = np.where(place > 0, np.roll(week, 1), -1)
    gaps[row, place] = week - before
    return sold, gaps, count


def bucket_rate(values: np.ndarray, n: np.ndarray, alphas: Sequence[float], shorter: bool) -> np.ndarray:
    """Weekly rate from the smoothed sums of buckets as long as the mean interval, or the mean over all lengths up to it (``shorter``).

    The oldest incomplete bucket is dropped; 0 for a row without sales.
    """
    positive = values > 0
    count = positive.sum(axis=1)
    last = np.where(count > 0, values.shape[1] - positive[:, ::-1].argmax(axis=1), 1)
    length = np.maximum(np.rint(last / np.maximum(count, 1)).astype(np.int64), 1)
    total = np.zeros(len(n))
    for size in range(1, length.max(initial=0) + 1):
        rows = np.flatnonzero((count > 0) & ((length >= size) if shorter else (length == size)))
        if len(rows):
            made = n[rows] // size
            at = (n[rows] % size)[:, None] + np.arange(made.max() * size)
            sums = np.take_along_axis(values[rows], np.minimum(at, values.shape[1] - 1), axis=1).reshape(len(rows), -1, size).sum(axis=2)
            total[rows] += best_level(sums, made, alphas) / size
    return np.where(count > 0, total / (length if shorter else 1), 0.0)
