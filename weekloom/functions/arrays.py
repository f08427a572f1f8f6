"""Expressions over one short array per row (a window frame or one packed series).

A packed series has one element per week, so its length is bounded by the calendar and not
by the number of sales rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` worked out once.

    A column used inside a lambda may be inlined there by the optimizer and then be evaluated per
    element, and conditional branches do not share subexpressions; a lambda variable avoids both.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def let_all(body: Callable[..., Column], **values: Column) -> Column:
    """``let`` for several named values at once."""
    packed = F.struct(*[v.alias(k) for k, v in values.items()])
    return let(packed, lambda s: body(**{k: s[k] for k in values}))


def median_of_sorted(arr: Column) -> Column:
    """Median of an ascending, non-empty array (mean of the two middle values)."""
    n = F.size(arr)
    return (
        F.element_at(arr, F.floor((n + 1) / 2).cast("int"))
        + F.element_at(arr, (F.floor(n / 2) + 1).cast("int"))
    ) / 2.0


def median(arr: Column) -> Column:
    """Median of a non-empty array; NULL for a NULL array."""
    return let(F.sort_array(arr), median_of_sorted)


def absolute_deviations(arr: Column, centre: Column) -> Column:
    return F.transform(arr, lambda v: F.abs(v - centre))


def array_total(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda acc, v: acc + v)


def array_mean(arr: Column) -> Column:
    return F.when(F.size(arr) > 0, array_total(arr) / F.size(arr))


def tail_from(arr: Column, skip: Column) -> Column:
    """Elements after the first ``skip`` ones."""
    return F.slice(arr, (skip + 1).cast("int"), F.greatest(F.size(arr) - skip, F.lit(0)).cast("int"))


def smoothed_level(arr: Column, alpha: float) -> Column:
    """Last level of exponential smoothing started at the first element; NULL if empty."""
    def level(values: Column) -> Column:
        return F.aggregate(
            tail_from(values, F.lit(1)), F.try_element_at(values, F.lit(1)),
            lambda lvl, v: F.lit(alpha) * v + F.lit(1.0 - alpha) * lvl)

    return let(arr, level)


def grid_smoothed_level(arr: Column, alphas: Sequence[float]) -> Column:
    """Last level under the alpha with the smallest one-step squared error (first alpha on ties).

    All alphas advance together in one fold, so the array is read once.
    """
    ids = range(len(alphas))

    def step(acc: Column, v: Column) -> Column:
        return F.struct(
            *[(F.lit(a) * v + F.lit(1.0 - a) * acc[f"l{i}"]).alias(f"l{i}") for i, a in enumerate(alphas)],
            *[(acc[f"e{i}"] + (v - acc[f"l{i}"]) * (v - acc[f"l{i}"])).alias(f"e{i}") for i in ids],
        )

    def best(acc: Column) -> Column:
        ranked = F.array_min(F.array(*[
            F.struct(acc[f"e{i}"].alias("e"), F.lit(i).alias("i"), acc[f"l{i}"].alias("l")) for i in ids]))
        return ranked["l"]

    def fold(values: Column) -> Column:
        first = F.try_element_at(values, F.lit(1))
        start = F.struct(*[first.alias(f"l{i}") for i in ids], *[F.lit(0.0).alias(f"e{i}") for i in ids])
        return F.aggregate(tail_from(values, F.lit(1)), start, step, best)

    return let(arr, fold)


def bucket_sums(arr: Column, length: Column) -> Column:
    """Sums of consecutive buckets of ``length``; the oldest incomplete bucket is dropped.

    Elements are read by position: ``slice`` copies the whole array on every call.
    """
    def sums(values: Column, size: Column) -> Column:
        skip = F.size(values) % size
        starts = F.when(
            F.size(values) >= size, F.sequence(skip + 1, F.size(values) - size + 1, size)
        ).otherwise(F.array().cast("array<int>"))
        bucket = F.transform(starts, lambda i: F.aggregate(
            F.sequence(i, i + size - 1), F.lit(0.0), lambda acc, k: acc + F.element_at(values, k)))
        return F.when(size == 1, values).otherwise(bucket)

    return let_all(sums, values=arr, size=length)
