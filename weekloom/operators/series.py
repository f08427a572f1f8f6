"""Refined series as one row each: gaps filled, high outliers capped, demand class, from the weeks with sales.

Spark brings the weeks of a series together and in order; a task then treats many whole series at once, from flat columns. Empty weeks are in no window's positives and
enter the class only by their number, so thresholds are worked out for the weeks with sales alone. The rules and the order of additions are those of
``demand.capped_values`` and ``demand.with_demand_type`` on the filled panel.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F, types as T

from weekloom.operators import demand as D

ROWS_AT_ONCE = 100_000
SCHEMA = "unique_id string, demand_type string, weeks array<date>, values array<bigint>, last_ds date, n int"


def in_runs(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows of a group one after the other in ``order``, numbered from 1 by ``_i``: what ``whole_groups`` reads. Rows that are dealt by
    the keys already are not exchanged again, and rows that lie in order cost one comparison each. Only a group's first row has its keys."""
    placed = rows.withColumn("_i", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return placed.withColumns({k: F.when(F.col("_i") == 1, F.col(k)) for k in keys})


def whole_groups(batches: Iterator) -> Iterator:
    """The rows of ``in_runs`` in Arrow batches of whole groups, with the places where the groups begin."""
    import pyarrow as pa

    held, size, enough = [], 0, ROWS_AT_ONCE
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size < enough:
            continue
        joined = pa.concat_batches(held)
        begin = np.flatnonzero(joined.column("_i").to_numpy() == 1)
        cut = int(begin[-1])
        if cut:
            yield joined.slice(0, cut), begin[:-1]
        held, size = [joined.slice(cut)], joined.num_rows - cut
        enough = max(ROWS_AT_ONCE, 2 * size)  # a longer group is not joined anew with every batch
    if size:
        joined = pa.concat_batches(held)
        yield joined, np.flatnonzero(joined.column("_i").to_numpy() == 1)


def moments(series: np.ndarray, y: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Count, sum and squared deviations from the mean of the values of each of ``n`` series (rows lie by series), added up one by one as Spark does."""
    count = np.bincount(series, minlength=n)
    start = np.cumsum(count) - count
    total = np.bincount(series, y, minlength=n)
    mean, square = np.zeros(n), np.zeros(n)
    longest_first = np.argsort(-count, kind="stable")
    lasting = np.searchsorted(-count[longest_first], -np.arange(count.max(initial=0)))
    for t, k in enumerate(lasting):  # running moments, all series side by side
        rows = longest_first[:k]
        off = y[start[rows] + t] - mean[rows]
        mean[rows] += off / (t + 1)
        square[rows] += off * (off - off / (t + 1))
    return count, total, square


def _middle(ascending: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Median of the first ``k`` values of each row."""
    at = np.arange(len(k))
    return (ascending[at, (k - 1) // 2] + ascending[at, k // 2]) / 2.0


def capped(series: np.ndarray, place: np.ndarray, y: np.ndarray, window: int = D.OUTLIER_WINDOW, cut: float = D.OUTLIER_CUT) -> np.ndarray:
    """Positive values with those above median + cut * deviation of their window moved there; rows lie by series and place."""
    half = window // 2
    at = series * (place.max(initial=0) + 2 * window) + place
    low, high = np.searchsorted(at, at - half), np.searchsorted(at, at + half, "right")
    out, k = y.copy(), high - low
    rows = np.flatnonzero((np.bincount(series)[series] >= window) & (k >= D.MIN_POSITIVE_IN_WINDOW)) if len(y) else np.empty(0, int)
    k, reach = k[rows], np.arange(window)
    inside = reach < k[:, None]
    near = np.where(inside, y[np.minimum(low[rows, None] + reach, max(len(y) - 1, 0))].astype(float), np.inf)
    median = _middle(np.sort(near, axis=1), k)
    above = np.flatnonzero(y[rows] > median)
    rows, k, median = rows[above], k[above], median[above]
    away = np.where(inside[above], np.abs(near[above] - median[:, None]), np.inf)
    upper = median + cut * (D.MAD_SCALE * _middle(np.sort(away, axis=1), k))
    beyond = y[rows] > upper
    out[rows[beyond]] = upper[beyond].astype(np.int64)
    return out


def classes(n: np.ndarray, series: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Class per series from its number of weeks and its positive values (rows lie by series)."""
    count, total, square = moments(series, y, len(n))
    sold = np.maximum(count, 1)
    variation = np.where(count > 0, np.sqrt(square / sold) / np.where(count > 0, total / sold, 1.0), 0.0) ** 2
    steady, often = variation < D.CV2_LIMIT, n / sold < D.ADI_LIMIT
    kind = np.where(often, np.where(steady, "smooth", "erratic"), np.where(steady, "intermittent", "lumpy"))
    return np.where(count == 0, "lumpy", kind)


def _treated(batches: Iterator) -> Iterator:
    import pyarrow as pa

    for batch, begin in whole_groups(batches):
        size = np.diff(np.append(begin, batch.num_rows))
        ds, y = batch.column("ds"), batch.column("y")
        dated, known = ds.is_valid().to_numpy(zero_copy_only=False), y.is_valid().to_numpy(zero_copy_only=False)
        day = ds.cast(pa.int32()).fill_null(0).to_numpy().astype(np.int64)
        value = y.fill_null(0).to_numpy().astype(np.int64)
        series = np.repeat(np.arange(len(size)), size)
        # as in ``panel.fill_weeks``: weeks to the next row; a second row of one date emits the week before it, too
        gap = np.ones(len(day), np.int64)
        follows = (series[1:] == series[:-1]) & dated[1:] & dated[:-1]
        gap[:-1][follows] = (day[1:] - day[:-1])[follows] // 7
        twice = (gap == 0).astype(np.int64)
        filled = np.maximum(gap, 1)
        end = np.cumsum(filled + twice)
        place = end - filled  # in all filled rows of the batch
        n = np.bincount(series, filled + twice, minlength=len(size)).astype(np.int64)
        first = np.cumsum(n) - n
        sold = np.flatnonzero(known & (value > 0))
        value[sold] = capped(series[sold], place[sold] - first[series[sold]], value[sold])
        kind = classes(n, series[sold][value[sold] > 0], value[sold][value[sold] > 0])

        source = np.repeat(np.arange(len(day)), filled + twice)
        step = np.arange(len(source)) - place[source]  # -1 in the week before a second row
        days, there = day[source] + 7 * step, dated[source]
        values = np.where(step == 0, value[source], 0)
        given = np.where(step == 0, known[source], True)
        if twice.any():
            order = np.lexsort((days, there, series[source]))
            days, there, values, given = days[order], there[order], values[order], given[order]
        offsets = pa.array(np.append(first, len(source)).astype(np.int32))
        # nulls come first, so the last date is in the last row
        yield pa.RecordBatch.from_arrays([
            batch.column("unique_id").take(pa.array(begin)), pa.array(kind.tolist(), pa.string()),
            pa.ListArray.from_arrays(offsets, pa.array(days.astype(np.int32), mask=~there).cast(pa.date32())),
            pa.ListArray.from_arrays(offsets, pa.array(values, mask=~given)),
            ds.take(pa.array(begin + size - 1)), pa.array(n.astype(np.int32))], names=["unique_id", "demand_type", "weeks", "values", "last_ds", "n"])


def refined(weekly: DataFrame) -> DataFrame:
    """``SCHEMA`` from the weekly rows (``unique_id, ds, y``, gaps not filled), both arrays in week order; a series has as many weeks as the calendar."""
    # rows of one date stay in the order in which a window over the series has them
    return in_runs(weekly.select("unique_id", "ds", "y"), ["unique_id"], ["ds"]).mapInArrow(_treated, SCHEMA)


def _doubles(column) -> np.ndarray:
    """A numeric Arrow column as doubles, NaN for null."""
    import pyarrow as pa

    return column.cast(pa.float64(), safe=False).to_numpy(zero_copy_only=False)


def packed(panel: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per group: ``keys``, ``last_ds``, ``ys`` by week (then value) and length ``n``, from rows with ``ds`` and ``y``."""
    def lists(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch, begin in whole_groups(batches):
            ends = np.append(begin, batch.num_rows)
            first, last = pa.array(begin), pa.array(ends[1:] - 1)
            yield pa.RecordBatch.from_arrays([
                *[batch.column(k).take(first) for k in keys],
                batch.column("ds").take(last),  # nulls come first
                pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), batch.column("y")),
                pa.array(np.diff(ends).astype(np.int32))], names=[*keys, "last_ds", "ys", "n"])

    rows = in_runs(panel.select(*keys, "ds", F.col("y").cast("double").alias("y")), keys, ["ds", "y"])
    schema = T.StructType([*[rows.schema[k] for k in keys], T.StructField("last_ds", rows.schema["ds"].dataType),
                           T.StructField("ys", T.ArrayType(T.DoubleType())), T.StructField("n", T.IntegerType())])
    return rows.mapInArrow(lists, schema)


def spread_statistics(rows: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float]) -> DataFrame:
    """Mean, sample deviation (0 for a single value) and interpolated quantiles of the known values of each group: ``keys, mean, deviation, quantiles``."""
    def found(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch, begin in whole_groups(batches):
            column = batch.column(value)
            known = column.is_valid().to_numpy(zero_copy_only=False)
            group = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, batch.num_rows)))[known]
            y = _doubles(column)[known]
            count, total, square = moments(group, y, len(begin))
            some = count > 0
            mean = total / np.maximum(count, 1)
            deviation = np.sqrt(square / np.maximum(count - 1, 1))
            ascending = np.append(y[np.lexsort((y, group))], 0.0)
            start = np.cumsum(count) - count
            cuts = []
            for p in probs:
                place = p * np.maximum(count - 1, 0)
                low, high = np.floor(place), np.ceil(place)
                a, b = ascending[start + low.astype(int)], ascending[start + high.astype(int)]
                cuts.append(np.where(low == high, a, (high - place) * a + (place - low) * b))
            flat = pa.array(np.stack(cuts, axis=1).ravel(), mask=np.repeat(~some, len(probs)))
            offsets = pa.array((np.arange(len(begin) + 1) * len(probs)).astype(np.int32))
            yield pa.RecordBatch.from_arrays([
                *[batch.column(k).take(pa.array(begin)) for k in keys], pa.array(mean, mask=~some),
                pa.array(np.where(count > 1, deviation, 0.0)), pa.ListArray.from_arrays(offsets, flat)],
                names=[*keys, "mean", "deviation", "quantiles"])

    # any order serves: the one by the keys leaves rows that lie by series where they are
    placed = in_runs(rows.select(*keys, value), keys, list(keys))
    schema = T.StructType([*[placed.schema[k] for k in keys], T.StructField("mean", T.DoubleType()), T.StructField("deviation", T.DoubleType()),
                           T.StructField("quantiles", T.ArrayType(T.DoubleType()))])
    return placed.mapInArrow(found, schema)
