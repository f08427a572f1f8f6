"""Linear quantile regression over feature columns by iteratively reweighted normal equations.

Each step majorises the check loss of every quantile at its present residuals by a parabola (Hunter and Lange), whose minimum solves d x d normal
equations. The rows are written once as packed blocks of doubles, which are deleted after the fit; a step is one pass that adds up the equations' sums by task, so that only d x d
numbers a quantile reach the driver, which solves them. The loss never rises from step to step, so a fit that starts from a known rule
ends no worse than that rule on its rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from weekloom.session import pin, unpin

STEPS = 20
SHARPNESS = 1e-3  # residuals below this share of the mean absolute residual count as that size
BLOCK, BLOCKS_AT_ONCE = 32768, 2  # numbers in one written value; values that a task has unpacked at a time, few enough for a core's cache
CODEC = "zstd"
RIDGE = 1e-2  # pull towards the start, as a share of the sum of weights


@dataclass(frozen=True)
class QuantileFit:
    """Coefficients per quantile over features in units of their spread, and the mean loss before and after."""

    features: tuple[str, ...]
    spread: tuple[float, ...]
    weights: dict[str, tuple[float, ...]]
    loss_before: dict[str, float]
    loss_after: dict[str, float]

    def predicted(self, name: str) -> Column:
        """The quantile as a column over the feature columns."""
        slopes = [w / s for w, s in zip(self.weights[name], self.spread)]
        return sum((F.lit(w) * F.col(f) for w, f in zip(slopes, self.features)), F.lit(0.0))

    def ordered(self, scale: Column | float = 1.0) -> dict[str, Column]:
        """All quantiles, rearranged so that they never cross."""
        sorted_values = F.array_sort(F.array(*[self.predicted(q) for q in self.weights]))
        return {q: sorted_values[i] * scale for i, q in enumerate(self.weights)}


def _blocks(vectors: DataFrame, width: int) -> DataFrame:
    """The rows of ``x, z`` as doubles, many rows a value, written once: a pass hands them on without unpacking lists. A value lies by column and is
    packed, as most columns have few different numbers (flags, weather of a week) or come again in the rows nearby (lags). Columns after ``z`` say
    which rows of a batch lie next to each other."""
    step = max(BLOCK // (width + 1), 1)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows:
                x = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, width)
                rows = np.column_stack([x, batch.column(1).to_numpy()])
                if batch.num_columns > 2:
                    rows = rows[np.lexsort([c.fill_null(0).to_numpy() for c in reversed(batch.columns[2:])])]
                parts = [rows[i:i + step] for i in range(0, len(rows), step)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([pa.compress(part.tobytes("F"), CODEC, asbytes=True) for part in parts], pa.binary()),
                    pa.array([part.nbytes for part in parts], pa.int32())], names=["rows", "size"])

    return pin(vectors.mapInArrow(run, "rows binary, size int"))


def _sums(blocks: DataFrame, width: int, work) -> dict[tuple[int, int], float]:
    """Add up the matrices ``work`` makes of a task's rows: entry (i, j) of the total."""

    def run(batches):
        import pyarrow as pa

        total = None
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCKS_AT_ONCE):
                part = batch.slice(start, BLOCKS_AT_ONCE)
                packed = zip(part.column(0).to_pylist(), part.column(1).to_pylist())
                columns = [np.frombuffer(pa.decompress(data, size, CODEC)).reshape(width + 1, -1) for data, size in packed]
                rows = np.concatenate(columns, axis=1).T
                made = work(np.ascontiguousarray(rows[:, :width]), np.ascontiguousarray(rows[:, width]))
                total = made if total is None else total + made
        if total is not None:
            i, j = np.divmod(np.arange(total.size), total.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total.ravel())], names=["i", "j", "v"])

    added = blocks.mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    return {(r["i"], r["j"]): r["v"] for r in added.collect()}


def _matrix(sums: Mapping[tuple[int, int], float], height: int, width: int) -> np.ndarray:
    out = np.zeros((height, width))
    for (i, j), v in sums.items():
        out[i, j] = v
    return out


def fit(rows: DataFrame, features: Mapping[str, Column], target: Column, probs: Mapping[str, float],
        start: Mapping[str, Mapping[str, float]] | None = None, steps: int = STEPS, ridge: float = RIDGE, near: Sequence[Column] = ()) -> QuantileFit:
    """Fit every quantile of ``probs`` by ``steps`` passes over ``rows``.

    ``near`` are whole numbers by which like rows come to lie together, for the space they take; the fit is the same without.

    ``start`` gives known coefficients per quantile (absent ones are 0). Rows with a null target or feature take no part. An intercept is a feature like any other.
    """
    names = tuple(features)
    vectors = rows.select(F.array(*[c.cast("double") for c in features.values()]).alias("x"), target.cast("double").alias("z"),
                          *[c.alias(f"near{i}") for i, c in enumerate(near)]).where(
        F.col("z").isNotNull() & ~F.exists("x", lambda v: v.isNull() | F.isnan(v)))
    blocks = _blocks(vectors, len(names))
    try:
        return _fit(blocks, names, probs, start, steps, ridge)
    finally:
        unpin(blocks)


def _fit(blocks: DataFrame, names: tuple[str, ...], probs: Mapping[str, float], start: Mapping[str, Mapping[str, float]] | None, steps: int, ridge: float) -> QuantileFit:
    d, k = len(names), len(probs)
    alpha = np.array(list(probs.values()))
    given = np.array([[(start or {}).get(q, {}).get(f, 0.0) for f in names] for q in probs])

    def losses(r: np.ndarray) -> np.ndarray:
        """Check loss and absolute residuals per quantile, each summed over the rows."""
        return np.array([np.where(r >= 0, alpha * r, (alpha - 1) * r).sum(axis=0), np.abs(r).sum(axis=0)])

    def measure(x, z):
        """Moments of the features, then the losses of the given start."""
        out = np.zeros((5, max(d, k)))
        out[:3, :d] = np.vstack([np.full(d, float(len(z))), x.sum(axis=0), (x * x).sum(axis=0)])
        out[3:, :k] = losses(z[:, None] - x @ given.T)
        return out

    measured = _matrix(_sums(blocks, d, measure), 5, max(d, k))
    moments = measured[:3, :d]
    n = moments[0, 0]
    if not n:
        none = {q: tuple((start or {}).get(q, {}).get(f, 0.0) for f in names) for q in probs}
        return QuantileFit(names, (1.0,) * d, none, dict.fromkeys(probs, 0.0), dict.fromkeys(probs, 0.0))
    mean = moments[1] / n
    deviation = np.sqrt(np.maximum(moments[2] / n - mean**2, 0.0))
    # features are scaled but not shifted: an intercept, or a flag per class, is one of them
    spread = np.where(deviation > 1e-9 * (1 + np.abs(mean)), deviation, 1.0)
    first = given * spread
    beta = first.copy()

    def equations(present: np.ndarray, tiny: np.ndarray):
        """Per quantile the sums X'WX, X'Wz, X'1, the loss and the sum of weights, one below the other, in units of the spread."""
        slopes = (present / spread).T

        def work(x, z):
            out = np.zeros((k * (d + 2), d + 2))
            r = z[:, None] - x @ slopes
            w = 1 / (tiny + np.abs(r))
            loss, ones = losses(r), x.sum(axis=0)
            for q in range(k):
                weighted, at = w[:, q, None] * x, q * (d + 2)
                out[at:at + d, :d] = x.T @ weighted
                out[at:at + d, d] = z @ weighted
                out[at:at + d, d + 1] = ones
                out[at + d, 0], out[at + d, 1] = loss[0, q], loss[1, q]
                out[at + d, 2] = w[:, q].sum()
            return out

        total = _matrix(_sums(blocks, d, work), k * (d + 2), d + 2)
        parts = [total[q * (d + 2):(q + 1) * (d + 2)] for q in range(k)]
        for part in parts:
            part[:d] /= spread[:, None]
            part[:d, :d] /= spread
        return parts

    tiny = np.maximum(SHARPNESS * measured[4, :k] / n, 1e-12)
    before = {q: float(v / n) for q, v in zip(probs, measured[3])}
    best, best_loss = beta.copy(), np.array(list(before.values()))
    for _ in range(steps + 1):
        for q, part in enumerate(equations(beta, tiny)):
            loss = part[d, 0] / n
            if loss < best_loss[q]:
                best[q], best_loss[q] = beta[q], loss
            pull = ridge * part[d, 2]
            right = part[:d, d] + (2 * alpha[q] - 1) * part[:d, d + 1] + pull * first[q]
            beta[q] = np.linalg.lstsq(part[:d, :d] + pull * np.eye(d), right, rcond=None)[0]
    weights = {q: tuple(map(float, best[i])) for i, q in enumerate(probs)}
    return QuantileFit(names, tuple(spread.tolist()), weights, before, {q: float(best_loss[i]) for i, q in enumerate(probs)})


def harmonics(date: str, terms: Sequence[int] = (1, 2)) -> dict[str, Column]:
    """Yearly sine and cosine columns of a date."""
    turn = F.dayofyear(date) * (2 * np.pi / 365.25)
    return {f"{name}{k}": f(turn * k) for k in terms for name, f in (("sin", F.sin), ("cos", F.cos))}
