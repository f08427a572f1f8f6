"""Per-series forecasters as column expressions over packed series.

``pack`` turns a panel into one row per series with its values in week order. A forecaster is an
expression over the values ``ys``, their number ``n`` and the horizon that gives ``array<double>``
with ``h`` values. It is map-only work, so any number of forecasters and any number of
cross-validation windows share the single shuffle of ``pack``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from weekloom.functions import arrays as A, grids as GS
from weekloom.operators import series as S

# fixed values: smoothing constants of the methods
CROSTON_ALPHA = 0.1
SBA_FACTOR = 0.95
ALPHA_GRID = [0.10, 0.15, 0.20, 0.25, 0.30]
TSB_ALPHA = 0.3
SEASONAL_ALPHA = 0.3
THETA_ALPHA = 0.3
SEASON = 52
ETS_ALPHAS = [0.1, 0.3, 0.5, 0.7]
ETS_BETAS = [0.0, 0.1, 0.3]

Forecaster = Callable[[Column, Column, int], Column]


def _in_batches(work: Callable[[np.ndarray, np.ndarray], np.ndarray], returns: str = "double") -> Callable[[Column], Column]:
    """``work`` over the value arrays of a batch: left-aligned rows of values (a NULL is NaN) and their lengths. Where it gives NaN, and for a
    NULL or empty array, the result is NULL."""

    @F.arrow_udf(returns)
    def run(lists: pa.Array) -> pa.Array:
        return GS.over_lists(work, lists, returns != "double")

    return run


def pack(panel: DataFrame, keys: Sequence[str] = ("unique_id",), extra: Sequence[str] = ()) -> DataFrame:
    """One row per series: ``ys`` in week order, last week and length (bounded by the calendar)."""
    return S.packed(panel, [*keys, *extra])


def unpack(packed: DataFrame, column: str, keep: Sequence[str], name: str = "y_pred") -> DataFrame:
    """One row per forecast week: ``keep``, ``step`` 1..h, ``ds`` and the value."""
    return packed.select(*keep, "last_ds", F.posexplode(column).alias("_k", name)).select(
        *keep, (F.col("_k") + 1).alias("step"), F.date_add("last_ds", (F.col("_k") + 1) * 7).alias("ds"), name)


# -- seasonal ------------------------------------------------------------------

def _steps(h: int, first: int = 0) -> Column:
    return F.sequence(F.lit(first), F.lit(h - 1 + first))


def _unknown(h: int) -> Column:
    return F.array_repeat(F.lit(None).cast("double"), h)


def _flat(value: Column, h: int) -> Column:
    return F.array_repeat(value, h)


def seasonal_naive(ys: Column, n: Column, h: int, season: int = SEASON) -> Column:
    """Value of the same week one season ago; NULL for series shorter than a season."""
    same_week = F.transform(_steps(h), lambda k: F.try_element_at(ys, (n - season + 1 + k % season).cast("int")))
    return F.when(n >= season, same_week).otherwise(_unknown(h))


def seasonal_smoothing(ys: Column, n: Column, h: int, season: int = SEASON, alpha: float = SEASONAL_ALPHA) -> Column:
    """Exponential smoothing of each season position on its own; NULL below one season."""
    def level(k: Column) -> Column:
        own = F.transform(F.sequence((n + k) % season + 1, n, F.lit(season)), lambda i: F.element_at(ys, i))
        return A.smoothed_level(own, alpha)

    return F.when(n >= season, F.transform(_steps(h), level)).otherwise(_unknown(h))


# -- intermittent demand -------------------------------------------------------

def sizes(ys: Column) -> Column:
    """The positive values."""
    return F.filter(ys, lambda v: v > 0)


def intervals(ys: Column) -> Column:
    """Weeks between positive values; the first counts from the start of the series."""
    at = F.filter(F.transform(ys, lambda v, i: F.when(v > 0, i + 1)), lambda p: p.isNotNull())
    return A.let(at, lambda pos: F.transform(pos, lambda p, i: (
        p - F.when(i > 0, F.element_at(pos, F.greatest(i, F.lit(1)))).otherwise(F.lit(0))).cast("double")))


def _if_sold(z: Column, value: Column) -> Column:
    return F.when(F.size(z) > 0, value).otherwise(F.lit(0.0))


def croston(ys: Column, n: Column, h: int, alpha: float = CROSTON_ALPHA, factor: float = 1.0) -> Column:
    """Smoothed size over smoothed interval; 0 for a series without sales."""
    rate = A.let_all(lambda z, gaps: _if_sold(
        z, factor * A.smoothed_level(z, alpha) / A.smoothed_level(gaps, alpha)), z=sizes(ys), gaps=intervals(ys))
    return _flat(rate, h)


def croston_sba(ys: Column, n: Column, h: int) -> Column:
    return croston(ys, n, h, factor=SBA_FACTOR)


def croston_optimised(ys: Column, n: Column, h: int, alphas: Sequence[float] = ALPHA_GRID) -> Column:
    """Croston with the best grid alpha for sizes and for intervals."""
    def rate(values: np.ndarray, length: np.ndarray) -> np.ndarray:
        sold, gaps, count = GS.sales(values)
        level, gap = GS.best_level(sold, count, alphas), GS.best_level(gaps, count, alphas)
        return np.where(count > 0, level / gap, 0.0)

    return _flat(_in_batches(rate)(ys), h)


def tsb(ys: Column, n: Column, h: int, alpha_d: float = TSB_ALPHA, alpha_p: float = TSB_ALPHA) -> Column:
    """Smoothed size times smoothed probability of a sale."""
    sold = F.transform(ys, lambda v: (v > 0).cast("double"))
    rate = A.let(sizes(ys), lambda z: _if_sold(z, A.smoothed_level(z, alpha_d) * A.smoothed_level(sold, alpha_p)))
    return _flat(rate, h)


def adida(ys: Column, n: Column, h: int, alphas: Sequence[float] = ALPHA_GRID) -> Column:
    """Smooth the sums of buckets as long as the mean interval and spread the level over the bucket."""
    return _flat(_in_batches(lambda values, n: GS.bucket_rate(values, n, alphas, shorter=False))(ys), h)


def imapa(ys: Column, n: Column, h: int, alphas: Sequence[float] = ALPHA_GRID) -> Column:
    """Mean of the bucket forecasts for lengths 1 .. mean interval."""
    return _flat(_in_batches(lambda values, n: GS.bucket_rate(values, n, alphas, shorter=True))(ys), h)


# -- trend ---------------------------------------------------------------------

def theta(ys: Column, n: Column, h: int, alpha: float = THETA_ALPHA) -> Column:
    """Mean of the straight trend line and of the smoothed line with doubled curvature."""
    st, stt = n * (n + 1) / 2.0, n * (n + 1) * (2 * n + 1) / 6.0

    def line(sy: Column, sty: Column) -> Column:
        slope = F.when(n > 1, (n * sty - st * sy) / (n * stt - st * st)).otherwise(F.lit(0.0))
        return A.let(slope, lambda b: F.struct(((sy - b * st) / n).alias("a"), b.alias("b")))

    def path(fit: Column) -> Column:
        curved = F.transform(ys, lambda v, i: 2 * v - (fit["a"] + fit["b"] * (i + 1)))
        return A.let(A.smoothed_level(curved, alpha), lambda level: F.transform(
            _steps(h, 1), lambda k: 0.5 * (fit["a"] + fit["b"] * (n + k)) + 0.5 * level))

    weighted = A.array_total(F.transform(ys, lambda v, i: v * (i + 1)))
    return A.let(A.let_all(line, sy=A.array_total(ys), sty=weighted), path)


def ar_on_differences(ys: Column, n: Column, h: int) -> Column:
    """Least-squares AR(1) on first differences, iterated ``h`` steps from the last value.

    Fewer than three differences, or constant ones, give the last value.
    """
    terms = ("x", "y", "xx", "xy")
    zero = F.struct(*[F.lit(0.0).alias(c) for c in terms], F.try_element_at(ys, F.lit(1)).alias("v"),
                    F.lit(None).cast("double").alias("d"))

    def add(acc: Column, v: Column) -> Column:
        d = v - acc["v"]
        x = F.coalesce(acc["d"], F.lit(0.0))
        y = F.when(acc["d"].isNotNull(), d).otherwise(F.lit(0.0))
        return F.struct((acc["x"] + x).alias("x"), (acc["y"] + y).alias("y"), (acc["xx"] + x * x).alias("xx"),
                        (acc["xy"] + x * y).alias("xy"), v.alias("v"), d.alias("d"))

    def line(s: Column) -> Column:
        m = (n - 2).cast("double")
        spread = m * s["xx"] - s["x"] * s["x"]
        usable = (n >= 4) & (spread > 0)
        phi = F.when(usable, (m * s["xy"] - s["x"] * s["y"]) / spread).otherwise(F.lit(0.0))
        return A.let(phi, lambda p: F.struct(
            p.alias("phi"), F.when(usable, (s["y"] - p * s["x"]) / m).otherwise(F.lit(0.0)).alias("c"),
            F.when(usable, s["d"]).otherwise(F.lit(0.0)).alias("d"), s["v"].alias("y")))

    def path(fit: Column) -> Column:
        def ahead(k: Column) -> Column:
            return F.aggregate(
                F.sequence(F.lit(1), k), F.struct(fit["d"].alias("d"), fit["y"].alias("y")),
                lambda acc, _: F.struct((fit["c"] + fit["phi"] * acc["d"]).alias("d"),
                                        (acc["y"] + fit["c"] + fit["phi"] * acc["d"]).alias("y")),
                lambda acc: acc["y"])
        return F.transform(_steps(h, 1), ahead)

    sums = F.aggregate(A.tail_from(ys, F.lit(1)), zero, add)
    return A.let(A.let(sums, line), path)


def ets_grid(ys: Column, n: Column, h: int, alphas: Sequence[float] = ETS_ALPHAS,
             betas: Sequence[float] = ETS_BETAS) -> Column:
    """Additive smoothing without (beta 0) or with trend; the grid pair with the smallest squared error wins.

    Starts at the first value with zero trend; ties go to the earlier pair (alpha first, then beta).
    """
    pairs = [(a, b) for a in alphas for b in betas]
    return _in_batches(lambda values, n: GS.best_line(values, n, pairs, h), "array<double>")(ys)


# -- registry ------------------------------------------------------------------

FORECASTERS: dict[str, Forecaster] = {
    "SeasonalNaive": seasonal_naive,
    "Croston": croston,
    "CrostonSBA": croston_sba,
    "CrostonOptimized": croston_optimised,
    "TSB": tsb,
    "ADIDA": adida,
    "IMAPA": imapa,
    "SeasonalES": seasonal_smoothing,
    "ETS": ets_grid,
    "Theta": theta,
    "AR": ar_on_differences,
}

# methods of users, by name: the forecast array for a horizon (see ``plugins``)
PLUGINS: dict[str, Callable[[int], Column]] = {}

# fixed values: season length a method needs on top of the windows of cross-validation
SEASON_OF = {"SeasonalNaive": SEASON, "SeasonalES": SEASON, "ETS": SEASON, "Theta": SEASON, "AR": 1}

# fixed values: variants of a registered method for one demand type
SEASON_OF_TYPE = {("erratic", "AR"): 13}

# fixed values: candidates and baselines of each demand type
CANDIDATES: dict[str, list[str]] = {
    "erratic": ["AR", "ETS", "Theta", "SeasonalES", "CrostonOptimized"],
    "intermittent": ["TSB", "ADIDA", "IMAPA", "CrostonSBA", "CrostonOptimized"],
    "lumpy": ["ETS", "AR", "IMAPA", "TSB", "CrostonSBA", "CrostonOptimized"],
}
DEFAULT_MODEL = "CrostonOptimized"
BASELINES = {
    "smooth": "SeasonalNaive", "erratic": "SeasonalNaive",
    "intermittent": "CrostonOptimized", "lumpy": "CrostonOptimized",
}


def season_needed(model: str, demand_type: str | None = None) -> int:
    return SEASON_OF_TYPE.get((demand_type, model), SEASON_OF.get(model, 0))


def forecaster(name: str) -> Forecaster:
    if name not in FORECASTERS:
        raise KeyError(f"unknown forecaster {name!r}; known: {sorted([*FORECASTERS, *PLUGINS])}")
    return FORECASTERS[name]


# methods that run over whole batches in Python; all others are expressions
BATCHED = {"CrostonOptimized", "ADIDA", "IMAPA", "ETS"}


def predicted(model: str, h: int, where: Column | None = None) -> Column:
    """Forecast array of one method over the packed columns ``ys`` and ``n``; NULL where there are no values.

    Spark runs Python on all rows, also those a conditional leaves out: ``where`` names the rows that are asked for, others reach it as NULL.
    """
    if model in BATCHED:
        asked = F.col("n") > 0 if where is None else where & (F.col("n") > 0)
        return F.when(asked, FORECASTERS[model](F.when(asked, F.col("ys")), F.col("n"), h))
    if model in PLUGINS:
        return F.when(F.col("n") > 0, PLUGINS[model](h))
    return F.when(F.col("n") > 0, A.let_all(lambda ys, n: forecaster(model)(ys, n, h), ys=F.col("ys"), n=F.col("n")))


def forecast(panel: DataFrame, model: str, h: int, keys: Sequence[str] = ("unique_id",)) -> DataFrame:
    """``keys, step, ds, y_pred`` for one method over all series of a panel."""
    return unpack(pack(panel, keys).withColumn("_fc", predicted(model, h)), "_fc", keys)


def route(packed: DataFrame, models: Mapping[str, str], h: int, out: str) -> DataFrame:
    """Forecast every series with the method of its ``demand_type``; adds ``out`` and ``model``.

    One pass over the packed rows: a conditional evaluates only the branch of the row's type.
    """
    used: dict[str, list[str]] = {}
    for kind, model in models.items():
        used.setdefault(model, []).append(kind)
    value, name = None, None
    for model, kinds in used.items():
        mine = F.col("demand_type").isin(*kinds)
        made = predicted(model, h, mine)
        value = F.when(mine, made) if value is None else value.when(mine, made)
        name = F.when(mine, model) if name is None else name.when(mine, model)
    return packed.where(F.col("demand_type").isin(*models)).withColumns({out: value, "model": name})


def apply_custom(panel: DataFrame, predict: Callable[[list[float], int], list[float]], h: int) -> DataFrame:
    """Run a user's Python forecaster per series: ``predict(values, h)`` returns ``h`` numbers.

    Spark groups and distributes the series; each call sees one series, whose length is bounded by
    the number of weeks.
    """
    schema = T.StructType([
        T.StructField("unique_id", panel.schema["unique_id"].dataType),
        T.StructField("ds", T.DateType()),
        T.StructField("y_pred", T.DoubleType()),
    ])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ds")
        values = predict(pdf["y"].astype(float).tolist(), h)
        weeks = pd.to_datetime(pdf["ds"].iloc[-1]) + pd.to_timedelta([7 * k for k in range(1, h + 1)], unit="D")
        return pd.DataFrame({"unique_id": pdf["unique_id"].iloc[0], "ds": weeks.date, "y_pred": values})

    return panel.select("unique_id", "ds", "y").groupBy("unique_id").applyInPandas(run, schema)
