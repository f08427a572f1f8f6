"""Lag features, target transforms and the training matrix."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from weekloom.operators import series as S
from weekloom.operators.panel import future_weeks

# fixed values: lag presets and the rolling windows that may be put on each lag
LAG_PRESETS = {"short": [4, 13], "medium": [4, 8, 13, 26], "long": [4, 8, 13, 26, 52]}
LAG_TRANSFORMS = {"none": None, "rolling_mean_4": 4, "rolling_mean_13": 13, "expanding_mean": "expanding"}
TARGET_TRANSFORMS = ["none", "log1p", "detrend", "normalize"]


def _series(keys: Sequence[str], date: str):
    return Window.partitionBy(*keys).orderBy(date)


def extend_future(panel: DataFrame, h: int, keys: Sequence[str] = ("unique_id",)) -> DataFrame:
    """Panel plus ``h`` future weeks per series with NULL ``y``."""
    ahead = future_weeks(panel, h, keys=keys).drop("step").withColumn("y", F.lit(None).cast("double"))
    return panel.select(*keys, "ds", F.col("y").cast("double")).unionByName(ahead.select(*keys, "ds", "y"))


def lag_columns(lags: Sequence[int], transform: str = "none", value: str = "y", date: str = "ds",
                keys: Sequence[str] = ("unique_id",)) -> dict[str, Column]:
    """``lag{k}`` and, per transform, the mean of ``w`` rows ending ``k`` rows back (NULL until full)."""
    order = _series(keys, date)
    window = LAG_TRANSFORMS[transform]
    out: dict[str, Column] = {}
    for k in lags:
        out[f"lag{k}"] = F.lag(value, k).over(order)
        if window == "expanding":
            out[f"expanding_mean_lag{k}"] = F.avg(value).over(order.rowsBetween(Window.unboundedPreceding, -k))
        elif window:
            frame = order.rowsBetween(-k - window + 1, -k)
            full = F.row_number().over(order) >= k + window
            out[f"rolling_mean_lag{k}_window_size{window}"] = F.when(full, F.avg(value).over(frame))
    return out


def with_lags(rows: DataFrame, lags: Sequence[int], transform: str = "none", keys: Sequence[str] = ("unique_id",)) -> DataFrame:
    """``lag_columns`` of ``y`` on the rows; the mean of a moving window is worked out once and looked up for every lag."""
    window = LAG_TRANSFORMS[transform]
    if not window or window == "expanding":
        return rows.withColumns(lag_columns(lags, transform, keys=keys))
    order = _series(keys, "ds")
    full = F.row_number().over(order) >= window
    mean = F.when(full, F.avg("y").over(order.rowsBetween(-window + 1, 0)))
    out: dict[str, Column] = {}
    for k in lags:
        out[f"lag{k}"] = F.lag("y", k).over(order)
        out[f"rolling_mean_lag{k}_window_size{window}"] = F.lag("_mean", k).over(order)
    return rows.withColumn("_mean", mean).withColumns(out).drop("_mean")


def date_columns(date: str = "ds") -> dict[str, Column]:
    d = F.col(date)
    return {"month": F.month(d), "quarter": F.quarter(d), "week": F.weekofyear(d)}


def lag_features(panel: DataFrame, lags: Sequence[int], transform: str = "none", h: int = 0,
                 keys: Sequence[str] = ("unique_id",)) -> DataFrame:
    """Lag, rolling and date features for the history and ``h`` future weeks.

    With every lag >= h the future rows only look at known history, so one window pass is enough.
    """
    if h and min(lags) < h:
        raise ValueError("a lag shorter than the horizon would need values that are not known yet")
    rows = extend_future(panel, h, keys) if h else panel
    return with_lags(rows, lags, transform, keys).withColumns(date_columns())


# -- target transforms ---------------------------------------------------------

def series_scale(train: DataFrame, value: str = "y", keys: Sequence[str] = ("unique_id",)) -> DataFrame:
    """Mean and population deviation of each series; a constant series gets deviation 1."""
    sd = F.stddev_pop(value)
    return train.groupBy(*keys).agg(
        F.avg(value).alias("scale_mean"), F.when(sd > 0, sd).otherwise(F.lit(1.0)).alias("scale_std"))


def standardise(panel: DataFrame, scale: DataFrame, value: str = "y", keys: Sequence[str] = ("unique_id",)) -> DataFrame:
    return panel.join(scale, list(keys), "left").withColumn(
        value, (F.col(value) - F.col("scale_mean")) / F.col("scale_std"))


def unstandardise(value: Column) -> Column:
    return value * F.col("scale_std") + F.col("scale_mean")


def boxcox(value: Column, lam: float = 0.0) -> Column:
    """Box-Cox of ``value + 1``; lambda 0 is log1p."""
    return F.log1p(value) if lam == 0 else (F.pow(value + 1, F.lit(lam)) - 1) / lam


def inverse_boxcox(value: Column, lam: float = 0.0) -> Column:
    return F.expm1(value) if lam == 0 else F.pow(value * lam + 1, F.lit(1.0 / lam)) - 1


def difference(value: str = "y", date: str = "ds", keys: Sequence[str] = ("unique_id",)) -> Column:
    return F.col(value) - F.lag(value, 1).over(_series(keys, date))


def undo_difference(first_value: Column, diff: str, date: str = "ds", keys: Sequence[str] = ("unique_id",)) -> Column:
    """Running sum of differences on top of the first value."""
    running = F.sum(diff).over(_series(keys, date).rowsBetween(Window.unboundedPreceding, 0))
    return first_value + F.coalesce(running, F.lit(0.0))


def target_transforms(panel: DataFrame, lam: float = 0.5, keys: Sequence[str] = ("unique_id",)) -> DataFrame:
    """All transforms of ``y`` next to each other, with the value each inverse gives back."""
    order = _series(keys, "ds")
    whole = Window.partitionBy(*keys)
    y = F.col("y").cast("double")
    sd = F.stddev_pop("y").over(whole)
    base = panel.withColumns({
        "y": y,
        "y_diff": difference(keys=keys).cast("double"),
        "scale_mean": F.avg("y").over(whole),
        "scale_std": F.when(sd > 0, sd).otherwise(F.lit(1.0)),
        "y_log1p": boxcox(y),
        "y_boxcox": boxcox(y, lam),
        "_first": F.first("y").over(order).cast("double"),
    })
    scaled = base.withColumn("y_scaled", (F.col("y") - F.col("scale_mean")) / F.col("scale_std"))
    return scaled.withColumns({
        "y_from_diff": undo_difference(F.col("_first"), "y_diff", keys=keys),
        "y_from_scaled": unstandardise(F.col("y_scaled")),
        "y_from_log1p": inverse_boxcox(F.col("y_log1p")),
        "y_from_boxcox": inverse_boxcox(F.col("y_boxcox"), lam),
    }).drop("_first", "scale_mean", "scale_std")


def training_matrix(dataset: DataFrame, lags: Sequence[int], transform: str = "none",
                    keys: Sequence[str] = ("unique_id",)) -> DataFrame:
    """Assembled dataset plus lag features; rows whose lags are not complete are dropped."""
    columns = list(lag_columns(lags, transform, keys=keys))
    return with_lags(dataset, lags, transform, keys).withColumns(date_columns()).na.drop(subset=columns)


def train_statistics(train: DataFrame, keys: Sequence[str] = ("unique_id",)) -> DataFrame:
    """``cv``, median and interquartile range of each series from training rows only."""
    stats = S.spread_statistics(train, keys, "y", [0.25, 0.5, 0.75])
    return stats.select(*keys, F.when(F.col("mean") > 0, F.col("deviation") / F.col("mean")).otherwise(F.lit(0.0)).alias("cv"),
                        F.col("quantiles")[1].alias("q50"), (F.col("quantiles")[2] - F.col("quantiles")[0]).alias("iqr"))


def add_train_statistics(rows: DataFrame, train: DataFrame, keys: Sequence[str] = ("unique_id",)) -> DataFrame:
    """Training statistics on any rows; series without training rows drop out.

    Both sides are merged by series: judged by packed series, unpacked rows look small enough to be broadcast.
    """
    return rows.join(train_statistics(train, keys).hint("merge"), list(keys), "inner")
