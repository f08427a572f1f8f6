"""Quantile forecasts and safety stock."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from weekloom.functions.ranks import exact_quantiles, rank_in_group
from weekloom.operators.profile import with_quantiles

# fixed values: forecast quantiles by column name
QUANTILES = {"q50": 0.50, "q80": 0.80, "q95": 0.95}
# a quantile that equals the actual value up to the last bits counts as covering it
TOLERANCE = 1e-9


def residual_quantiles(cv: DataFrame, probs: Mapping[str, float] = QUANTILES) -> DataFrame:
    """Quantiles per demand type of the residuals in units of their series' ``naive_mae``.

    One rule for all series, long or short: a type's residuals are made comparable by the naive error of
    their series. Takes ``demand_type, y, y_pred, naive_mae`` rows; those of a series without a naive error
    (constant, or a single value) have no unit and are left out.
    """
    resid = cv.select("demand_type", ((F.col("y") - F.col("y_pred")) / F.col("naive_mae")).alias("r")).where("r is not null")
    return exact_quantiles(resid, ["demand_type"], "r", {f"r_{q}": p for q, p in probs.items()})


def quantile_forecast(point: DataFrame, residuals: DataFrame, probs: Mapping[str, float] = QUANTILES) -> DataFrame:
    """Point forecast plus the type's residual quantiles in units of the row's ``naive_mae``.

    A series without a naive error does not vary, so its quantiles are the point forecast.
    """
    unit = F.coalesce("naive_mae", F.lit(0.0))
    rows = point.join(F.broadcast(residuals), "demand_type", "left")
    return rows.withColumns({q: F.col("y_pred") + F.col(f"r_{q}") * unit for q in probs}).drop(*[f"r_{q}" for q in probs], "naive_mae")


def safety_stock(quantiles: DataFrame) -> DataFrame:
    return quantiles.withColumn("safety_stock", F.col("q95") - F.col("q50"))


def quantile_metrics(results: DataFrame, probs: Mapping[str, float] = QUANTILES) -> DataFrame:
    """Pinball loss and coverage per quantile, all quantiles from one pass."""
    y = F.col("y")
    cells = F.array(*[F.struct(F.lit(q).alias("quantile"), F.lit(a).alias("alpha"), F.col(q).alias("v"))
                      for q, a in probs.items()])
    long = results.select("y", F.explode(cells).alias("c")).select("y", "c.*").where("v is not null and y is not null")
    err = y - F.col("v")
    loss = F.when(err >= 0, F.col("alpha") * err).otherwise((F.col("alpha") - 1) * err)
    return long.groupBy("quantile", "alpha").agg(
        F.avg(loss).alias("pinball"), F.avg((y <= F.col("v") + TOLERANCE).cast("double")).alias("coverage"))


def coverage_by_series(results: DataFrame, q: str = "q95") -> DataFrame:
    return results.where(F.col(q).isNotNull()).groupBy("unique_id").agg(
        F.avg((F.col("y") <= F.col(q) + TOLERANCE).cast("double")).alias(f"coverage_{q}"))


def coverage_picks(coverage: DataFrame, column: str = "coverage_q95", best: int = 2) -> DataFrame:
    """Two lowest, the middle and the two highest series by coverage."""
    ranked = rank_in_group(coverage, [], [column, "unique_id"], "_r", "_n")
    quality = (
        F.when(F.col("_r") > F.col("_n") - best, "High coverage")
        .when(F.col("_r") == F.floor(F.col("_n") / 2) + 1, "Median")
        .when(F.col("_r") <= best, "Low coverage")
    )
    return ranked.select("unique_id", column, quality.alias("quality")).where("quality is not null")


def series_stock_summary(results: DataFrame) -> DataFrame:
    """Distribution of the mean safety stock over series: count, mean, spread and quantiles."""
    mean = results.where("safety_stock is not null").groupBy("unique_id").agg(F.avg("safety_stock").alias("v"))
    moments = mean.agg(F.count(F.lit(1)).alias("n_series"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
                       F.min("v").alias("min"), F.max("v").alias("max"))
    return with_quantiles(moments, mean, "v", {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95})


def weekly_stock_summary(results: DataFrame) -> DataFrame:
    """Mean and median safety stock per forecast week."""
    known = results.where("safety_stock is not null")
    means = known.groupBy("ds").agg(F.avg("safety_stock").alias("mean"))
    return means.join(exact_quantiles(known, ["ds"], "safety_stock", {"median": 0.5}), "ds")


def equal_width_histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Counts in ``bins`` equal bins between the minimum and the maximum (last bin closed)."""
    low, high = F.min(column).cast("double").alias("lo"), F.max(column).cast("double").alias("hi")
    bounds = df.agg(F.struct(low, high)).scalar()
    counted = df.where(F.col(column).isNotNull()).withColumns({"_lo": bounds["lo"], "_hi": bounds["hi"]})
    width = (F.col("_hi") - F.col("_lo")) / bins
    at = F.when(width > 0, F.least(F.floor((F.col(column) - F.col("_lo")) / F.nullif(width, F.lit(0.0))), F.lit(bins - 1))).otherwise(F.lit(0))
    return counted.groupBy(at.cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.col("_lo") + at * width).alias("bin_start"))
