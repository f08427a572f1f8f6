"""Maturity, outliers and demand classes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from weekloom.functions import arrays as A

# fixed values: class thresholds, maturity limits and the outlier rule
ADI_LIMIT = 1.32
CV2_LIMIT = 0.49
MIN_WEEKS = 26
DISCONTINUED_WEEKS = 26
OUTLIER_WINDOW = 13
OUTLIER_CUT = 3.0
MAD_SCALE = 1.4826
MIN_POSITIVE_IN_WINDOW = 3

DEMAND_TYPES = ["smooth", "erratic", "intermittent", "lumpy"]


def maturity_columns(length: Column, last: Column, reference: Column,
                     discontinued_weeks: int = DISCONTINUED_WEEKS) -> tuple[Column, Column]:
    """Segment and weeks since the last sale of a series."""
    segment = (
        F.when(length < MIN_WEEKS, "cold_start")
        .when(last < F.date_sub(reference, 7 * discontinued_weeks), "discontinued")
        .otherwise("valid")
    )
    return segment, F.floor(F.datediff(reference, last) / 7).cast("int")


def segment_by_maturity(registry: DataFrame, id_column: str = "time_series_id",
                        reference: Column | None = None) -> DataFrame:
    """``cold_start`` below 26 weeks, else ``discontinued`` if the last week is older than 26 weeks
    before the reference date (default: the latest last week), else ``valid``."""
    if reference is None:
        reference = registry.agg(F.max("last_week_date")).scalar()
    segment, idle = maturity_columns(F.col("total_weeks_length"), F.col("last_week_date"), reference)
    return registry.select(id_column, segment.alias("segment"), idle.alias("weeks_since_last_sale"))


def segment_weekly(weekly: DataFrame, reference: Column, keys: Sequence[str] = ("unique_id",),
                   date: str = "ds") -> DataFrame:
    """The same rule on every row of a weekly table with gaps, inside its partitioning by series.

    The length is the number of weeks from the first to the last row, so excluded series can be
    filtered before their gaps are filled. The rows are put in the order of weeks that the next steps need, so they are sorted once.
    """
    whole = Window.partitionBy(*keys).orderBy(date).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first, last = F.min(date).over(whole), F.max(date).over(whole)
    ends = weekly.withColumns({"_first": first, "_last": last})
    length = F.datediff("_last", "_first") / 7 + 1
    segment, idle = maturity_columns(length, F.col("_last"), reference)
    return ends.withColumns({"segment": segment, "weeks_since_last_sale": idle}).drop("_first", "_last")


def _positive_window(value: str, keys: Sequence[str], date: str, window: int) -> tuple[Column, Column]:
    half = window // 2
    near = Window.partitionBy(*keys).orderBy(date).rowsBetween(-half, half)
    whole = Window.partitionBy(*keys)
    y = F.col(value)
    positives = F.collect_list(F.when(y > 0, y.cast("double"))).over(near)
    return positives, F.count_if(y > 0).over(whole)


def outlier_thresholds(panel: DataFrame, value: str = "y", date: str = "ds", keys: Sequence[str] = ("unique_id",),
                       window: int = OUTLIER_WINDOW, cut: float = OUTLIER_CUT, two_sided: bool = False) -> DataFrame:
    """Rolling median and MAD of the positive values in a centred window, and the outlier flag.

    Thresholds are NULL where the window has fewer than three positives or the series fewer than
    ``window``. One-sided: the lower bound is 0. Two-sided: it is median - cut * std, at least 0,
    and without the whole-series condition.
    """
    positives, n_positive = _positive_window(value, keys, date, window)
    y = F.col(value)
    enough = F.size("_near") >= MIN_POSITIVE_IN_WINDOW
    if not two_sided:
        enough = enough & (F.col("_npos") >= window)
    framed = (
        panel.withColumns({"_near": positives, "_npos": n_positive})
        .withColumn("_near", F.when(enough, F.col("_near")))
        .withColumn("rolling_baseline", A.median(F.col("_near")))
        .withColumn("rolling_std", MAD_SCALE * A.median(
            A.absolute_deviations(F.col("_near"), F.col("rolling_baseline"))))
        .withColumn("upper_threshold", F.col("rolling_baseline") + cut * F.col("rolling_std"))
        .drop("_near", "_npos")
    )
    if two_sided:
        lower = F.when(
            F.col("rolling_baseline").isNotNull(),
            F.greatest(F.col("rolling_baseline") - cut * F.col("rolling_std"), F.lit(0.0)),
        )
    else:
        lower = F.lit(0.0)
    beyond = (y > F.col("upper_threshold")) | (y < F.col("lower_threshold"))
    return framed.withColumn("lower_threshold", lower).withColumn(
        "is_outlier", F.coalesce((y > 0) & F.col("upper_threshold").isNotNull() & beyond, F.lit(False))
    )


def cap_outliers(flagged: DataFrame, value: str = "y") -> DataFrame:
    """``y_capped``: outliers moved to the bound they cross, truncated to whole units."""
    y = F.col(value)
    bound = F.when(y > F.col("upper_threshold"), F.col("upper_threshold")).otherwise(F.col("lower_threshold"))
    return flagged.withColumn("y_capped", F.when(F.col("is_outlier"), bound).otherwise(y).cast("bigint"))


def capped_values(panel: DataFrame, value: str = "y", date: str = "ds", keys: Sequence[str] = ("unique_id",),
                  window: int = OUTLIER_WINDOW, cut: float = OUTLIER_CUT) -> DataFrame:
    """Only ``is_outlier`` and ``y_capped``, for the refined panel.

    Same result as ``outlier_thresholds`` + ``cap_outliers``; the deviations are worked out only for
    rows above their window median, since no other row can be a (high) outlier.
    """
    positives, n_positive = _positive_window(value, keys, date, window)
    y = F.col(value)
    near = F.col("_near")
    enough = (y > 0) & (F.col("_npos") >= window) & (F.size(near) >= MIN_POSITIVE_IN_WINDOW)
    median = F.col("_median")
    upper = median + cut * (MAD_SCALE * A.median(A.absolute_deviations(near, median)))
    return (
        panel.withColumns({"_near": positives, "_npos": n_positive})
        .withColumn("_median", F.when(enough, A.median(near)))
        .withColumn("_upper", F.when(y > median, upper))
        .withColumn("is_outlier", F.coalesce(y > F.col("_upper"), F.lit(False)))
        .withColumn("y_capped", F.when(F.col("is_outlier"), F.col("_upper")).otherwise(y).cast("bigint"))
        .drop("_near", "_npos", "_median", "_upper")
    )


def demand_class(n: Column, n_positive: Column, mean: Column, std: Column, empty: str = "lumpy") -> Column:
    """Class from the mean interval n / n_positive and the squared variation of the positive values."""
    adi = n / n_positive
    cv2 = F.coalesce(F.pow(std / mean, 2), F.lit(0.0))
    steady = cv2 < CV2_LIMIT
    return (
        F.when(n_positive == 0, empty)
        .when(adi < ADI_LIMIT, F.when(steady, "smooth").otherwise("erratic"))
        .otherwise(F.when(steady, "intermittent").otherwise("lumpy"))
    )


def _class_parts(value: str) -> tuple[Column, Column, Column, Column]:
    positive = F.when(F.col(value) > 0, F.col(value).cast("double"))
    return F.count(F.lit(1)), F.count(positive), F.avg(positive), F.stddev_pop(positive)


def classify(panel: DataFrame, value: str = "y", keys: Sequence[str] = ("unique_id",),
             empty: str = "lumpy") -> DataFrame:
    """One row per series: interval, squared variation and class."""
    n, npos, mean, std = _class_parts(value)
    stats = panel.groupBy(*keys).agg(
        n.alias("n"), npos.alias("n_positive"), mean.alias("_m"), std.alias("_s"))
    return stats.select(
        *keys, "n", "n_positive",
        F.when(F.col("n_positive") > 0, F.col("n") / F.col("n_positive")).alias("adi"),
        F.pow(F.col("_s") / F.col("_m"), 2).alias("cv2"),
        demand_class(F.col("n"), F.col("n_positive"), F.col("_m"), F.col("_s"), empty).alias("demand_type"),
    )


def with_demand_type(panel: DataFrame, value: str = "y", keys: Sequence[str] = ("unique_id",)) -> DataFrame:
    """The class of its series on every row, inside the existing partitioning (no join)."""
    whole = Window.partitionBy(*keys)
    n, npos, mean, std = (c.over(whole) for c in _class_parts(value))
    parts = panel.withColumns({"_n": n, "_p": npos, "_m": mean, "_s": std})
    return parts.withColumn(
        "demand_type", demand_class(F.col("_n"), F.col("_p"), F.col("_m"), F.col("_s"))
    ).drop("_n", "_p", "_m", "_s")


def outlier_summary(flagged: DataFrame, keys: Sequence[str] = ("unique_id",)) -> DataFrame:
    """Outlier counts over the whole panel and the number of series touched."""
    per_series = flagged.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_outlier").alias("k"))
    return per_series.agg(
        F.sum("n").alias("n_rows"),
        F.sum("k").alias("n_outliers"),
        (F.sum("k") / F.sum("n")).alias("outlier_share"),
        F.count(F.lit(1)).alias("n_series"),
        F.count_if(F.col("k") > 0).alias("n_series_affected"),
    )


def series_tags(segments: DataFrame, treated: DataFrame, id_column: str) -> DataFrame:
    """Segment, idle weeks, outlier count and class per series; the last two are NULL for excluded series."""
    counts = treated.groupBy(id_column).agg(
        F.count_if("is_outlier").alias("n_outliers"), F.first("demand_type").alias("demand_type"))
    return segments.join(counts, id_column, "left")
