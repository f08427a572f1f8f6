"""Accuracy metrics, rolling-origin windows, model choice and backtest tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from weekloom.functions import arrays as A
from weekloom.functions.ranks import exact_quantiles, rank_in_group
from weekloom.operators import forecasters as FC

HORIZON = 4
N_WINDOWS = 6


# -- metrics -------------------------------------------------------------------

def _gap(y: str, pred: str) -> Column:
    return F.abs(F.col(y) - F.col(pred))


def wape_expr(y: str = "y", pred: str = "y_pred") -> Column:
    return F.sum(_gap(y, pred)) / F.nullif(F.sum(F.abs(F.col(y).cast("double"))), F.lit(0.0))


def smape_expr(y: str = "y", pred: str = "y_pred") -> Column:
    size = F.abs(F.col(y)) + F.abs(F.col(pred))
    return 2 * F.avg(F.when(size > 0, _gap(y, pred) / size))


def mae_expr(y: str = "y", pred: str = "y_pred") -> Column:
    return F.avg(_gap(y, pred))


METRICS = {"wape": wape_expr, "smape": smape_expr, "mae": mae_expr}


def naive_scale(train: DataFrame, keys: Sequence[str] = ("unique_id",)) -> DataFrame:
    """Mean absolute first difference of the training rows; NULL where it is 0 or undefined."""
    order = Window.partitionBy(*keys).orderBy("ds")
    steps = train.select(*keys, F.abs(F.col("y") - F.lag("y", 1).over(order)).alias("_d"))
    return steps.groupBy(*keys).agg(F.nullif(F.avg("_d"), F.lit(0.0)).alias("naive_mae"))


def series_metrics(pred: DataFrame, scale: DataFrame | None = None, group: Sequence[str] = (), y: str = "y",
                   y_pred: str = "y_pred") -> DataFrame:
    """MASE, SMAPE and WAPE per series. ``scale`` is joined on the series, or the rows carry
    ``naive_mae`` themselves. A NULL forecast makes its series' metrics NULL: no forecast is not a
    good forecast."""
    if scale is not None:
        pred = pred.drop("naive_mae").join(scale.select("unique_id", "naive_mae"), "unique_id", "left")
    per = pred.groupBy("unique_id", *group).agg(
        F.count_if(F.col(y_pred).isNull() & F.col(y).isNotNull()).alias("_absent"),
        F.max("naive_mae").alias("_scale"), mae_expr(y, y_pred).alias("mae"),
        smape_expr(y, y_pred).alias("smape"), wape_expr(y, y_pred).alias("wape"))
    known = F.col("_absent") == 0
    return per.select(
        "unique_id", *group,
        F.when(known, F.col("mae") / F.col("_scale")).alias("mase"),
        F.when(known, F.col("smape")).alias("smape"),
        F.when(known, F.col("wape")).alias("wape"),
    )


def mean_metrics(per_series: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Unweighted mean over series, NULLs skipped; ``n_series`` counts all."""
    return per_series.groupBy(*group).agg(
        F.avg("mase").alias("mase"), F.avg("smape").alias("smape"), F.avg("wape").alias("wape"),
        F.count(F.lit(1)).alias("n_series"))


def custom_metrics(pred: DataFrame, metrics: Sequence[str | Callable[[], Column]], group: Sequence[str] = ()) -> DataFrame:
    """Metrics per group: registered ones by name, a user's own as a function giving an aggregate of ``y`` and
    ``y_pred``, named like the function."""
    columns = [METRICS[m]().alias(m) if isinstance(m, str) else m().alias(m.__name__) for m in metrics]
    return pred.groupBy(*group).agg(*columns)


def packed_naive_scale(packed: DataFrame) -> DataFrame:
    """Add ``naive_mae`` of the packed (training) values."""
    total = F.aggregate(
        "ys", F.struct(F.lit(None).cast("double").alias("v"), F.lit(0.0).alias("s")),
        lambda acc, v: F.struct(v.alias("v"), (acc["s"] + F.coalesce(F.abs(v - acc["v"]), F.lit(0.0))).alias("s")),
        lambda acc: acc["s"])
    mean = F.when(F.col("n") > 1, total / (F.col("n") - 1))
    return packed.withColumn("naive_mae", F.nullif(mean, F.lit(0.0)))


# -- alignment -----------------------------------------------------------------

def by_position(test: DataFrame, pred: DataFrame, keys: Sequence[str] = ("unique_id",)) -> DataFrame:
    """Join the k-th test row of a series to its k-th forecast; dates come from the test rows."""
    order = Window.partitionBy(*keys).orderBy("ds")
    left = test.withColumn("_k", F.row_number().over(order) - 1)
    right = pred.select(*keys, (F.row_number().over(order) - 1).alias("_k"), "y_pred")
    return left.join(right, [*keys, "_k"], "left").drop("_k")


def by_date(test: DataFrame, pred: DataFrame, keys: Sequence[str] = ("unique_id",)) -> DataFrame:
    return test.join(pred.select(*keys, "ds", "y_pred"), [*keys, "ds"], "left")


def hold_out(packed: DataFrame, cutoff: Column) -> DataFrame:
    """Split packed series at a date: ``ys`` keeps the weeks up to it, ``actual`` gets the later ones.

    A series that ended earlier has an empty ``actual``; one that started later has no training part
    and keeps its test weeks, for which no method has a forecast.
    """
    n_test = F.least(F.greatest(F.floor(F.datediff("last_ds", cutoff) / 7), F.lit(0)), F.col("n")).cast("int")
    rows = packed.withColumn("_t", n_test)
    return rows.withColumns({
        "actual": F.slice("ys", F.col("n") - F.col("_t") + 1, F.col("_t")),
        "ys": F.slice("ys", F.lit(1), F.col("n") - F.col("_t")),
        "last_ds": F.date_sub("last_ds", F.col("_t") * 7),
        "n": F.col("n") - F.col("_t"),
    }).drop("_t")


def test_rows(forecasts: DataFrame, columns: Mapping[str, str], keep: Sequence[str]) -> DataFrame:
    """One row per test week: the k-th actual value next to the k-th value of each forecast column."""
    zipped = F.arrays_zip(F.col("actual").alias("y"), *[F.col(c).alias(name) for name, c in columns.items()])
    inside = F.slice(zipped, F.lit(1), F.size("actual"))
    return forecasts.select(*keep, "last_ds", F.posexplode(inside).alias("_k", "p")).select(
        *keep, F.date_add("last_ds", (F.col("_k") + 1) * 7).alias("ds"), "p.y", *[f"p.{name}" for name in columns])


# -- rolling origin --------------------------------------------------------------

def min_length_filter(panel: DataFrame, h: int, n_windows: int, season: int = 0) -> DataFrame:
    """Keep series with at least ``h * (n_windows + 1) + season`` rows."""
    whole = Window.partitionBy("unique_id")
    return (
        panel.withColumn("_n", F.count(F.lit(1)).over(whole))
        .where(F.col("_n") >= h * (n_windows + 1) + max(season, 0)).drop("_n")
    )


def rolling_windows(panel: DataFrame, h: int, n_windows: int, step: int) -> DataFrame:
    """Rows of every window of every series: ``window`` 0 is the latest; ``is_test`` marks its ``h`` weeks.

    Windows count back from each series' own end. Rows are multiplied after the exchange on the
    series, and only rows up to the end of the window's test part are made.
    """
    order, whole = Window.partitionBy("unique_id").orderBy("ds"), Window.partitionBy("unique_id")
    placed = panel.withColumns({
        "_rn": F.row_number().over(order), "_n": F.count(F.lit(1)).over(whole), "_last": F.max("ds").over(whole)})
    from_end = F.col("_n") - F.col("_rn")
    reach = F.least(F.floor(from_end / step), F.lit(n_windows - 1)).cast("int")
    spread = placed.withColumn("window", F.explode(F.sequence(F.lit(0), reach)))
    spread = spread.where(F.col("_n") - h - F.col("window") * step >= 1)
    return spread.select(
        "unique_id", "window", F.date_sub("_last", (F.col("window") * step + h) * 7).alias("cutoff"),
        "ds", "y", (F.col("_rn") > F.col("_n") - h - F.col("window") * step).alias("is_test"))


def packed_windows(packed: DataFrame, h: int, n_windows: int, step: int) -> DataFrame:
    """The same windows on packed series: ``ys`` becomes the training part, ``actual`` the test part."""
    rows = packed.withColumn("window", F.explode(F.sequence(F.lit(0), F.lit(n_windows - 1))))
    cut = F.col("n") - h - F.col("window") * step
    rows = rows.withColumn("_cut", cut.cast("int")).where(F.col("_cut") >= 1)
    return rows.withColumns({
        "n_total": F.col("n"),
        "actual": F.slice("ys", F.col("_cut") + 1, F.lit(h)),
        "ys": F.slice("ys", F.lit(1), F.col("_cut")),
        "n": F.col("_cut"),
        "last_ds": F.date_sub("last_ds", (F.col("window") * step + h) * 7),
    }).drop("_cut")


def cv_forecasts(packed: DataFrame, models: Mapping[str, Column], h: int, n_windows: int, step: int,
                 keep: Sequence[str] = ("unique_id",)) -> DataFrame:
    """Forecasts of several methods on all windows: ``keep, window, n_total, step, model, y, y_pred``.

    ``models`` maps a method to the rows it applies to. One pass over the packed windows makes all of
    them; (method, row) pairs that do not apply give no output rows.
    """
    rows = packed_windows(packed, h, n_windows, step).withColumns(
        {f"fc_{m}": F.when(where, FC.predicted(m, h, where)) for m, where in models.items()})
    named = F.filter(
        F.array(*[F.struct(F.lit(m).alias("model"), F.col(f"fc_{m}").alias("v")) for m in models]),
        lambda f: f["v"].isNotNull())
    long = rows.select(*keep, "window", "n_total", "last_ds", "actual", F.explode(named).alias("f"))
    pairs = F.arrays_zip(F.col("actual").alias("y"), F.col("f.v").alias("y_pred"))
    return long.select(*keep, "window", "n_total", "last_ds", F.col("f.model").alias("model"),
                       F.posexplode(pairs).alias("_k", "p")).select(
        *keep, "window", "n_total", "last_ds", "model", (F.col("_k") + 1).alias("step"), "p.y", "p.y_pred")


def candidate_scores(packed: DataFrame, candidates: Mapping[str, Sequence[str]], h: int = HORIZON,
                     n_windows: int = N_WINDOWS) -> DataFrame:
    """Mean per-series WAPE over disjoint windows for each (demand type, candidate), in one pass.

    A candidate is scored only on series long enough for its season.
    """
    where: dict[str, Column] = {}
    for kind, models in candidates.items():
        for m in models:
            long_enough = F.col("n_total") >= h * (n_windows + 1) + FC.season_needed(m, kind)
            where[m] = where.get(m, F.lit(False)) | ((F.col("demand_type") == kind) & long_enough)
    rows = packed.where(F.col("demand_type").isin(*candidates) & (F.col("n") >= h * (n_windows + 1)))
    cv = cv_forecasts(rows, where, h, n_windows, h, keep=("unique_id", "demand_type"))
    per_series = cv.groupBy("demand_type", "model", "unique_id").agg(wape_expr().alias("wape"))
    return per_series.groupBy("demand_type", "model").agg(
        F.avg("wape").alias("cv_wape"), F.count(F.lit(1)).alias("n_series"))


def select_models(scores: DataFrame, kinds: DataFrame) -> DataFrame:
    """Smallest CV WAPE per demand type (name on ties); the default method where nothing was scored."""
    best = scores.where(F.col("cv_wape").isNotNull()).groupBy("demand_type").agg(
        F.min(F.struct("cv_wape", "model")).alias("b"))
    return kinds.join(best, "demand_type", "left").select(
        "demand_type", F.coalesce("b.model", F.lit(FC.DEFAULT_MODEL)).alias("model"), F.col("b.cv_wape").alias("cv_wape"))


def improvement_expr(over: Callable[[Column], Column] = lambda c: c) -> Column:
    """WAPE change in percent of the baseline, from the ``Baseline`` and ``Trained`` rows of a group."""
    base = over(F.max(F.when(F.col("model") == "Baseline", F.col("wape"))))
    trained = over(F.max(F.when(F.col("model") == "Trained", F.col("wape"))))
    return (base - trained) / F.nullif(base, F.lit(0.0)) * 100


def with_improvement(scores: DataFrame) -> DataFrame:
    """Add ``delta_wape_pct`` to the two score rows of each demand type."""
    pair = Window.partitionBy("demand_type")
    return scores.withColumn("delta_wape_pct", improvement_expr(lambda c: c.over(pair)))


# -- per-series quality ----------------------------------------------------------

def quality_picks(per_series: DataFrame, score: str, group: Sequence[str], best: int = 2) -> DataFrame:
    """The best two, the middle and the worst two series per group, by ascending score and id."""
    scored = per_series.where(F.col(score).isNotNull())
    ranked = rank_in_group(scored, group, [score, "unique_id"], "_r", "_n", few_groups=True)
    place = (
        F.when(F.col("_r") <= best, "best")
        .when(F.col("_r") == F.floor(F.col("_n") / 2) + 1, "median")
        .when(F.col("_r") > F.col("_n") - best, "worst")
    )
    return ranked.withColumn("quality", place).where(F.col("quality").isNotNull()).select(
        *group, "unique_id", score, "quality")


def score_quantiles(per_series: DataFrame, score: str, group: Sequence[str]) -> DataFrame:
    return exact_quantiles(per_series, group, score, {"p10": 0.1, "p50": 0.5, "p90": 0.9})
