"""Global boosted-tree model over lag, calendar, static and exogenous features."""

from __future__ import annotations

import functools
import random
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from weekloom.functions.ranks import global_row_number
from weekloom.operators import boosting as B, lags as L, panel as P
from weekloom.session import pin


@dataclass(frozen=True)
class TreeParams:
    """Settings of one tree model: feature choices and booster parameters."""

    lag_preset: str = "medium"
    lag_transform: str = "rolling_mean_4"
    target_transform: str = "normalize"
    step_size: float = 0.1
    max_iter: int = 100
    max_depth: int = 5
    feature_fraction: float = 0.9
    row_fraction: float = 0.75
    seed: int = 42

    def booster(self, trees: int | None = None) -> B.Booster:
        """The booster's part of the settings, with another number of trees where one is given."""
        return B.Booster(self.step_size, trees or self.max_iter, self.max_depth, self.feature_fraction, self.row_fraction, self.seed)


@dataclass
class TreeFit:
    """A fitted booster with what prediction needs."""

    model: B.Ensemble
    params: TreeParams
    features: list[str]
    scale: DataFrame


def _with_target(rows: DataFrame, params: TreeParams, scale: DataFrame) -> DataFrame:
    """Replace ``y`` by the transformed target (before lags are taken, so lags are transformed too)."""
    y = F.col("y").cast("double")
    if params.target_transform == "normalize":
        return L.standardise(rows.withColumn("y", y), scale)
    if params.target_transform == "log1p":
        return rows.withColumn("y", L.boxcox(y))
    if params.target_transform == "detrend":
        return rows.withColumn("y", y).withColumn("y", L.difference())
    return rows.withColumn("y", y)


def _back_to_units(pred: DataFrame, params: TreeParams, scale: DataFrame, last: DataFrame) -> DataFrame:
    if params.target_transform == "normalize":
        return pred.join(scale, "unique_id", "left").withColumn(
            "y_pred", L.unstandardise(F.col("y_pred"))).drop("scale_mean", "scale_std")
    if params.target_transform == "log1p":
        return pred.withColumn("y_pred", L.inverse_boxcox(F.col("y_pred")))
    if params.target_transform == "detrend":
        return pred.join(last, "unique_id").withColumn(
            "y_pred", L.undo_difference(F.col("last_y"), "y_pred")).drop("last_y")
    return pred


def feature_names(params: TreeParams, exogenous: Sequence[str]) -> list[str]:
    lags = L.lag_columns(L.LAG_PRESETS[params.lag_preset], params.lag_transform)
    return [*lags, *L.date_columns(), *exogenous, *map(missing_flag, exogenous)]


def missing_flag(name: str) -> str:
    return f"{name}_is_missing"


def _assemble(rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """Feature vector. An exogenous value unknown for a week is 0 with its flag set, so it never passes for
    a measured one; lags are complete wherever the vector is used."""
    known = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features if c in rows.columns}
    flags = {c: F.col(c.removesuffix(missing_flag(""))).isNull().cast("double") for c in features if c not in rows.columns}
    filled = rows.withColumns(flags).withColumns(known)
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(filled)


def fit(dataset: DataFrame, params: TreeParams, exogenous: Sequence[str]) -> TreeFit:
    """Train on ``unique_id, ds, y`` + exogenous columns with known parameters."""
    scale = L.series_scale(dataset)
    prepared = _with_target(dataset, params, scale)
    matrix = L.training_matrix(prepared, L.LAG_PRESETS[params.lag_preset], params.lag_transform)
    features = feature_names(params, exogenous)
    # cut points and boosting each read the rows, so they are written once
    rows = pin(_assemble(matrix.where(F.col("y").isNotNull()), features).select(
        row_key(), vector_to_array("features").alias("x"), "y", F.lit(False).alias("late")))
    model = B.fit(rows, params.booster(), rows.count())
    return TreeFit(model, params, features, scale)


def row_key() -> Column:
    return F.xxhash64("unique_id", "ds").alias("key")


def predict(fitted: TreeFit, history: DataFrame, future_exogenous: DataFrame, h: int) -> DataFrame:
    """``unique_id, step, ds, y_pred`` for the ``h`` weeks after each series, in one pass.

    Every lag preset starts at the horizon, so future rows need no forecast values as input. A row whose lags
    reach beyond the series' start has no forecast (NULL): training drops such rows, too.
    """
    params = fitted.params
    prepared = _with_target(history, params, fitted.scale).select("unique_id", "ds", "y")
    rows = L.lag_features(prepared, L.LAG_PRESETS[params.lag_preset], params.lag_transform, h)
    steps = P.future_weeks(history.select("unique_id", "ds"), h)
    ahead = steps.join(rows.drop("y"), ["unique_id", "ds"]).join(
        future_exogenous.drop("step"), ["unique_id", "ds"], "left")
    lags = L.lag_columns(L.LAG_PRESETS[params.lag_preset], params.lag_transform)
    complete = functools.reduce(Column.__and__, [F.col(c).isNotNull() for c in lags])
    filled = _assemble(ahead.withColumn("_complete", complete), fitted.features)
    scored = filled.withColumn("prediction", fitted.model.predict(vector_to_array("features")))
    pred = scored.select("unique_id", "step", "ds", F.when(F.col("_complete"), F.col("prediction")).alias("y_pred"))
    last = history.groupBy("unique_id").agg(F.max_by("y", "ds").cast("double").alias("last_y"))
    return _back_to_units(pred, params, fitted.scale, last)


N_TRIALS = 50
SCORED_AT_ONCE = 16384
SEARCHED_TRANSFORMS = ["none", "rolling_mean_4", "rolling_mean_13"]


def search_space(n_trials: int = N_TRIALS, seed: int = 42, max_iter: tuple[int, int] = (100, 1000)) -> list[TreeParams]:
    """Seeded random grid over lag preset, lag transform, target transform and booster parameters."""
    rng = random.Random(seed)
    return [
        TreeParams(
            lag_preset=rng.choice(sorted(L.LAG_PRESETS)),
            lag_transform=rng.choice(SEARCHED_TRANSFORMS),
            target_transform=rng.choice(L.TARGET_TRANSFORMS),
            step_size=round(10 ** rng.uniform(-2, -1), 4),
            max_iter=rng.randint(*max_iter),
            max_depth=rng.randint(5, 9),
            feature_fraction=round(rng.uniform(0.6, 1.0), 3),
            row_fraction=round(rng.uniform(0.6, 1.0), 3),
            seed=seed,
        )
        for _ in range(n_trials)
    ]


def with_places(dataset: DataFrame) -> DataFrame:
    """Add each row's distance from its series' end (``_back``) and the series' length (``_rows``)."""
    order, whole = Window.partitionBy("unique_id").orderBy(F.col("ds").desc()), Window.partitionBy("unique_id")
    return dataset.withColumns({"_back": F.row_number().over(order) - 1, "_rows": F.count(F.lit(1)).over(whole)})


def window_parts(placed: DataFrame, w: int, h: int, step: int) -> tuple[DataFrame, DataFrame]:
    """Training and test rows of one window, counted back from each series' own end; a series without
    training rows takes no part in it."""
    end = w * step
    inside = placed.where(F.col("_rows") - h - end >= 1)
    train = inside.where(F.col("_back") >= h + end)
    test = inside.where(F.col("_back").between(end, end + h - 1))
    return train.drop("_back", "_rows"), test.drop("_back", "_rows")


def gain_importance(fitted: TreeFit, spark) -> DataFrame:
    """Split-gain importance per feature, largest first (one row per feature)."""
    pairs = list(zip(fitted.features, [float(v) for v in fitted.model.importances]))
    return spark.createDataFrame(pairs, "feature string, gain double")


def permutation_importance(fitted: TreeFit, dataset: DataFrame, seed: int = 42) -> DataFrame:
    """Rise of the squared error when one feature column is shuffled.

    Rows are numbered in a hash order and in key order; the row with the same number lends its
    feature values. One join serves all features; where the row lies it is then scored for each feature,
    by the trees that ask for it. Rows travel as one byte per feature (``Ensemble.coded``).
    """
    params = fitted.params
    prepared = _with_target(dataset, params, fitted.scale)
    matrix = L.training_matrix(prepared, L.LAG_PRESETS[params.lag_preset], params.lag_transform)
    rows = _assemble(matrix.where(F.col("y").isNotNull()), fitted.features).select(
        "unique_id", "ds", "y", fitted.model.code(vector_to_array("features")).alias("x"))
    mixed = F.xxhash64("unique_id", "ds", F.lit(seed))
    numbered = global_row_number(rows.withColumn("_h", mixed), ["unique_id", "ds"], "_i")
    lenders = global_row_number(numbered.select("_h", "unique_id", "ds", F.col("x").alias("x2")),
                                ["_h", "unique_id", "ds"], "_i").select("_i", "x2")
    paired = numbered.join(lenders, "_i")
    model = fitted.model

    def errors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for start in range(0, b.num_rows, SCORED_AT_ONCE):
                part = b.slice(start, SCORED_AT_ONCE)
                codes, codes2 = (np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint8).reshape(part.num_rows, -1) for c in ("x", "x2"))
                found = model.coded_errors(codes, codes2, part.column("y").to_numpy())
                yield pa.RecordBatch.from_pydict({"f": pa.array(range(len(found)), pa.int32()), "e": found, "n": pa.array([part.num_rows] * len(found), pa.int64())})

    sums = paired.select("y", "x", "x2").mapInArrow(errors, "f int, e double, n long")
    mse = sums.groupBy("f").agg((F.sum("e") / F.sum("n")).alias("mse"))
    found = {r["f"]: r["mse"] for r in mse.collect()}  # one row per feature
    rises = [(name, found[k] - found[0]) for k, name in enumerate(fitted.features, 1) if k in found]
    return dataset.sparkSession.createDataFrame(rises, "feature string, mse_rise double")


def feature_importance(fitted: TreeFit, dataset: DataFrame, top: int = 20, seed: int = 42) -> DataFrame:
    """Gain and permutation importance side by side, the ``top`` features by permutation."""
    gain = gain_importance(fitted, dataset.sparkSession)
    return permutation_importance(fitted, dataset, seed).join(gain, "feature").orderBy(
        F.col("mse_rise").desc(), "feature").limit(top)


def params_from(values: Mapping[str, object]) -> TreeParams:
    """Known parameters (for a refit without search); unknown names are ignored."""
    return TreeParams(**{k: v for k, v in values.items() if k in TreeParams.__dataclass_fields__})
