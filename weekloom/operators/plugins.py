"""Users' own per-series models: fitted once, kept as one state row per series, asked later without refitting.

A registered model is a method like any other: its name may stand among the candidates of a choice, in a backtest and in a final
forecast, where it is fitted on the values at hand. ``fit_states`` and ``predict_saved`` split the two halves: states are a plain table
that can be written, read back and joined with a longer history. Both halves are map-only over packed series.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from weekloom.operators import forecasters as FC


class SeriesModel(Protocol):
    """What a user writes; instances travel to the executors, so they hold settings only."""

    version: str  # states of another version are not used

    def fit(self, values: Sequence[float]) -> bytes:
        """The state of one series; ``values`` are its weeks in order, at least one."""

    def predict(self, state: bytes, values: Sequence[float], h: int) -> Sequence[float]:
        """``h`` numbers after ``values``, which may reach further than what the state was fitted on."""


MODELS: dict[str, SeriesModel] = {}


def register(name: str, model: SeriesModel) -> None:
    """Make ``model`` known as ``name``; a name of a built-in method is refused."""
    if name in FC.FORECASTERS:
        raise ValueError(f"{name!r} is a built-in method")
    MODELS[name] = model
    FC.PLUGINS[name] = lambda h: _forecast_udf(model, h)(F.col("ys"))


def unregister(name: str) -> None:
    del MODELS[name], FC.PLUGINS[name]


def model_of(name: str) -> SeriesModel:
    if name not in MODELS:
        raise KeyError(f"unknown model {name!r}; known: {sorted(MODELS)}")
    return MODELS[name]


def _checked(made: Sequence[float], h: int) -> list[float | None]:
    """The forecast as a list; a value that is no finite number is NULL."""
    if len(made) != h:
        raise ValueError(f"the model gave {len(made)} values for {h} weeks")
    return [float(v) if v is not None and math.isfinite(v) else None for v in made]


def _forecast_udf(model: SeriesModel, h: int):
    @F.pandas_udf("array<double>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in batches:
            yield pd.Series([None if ys is None or not len(ys) else _checked(model.predict(model.fit(ys), ys, h), h) for ys in series], dtype=object)
    return run


def fit_states(packed: DataFrame, name: str) -> DataFrame:
    """``unique_id, model, version, fitted_to, state``: one row per packed series that has values."""
    model = model_of(name)

    @F.pandas_udf("binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in batches:
            yield pd.Series([model.fit(ys) for ys in series], dtype=object)

    rows = packed.where(F.col("n") > 0)
    return rows.select("unique_id", F.lit(name).alias("model"), F.lit(model.version).alias("version"), F.col("last_ds").alias("fitted_to"),
                       run("ys").alias("state"))


def predict_saved(packed: DataFrame, states: DataFrame, name: str, h: int) -> DataFrame:
    """``unique_id, ds, y_pred, fitted_to``: ``h`` weeks after each packed series from its saved state.

    A series without a state of this model and version keeps its weeks, with NULL. History and states have one row per series each.
    """
    model = model_of(name)

    @F.pandas_udf("array<double>")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for kept, series in batches:
            yield pd.Series([None if state is None else _checked(model.predict(state, ys, h), h) for state, ys in zip(kept, series)], dtype=object)

    mine = states.where((F.col("model") == name) & (F.col("version") == model.version)).select("unique_id", "fitted_to", "state")
    nothing: Column = F.array_repeat(F.lit(None).cast("double"), h)
    made = packed.where(F.col("n") > 0).select("unique_id", "last_ds", "ys").join(mine, "unique_id", "left").withColumn(
        "_fc", F.coalesce(run("state", "ys"), nothing))
    return FC.unpack(made, "_fc", ["unique_id", "fitted_to"]).select("unique_id", "ds", "y_pred", "fitted_to")
