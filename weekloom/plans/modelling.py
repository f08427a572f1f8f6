"""Training, backtest and final forecast over the refined panel."""

from __future__ import annotations

import functools
import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict
from functools import cached_property

from pyspark.sql import Column, DataFrame, functions as F

from weekloom.operators import dimensions as DIM, evaluation as EV, features as FE, forecasters as FC, panel as P
from weekloom.operators import inventory as INV, lags as L, plugins as PL, quantile_regression as QR, tree_search as TS, trees as TR
from weekloom.plans import preparation as PREP
from weekloom.sources import holidays as H, sinks as K
from weekloom.session import pin, setting, shuffles_cleaned, unpin
from weekloom.sources.retail import RetailTables

HORIZON = 4
TREE_MODEL = "GBT"
YEAR_WINDOWS = 13  # windows of 4 weeks
JOIN_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"  # "false": a join by series and week takes rows that lie by series as they are

# demand types whose default forecaster is the global tree model
TREE_TYPES = {"smooth"}

# per-series methods known to suit each type, for runs without a search
PER_SERIES_MODELS = {
    "smooth": "SeasonalES", "erratic": "CrostonOptimized", "intermittent": "TSB", "lumpy": "TSB",
}
TREE_FEATURES = [*FE.STATIC_COLUMNS, *FE.HOLIDAY_COLUMNS, *FE.WEATHER_COLUMNS]


# one setting for all tree types, or one for each
TreeChoice = TR.TreeParams | Mapping[str, TR.TreeParams] | None


def params_of(choice: TreeChoice, kind: str) -> TR.TreeParams:
    if isinstance(choice, Mapping):
        choice = choice.get(kind)
    return choice or TR.TreeParams()


def model_for(demand_type: str, chosen: Mapping[str, str] | None = None) -> str:
    """Method of a demand type: the chosen one, else trees for the tree types, else the default."""
    if chosen and demand_type in chosen:
        return chosen[demand_type]
    return TREE_MODEL if demand_type in TREE_TYPES else FC.DEFAULT_MODEL


class Modelling:
    """Panel, feature tables and model runs over one folder of retail tables."""

    def __init__(self, tables: RetailTables, h: int = HORIZON):
        self.tables = tables
        self.h = h

    @cached_property
    def series(self) -> DataFrame:
        """The refined series, written once: panel, packed series and span all read them."""
        return pin(PREP.refined_series(self.tables))

    @cached_property
    def panel(self) -> DataFrame:
        return PREP.unpacked(self.series)

    @cached_property
    def packed(self) -> DataFrame:
        """One row per series, read without an exchange: as ``FC.pack`` makes of the panel."""
        # only where a date comes twice the order by week leaves something open
        even = F.col("n") == F.datediff("last_ds", F.col("weeks")[0]) / 7 + 1
        values = F.when(even, F.col("values")).otherwise(F.sort_array(F.arrays_zip("weeks", "values"))["values"])
        return self.series.select("unique_id", "demand_type", "last_ds", values.cast("array<double>").alias("ys"), "n")

    @cached_property
    def span(self) -> DataFrame:
        """First and last week of the panel: one row, written once because many steps ask for it."""
        return pin(self.series.agg(F.min(F.array_min("weeks")).alias("ds_min"), F.max("last_ds").alias("ds_max")))

    @property
    def cutoff(self) -> Column:
        """Last training week of the hold-out split."""
        return self.span.select(F.date_sub("ds_max", 7 * self.h)).scalar()

    # -- features --------------------------------------------------------------

    @cached_property
    def static(self) -> DataFrame:
        """Supplier, region and product codes of each series; -1 where a level has no product."""
        products = DIM.product_dimension(self.tables.sold_products()).drop("product_name")
        part = F.split("unique_id", "/")
        valid = PREP.series_segments(self.tables).where(F.col("segment") == "valid")
        ids = valid.select(
            "unique_id", part[0].cast("bigint").alias("supplier_id"),
            F.try_element_at(part, F.lit(2)).alias("product_id"))
        rows = (
            ids.join(self.tables.supplier_regions().drop("region"), "supplier_id", "left")
            .join(FE.ordinal_codes(products, *FE.STATIC_COLUMNS[:3]), "product_id", "left")
        )
        codes = {c: F.coalesce(c, F.lit(-1)) for c in FE.STATIC_COLUMNS[:3]}
        return FE.static_features(rows.withColumns(codes))

    @cached_property
    def weeks(self) -> DataFrame:
        return FE.weeks_through_horizon(self.span, self.h)

    @cached_property
    def holidays(self) -> DataFrame:
        source = H.holiday_table(H.years_covered(self.tables.date_bounds(), "date", self.h))
        return FE.holiday_features(self.weeks, source, H.region_states(self.tables.spark))

    @cached_property
    def weather(self) -> DataFrame:
        weekly = FE.weekly_weather(self.tables.weather_daily())
        return FE.shifted_weather(weekly, self.span, self.h)

    @cached_property
    def dataset(self) -> DataFrame:
        """Panel with static, holiday and weather columns."""
        return FE.assemble(self.panel, self.static, self.holidays, self.weather)

    def of_type(self, demand_type: str) -> DataFrame:
        """The assembled dataset of one demand type."""
        rows = self.panel.where(F.col("demand_type") == demand_type)
        return FE.assemble(rows, self.static, self.holidays, self.weather)

    @cached_property
    def future_exogenous(self) -> DataFrame:
        """Static, holiday and weather columns of the ``h`` weeks after each series."""
        return FE.assemble(P.future_weeks(self.panel, self.h), self.static, self.holidays, self.weather)

    # -- runs ------------------------------------------------------------------

    @cached_property
    def held_out(self) -> DataFrame:
        return EV.packed_naive_scale(EV.hold_out(self.packed, self.cutoff))

    def backtest(self, models: Mapping[str, str] = PER_SERIES_MODELS, run_date: Column | None = None,
                 tree_params: TreeChoice = None) -> DataFrame:
        """Test weeks with the model's and the baseline's forecast: per-series methods aligned by position,
        the tree model by date."""
        run_date = F.current_date() if run_date is None else run_date
        parts = []
        per_series = {k: m for k, m in models.items() if m != TREE_MODEL}
        if per_series:
            parts.append(self._per_series_backtest(per_series, run_date))
        for kind in (k for k, m in models.items() if m == TREE_MODEL):
            # the baseline's test weeks, their forecast column replaced by the trees'
            base = self._per_series_backtest({kind: FC.BASELINES[kind]}, run_date).drop("y_pred")
            pred = self.tree_hold_out(kind, params_of(tree_params, kind))
            rows = base.join(pred, ["unique_id", "ds"], "left").withColumn("model", F.lit(TREE_MODEL))
            parts.append(rows.select("unique_id", "ds", "y", "y_pred", *base.columns[3:]))
        return functools.reduce(DataFrame.unionByName, parts)

    def tree_hold_out(self, demand_type: str, params: TR.TreeParams) -> DataFrame:
        """``unique_id, ds, y_pred`` of the test weeks from trees fitted on the training weeks."""
        rows = self.of_type(demand_type)
        train = rows.where(F.col("ds") <= self.cutoff)
        fitted = TR.fit(train, params, TREE_FEATURES)
        exogenous = rows.where(F.col("ds") > self.cutoff).select("unique_id", "ds", *TREE_FEATURES)
        return TR.predict(fitted, train, exogenous, self.h).select("unique_id", "ds", "y_pred")

    def _per_series_backtest(self, models: Mapping[str, str], run_date: Column) -> DataFrame:
        modelled = FC.route(self.held_out, models, self.h, "_model")
        kinds = list(models)
        based = FC.route(modelled.withColumnRenamed("model", "_name"),
                         {k: FC.BASELINES[k] for k in kinds}, self.h, "_base")
        rows = EV.test_rows(based, {"y_pred": "_model", "y_baseline": "_base"},
                            ["unique_id", "demand_type", "_name", "model", "naive_mae"])
        return rows.select(
            "unique_id", "ds", "y", "y_pred", "y_baseline", "demand_type", F.col("_name").alias("model"),
            F.col("model").alias("baseline_model"), "naive_mae", self.cutoff.alias("ref_date"), run_date.alias("run_date"))

    def scores(self, backtest: DataFrame) -> DataFrame:
        """Mean metrics per demand type for ``Baseline`` and ``Trained``, from one pass over the rows."""
        sides = F.array(
            F.struct(F.lit("Baseline").alias("model"), F.col("y_baseline").alias("p")),
            F.struct(F.lit("Trained").alias("model"), F.col("y_pred").alias("p")))
        long = backtest.select("unique_id", "demand_type", "y", "naive_mae", F.explode(sides).alias("s")).select(
            "unique_id", "demand_type", "y", "naive_mae", "s.model", F.col("s.p").alias("y_pred"))
        per = EV.series_metrics(long, group=("demand_type", "model"))
        return EV.mean_metrics(per, ("demand_type", "model"))

    def choose(self, candidates: Mapping[str, Sequence[str]] = FC.CANDIDATES, n_windows: int = EV.N_WINDOWS) -> DataFrame:
        """Winner per demand type by cross-validation on the training part."""
        train = self.held_out.drop("actual", "naive_mae")
        scores = EV.candidate_scores(train, candidates, self.h, n_windows)
        kinds = self.tables.spark.range(1).select(
            F.explode(F.array(*[F.lit(k) for k in candidates])).alias("demand_type"))
        return EV.select_models(scores, kinds)

    def final_forecast(self, models: Mapping[str, str], run_date: Column | None = None,
                       tree_params: TreeChoice = None) -> DataFrame:
        """Refit on the full history with known methods and forecast ``h`` weeks per series."""
        run_date = F.current_date() if run_date is None else run_date
        chosen = {k: model_for(k, models) for k in models}
        per_series = {k: m for k, m in chosen.items() if m != TREE_MODEL}
        parts = []
        if per_series:
            routed = FC.route(self.packed, per_series, self.h, "_fc")
            parts.append(FC.unpack(routed, "_fc", ["unique_id", "demand_type", "model"]))
        for kind in (k for k, m in chosen.items() if m == TREE_MODEL):
            pred = self.tree_forecast(kind, params_of(tree_params, kind))
            parts.append(pred.withColumns({"demand_type": F.lit(kind), "model": F.lit(TREE_MODEL)}))
        out = functools.reduce(DataFrame.unionByName, [p.select("unique_id", "ds", "y_pred", "demand_type", "model") for p in parts])
        ref = self.span.select("ds_max").scalar()
        return out.select("unique_id", "ds", "y_pred", "demand_type", "model", ref.alias("ref_date"),
                          run_date.alias("run_date"))

    def tree_forecast(self, demand_type: str, params: TR.TreeParams) -> DataFrame:
        rows = self.of_type(demand_type)
        fitted = TR.fit(rows, params, TREE_FEATURES)
        return TR.predict(fitted, rows, self.future_exogenous.drop("y"), self.h)

    def metadata(self, backtest: DataFrame, chosen: DataFrame, freq: str = "W-MON",
                 n_windows: int = EV.N_WINDOWS) -> DataFrame:
        """One metadata row per demand type: metrics of both sides, improvement, method and CV score."""
        scores = self.scores(backtest)
        fields = ["mase", "smape", "wape", "n_series"]
        sides = scores.groupBy("demand_type").agg(
            F.max(F.when(F.col("model") == "Baseline", F.struct(*fields))).alias("baseline_metrics"),
            F.max(F.when(F.col("model") == "Trained", F.struct(*fields))).alias("model_metrics"),
            EV.improvement_expr().alias("delta_wape_pct"))
        return sides.join(
            F.broadcast(chosen.withColumnRenamed("model", "model_col")), "demand_type", "left").select(
            "demand_type", F.when(F.col("model_col") == TREE_MODEL, "GlobalTrees").otherwise("PerSeries").alias("class"),
            F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("saved_at"),
            F.lit(freq).alias("freq"), F.lit(self.h).alias("horizon"), F.lit(n_windows).alias("n_windows"),
            "baseline_metrics", "model_metrics", F.round("delta_wape_pct", 2).alias("delta_wape_pct"),
            "model_col", "cv_wape", "best_params")

    def train(self, path: str, tree_types: Sequence[str] = tuple(TREE_TYPES), tree_params: TreeChoice = None,
              trials: Sequence[TR.TreeParams] | None = None, candidates: Mapping[str, Sequence[str]] = FC.CANDIDATES,
              n_windows: int = EV.N_WINDOWS, run_date: Column | None = None) -> DataFrame:
        """A training run: choose a model per demand type, backtest it against the baseline, write the metadata
        to ``path`` and return the backtest.

        Per-series types take the winner of cross-validation over ``candidates``. Each tree type takes its ``tree_params`` where given, else the
        best of ``trials`` (by default the whole search space) on its training part.
        """
        kinds = [k for k in candidates if k not in tree_types]
        winners = self.choose({k: candidates[k] for k in kinds}, n_windows).collect()  # one row per demand type
        rows = [(r["demand_type"], r["model"], r["cv_wape"], None) for r in winners]
        chosen_params: dict[str, TR.TreeParams] = {}
        for kind in tree_types:
            if tree_params is None:
                train = self.of_type(kind).where(F.col("ds") <= self.cutoff)
                found = TS.search(train, TR.search_space() if trials is None else trials, TREE_FEATURES, self.h, n_windows)
                chosen_params[kind] = TS.best_params(found)
            else:
                chosen_params[kind] = params_of(tree_params, kind)
            rows.append((kind, TREE_MODEL, None, json.dumps(asdict(chosen_params[kind]))))
        chosen = self.tables.spark.createDataFrame(rows, "demand_type string, model string, cv_wape double, best_params string")
        backtest = pin(self.backtest({k: m for k, m, *_ in rows}, run_date, chosen_params))
        K.write_metadata(self.metadata(backtest, chosen, n_windows=n_windows), path)
        return backtest

    def predict(self, path: str, run_date: Column | None = None) -> DataFrame:
        """The final forecast with the models and parameters of the run whose metadata lie at ``path``.

        Raises where there are none: without a training run there is nothing to predict with.
        """
        runs = K.read_metadata(self.tables.spark, path).select("demand_type", "model_col", "best_params").collect()
        if not runs:
            raise FileNotFoundError(f"no run metadata at {path}; train first")
        params = {r["demand_type"]: TR.params_from(json.loads(r["best_params"])) for r in runs if r["best_params"]}
        return self.final_forecast({r["demand_type"]: r["model_col"] for r in runs}, run_date, params)

    # -- users' models -----------------------------------------------------------

    def fit_custom(self, name: str, path: str, training_part: bool = False) -> str:
        """Fit a registered model on every series (or its training part) and write the states to ``path``."""
        return K.write_table(PL.fit_states(self.held_out if training_part else self.packed, name), path)

    def predict_custom(self, name: str, path: str) -> DataFrame:
        """``h`` weeks after every series from the states at ``path``, without refitting; NULL for series without one."""
        return PL.predict_saved(self.packed, self.tables.spark.read.parquet(path), name, self.h)

    # -- quantiles -------------------------------------------------------------

    def residual_rows(self, held_out: DataFrame, models: Mapping[str, str], n_windows: int) -> DataFrame:
        """Point forecasts of rolling windows inside the training part, with their dates."""
        where: dict[str, Column] = {}
        for kind, model in models.items():
            where[model] = where.get(model, F.lit(False)) | (F.col("demand_type") == kind)
        cv = EV.cv_forecasts(held_out.drop("actual"), where, self.h, n_windows, self.h, keep=("unique_id", "demand_type", "naive_mae"))
        ds = F.date_add("last_ds", F.col("step") * 7).alias("ds")
        return pin(cv.select("unique_id", "demand_type", ds, "y", "y_pred", "naive_mae"))  # ranks over the residuals read them several times

    def point_rows(self, held_out: DataFrame, models: Mapping[str, str]) -> DataFrame:
        return EV.test_rows(FC.route(held_out, models, self.h, "_fc"), {"y_pred": "_fc"}, ["unique_id", "demand_type", "naive_mae"])

    def quantile_rows(self, models: Mapping[str, str] = PER_SERIES_MODELS, n_windows: int = EV.N_WINDOWS) -> DataFrame:
        """Test weeks with point forecast, quantiles and safety stock; residuals come from rolling
        windows inside the training part."""
        # the packed series feed both the residual windows and the point forecast
        held_out = pin(self.held_out)
        residuals = INV.residual_quantiles(self.residual_rows(held_out, models, n_windows))
        return INV.safety_stock(INV.quantile_forecast(self.point_rows(held_out, models), residuals))

    def recent_lags(self, weeks: int) -> DataFrame:
        """Lags and rolling means of the last ``weeks`` weeks up to each series' end, written once. Only as many weeks before them are
        unpacked as the longest lag with its mean reaches back."""
        preset, mean = L.LAG_PRESETS["medium"], "rolling_mean_4"
        reach = weeks + max(preset) + L.LAG_TRANSFORMS[mean]
        near = F.filter(F.arrays_zip("weeks", "values"), lambda r: r["weeks"].isNull() | (r["weeks"] >= F.date_sub("last_ds", 7 * reach)))
        ends = self.series.withColumn("_near", near).withColumns({"weeks": F.col("_near.weeks"), "values": F.col("_near.values"), "n": F.size("_near")})
        since = self.series.select("unique_id", F.date_sub("last_ds", 7 * weeks).alias("_since"))
        rows = PREP.unpacked(ends.drop("_near")).select("unique_id", "ds", F.col("y").cast("double").alias("y"))
        return pin(L.with_lags(rows, preset, mean).drop("y").join(since, "unique_id").where(F.col("ds") >= F.col("_since")).drop("_since"))

    def quantile_features(self, rows: DataFrame, known: DataFrame) -> DataFrame:
        """Feature columns of forecast rows (``unique_id, ds, demand_type, y_pred, naive_mae``): lags and rolling means (``known``) in units of
        the series' naive error, season, holidays, weather. A lag before the series' start counts as the forecast; what is not known of
        a week counts as 0 and is flagged."""
        lags = L.lag_columns(L.LAG_PRESETS["medium"], "rolling_mean_4")
        # the region comes first: its exchange by series then moves no lags
        placed = FE.assemble(rows.withColumn("_type", F.col("demand_type")), self.static.select("unique_id", "region_id"))
        out = FE.with_weeks(placed.join(known, ["unique_id", "ds"], "left"), self.holidays, self.weather)
        unit = F.col("naive_mae")
        exogenous = [*FE.HOLIDAY_COLUMNS, *FE.WEATHER_COLUMNS]
        return out.withColumns({
            "x_point": F.col("y_pred") / unit,
            **{f"x_{c}": F.coalesce(c, "y_pred") / unit for c in lags},
            **{f"x_{k}": (F.col("_type") == k).cast("double") for k in FC.CANDIDATES},
            **{f"x_{n}": c for n, c in QR.harmonics("ds").items()},
            **{f"x_{c}": F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in exogenous},
            "x_unknown": F.col(FE.WEATHER_COLUMNS[0]).isNull().cast("double"),
        }).withColumnRenamed("_type", "demand_type")

    def quantile_regression(self, models: Mapping[str, str] = PER_SERIES_MODELS, n_windows: int = YEAR_WINDOWS,
                            probs: Mapping[str, float] = INV.QUANTILES) -> tuple[QR.QuantileFit, DataFrame]:
        """Quantiles that depend on the features of series and week: the fit and the test weeks with them.

        The windows span a year, as season, holidays and weather have as many values as there are weeks. The target is the value in units of the series' naive error. The fit starts from the rule of ``quantile_rows`` (point forecast
        plus the type's residual quantile), of which it is a generalisation. Quantiles are at least 0, as sales are. A series without a naive
        error does not vary, so its quantiles are the point forecast.
        """
        held_out = pin(self.held_out)
        cv = self.residual_rows(held_out, models, n_windows)
        with shuffles_cleaned(self.tables.spark):
            residuals = INV.residual_quantiles(cv, probs).collect()  # one row per demand type
        start = {q: {"x_point": 1.0, **{f"x_{r['demand_type']}": r[f"r_{q}"] for r in residuals}} for q in probs}
        known = self.recent_lags(self.h * (n_windows + 1))
        # all rows of a series go to one task once, for the joins by series and by week
        train = self.quantile_features(cv.repartition("unique_id"), known.repartition("unique_id"))
        names = [c for c in train.columns if c.startswith("x_")]
        with setting(self.tables.spark, JOIN_KEYS, "false"):
            fitted = QR.fit(train, {c: F.col(c) for c in names}, F.col("y") / F.col("naive_mae"), probs, start,
                            near=[F.xxhash64("unique_id"), F.unix_date("ds").cast("long")])
        unpin(cv)
        rows = self.quantile_features(self.point_rows(held_out, models), known)
        flat = F.col("naive_mae").isNull()
        quantiles = {q: F.when(flat, F.col("y_pred")).otherwise(F.greatest(c, F.lit(0.0))) for q, c in fitted.ordered(F.col("naive_mae")).items()}
        out = rows.withColumns(quantiles).select("unique_id", "demand_type", "ds", "y", "y_pred", *probs)
        return fitted, INV.safety_stock(out)
