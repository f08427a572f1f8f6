"""Parameter search of the global tree model: successive halving over concurrent jobs, with early stopping inside each fit.

All lags and rolling means that any trial may ask for are computed once, over the raw, the logarithmic and the differenced series, and written;
a trial only selects columns of that table. The first rung fits every trial on one window with few trees. A share of the trials goes on to the
next rung, with more windows and more trees, and the last rung scores the finalists on all windows with as many trees as they ask for. Within a fit,
boosting ends when the error on the last weeks before the window no longer falls. The windows of a rung's trials are independent jobs that are submitted
from threads, each trial in a scheduler pool of its own, so that a FAIR scheduler shares the cluster among them.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass

from pyspark import inheritable_thread_target
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from weekloom.operators import boosting as B, evaluation as EV, lags as L, trees as TR
from weekloom.session import pin

ETA = 4
FIRST_TREES = 8
PARALLEL = 8
ONE_TASK = 3_000_000  # rows of a fit inside one task, at most: many fits go side by side and keep the cores busy, at some 60 bytes a row
BASES = {"none": "raw", "normalize": "raw", "log1p": "log", "detrend": "diff"}


@dataclass(frozen=True)
class Rung:
    """How many trials, on how many windows, with how many trees at most (None: as many as the trial asks for)."""

    trials: int
    windows: int
    trees: int | None


def ladder(n_trials: int, n_windows: int, eta: int = ETA, first_trees: int = FIRST_TREES) -> list[Rung]:
    """Rungs from all trials on one window to at most ``eta`` finalists on all windows."""
    sizes = [n_trials]
    while sizes[-1] > eta:
        sizes.append(math.ceil(sizes[-1] / eta))
    last = len(sizes) - 1
    grown = [round(n_windows ** (k / last)) if last else n_windows for k in range(len(sizes))]
    return [Rung(n, w, None if k == last else first_trees * eta**k) for k, (n, w) in enumerate(zip(sizes, grown))]


def wide_lags(dataset: DataFrame) -> DataFrame:
    """The dataset with every lag column of the search space, named ``<base>_<lag column>``."""
    y = F.col("y").cast("double")
    based = dataset.withColumns({"y": y, "log_y": L.boxcox(y)}).withColumn("diff_y", L.difference())
    lags = sorted({k for preset in L.LAG_PRESETS.values() for k in preset})
    columns: dict[str, Column] = {}
    for base, value in {"raw": "y", "log": "log_y", "diff": "diff_y"}.items():
        for transform in TR.SEARCHED_TRANSFORMS:
            columns |= {f"{base}_{name}": c for name, c in L.lag_columns(lags, transform, value=value).items()}
    return TR.with_places(based.withColumns({**columns, **L.date_columns()}))


class TreeSearch:
    """Trials over one assembled dataset (``unique_id, ds, y`` and exogenous columns)."""

    def __init__(self, dataset: DataFrame, exogenous: Sequence[str], h: int, n_windows: int = EV.N_WINDOWS, step: int = 1):
        self.exogenous, self.h, self.n_windows, self.step = list(exogenous), h, n_windows, step
        self.table = pin(wide_lags(dataset))
        self.naive = pin(EV.naive_scale(self.table))
        self.scales: dict[int, DataFrame] = {}

    def part(self, w: int) -> Column:
        """Rows of series that take part in a window."""
        return F.col("_rows") - self.h - w * self.step >= 1

    def scale(self, w: int) -> DataFrame:
        """Mean and deviation of the window's training rows, written once for all trials."""
        if w not in self.scales:
            self.scales[w] = pin(L.series_scale(self.table.where(self.part(w) & (F.col("_back") >= self.h + w * self.step))))
        return self.scales[w]

    def matrix(self, params: TR.TreeParams, w: int) -> DataFrame:
        """Feature vectors of a window's training and test rows with the transformed target ``z``."""
        base = BASES[params.target_transform]
        lags = list(L.lag_columns(L.LAG_PRESETS[params.lag_preset], params.lag_transform))
        rows = self.table.where(self.part(w) & (F.col("_back") >= w * self.step))
        values = {c: F.col(f"{base}_{c}") for c in lags} | {"z": F.col({"raw": "y", "log": "log_y", "diff": "diff_y"}[base])}
        if params.target_transform == "normalize":
            rows = rows.join(self.scale(w), "unique_id")
            values = {c: (v - F.col("scale_mean")) / F.col("scale_std") for c, v in values.items()}
        first = (w * self.step) + self.h
        out = rows.select("unique_id", "ds", "y", *L.date_columns(), *self.exogenous, *[v.alias(c) for c, v in values.items()],
                          (F.col("_back") < first).alias("_test"), (F.col("_back") < first + self.h).alias("_late"))
        complete = functools.reduce(Column.__and__, [F.col(c).isNotNull() for c in lags])
        return TR._assemble(out.where(complete), TR.feature_names(params, self.exogenous)).select("unique_id", "ds", "y", "z", "features", "_test", "_late")

    def window(self, params: TR.TreeParams, w: int, trees: int) -> tuple[DataFrame | None, int]:
        """Test weeks of a window with their forecasts, and the number of trees that were grown."""
        rows = self.matrix(params, w)
        train = rows.where(~F.col("_test") & F.col("z").isNotNull())
        counts = {r["_late"]: r["count"] for r in train.groupBy("_late").count().collect()}
        tested = self.table.where(self.part(w) & F.col("_back").between(w * self.step, w * self.step + self.h - 1)).select("unique_id", "ds", "y")
        if not counts:
            return tested.withColumn("y_pred", F.lit(None).cast("double")), 0
        validate = len(counts) == 2
        late = F.col("_late") if validate else F.lit(False)
        given = train.select(TR.row_key(), vector_to_array("features").alias("x"), F.col("z").alias("y"), late.alias("late"))
        model = B.fit(given, params.booster(trees), counts[False] if validate else sum(counts.values()), validate, ONE_TASK)
        pred = rows.where("_test").select("unique_id", "ds", model.predict(vector_to_array("features")).alias("y_pred"))
        last = self.table.where(F.col("_back") == w * self.step + self.h).select("unique_id", F.col("y").alias("last_y"))
        return EV.by_date(tested, TR._back_to_units(pred, params, self.scale(w), last)), model.n_trees

    def scored(self, found: Sequence[tuple[DataFrame, int]]) -> tuple[float | None, int, int]:
        """Mean MASE over a trial's windows, the series that have one, and the most trees grown."""
        per = EV.series_metrics(functools.reduce(DataFrame.unionByName, [rows for rows, _ in found]), self.naive)
        row = per.agg(F.avg("mase").alias("mase"), F.count("mase").alias("n_series")).first()
        return row["mase"], row["n_series"], max(n for _, n in found)

    def run(self, trials: Sequence[TR.TreeParams], eta: int = ETA, first_trees: int = FIRST_TREES, parallel: int | None = None) -> DataFrame:
        """One row per trial and rung it reached: ``trial, rung, params..., n_windows, trees, mase, n_series, is_final``."""
        spark, places = self.table.sparkSession, list(range(len(trials)))
        rungs, results = ladder(len(trials), self.n_windows, eta, first_trees), []
        for w in range(self.n_windows):
            self.scale(w)
        parallel = parallel or max(PARALLEL, spark.sparkContext.defaultParallelism)
        for k, rung in enumerate(rungs):
            places = places[:rung.trials]

            def submit(job: tuple[int, int]):
                i, w = job
                spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"search-{i}")
                return self.window(trials[i], w, min(trials[i].max_iter, rung.trees or trials[i].max_iter))

            # the trials with most trees begin first, so that none is waited for alone
            jobs = sorted(((i, w) for i in places for w in range(rung.windows)), key=lambda job: -trials[job[0]].max_iter)
            with ThreadPoolExecutor(parallel) as pool:
                found = dict(zip(jobs, pool.map(inheritable_thread_target(spark)(submit), jobs)))
                each = [[found[i, w] for w in range(rung.windows)] for i in places]
                scores = dict(zip(places, pool.map(inheritable_thread_target(spark)(self.scored), each)))
            results += [(i, k, *asdict(trials[i]).values(), rung.windows, grown, loss, n, k == len(rungs) - 1) for i, (loss, n, grown) in scores.items()]
            # the best go on; without a loss a trial comes last
            places = sorted(places, key=lambda i: (scores[i][0] is None, scores[i][0] or 0.0, i))
        return spark.createDataFrame(results, RESULT)


RESULT = ("trial int, rung int, lag_preset string, lag_transform string, target_transform string, step_size double, max_iter int, max_depth int, "
          "feature_fraction double, row_fraction double, seed int, n_windows int, trees int, mase double, n_series long, is_final boolean")


def search(dataset: DataFrame, trials: Sequence[TR.TreeParams], exogenous: Sequence[str], h: int, n_windows: int = EV.N_WINDOWS,
           **options) -> DataFrame:
    return TreeSearch(dataset, exogenous, h, n_windows).run(trials, **options)


def best_params(results: DataFrame) -> TR.TreeParams:
    """The finalist with the smallest loss, with as many trees as early stopping left it (one small row is fetched)."""
    row = results.where("is_final").orderBy(F.col("mase").asc_nulls_last(), "trial").first()
    kept: Mapping[str, object] = {f: row[f] for f in TR.TreeParams.__dataclass_fields__}
    return TR.TreeParams(**{**kept, "max_iter": max(row["trees"], 1)})
