"""The training run and the tree model's search."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import MONDAY, SF
from weekloom.operators import evaluation as EV, tree_search as TS, trees as TR
from weekloom.plans.modelling import Modelling
from weekloom.sources import sinks as K
from weekloom.sources.retail import RetailTables


def test_prediction_needs_a_run(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        Modelling(RetailTables(spark, SF)).predict(f"{tmp_path}/absent")


def test_train_then_predict(spark, tmp_path):
    model = Modelling(RetailTables(spark, SF))
    params = TR.TreeParams(max_iter=2, max_depth=3)
    few = {"erratic": ["CrostonOptimized", "SeasonalES"], "intermittent": ["TSB", "ADIDA"], "lumpy": ["TSB"]}
    path = f"{tmp_path}/run"
    backtest = model.train(path, tree_params=params, candidates=few, n_windows=2)
    runs = {r["demand_type"]: r for r in K.read_metadata(spark, path).collect()}
    kinds = {r["demand_type"] for r in backtest.select("demand_type").distinct().collect()}
    assert kinds == set(runs) and runs["smooth"]["model_col"] == "GBT"
    assert json.loads(runs["smooth"]["best_params"])["max_iter"] == 2
    assert all(runs[k]["cv_wape"] is not None and runs[k]["model_col"] in few[k] for k in kinds - {"smooth"})
    shown = backtest.groupBy("demand_type").agg(F.count("y_pred").alias("n")).collect()
    assert all(r["n"] > 0 for r in shown)
    forecast = model.predict(path)
    assert {(r[0], r[1]) for r in forecast.select("demand_type", "model").distinct().collect()} == {(k, r["model_col"]) for k, r in runs.items() if k in kinds}


def test_each_tree_type_keeps_its_own_parameters(spark, tmp_path):
    model = Modelling(RetailTables(spark, SF))
    params = {"smooth": TR.TreeParams(max_iter=2, max_depth=3), "lumpy": TR.TreeParams(max_iter=1, max_depth=2, target_transform="none")}
    few = {"smooth": ["TSB"], "erratic": ["TSB"], "intermittent": ["TSB"], "lumpy": ["TSB"]}
    backtest = model.train(f"{tmp_path}/run", tree_types=("smooth", "lumpy"), tree_params=params, candidates=few, n_windows=2)
    runs = {r["demand_type"]: r for r in K.read_metadata(spark, f"{tmp_path}/run").collect()}
    kinds = {r[0] for r in backtest.select("demand_type").distinct().collect()} & set(params)
    assert kinds
    for kind in kinds:
        assert json.loads(runs[kind]["best_params"])["max_iter"] == params[kind].max_iter
        assert runs[kind]["class"] == "GlobalTrees"
    assert {runs[k]["class"] for k in set(runs) - set(params)} <= {"PerSeries"}


@pytest.mark.parametrize("n,sizes", [(50, [50, 13, 4]), (4, [4]), (17, [17, 5, 2])])
def test_rungs(n, sizes):
    rungs = TS.ladder(n, 6)
    assert [r.trials for r in rungs] == sizes
    assert rungs[-1].windows == 6 and rungs[-1].trees is None
    assert all(a.windows < b.windows and a.trees < (b.trees or 10**9) for a, b in zip(rungs, rungs[1:]))


def test_search_ends_with_a_finalist(spark):
    data = rows(spark, {"a": 70, "b": 64, "c": 90})
    trials = [TR.TreeParams(**{**vars(t), "lag_preset": "short"}) for t in TR.search_space(6, max_iter=(2, 4))]
    found = TS.search(data, trials, ["x"], 4, n_windows=2, eta=3, first_trees=1)
    got = sorted(found.collect(), key=lambda r: (r["rung"], r["trial"]))
    first, last = [r for r in got if r["rung"] == 0], [r for r in got if r["is_final"]]
    assert len(first) == 6 and len(last) == 2 and {r["n_windows"] for r in last} == {2} and {r["trees"] for r in first} == {1}
    best = sorted(first, key=lambda r: (r["mase"], r["trial"]))[:2]
    assert {r["trial"] for r in last} == {r["trial"] for r in best}
    winner = min(last, key=lambda r: (r["mase"], r["trial"]))
    chosen = TS.best_params(found)
    assert (chosen.max_depth, chosen.step_size, chosen.max_iter) == (winner["max_depth"], winner["step_size"], winner["trees"])


@pytest.mark.parametrize("target", ["none", "log1p", "detrend", "normalize"])
def test_columns_of_a_trial_are_those_of_a_single_fit(spark, target):
    data = rows(spark, {"a": 60, "b": 50})
    params = TR.TreeParams(lag_preset="short", lag_transform="rolling_mean_4", target_transform=target, max_iter=1)
    search = TS.TreeSearch(data, ["x"], 4, n_windows=2)
    train, _ = TR.window_parts(TR.with_places(data), 1, 4, 1)
    scale = TS.L.series_scale(train)
    want = TS.L.training_matrix(TR._with_target(train, params, scale), TS.L.LAG_PRESETS["short"], "rolling_mean_4")
    want = TR._assemble(want.where("y is not null"), TR.feature_names(params, ["x"])).select("unique_id", "ds", F.col("y").alias("z"), "features")
    got = search.matrix(params, 1).where("not _test and z is not null").select("unique_id", "ds", "z", "features")
    key = lambda r: (r[0], r[1])
    for a, b in zip(sorted(got.collect(), key=key), sorted(want.collect(), key=key), strict=True):
        assert key(a) == key(b) and a["z"] == pytest.approx(b["z"]) and a["features"].toArray() == pytest.approx(b["features"].toArray())


def rows(spark, lengths, seed=1):
    draw = random.Random(seed)
    data = [(k, MONDAY + dt.timedelta(weeks=w), float(draw.randint(5, 20)), draw.choice([None, -1.0, 0.0])) for k, n in lengths.items() for w in range(n)]
    return spark.createDataFrame(data, "unique_id string, ds date, y double, x double")


def test_windows_count_back_from_each_series_own_end(spark):
    data = rows(spark, {"a": 12, "b": 5, "c": 30})
    want = EV.rolling_windows(data, 4, 3, 1).select("unique_id", "window", "ds", "is_test")
    placed = TR.with_places(data)
    got = None
    for w in range(3):
        for part, is_test in zip(TR.window_parts(placed, w, 4, 1), (False, True)):
            part = part.select("unique_id", F.lit(w).alias("window"), "ds", F.lit(is_test).alias("is_test"))
            got = part if got is None else got.unionByName(part)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_a_series_shorter_than_its_lags_has_no_forecast(spark):
    data = rows(spark, {"long": 90, "other": 80, "short": 30})
    params = TR.TreeParams(lag_preset="long", lag_transform="none", max_iter=2, max_depth=2)
    fitted = TR.fit(data, params, ["x"])
    future = spark.createDataFrame([], "unique_id string, ds date, x double")
    got = {}
    for r in TR.predict(fitted, data, future, 4).collect():
        got.setdefault(r["unique_id"], []).append(r["y_pred"] is None)
    assert got == {"long": [False] * 4, "other": [False] * 4, "short": [True] * 4}


def test_missing_is_not_a_value(spark):
    data = spark.createDataFrame([(-1.0,), (0.0,), (None,)], "x double")
    vectors = [tuple(r["features"]) for r in TR._assemble(data, ["x", TR.missing_flag("x")]).collect()]
    assert vectors == [(-1.0, 0.0), (0.0, 0.0), (0.0, 1.0)]
