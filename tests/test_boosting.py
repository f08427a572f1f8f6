"""Boosted trees over histograms."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from tests.conftest import MONDAY
from weekloom.operators import boosting as B, tree_search as TS, trees as TR

P = B.Booster(step_size=0.1, max_iter=12, max_depth=4, feature_fraction=0.7, row_fraction=0.75, seed=7)
N = 3000


@pytest.fixture(scope="module")
def data(spark):
    x = F.array(*[F.rand(i) for i in range(4)], F.pmod("id", F.lit(3)).cast("double"))
    rows = spark.range(0, N, 1, 3).select(F.col("id").alias("key"), x.alias("x"), (F.pmod("id", F.lit(10)) == 0).alias("late"))
    return rows.withColumn("y", F.sin(F.col("x")[0] * 6) * 3 + F.col("x")[1] + F.col("x")[4] + F.randn(5) * 0.1).localCheckpoint()


def error(rows, model):
    return rows.select(F.avg(F.pow(F.col("y") - model.predict("x"), F.lit(2)))).first()[0]


@pytest.mark.parametrize("validate", [False, True])
def test_trees_do_not_depend_on_how_rows_lie(data, validate):
    n = data.where(~F.col("late")).count() if validate else N
    one, spread = B.fit(data, P, n, validate), B.fit(data.repartition(5, "y"), P, n, validate, one_task=0)
    assert one.n_trees == spread.n_trees and (one.feature == spread.feature).all()
    assert spread.value == pytest.approx(one.value) and spread.importances == pytest.approx(one.importances)


def test_as_good_as_spark(data):
    booster = GBTRegressor(labelCol="y", stepSize=0.1, maxIter=12, maxDepth=4, featureSubsetStrategy="all", subsamplingRate=1.0, seed=7)
    vectors = data.withColumn("features", array_to_vector("x"))
    fitted = booster.fit(vectors)
    want = fitted.transform(vectors).select(F.avg(F.pow(F.col("y") - F.col("prediction"), F.lit(2)))).first()[0]
    model = B.fit(data, B.Booster(0.1, 12, 4, 1.0, 1.0, 7), N)
    assert model.n_trees == 12 and error(data, model) < 1.05 * want
    assert model.importances == pytest.approx(fitted.featureImportances.toArray(), abs=0.02)


@pytest.mark.parametrize("noise,step", [(0.1, 0.1), (30.0, 0.3)])
def test_ends_early_as_spark_does(data, noise, step):
    rows = data.withColumn("y", F.col("y") + noise * F.randn(11)).localCheckpoint()
    booster = GBTRegressor(labelCol="y", stepSize=step, maxIter=14, maxDepth=4, featureSubsetStrategy="all", subsamplingRate=1.0, seed=7,
                           validationIndicatorCol="late", validationTol=B.VALIDATION_TOLERANCE)
    want = booster.fit(rows.withColumn("features", array_to_vector("x"))).getNumTrees
    got = B.fit(rows, B.Booster(step, 14, 4, 1.0, 1.0, 7), rows.where(~F.col("late")).count(), True).n_trees
    assert abs(got - want) <= 1 and (got == 14) == (noise < 1)


def test_exact_on_a_step(spark):
    rows = spark.createDataFrame([(k, [float(k), 1.0], 5.0 if k < 4 else 9.0, False) for k in range(10)], "key long, x array<double>, y double, late boolean")
    model = B.fit(rows, B.Booster(0.1, 1, 3, 1.0, 1.0, 1), 10)
    assert [r[0] for r in rows.orderBy("key").select(model.predict("x")).collect()] == [5.0] * 4 + [9.0] * 6
    assert model.importances.tolist() == [1.0, 0.0] and model.threshold[0][0] == 3.5


def test_cut_points():
    assert B.cut_points(np.array([1.0, 3.0, 3.0, 7.0])).tolist() == [2.0, 5.0]
    assert B.cut_points(np.ones(9)).tolist() == []
    many = B.cut_points(np.arange(3200.0))
    assert len(many) == 31 and np.diff(many) == pytest.approx(100, abs=1)


def test_errors_of_swapped_features():
    rng = np.random.default_rng(1)
    x, x2, y = rng.random((50, 3)), rng.random((50, 3)), rng.random(50)
    feature, threshold = np.array([[0, 1, 0], [1, 0, 1]]), np.array([[0.5, 0.3, np.inf], [0.6, np.inf, 0.2]])
    model = B.Ensemble(np.array([1.0, 0.1]), feature, threshold, rng.random((2, 4)), np.ones((2, 3)))
    got = model.swapped_errors(x, x2, y)
    assert got[0] == pytest.approx(((y - model.score(x)) ** 2).sum()) and got[3] == pytest.approx(got[0])
    for f in range(3):
        mixed = x.copy()
        mixed[:, f] = x2[:, f]
        assert got[f + 1] == pytest.approx(((y - model.score(mixed)) ** 2).sum())


def series(spark):
    draw = random.Random(3)
    rows = [(k, MONDAY + dt.timedelta(weeks=w), float(draw.randint(5, 20)), draw.choice([None, 0.0, 1.0])) for k in "abc" for w in range(70)]
    return spark.createDataFrame(rows, "unique_id string, ds date, y double, x double")


def jobs(spark, group, run):
    spark.sparkContext.setJobGroup(group, group)
    run()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_jobs_do_not_grow_with_the_trees(spark):
    """a fit took several jobs for every tree."""
    rows = series(spark)
    few, many = (jobs(spark, f"fit-{n}", lambda: TR.fit(rows, TR.TreeParams(lag_preset="short", max_iter=n, max_depth=3), ["x"])) for n in (2, 30))
    assert few == many


def test_jobs_of_a_search_do_not_grow_with_the_trees(spark):
    """the finalists' fits took several jobs for every tree."""
    rows, found = series(spark), []
    for n in (2, 30):
        params = TR.TreeParams(lag_preset="short", max_iter=n, max_depth=3)
        search = TS.TreeSearch(rows, ["x"], 4, n_windows=1)
        search.scale(0)
        found.append(jobs(spark, f"search-{n}", lambda: search.window(params, 0, n)[0].collect()))
    assert found[0] == found[1]


@pytest.mark.parametrize("depth", [0, 3, 5, 7])
def test_errors_of_swapped_features_at_any_depth(depth):
    """rows are judged by one byte a feature."""
    rng = np.random.default_rng(depth)
    inner = 2**depth - 1
    x, x2, y = (rng.integers(0, 9, (60, 4)) / 8 for _ in range(3))
    y = y[:, 0]
    threshold = np.where(rng.random((3, inner)) < 0.2, np.inf, rng.integers(0, 9, (3, inner)) / 8)
    model = B.Ensemble(np.array([1.0, 0.1, 0.1]), rng.integers(0, 4, (3, inner)), threshold, rng.random((3, inner + 1)), np.ones((3, 4)))
    got = model.swapped_errors(x, x2, y)
    for f in range(-1, 4):
        mixed = x.copy()
        if f >= 0:
            mixed[:, f] = x2[:, f]
        assert got[f + 1] == pytest.approx(((y - model.score(mixed)) ** 2).sum())


def test_codes_are_bytes(spark):
    model = B.Ensemble(np.array([1.0]), np.array([[0, 1, 0]]), np.array([[0.5, 2.0, 0.25]]), np.arange(4.0)[None], np.ones((1, 2)))
    rows = spark.createDataFrame([([0.3, 2.0],), ([0.5, 3.0],), ([0.6, 0.0],)], "x array<double>")
    assert [list(r[0]) for r in rows.select(model.code("x")).collect()] == [[1, 0], [1, 1], [2, 0]]


def test_features_with_few_bins_share_a_table():
    """a table was counted for every feature, for constant ones too."""
    rng = np.random.default_rng(4)
    x = np.column_stack([np.zeros(500), rng.random((500, 2)), rng.integers(0, 2, (500, 5)), rng.integers(0, 12, 500), np.ones(500)])
    cuts = [B.cut_points(c) for c in x.T]
    packing = B.Packing(cuts)
    assert sorted(f for g in packing.groups for f in g) == list(range(1, 9)) and len(packing.groups) == 2
    key, y = np.arange(500, dtype=np.uint64), rng.random(500)
    rows = B._Rows(packing.codes(x, cuts), y, key, np.zeros(500, bool), np.zeros(500), packing).start(P, 0)
    rows.descend(np.array([8], np.int32), np.array([4], np.int32))
    right = x[:, 8] > cuts[8][4]
    assert (rows.node == right).all()
    sums, counts = np.zeros((10, 2 * B.BINS)), np.zeros((10, 2 * B.BINS), np.int64)
    B._add_up([rows], np.array([0, 1]), sums, counts)
    for f in range(10):
        at = (right * B.BINS + np.searchsorted(cuts[f], x[:, f]))[rows.used]
        assert counts[f].tolist() == np.bincount(at, minlength=2 * B.BINS).tolist()
        assert sums[f] == pytest.approx(np.bincount(at, y[rows.used], 2 * B.BINS))


def test_exchanges_move_codes(data, monkeypatch):
    """rows went to their task as 8 bytes a feature."""
    seen = []
    real = type(data).repartition
    monkeypatch.setattr(type(data), "repartition", lambda self, *a: seen.append(self.dtypes) or real(self, *a))
    monkeypatch.setattr(B, "SMALL_FIT", 0)
    one = B.fit(data, P, N)
    B.fit(data, P, N, one_task=0)
    monkeypatch.setattr(B, "SMALL_FIT", N)
    assert (one.feature == B.fit(data, P, N).feature).all() and seen.pop() == data.select("key", "x", "y", "late").dtypes
    assert seen == [[("key", "bigint"), ("y", "double"), ("late", "boolean"), ("codes", "binary")]] * 2
