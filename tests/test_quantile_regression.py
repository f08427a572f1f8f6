"""Quantile regression against sample quantiles, a planted model and the check loss itself."""

import pathlib
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from weekloom.operators import quantile_regression as QR
from weekloom.session import CLEANUP_KEY, pin, pinned_folder, unpin

PROBS = {"q50": 0.5, "q80": 0.8, "q95": 0.95}


def loss(y, q, alpha):
    return np.where(y >= q, alpha * (y - q), (alpha - 1) * (y - q)).mean()


def test_intercept_alone_gives_the_sample_quantiles(spark):
    y = np.random.default_rng(1).exponential(size=4000)
    rows = spark.createDataFrame([(float(v),) for v in y], "y double").coalesce(1)
    fitted = QR.fit(rows, {"one": F.lit(1.0)}, F.col("y"), PROBS, steps=40, ridge=0.0)
    for q, a in PROBS.items():
        assert fitted.weights[q][0] == pytest.approx(np.quantile(y, a), abs=0.12)
        assert fitted.loss_after[q] == pytest.approx(loss(y, np.quantile(y, a), a), rel=2e-3)


def test_planted_spread_that_depends_on_a_feature(spark):
    draw = np.random.default_rng(2)
    x = draw.uniform(0, 4, size=6000)
    y = 1 + 2 * x + x * draw.normal(size=x.size)
    rows = spark.createDataFrame(list(zip(x.tolist(), y.tolist())), "x double, y double").coalesce(1).withColumn("one", F.lit(1.0))
    fitted = QR.fit(rows, {"one": F.col("one"), "x": F.col("x")}, F.col("y"), PROBS, steps=40, ridge=0.0)
    for q, z in {"q50": 0.0, "q80": 0.8416, "q95": 1.6449}.items():
        assert fitted.weights[q][1] / fitted.spread[1] == pytest.approx(2 + z, abs=0.15)
    out = rows.withColumns(fitted.ordered()).toPandas()
    assert (out.q50 <= out.q80).all() and (out.q80 <= out.q95).all()
    for q, a in PROBS.items():
        assert (out.y <= out[q]).mean() == pytest.approx(a, abs=0.03)


def test_never_worse_than_the_start(spark):
    draw = np.random.default_rng(3)
    x = draw.normal(size=500)
    y = 3 * x + draw.normal(size=500)
    rows = spark.createDataFrame(list(zip(x.tolist(), y.tolist())), "x double, y double")
    start = {q: {"x": 3.0} for q in PROBS}
    fitted = QR.fit(rows, {"x": F.col("x")}, F.col("y"), PROBS, start, steps=3)
    for q, a in PROBS.items():
        assert fitted.loss_before[q] == pytest.approx(loss(y, 3 * x, a))
        assert fitted.loss_after[q] <= fitted.loss_before[q]


def test_nothing_to_fit(spark):
    rows = spark.createDataFrame([(None, 1.0), (1.0, None)], "x double, y double")
    fitted = QR.fit(rows, {"x": F.col("x")}, F.col("y"), PROBS, {"q50": {"x": 2.0}})
    assert fitted.weights == {"q50": (2.0,), "q80": (0.0,), "q95": (0.0,)}


def test_rows_are_written_as_blocks(spark):
    """Fewer written values than rows, and the same rows come back in every pass, whatever the number of columns."""
    draw = np.random.default_rng(5)
    for width in (1, 3, 2000):
        x = draw.normal(size=(100, width))
        rows = spark.createDataFrame([(v.tolist(), float(i)) for i, v in enumerate(x)], "x array<double>, z double").coalesce(1)
        blocks = QR._blocks(rows, width)
        assert blocks.count() == -(-100 // max(QR.BLOCK // (width + 1), 1))
        sums = QR._sums(blocks, width, lambda a, z: np.array([[a.sum(), (a[:, 0] * z).sum(), float(len(z))]]))
        assert [sums[0, j] for j in range(3)] == pytest.approx([x.sum(), (x[:, 0] * np.arange(100)).sum(), 100])


def test_blocks_are_packed_and_do_not_outlive_the_fit(spark):
    """F7, F8: the blocks took 8 bytes a number, flags included, and lay on disk to the end of the run."""
    flags = [([float(i % 2), 1.0, float(i // 500)], float(i % 7)) for i in range(4000)]
    rows = spark.createDataFrame(flags, "x array<double>, z double").coalesce(1)
    blocks = QR._blocks(rows, 3)
    assert sum(len(r["rows"]) for r in blocks.collect()) < 4000 * 4 * 8 / 10
    unpin(blocks)
    before = pinned_files(spark)
    wide = rows.selectExpr("x[0] AS a", "x[2] AS b", "z")
    QR.fit(wide, {"a": F.col("a"), "b": F.col("b")}, F.col("z"), PROBS, steps=2)
    assert pinned_files(spark) == before


def pinned_files(spark):
    return {d for d in pathlib.Path(pinned_folder(spark).removeprefix("file:")).iterdir()}


def test_a_write_leaves_no_shuffle_files(spark):
    """F7, F8: shuffle files of all writes of a run added up."""
    folders = [pathlib.Path(d.toString()) for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]

    def files():
        return {f for folder in folders for f in folder.rglob("shuffle_*")}

    before, setting = files(), spark.conf.get(CLEANUP_KEY, None)
    pin(spark.range(1000).repartition(3, "id"))
    for _ in range(50):  # they are deleted in the background
        if files() <= before:
            break
        time.sleep(0.1)
    assert files() <= before and spark.conf.get(CLEANUP_KEY, None) == setting
