import datetime as dt
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from weekloom.operators import demand as D, forecasters as FC, lags as L, panel as P, series as S
from weekloom.plans import preparation as PREP
from weekloom.session import pin
from tests.conftest import MONDAY


def rows_of(df):
    return sorted((r["unique_id"], str(r["ds"]), str(r["y"]), r["demand_type"]) for r in df.collect())


def test_refined_series_equal_the_panel_of_windows(spark):
    rng, rows = random.Random(3), []
    for s in range(40):
        for w in range(rng.randint(1, 120)):
            if rng.random() < (0.2, 0.5, 0.95)[s % 3]:
                rows.append((f"s{s}", MONDAY + dt.timedelta(weeks=w), rng.choice([0, 1, 2, 3, 9, rng.randint(1, 400)])))
    rows += [("steady", MONDAY + dt.timedelta(weeks=w), 7) for w in range(30)] + [("null", MONDAY, None), ("null", MONDAY + dt.timedelta(weeks=3), 2)]
    rows += [("undated", None, 4), *[("undated", MONDAY + dt.timedelta(weeks=w), 4 + 90 * (w == 6)) for w in range(16)]]
    rows += [("twice", MONDAY + dt.timedelta(weeks=w), 5) for w in (0, 2, 2, 4)]
    weekly = spark.createDataFrame(rows, "unique_id string, ds date, y bigint")
    windows = D.with_demand_type(D.capped_values(P.fill_weeks(P.by_series(weekly, ["unique_id"]), ["unique_id"])), "y_capped")
    expected = windows.selectExpr("unique_id", "ds", "y_capped as y", "demand_type")
    got = pin(S.refined(weekly))
    assert rows_of(PREP.unpacked(got)) == rows_of(expected)
    assert {r["unique_id"]: r["n"] for r in got.collect()} == {r["unique_id"]: r["count"] for r in expected.groupBy("unique_id").count().collect()}
    assert any(r["y"] != r["y_capped"] for r in windows.collect())


def test_number_of_partitions_grows_with_the_weeks(spark, monkeypatch):
    monkeypatch.setattr(PREP, "WEEKS_PER_TASK", 10)
    weekly = spark.createDataFrame([(f"s{k}", MONDAY + dt.timedelta(weeks=w), 1) for k in range(10) for w in (0, 9)], "unique_id string, ds date, y bigint")
    assert PREP.unpacked(pin(S.refined(weekly))).rdd.getNumPartitions() == 10


def test_spread_takes_as_many_partitions_as_the_rows_need(spark):
    rows = pin(spark.range(100).selectExpr("id % 7 as k", "id"))
    assert P.spread(rows, ["k"], 5).rdd.getNumPartitions() == 20
    assert P.spread(rows, ["k"], 1000).rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


@pytest.mark.parametrize("at_once", [1, 3, 7, 100])
def test_groups_stay_whole_across_batches(monkeypatch, at_once):
    monkeypatch.setattr(S, "ROWS_AT_ONCE", at_once)
    sizes = [3, 1, 1, 20, 2, 5]
    numbers = [k for size in sizes for k in range(1, size + 1)]
    names = [g for g, size in enumerate(sizes) for _ in range(size)]
    table = pa.RecordBatch.from_pydict({"g": names, "_i": pa.array(numbers, pa.int32())})
    batches = [table.slice(k, 4) for k in range(0, len(names), 4)] + [table.slice(0, 0)]
    seen = []
    for batch, begin in S.whole_groups(iter(batches)):
        ends = [*begin[1:], batch.num_rows]
        for a, b in zip(begin, ends, strict=True):
            group = batch.column("g").slice(a, b - a).to_pylist()
            assert len(set(group)) == 1
            seen.append((group[0], len(group)))
    assert seen == list(enumerate(sizes))


def test_refining_sorts_once_and_collects_no_rows(spark):
    """Weeks come to a task flat and in order: one sort by series and week serves the segments and the refining."""
    weekly = spark.createDataFrame([(f"s{k}", MONDAY + dt.timedelta(weeks=w), 1) for k in range(3) for w in range(30)], "unique_id string, ds date, y bigint")
    placed = D.segment_weekly(P.by_series(weekly, ["unique_id"]), F.lit(MONDAY + dt.timedelta(weeks=29)))
    plan = S.refined(placed.where("segment = 'valid'"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 1 and "ObjectHashAggregate" not in plan and plan.count("Exchange") == 1


def test_unpacked_weeks_lie_by_series(spark):
    weekly = spark.createDataFrame([(f"s{k}", MONDAY + dt.timedelta(weeks=w), 1) for k in range(50) for w in range(4)], "unique_id string, ds date, y bigint")
    for part in PREP.unpacked(pin(S.refined(weekly))).select("unique_id", "ds").rdd.glom().collect():
        assert part == sorted(part)


def test_packed_rows_are_those_of_collected_lists(spark):
    rows = [("a", "k", MONDAY + dt.timedelta(weeks=w), y) for w, y in [(2, 5), (0, None), (1, 7), (1, 3), (1, None)]]
    rows += [("a", "m", MONDAY, 4), (None, "k", MONDAY, 9), (None, "k", None, 8), ("b", None, None, 1)]
    df = spark.createDataFrame(rows, "unique_id string, kind string, ds date, y bigint")
    lists = F.sort_array(F.collect_list(F.struct("ds", F.col("y").cast("double").alias("y"))))
    wanted = df.groupBy("unique_id", "kind").agg(F.max("ds").alias("last_ds"), F.transform(lists, lambda r: r["y"]).alias("ys"), F.count(F.lit(1)).cast("int").alias("n"))
    got = FC.pack(df, ("unique_id",), ("kind",))
    assert got.columns == wanted.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, wanted.collect()))
    assert "ObjectHashAggregate" not in got._jdf.queryExecution().executedPlan().toString()


def test_train_statistics_without_hash_maps_of_values(spark):
    """As Spark's own aggregates have them, with nulls, single and constant values; the rows are merged with them, never broadcast."""
    rng = random.Random(5)
    rows = [(f"s{k}", rng.choice([None, 0, 3, rng.randint(0, 90)])) for k in range(12) for _ in range(3 * k + 1)]
    rows += [("one", 4), ("flat", 2), ("flat", 2), ("unknown", None), (None, 3), (None, 8)]
    train = spark.createDataFrame(rows, "unique_id string, y bigint")
    q = F.percentile("y", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    stats = train.groupBy("unique_id").agg(F.avg("y").alias("m"), F.coalesce(F.stddev_samp("y"), F.lit(0.0)).alias("s"), q.alias("q"))
    wanted = {r["unique_id"]: (r["s"] / r["m"] if r["m"] else 0.0, r["q"] and r["q"][1], r["q"] and r["q"][2] - r["q"][0]) for r in stats.collect()}
    got = {r["unique_id"]: (r["cv"], r["q50"], r["iqr"]) for r in L.train_statistics(train).collect()}
    assert got.keys() == wanted.keys()
    for k, row in got.items():
        assert [v is None for v in row] == [v is None for v in wanted[k]]
        assert [v for v in row if v is not None] == pytest.approx([v for v in wanted[k] if v is not None], rel=1e-12)
    plan = L.add_train_statistics(train, train)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan and "percentile" not in plan
