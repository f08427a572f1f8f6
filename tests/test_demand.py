import datetime as dt

from pyspark.sql import functions as F

from weekloom.operators import demand as D, panel as P
from tests.conftest import MONDAY


def by_id(df, column):
    return {r["unique_id"]: r[column] for r in df.collect()}


def test_gap_filling_adds_zero_weeks_only_inside(panel):
    rows = P.fill_weeks(panel(gap=[5, None, None, 2, None, None, None, None, None, 7]), ["unique_id"]).orderBy("ds").collect()
    assert [r["y"] for r in rows] == [5, 0, 0, 2, 0, 0, 0, 0, 0, 7]
    assert [r["ds"] for r in rows] == [MONDAY + dt.timedelta(weeks=k) for k in range(10)]


def test_series_statistics_of_single_and_gap_series(panel):
    dense = P.fill_weeks(panel(single=[4], gap=[5, None, None, 2]), ["unique_id"])
    got = {r["unique_id"]: r for r in P.series_statistics(dense, ["unique_id"], "ds", "y").collect()}
    assert got["single"]["std_weekly_sales"] == 0 and got["single"]["total_weeks_length"] == 1
    assert got["gap"]["num_week_with_zeros"] == 2 and got["gap"]["sales_units"] == 7
    assert got["gap"]["q75_sales"] == 2.75


def test_classes(panel):
    every_third = lambda *vs: [vs[(k // 3) % len(vs)] if k % 3 == 0 else 0 for k in range(30)]
    rows = panel(smooth=[9, 10, 11] * 9, erratic=[1, 40, 2] * 10, intermittent=every_third(5), lumpy=every_third(1, 40), zeros=[0] * 30)
    kinds = by_id(D.classify(rows), "demand_type")
    assert kinds == {"smooth": "smooth", "erratic": "erratic", "intermittent": "intermittent", "lumpy": "lumpy", "zeros": "lumpy"}
    assert by_id(D.classify(rows, empty="Empty"), "demand_type")["zeros"] == "Empty"
    assert by_id(D.with_demand_type(rows).distinct(), "demand_type") == kinds


def test_outliers_follow_the_rolling_median_rule(panel):
    spike = [10 + (k % 3) - 1 for k in range(30)]
    spike[15] = 500
    rows = panel(spike=spike, mad0=[10] * 10 + [12] + [10] * 9, few=[5, 0] * 5 + [900] + [0] * 9)
    flagged = D.cap_outliers(D.outlier_thresholds(rows))
    outliers = {(r["unique_id"], r["y"]): r["y_capped"] for r in flagged.where("is_outlier").collect()}
    assert outliers == {("spike", 500): 14, ("mad0", 12): 10}
    assert flagged.where("unique_id = 'few' and upper_threshold is not null").count() == 0
    short = D.capped_values(rows).select("unique_id", "ds", "is_outlier", "y_capped")
    assert short.exceptAll(flagged.select(*short.columns)).count() == 0


def test_low_outliers_are_lifted_to_the_lower_bound(panel):
    values = [100 + (k % 3) - 1 for k in range(30)]
    values[15] = 1
    row = D.cap_outliers(D.outlier_thresholds(panel(low=values), two_sided=True)).where("is_outlier").first()
    assert row["y"] == 1 and row["y_capped"] == int(row["lower_threshold"]) > 90


def test_maturity_boundaries(spark):
    ref = dt.date(2024, 12, 30)
    rows = [("cold", ref, 25), ("edge", ref - dt.timedelta(weeks=26), 40), ("old", ref - dt.timedelta(weeks=27), 40), ("ok", ref, 26)]
    registry = spark.createDataFrame(rows, "unique_id string, last_week_date date, total_weeks_length int")
    assert by_id(D.segment_by_maturity(registry, "unique_id"), "segment") == {
        "cold": "cold_start", "edge": "valid", "old": "discontinued", "ok": "valid"}


def test_hierarchy_levels_keep_the_total(spark):
    rows = spark.createDataFrame([("a", "x", MONDAY, 3), ("a", "y", MONDAY, 4), ("b", "x", MONDAY, 5)], "s string, p string, ds date, y bigint")
    levels = P.hierarchy_panel(rows, [[], ["s"], ["s", "p"]])
    sums = {r["level"]: r["t"] for r in levels.groupBy("level").agg(F.sum("y").alias("t")).collect()}
    assert sums == {"total": 12, "s": 12, "s/p": 12}
    assert {r["unique_id"] for r in levels.collect()} == {"Total", "a", "b", "a/x", "a/y", "b/x"}
