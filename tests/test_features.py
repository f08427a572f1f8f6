import datetime as dt

import pytest

from weekloom.operators import features as FE, lags as L
from weekloom.sources import holidays as H
from weekloom.sources.bronze import parse_raw_lines, to_bronze
from weekloom.sources.sinks import read_metadata
from weekloom.sources.tables import LAYERS, TableCatalog
from tests.conftest import MONDAY


def test_easter_of_known_years(spark):
    from pyspark.sql import functions as F
    years = spark.createDataFrame([(2023,), (2024,), (2025,), (2038,), (1954,)], "y int")
    got = [r["e"] for r in years.select("y", H.easter_sunday(F.col("y")).alias("e")).collect()]
    assert got == [dt.date(2023, 4, 9), dt.date(2024, 3, 31), dt.date(2025, 4, 20), dt.date(2038, 4, 25), dt.date(1954, 4, 18)]


def test_holiday_proximity_is_capped(spark):
    weeks = spark.createDataFrame([(MONDAY + dt.timedelta(weeks=k),) for k in range(12)], "ds date")
    days = [(MONDAY + dt.timedelta(days=14), "Carnaval", None), (MONDAY + dt.timedelta(days=15), "Local", "SP"),
            (MONDAY + dt.timedelta(days=14), "Also national", "SP"), (MONDAY + dt.timedelta(days=21), "Only there", "RJ")]
    source = spark.createDataFrame(days, "date date, name string, subdivision string")
    got = FE.holiday_features(weeks, source, H.region_states(spark)).where("region_id = 4").orderBy("ds").collect()
    assert [r["weeks_to_next_holiday"] for r in got] == [2, 1, 0, 0] + [4] * 8
    assert [r["weeks_since_last_holiday"] for r in got] == [4, 4, 0, 0, 1, 2, 3, 4, 4, 4, 4, 4]
    assert got[2]["holiday_type"] == "carnival" and got[2]["n_holidays"] == 2 and got[2]["is_regional_holiday"]
    assert got[3]["holiday_type"] == "regional" and got[3]["holiday_type_enc"] == 1


def test_weather_week_closes_on_monday(spark):
    days = [(MONDAY + dt.timedelta(days=k), 1, 20.0, 10.0, 15.0, 1.0, 5.0) for k in range(15)]
    daily = spark.createDataFrame(days, "date date, region_id int, temperature_2m_max double, temperature_2m_min double, "
                                        "temperature_2m_mean double, precipitation_sum double, windspeed_10m_max double")
    got = [(r["ds"], r["precip"]) for r in FE.weekly_weather(daily).orderBy("ds").collect()]
    assert got == [(MONDAY, 1.0), (MONDAY + dt.timedelta(days=7), 7.0), (MONDAY + dt.timedelta(days=14), 7.0)]


def test_lags_reach_the_future_without_recursion(panel):
    rows = L.lag_features(panel(a=list(range(1, 21))), [4, 13], "rolling_mean_4", 4).orderBy("ds").collect()
    assert len(rows) == 24 and rows[-1]["y"] is None
    assert rows[-1]["lag4"] == 20 and rows[-1]["rolling_mean_lag4_window_size4"] == 18.5
    assert rows[3]["lag4"] is None and rows[6]["rolling_mean_lag4_window_size4"] is None
    with pytest.raises(ValueError):
        L.lag_features(panel(a=[1, 2]), [2], "none", 4)


def test_target_transforms_invert(panel):
    for r in L.target_transforms(panel(a=[3, 0, 8, 5], flat=[2, 2, 2])).collect():
        for name in ("diff", "scaled", "log1p", "boxcox"):
            assert r[f"y_from_{name}"] == pytest.approx(r["y"])


def test_category_codes_sort_and_mark_missing(spark):
    df = spark.createDataFrame([("b", "z"), ("a", None), (None, "y"), ("c", "z")], "k string, m string")
    got = sorted((r["k"], r["m"]) for r in FE.ordinal_codes(df, "k", "m").collect())
    assert got == [(-1, 0), (0, -1), (1, 1), (2, 1)]


def test_csv_lines_become_typed_rows(spark):
    lines = spark.createDataFrame([("2024-01-01,7,P1,Sul,12,a,b,c",)], "line string")
    row = to_bronze(parse_raw_lines(lines)).first()
    assert (row["week_date"], row["supplier_id"], row["units_sold"], row["region"]) == (MONDAY, 7, 12, "Sul")


def test_catalog_names_sections_and_missing_tables(spark, tmp_path):
    catalog = TableCatalog(spark, str(tmp_path), LAYERS)
    assert catalog.path("silver", "dim_region").endswith("silver/dim_region")
    with pytest.raises(ValueError, match="section"):
        catalog.path("forecasting", "features")
    with pytest.raises(KeyError):
        catalog.path("silver", "nothing")
    assert catalog.read_optional("forecasting", "features", "weather") is None
    assert read_metadata(spark, str(tmp_path / "none")).count() == 0


def test_holidays_begin_in_their_first_year(spark):
    table = H.holiday_table(spark.createDataFrame([(2023,), (2024,)], "year int")).collect()
    national = {r["date"] for r in table if r["subdivision"] is None}
    assert dt.date(2024, 11, 20) in national and dt.date(2023, 11, 20) not in national
    assert {r["date"].strftime("%m-%d") for r in table if r["subdivision"] == "AC" and r["date"].year == 2023} == {"01-23", "03-08", "06-15", "09-05", "11-17"}
    assert [r["date"] for r in table if r["name"] == "Nossa Senhora da Penha"] == [dt.date(2023, 4, 17), dt.date(2024, 4, 8)]
    early = H.holiday_table(spark.createDataFrame([(1995,)], "year int")).collect()
    assert not [r for r in early if r["subdivision"] in ("RJ", "SP", "RS")]


def test_every_state_has_a_holiday():
    states = {s for listed in H.REGION_STATES.values() for s in listed}
    assert states == {s for *_, s, _ in H.STATE_FIXED}


def test_moving_mean_is_worked_out_once(spark, panel):
    """The same lags and means as with a moving window for each lag, also past the end of a series; one moving window in the plan."""
    rows = panel(a=[(k * 7) % 11 for k in range(60)], b=[3] * 15, c=[1, None, None, 5] * 8)
    for ahead in (0, 4):
        base = L.extend_future(rows, ahead) if ahead else rows
        for transform in ("none", "rolling_mean_4", "rolling_mean_13", "expanding_mean"):
            wanted = base.withColumns(L.lag_columns([4, 8, 13], transform))
            got = L.with_lags(base, [4, 8, 13], transform).select(wanted.columns)
            assert got.exceptAll(wanted).isEmpty() and wanted.exceptAll(got).isEmpty()
    plan = L.lag_features(rows, L.LAG_PRESETS["long"], "rolling_mean_13")._jdf.queryExecution().analyzed().toString()
    assert plan.count("avg(") == 1


def test_recent_lags_are_those_of_the_whole_series(spark):
    """Cutting the weeks before the lags are taken changes none of the last weeks, in long, short and twice-dated series."""
    from pyspark.sql import functions as F
    from weekloom.plans.modelling import Modelling
    from weekloom.sources.retail import RetailTables

    def row(name, places):
        days = [None if p is None else MONDAY + dt.timedelta(weeks=p) for p in places]
        return name, "lumpy", days, [(k * 5) % 13 for k in range(len(places))], max(d for d in days if d), len(places)

    given = [row("long", range(200)), row("short", range(20)), row("twice", sorted([*range(100), 70, 95, 95])), row("undated", [None, *range(90)])]
    model = Modelling(RetailTables(spark, "unused"))
    model.__dict__["series"] = spark.createDataFrame(given, "unique_id string, demand_type string, weeks array<date>, values array<bigint>, last_ds date, n int")
    whole = model.panel.select("unique_id", "ds", F.col("y").cast("double").alias("y")).withColumns(L.lag_columns(L.LAG_PRESETS["medium"], "rolling_mean_4")).drop("y")
    ends = model.series.select("unique_id", "last_ds")
    wanted = whole.join(ends, "unique_id").where(F.col("ds") >= F.date_sub("last_ds", 7 * 20)).drop("last_ds")
    got = model.recent_lags(20).select(wanted.columns)
    assert got.count() == 21 + 20 + 23 + 21
    assert got.exceptAll(wanted).isEmpty() and wanted.exceptAll(got).isEmpty()
