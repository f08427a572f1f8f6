"""Every registered query with a DuckDB counterpart gives the same rows at the smallest scale."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF
from tools.check_oracle import arrow_frame, compare, connect

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
# model fits take long on a laptop; the check tool runs them
SLOW = {"gbt_search", "feature_importance"}
# one query per area keeps the suite short; tools/check_oracle.py runs all of them
QUICK = ["ingest_bronze", "fact_sales_weekly", "series_registry", "base_dataset", "hierarchy_panel", "cv_cascade", "acf_by_type",
         "ljung_box", "demand_classes", "outlier_flags", "outlier_flags_two_sided", "series_tags", "holiday_features",
         "training_dataset", "train_stats", "fc_imapa", "fc_ar", "backtest_table", "quality_picks", "model_selection",
         "quantile_forecast", "coverage_by_series"]


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", QUICK)
def test_same_rows_as_duckdb(spark, duck, name):
    got = arrow_frame(QUERIES[name](spark, SF))
    want = duck.sql(ORACLES[name]).to_arrow_table().to_pandas(date_as_object=True)
    assert compare(got, want) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - SLOW))
def test_queries_without_counterpart_give_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_no_counterpart_without_query():
    assert set(ORACLES) <= set(QUERIES)
