"""Users' models: saved states, what lacks one, and their place beside the built-in methods."""

import datetime as dt
import struct

import pytest

from tests.conftest import MONDAY, SF
from weekloom.operators import evaluation as EV, forecasters as FC, plugins as PL
from weekloom.plans.modelling import Modelling
from weekloom.sources.retail import RetailTables


class Mean:
    version = "1"

    def fit(self, values):
        return struct.pack("<d", sum(values) / len(values))

    def predict(self, state, values, h):
        return [struct.unpack("<d", state)[0]] * h


class MeanOfTwo(Mean):
    version = "2"


class Last(Mean):
    def predict(self, state, values, h):
        return [values[-1]] * h


class Short(Mean):
    def predict(self, state, values, h):
        return [float("nan")] * (h - 1)


class Endless(Mean):
    def predict(self, state, values, h):
        return [float("inf"), *[1.0] * (h - 1)]


@pytest.fixture
def registered():
    made = {"Mean": Mean(), "Last": Last(), "Short": Short(), "Endless": Endless()}
    for name, model in made.items():
        PL.register(name, model)
    yield made
    for name in made:
        PL.unregister(name)


def rows(df):
    return sorted((r["unique_id"], r["ds"], r["y_pred"], r["fitted_to"]) for r in df.collect() if r["fitted_to"])


def test_saved_states_forecast_a_longer_history_without_a_new_fit(spark, panel, registered, tmp_path):
    path = str(tmp_path / "states")
    PL.fit_states(FC.pack(panel(a=[1, 2, 3], b=[4])), "Mean").write.parquet(path)
    later = FC.pack(panel(a=[1, 2, 3, 50], b=[4, 60, 60], new=[9]))
    got = PL.predict_saved(later, spark.read.parquet(path), "Mean", 2)
    weeks = [MONDAY + dt.timedelta(weeks=k) for k in range(6)]
    assert rows(got) == [("a", weeks[4], 2.0, weeks[2]), ("a", weeks[5], 2.0, weeks[2]), ("b", weeks[3], 4.0, weeks[0]), ("b", weeks[4], 4.0, weeks[0])]
    # a series without a state keeps its weeks
    assert [(r["ds"], r["y_pred"]) for r in got.where("unique_id = 'new'").orderBy("ds").collect()] == [(weeks[1], None), (weeks[2], None)]


def test_states_of_another_version_or_model_are_not_used(panel, registered):
    packed = FC.pack(panel(a=[1, 2, 3]))
    states = PL.fit_states(packed, "Mean")
    assert PL.predict_saved(packed, states, "Last", 2).where("y_pred is not null").count() == 0
    PL.register("Mean", MeanOfTwo())
    assert PL.predict_saved(packed, states, "Mean", 2).where("y_pred is not null").count() == 0
    assert PL.predict_saved(packed, PL.fit_states(packed, "Mean"), "Mean", 2).where("y_pred = 2").count() == 2


def test_wrong_lengths_raise_and_infinite_values_are_null(panel, registered):
    packed = FC.pack(panel(a=[1, 2, 3]))
    with pytest.raises(Exception, match="the model gave 1 values for 2 weeks"):
        PL.predict_saved(packed, PL.fit_states(packed, "Short"), "Short", 2).collect()
    got = PL.predict_saved(packed, PL.fit_states(packed, "Endless"), "Endless", 2).orderBy("ds").collect()
    assert [r["y_pred"] for r in got] == [None, 1.0]


def test_names(registered):
    with pytest.raises(ValueError, match="built-in"):
        PL.register("TSB", Mean())
    with pytest.raises(KeyError, match="unknown model"):
        PL.model_of("Oracle")


def test_a_registered_model_is_a_candidate_like_any_other(panel, registered):
    """Its cross-validation score is what its forecasts give, and the choice takes it where it is best."""
    level = {f"s{k}": [100 + k, 100 - k] * 20 for k in range(6)}
    packed = FC.pack(panel(**level)).selectExpr("*", "'lumpy' as demand_type")
    scores = EV.candidate_scores(packed, {"lumpy": ["Mean", "Last", "Croston"]}, 4, 6)
    got = {r["model"]: r["cv_wape"] for r in scores.collect()}
    # the training parts have even lengths, so their mean is 100
    assert got["Mean"] == pytest.approx(sum(k / 100 for k in range(6)) / 6)
    # the last week is the lower one: two of four weeks are off by 2k
    assert got["Last"] == pytest.approx(sum(k / 100 for k in range(6)) / 6)
    assert set(got) == {"Mean", "Last", "Croston"}


def test_backtest_and_final_forecast_take_a_registered_model(spark, registered):
    model = Modelling(RetailTables(spark, SF))
    tested = model.backtest({"lumpy": "Mean", "intermittent": "TSB"})
    assert {(r["demand_type"], r["model"]) for r in tested.select("demand_type", "model").distinct().collect()} <= {("lumpy", "Mean"), ("intermittent", "TSB")}
    wrong = tested.where("model = 'Mean'").join(model.held_out.selectExpr("unique_id", "aggregate(ys, 0D, (a, v) -> a + v) / n as mean"), "unique_id")
    assert wrong.count() > 0 and wrong.where("abs(y_pred - mean) > 1e-9").count() == 0
    assert model.final_forecast({"lumpy": "Mean"}).where("model = 'Mean' and y_pred is not null").count() > 0
