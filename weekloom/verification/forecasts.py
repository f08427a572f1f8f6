"""Forecasters, evaluation, model choice and safety stock."""

from __future__ import annotations

import struct

from pyspark.sql import functions as F

from weekloom.operators import evaluation as EV, forecasters as FC, inventory as INV, panel as P, plugins as PL
from weekloom.operators import tree_search as TS, trees as TR
from weekloom.plans.modelling import PER_SERIES_MODELS, TREE_FEATURES
from weekloom.session import pin
from weekloom.sources import sinks as K
from weekloom.verification.common import CTES, H, Inputs, Registry, r, sql
from weekloom.verification.warehouse import scratch

AREA = Registry()
RUN_DATE = "2024-01-01"


def run_date():
    return F.lit(RUN_DATE).cast("date")


# -- forecasters as DuckDB list expressions ---------------------------------------

def ses(lst: str, a: float) -> str:
    return f"list_reduce({lst}, lambda acc, x: CAST({a} AS DOUBLE) * x + CAST({1 - a} AS DOUBLE) * acc)"


def ses_grid(lst: str) -> str:
    """Level of the grid alpha with the smallest squared error."""
    start = f"list_transform({lst}, lambda x: {{'l': x, 's': CAST(0 AS DOUBLE)}})"
    runs = ", ".join(
        f"list_reduce({start}, lambda acc, e: {{'l': CAST({a} AS DOUBLE) * e.l + CAST({1 - a} AS DOUBLE) * acc.l, "
        f"'s': acc.s + (e.l - acc.l) * (e.l - acc.l)}})" for a in FC.ALPHA_GRID)
    ranked = f"list_transform([{runs}], lambda f, i: {{'s': f.s, 'i': i, 'l': f.l}})"
    return f"(list_sort({ranked})[1]).l"


Z = "list_filter(ys, lambda v: v > 0)"
POS = "list_filter(list_transform(ys, lambda v, i: CASE WHEN v > 0 THEN i END), lambda p: p IS NOT NULL)"
GAPS = f"list_transform({POS}, lambda p, i: CAST(p - CASE WHEN i > 1 THEN ({POS})[i - 1] ELSE 0 END AS DOUBLE))"
LENGTH = "CAST(greatest(round_even(list_avg(gaps), 0), 1) AS BIGINT)"


def sold(value: str) -> str:
    return f"CASE WHEN len(z) > 0 THEN {value} ELSE 0.0 END"


def flat(value: str) -> str:
    return f"(SELECT [v, v, v, v] FROM (SELECT {value} AS v))"


def buckets(length: str) -> str:
    return (f"list_transform(range(n % {length}, n, {length}), lambda s: list_sum(list_slice(ys, s + 1, s + {length})))")


def season_es() -> str:
    steps = []
    for k in range(4):
        own = f"list_filter(list_transform(ys, lambda v, i: CASE WHEN (i - 1) % 52 = (n + {k}) % 52 THEN v END), lambda v: v IS NOT NULL)"
        steps.append(f"CASE WHEN n >= 52 THEN {ses(own, 0.3)} END")
    return f"[{', '.join(steps)}]"


def naive52() -> str:
    return "[" + ", ".join(f"CASE WHEN n >= 52 THEN ys[n - 52 + {k}] END" for k in range(1, 5)) + "]"


SY = "list_sum(ys)"
STY = "list_sum(list_transform(ys, lambda v, i: v * i))"
ST, STT = "(n * (n + 1) / 2.0)", "(n * (n + 1) * (2 * n + 1) / 6.0)"
B = f"((n * {STY} - {ST} * {SY}) / (n * {STT} - {ST} * {ST}))"


def theta() -> str:
    lvl = ses("list_transform(ys, lambda v, i: 2 * v - (ta + tb * i))", 0.3)
    return "[" + ", ".join(f"0.5 * (ta + tb * (n + {k})) + 0.5 * {lvl}" for k in range(1, 5)) + "]"


def ets() -> str:
    start = "list_transform(ys, lambda x: {'l': x, 't': CAST(0 AS DOUBLE), 's': CAST(0 AS DOUBLE)})"
    pairs = [(a, b) for a in FC.ETS_ALPHAS for b in FC.ETS_BETAS]
    runs = []
    for a, b in pairs:
        level = f"({a}::DOUBLE * e.l + {1 - a}::DOUBLE * (acc.l + acc.t))"
        runs.append(f"list_reduce({start}, lambda acc, e: {{'l': {level}, 't': {b}::DOUBLE * ({level} - acc.l) + {1 - b}::DOUBLE * acc.t, "
                    f"'s': acc.s + (e.l - acc.l - acc.t) * (e.l - acc.l - acc.t)}})")
    ranked = f"list_transform([{', '.join(runs)}], lambda f, i: {{'s': f.s, 'i': i, 'l': f.l, 't': f.t}})"
    return f"(SELECT [f.l + f.t, f.l + 2 * f.t, f.l + 3 * f.t, f.l + 4 * f.t] FROM (SELECT list_sort({ranked})[1] AS f))"


def ar() -> str:
    return """(SELECT [y1, y2, y3, y4] FROM (SELECT *, y3 + c + p * d3 AS y4 FROM (SELECT *, y2 + d3 AS y3 FROM (
        SELECT *, y1 + d2 AS y2, c + p * d2 AS d3 FROM (SELECT *, yl + d1 AS y1, c + p * d1 AS d2 FROM (
        SELECT phi AS p, drift AS c, drift + phi * lastd AS d1, ys[n] AS yl)))))) """.replace("y3 + c + p * d3 AS y4", "y3 + (c + p * d3) AS y4")


FORECAST_SQL = {
    "SeasonalNaive": naive52(),
    "Croston": flat(sold(f"{ses('z', 0.1)} / {ses('gaps', 0.1)}")),
    "CrostonSBA": flat(sold(f"0.95 * {ses('z', 0.1)} / {ses('gaps', 0.1)}")),
    "CrostonOptimized": flat(sold(f"{ses_grid('z')} / {ses_grid('gaps')}")),
    "TSB": flat(sold(f"{ses('z', 0.3)} * {ses('list_transform(ys, lambda v: CASE WHEN v > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)', 0.3)}")),
    "ADIDA": flat(sold(f"{ses_grid('bk')} / len_b")),
    "IMAPA": flat(sold("im")),
    "SeasonalES": season_es(),
    "Theta": theta(),
    "ETS": ets(),
    "AR": ar(),
}


def prepared(table: str, keys: str, models) -> str:
    """Packed rows plus the helper columns the asked methods use."""
    sql_text = f"SELECT *, {Z} AS z, {GAPS} AS gaps FROM {table}"
    if {"ADIDA", "IMAPA"} & set(models):
        sql_text = f"SELECT *, CASE WHEN len(gaps) > 0 THEN {LENGTH} ELSE 1 END AS len_b FROM ({sql_text})"
    if "ADIDA" in models:
        sql_text = f"SELECT *, {buckets('len_b')} AS bk FROM ({sql_text})"
    if "IMAPA" in models:
        inner = f"SELECT *, unnest(range(1, len_b + 1)) AS lb FROM ({sql_text})"
        rate = f"SELECT {keys}, avg({ses_grid('bkl')} / lb) AS im FROM (SELECT *, {buckets('lb')} AS bkl FROM ({inner})) GROUP BY ALL"
        sql_text = f"SELECT * FROM ({sql_text}) JOIN ({rate}) USING ({keys})"
    if "Theta" in models:
        sql_text = f"SELECT *, ({SY} - tb * {ST}) / n AS ta FROM (SELECT *, CASE WHEN n > 1 THEN {B} ELSE 0.0 END AS tb FROM ({sql_text}))"
    if "AR" in models:
        d = "list_transform(range(2, n + 1), lambda i: ys[i] - ys[i - 1])"
        sql_text = f"SELECT *, {d} AS dd FROM ({sql_text})"
        x, y = "list_slice(dd, 1, len(dd) - 1)", "list_slice(dd, 2, len(dd))"
        sql_text = (f"SELECT *, list_sum({x}) AS sx, list_sum({y}) AS sy, list_sum(list_transform({x}, lambda v: v * v)) AS sxx, "
                    f"list_sum(list_transform(range(1, len(dd)), lambda i: dd[i] * dd[i + 1])) AS sxy FROM ({sql_text})")
        usable = "n >= 4 AND (n - 2) * sxx - sx * sx > 0"
        sql_text = (f"SELECT *, CASE WHEN {usable} THEN ((n - 2) * sxy - sx * sy) / ((n - 2) * sxx - sx * sx) ELSE 0.0 END AS phi, "
                    f"CASE WHEN {usable} THEN dd[len(dd)] ELSE 0.0 END AS lastd FROM ({sql_text})")
        sql_text = f"SELECT *, CASE WHEN {usable} THEN (sy - phi * sx) / (n - 2) ELSE 0.0 END AS drift FROM ({sql_text})"
    return f"({sql_text})"


def forecast_oracle(model: str) -> str:
    rows = f"SELECT unique_id, last_ds, unnest({FORECAST_SQL[model]}) AS v, unnest([1, 2, 3, 4]) AS step FROM {prepared('packs', 'unique_id', [model])}"
    return sql(f"SELECT unique_id, step, CAST(last_ds + 7 * step AS DATE) AS ds, {r('v')} AS y_pred FROM ({rows})")


FORECAST_QUERIES = {
    "fc_seasonal_naive": "SeasonalNaive", "fc_croston": "Croston", "fc_croston_sba": "CrostonSBA",
    "fc_croston_opt": "CrostonOptimized", "fc_tsb": "TSB", "fc_adida": "ADIDA", "fc_imapa": "IMAPA",
    "fc_seasonal_es": "SeasonalES", "fc_theta": "Theta", "fc_ets_grid": "ETS", "fc_ar": "AR",
}


def _register(name: str, model: str) -> None:
    @AREA.query(name, forecast_oracle(model))
    def run(i: Inputs):
        made = i.model.packed.withColumn("_fc", FC.predicted(model, H))
        return FC.unpack(made, "_fc", ["unique_id"])


for _name, _model in FORECAST_QUERIES.items():
    _register(_name, _model)


@AREA.query("fc_custom_udf", sql(f"""
    SELECT unique_id, CAST(last_ds + 7 * step AS DATE) AS ds, {r('(ys[n] + ys[n - 1] + ys[n - 2]) / 3')} AS y_pred
    FROM packs, (SELECT unnest([1, 2, 3, 4]) AS step)"""))
def fc_custom_udf(i: Inputs):
    """A user's Python forecaster: mean of the last three weeks."""
    return FC.apply_custom(i.model.panel, lambda ys, h: [sum(ys[-3:]) / len(ys[-3:])] * h, H)


class MeanAndLast:
    """A user's model: half the mean of what it was fitted on, half the last week known when asked."""

    version = "1"

    def fit(self, values):
        return struct.pack("<d", sum(values) / len(values))

    def predict(self, state, values, h):
        return [(struct.unpack("<d", state)[0] + values[-1]) / 2] * h


@AREA.query("custom_fit_predict", sql(f"""
    SELECT p.unique_id, CAST(p.last_ds + 7 * step AS DATE) AS ds, {r('(list_avg(t.ys) + p.ys[p.n]) / 2')} AS y_pred, t.last_ds AS fitted_to
    FROM packs p LEFT JOIN ho t USING (unique_id), (SELECT unnest([1, 2, 3, 4]) AS step)"""))
def custom_fit_predict(i: Inputs):
    """States of a user's model fitted on the training part, written, and asked with the whole history."""
    PL.register("MeanAndLast", MeanAndLast())
    path = i.model.fit_custom("MeanAndLast", scratch(i, "states"), training_part=True)
    return i.model.predict_custom("MeanAndLast", path)


# -- hold-out ---------------------------------------------------------------------

def routed_sql(table: str, keys: str, models: dict[str, str], name: str) -> str:
    """CASE over the demand type picking the method's list."""
    return "CASE " + " ".join(f"WHEN demand_type = '{k}' THEN {FORECAST_SQL[m]}" for k, m in models.items()) + f" END AS {name}"


NAIVE_MAE = "nullif(list_avg(list_transform(range(2, n + 1), lambda i: abs(ys[i] - ys[i - 1]))), 0)"
ALL_MODELS = sorted(set(PER_SERIES_MODELS.values()) | set(FC.BASELINES.values()))
CTES["hop"] = prepared("ho", "unique_id", ALL_MODELS)[1:-1]
CTES["bt"] = f"""
    SELECT unique_id, CAST(last_ds + 7 * k AS DATE) AS ds, actual[k] AS y, fc[k] AS y_pred, fb[k] AS y_baseline, demand_type,
           naive_mae, cutoff
    FROM (SELECT *, CAST(unnest(range(1, len(actual) + 1)) AS INTEGER) AS k FROM (
        SELECT *, {routed_sql('hop', 'unique_id', PER_SERIES_MODELS, 'fc')}, {routed_sql('hop', 'unique_id', FC.BASELINES, 'fb')},
               {NAIVE_MAE} AS naive_mae FROM hop))"""
CASE_MODEL = "CASE demand_type " + " ".join(f"WHEN '{k}' THEN '{m}'" for k, m in PER_SERIES_MODELS.items()) + " END"
CASE_BASE = "CASE demand_type " + " ".join(f"WHEN '{k}' THEN '{m}'" for k, m in FC.BASELINES.items()) + " END"
CTES["sides"] = """
    SELECT unique_id, demand_type, 'Baseline' AS model, y, y_baseline AS p, naive_mae FROM bt
    UNION ALL SELECT unique_id, demand_type, 'Trained', y, y_pred, naive_mae FROM bt"""
CTES["per"] = """
    SELECT unique_id, demand_type, model, CASE WHEN ok THEN mae / scale END AS mase, CASE WHEN ok THEN smape END AS smape,
           CASE WHEN ok THEN wape END AS wape
    FROM (SELECT unique_id, demand_type, model, count(p) = count(*) AS ok, avg(abs(y - p)) AS mae, max(naive_mae) AS scale,
                 2 * avg(abs(y - p) / (abs(y) + abs(p))) FILTER (abs(y) + abs(p) > 0) AS smape,
                 sum(abs(y - p)) / nullif(sum(abs(y)), 0) AS wape
          FROM sides GROUP BY 1, 2, 3)"""
CTES["scored"] = """
    SELECT demand_type, model, avg(mase) AS mase, avg(smape) AS smape, avg(wape) AS wape, count(*) AS n_series FROM per GROUP BY 1, 2"""


@AREA.query("rank_aligned_eval", sql(f"SELECT unique_id, ds, CAST(y AS BIGINT) AS y, {r('y_baseline')} AS y_pred FROM bt"))
def rank_aligned_eval(i: Inputs):
    """Test rows of all types joined to their type's baseline forecast by the position in the series."""
    panel, cutoff = i.model.panel, i.model.cutoff
    train = FC.pack(panel.where(F.col("ds") <= cutoff), ("unique_id",), ("demand_type",))
    pred = FC.unpack(FC.route(train, FC.BASELINES, H, "_fc"), "_fc", ["unique_id"])
    # series without training rows have no forecast and are left to the caller
    return EV.by_position(panel.where(F.col("ds") > cutoff).select("unique_id", "ds", "y"), pred)


@AREA.query("baseline_eval", sql(f"""
    SELECT demand_type, {r('mase')} AS mase, {r('smape')} AS smape, {r('wape')} AS wape, n_series FROM scored WHERE model = 'Baseline'"""))
def baseline_eval(i: Inputs):
    rows = FC.route(i.model.held_out, FC.BASELINES, H, "_base")
    test = EV.test_rows(rows, {"y_pred": "_base"}, ["unique_id", "demand_type", "naive_mae"])
    return EV.mean_metrics(EV.series_metrics(test, group=["demand_type"]), ["demand_type"])


@AREA.query("backtest_table", sql(f"""
    SELECT unique_id, ds, y, {r('y_pred')} AS y_pred, {r('y_baseline')} AS y_baseline, demand_type, {CASE_MODEL} AS model,
           {CASE_BASE} AS baseline_model, cutoff AS ref_date, DATE '{RUN_DATE}' AS run_date FROM bt"""))
def backtest_table(i: Inputs):
    """Backtest written per reference and run date and read back."""
    rows = i.model.backtest(PER_SERIES_MODELS, run_date()).drop("naive_mae")
    path = K.write_dated(rows, scratch(i, "backtest"))
    back = i.spark.read.parquet(path)
    return back.withColumns({c: F.col(c).cast("date") for c in ("ref_date", "run_date")})


@AREA.query("forecast_metrics", sql(f"""
    SELECT unique_id, demand_type, {r('mase')} AS mase, {r('smape')} AS smape, {r('wape')} AS wape FROM per WHERE model = 'Trained'"""))
def forecast_metrics(i: Inputs):
    """Metrics per series, the scale taken from the training rows by a window difference."""
    train = i.model.panel.where(F.col("ds") <= i.model.cutoff)
    bt = i.model.backtest(PER_SERIES_MODELS, run_date())
    return EV.series_metrics(bt, EV.naive_scale(train), ["demand_type"])


@AREA.query("model_vs_baseline", sql(f"""
    SELECT demand_type, model, round(mase, 4) + 0.0 AS mase, round(smape, 4) + 0.0 AS smape, round(wape, 4) + 0.0 AS wape, n_series,
           {r('(max(CASE WHEN model = ' + chr(39) + 'Baseline' + chr(39) + ' THEN wape END) OVER p - max(CASE WHEN model = ' + chr(39) + 'Trained' + chr(39) + ' THEN wape END) OVER p) / max(CASE WHEN model = ' + chr(39) + 'Baseline' + chr(39) + ' THEN wape END) OVER p * 100')} AS delta_wape_pct
    FROM scored WINDOW p AS (PARTITION BY demand_type)"""))
def model_vs_baseline(i: Inputs):
    scores = EV.with_improvement(i.model.scores(i.model.backtest(PER_SERIES_MODELS, run_date())))
    return scores.withColumns({c: F.round(c, 4) for c in ("mase", "smape", "wape")})


@AREA.query("custom_metrics", sql(f"""
    SELECT demand_type, {r('sum(abs(y - y_pred)) / nullif(sum(abs(y)), 0)')} AS wape, {r('avg(abs(y - y_pred))')} AS mae, {r('avg(y_pred - y)')} AS bias
    FROM bt GROUP BY 1"""))
def custom_metrics(i: Inputs):
    """Two registered metrics by name and one of the user's own."""
    def bias():
        return F.avg(F.col("y_pred") - F.col("y"))

    return EV.custom_metrics(i.model.backtest(PER_SERIES_MODELS, run_date()), ["wape", "mae", bias], ["demand_type"])


@AREA.query("quality_picks", sql(f"""
    SELECT q.demand_type, unique_id, {r('wape')} AS wape, quality, {r('p10')} AS p10, {r('p50')} AS p50, {r('p90')} AS p90
    FROM (SELECT demand_type, unique_id, wape, CASE WHEN k <= 2 THEN 'best' WHEN k = n // 2 + 1 THEN 'median' WHEN k > n - 2 THEN 'worst' END AS quality
          FROM (SELECT *, row_number() OVER (PARTITION BY demand_type ORDER BY wape, unique_id) AS k, count(*) OVER (PARTITION BY demand_type) AS n
                FROM per WHERE model = 'Trained' AND wape IS NOT NULL)) q
    JOIN (SELECT demand_type, quantile_cont(wape, 0.1) AS p10, quantile_cont(wape, 0.5) AS p50, quantile_cont(wape, 0.9) AS p90
          FROM per WHERE model = 'Trained' GROUP BY 1) USING (demand_type)
    WHERE quality IS NOT NULL"""))
def quality_picks(i: Inputs):
    """Best, middle and worst series per type, with the type's WAPE quantiles over all series."""
    bt = i.model.backtest(PER_SERIES_MODELS, run_date())
    per = pin(EV.series_metrics(bt, group=["demand_type"]))
    picks = EV.quality_picks(per, "wape", ["demand_type"])
    return picks.join(EV.score_quantiles(per, "wape", ["demand_type"]), "demand_type")


# -- rolling origin -----------------------------------------------------------------

@AREA.query("cv_windows", sql("""
    SELECT unique_id, w AS "window", CAST(last_ds - 7 * (4 + 4 * w) AS DATE) AS cutoff, count(*) FILTER (i <= n - 4 - 4 * w) AS n_train,
           count(*) FILTER (i > n - 4 - 4 * w) AS n_test, CAST(sum(y) FILTER (i > n - 4 - 4 * w) AS BIGINT) AS y_test
    FROM (SELECT unique_id, ds, y, row_number() OVER (PARTITION BY unique_id ORDER BY ds) AS i, count(*) OVER (PARTITION BY unique_id) AS n,
                 max(ds) OVER (PARTITION BY unique_id) AS last_ds FROM rp),
         (SELECT CAST(unnest(range(0, 6)) AS INTEGER) AS w)
    WHERE n >= 28 AND i <= n - 4 * w GROUP BY 1, 2, 3"""))
def cv_windows(i: Inputs):
    """Sizes and test totals of all six disjoint windows of every long enough series."""
    rows = EV.rolling_windows(EV.min_length_filter(i.model.panel, H, 6), H, 6, H)
    return rows.groupBy("unique_id", "window", "cutoff").agg(
        F.count_if(~F.col("is_test")).alias("n_train"), F.count_if("is_test").alias("n_test"),
        F.sum(F.when(F.col("is_test"), F.col("y"))).alias("y_test"))


def _cv_table(models) -> str:
    """Windowed packed rows of the training part with helper columns."""
    windows = f"""SELECT unique_id, demand_type, w, n AS n_total, {NAIVE_MAE} AS scale, list_slice(ys, n - 4 - 4 * w + 1, n - 4 * w) AS actual,
        list_slice(ys, 1, n - 4 - 4 * w) AS ys, n - 4 - 4 * w AS n
        FROM ho, (SELECT CAST(unnest(range(0, 6)) AS INTEGER) AS w) WHERE n - 4 - 4 * w >= 1"""
    return prepared(f"({windows})", "unique_id, w", models)


def _selection_sql() -> str:
    parts = []
    for kind, models in FC.CANDIDATES.items():
        for m in models:
            need = 28 + FC.season_needed(m, kind)
            parts.append(f"""SELECT demand_type, '{m}' AS model, unique_id, sum(abs(actual[k] - f[k])) / nullif(sum(actual[k]), 0) AS wape
              FROM (SELECT demand_type, unique_id, actual, {FORECAST_SQL[m]} AS f, unnest([1, 2, 3, 4]) AS k
                    FROM {_cv_table([m])} WHERE demand_type = '{kind}' AND n_total >= {need}) GROUP BY ALL""")
    return " UNION ALL ".join(parts)


CTES["cvs"] = f"SELECT demand_type, model, avg(wape) AS cv_wape, count(*) AS n_series FROM ({_selection_sql()}) GROUP BY 1, 2"


@AREA.query("model_selection", sql(f"""
    SELECT demand_type, model, {r('cv_wape')} AS cv_wape, n_series,
           row_number() OVER (PARTITION BY demand_type ORDER BY cv_wape, model) = 1 AS is_winner FROM cvs"""))
def model_selection(i: Inputs):
    """CV score of every candidate, the winner of each type marked."""
    train = i.model.held_out.drop("actual", "naive_mae")
    scores = pin(EV.candidate_scores(train, FC.CANDIDATES, H))
    kinds = scores.select("demand_type").distinct()
    winners = EV.select_models(scores, kinds).select("demand_type", F.col("model").alias("_w"))
    return scores.join(winners, "demand_type", "left").withColumn("is_winner", F.col("model") == F.col("_w")).drop("_w")


FINAL_MODELS = {"smooth": "SeasonalES", "erratic": "AR", "intermittent": "TSB", "lumpy": "ADIDA"}


@AREA.query("final_forecast", sql(f"""
    SELECT unique_id, CAST(last_ds + 7 * k AS DATE) AS ds, {r('f[k]')} AS y_pred, demand_type,
           CASE demand_type {' '.join(f"WHEN '{a}' THEN '{b}'" for a, b in FINAL_MODELS.items())} END AS model,
           (SELECT m FROM cut) AS ref_date, DATE '{RUN_DATE}' AS run_date
    FROM (SELECT unique_id, last_ds, demand_type, {routed_sql('packs', 'unique_id', FINAL_MODELS, 'f')}, unnest([1, 2, 3, 4]) AS k
          FROM {prepared('packs', 'unique_id', FINAL_MODELS.values())})"""))
def final_forecast(i: Inputs):
    """Known methods refitted on the full history, written per date and read back."""
    rows = i.model.final_forecast(FINAL_MODELS, run_date())
    back = i.spark.read.parquet(K.write_dated(rows, scratch(i, "forecast")))
    return back.withColumns({c: F.col(c).cast("date") for c in ("ref_date", "run_date")})


@AREA.query("run_metadata", sql(f"""
    SELECT demand_type, 'W-MON' AS freq, 4 AS horizon, 6 AS n_windows, {CASE_MODEL} AS model_col,
           {r("max(wape) FILTER (model = 'Baseline')")} AS baseline_wape, {r("max(wape) FILTER (model = 'Trained')")} AS model_wape,
           max(n_series) AS n_series,
           round((max(wape) FILTER (model = 'Baseline') - max(wape) FILTER (model = 'Trained')) / max(wape) FILTER (model = 'Baseline') * 100, 2) + 0.0 AS delta_wape_pct
    FROM scored GROUP BY 1"""))
def run_metadata(i: Inputs):
    """Metadata rows written as JSON, read back and flattened for reporting."""
    chosen = i.spark.range(1).select(F.explode(F.create_map(*[
        F.lit(x) for pair in PER_SERIES_MODELS.items() for x in pair])).alias("demand_type", "model")).withColumn(
        "cv_wape", F.lit(None).cast("double")).withColumn("best_params", F.lit(None).cast("string"))
    rows = i.model.metadata(i.model.backtest(PER_SERIES_MODELS, run_date()), chosen)
    back = K.read_metadata(i.spark, K.write_metadata(rows, scratch(i, "metadata")))
    return back.select("demand_type", "freq", "horizon", "n_windows", "model_col",
                       F.col("baseline_metrics.wape").alias("baseline_wape"), F.col("model_metrics.wape").alias("model_wape"),
                       F.col("model_metrics.n_series").alias("n_series"), "delta_wape_pct")


# -- quantiles and safety stock -------------------------------------------------------

CTES["resid"] = f"""
    SELECT demand_type, (actual[k] - f[k]) / scale AS e FROM (
      SELECT unique_id, demand_type, actual, scale, {routed_sql('x', 'unique_id', PER_SERIES_MODELS, 'f')}, unnest([1, 2, 3, 4]) AS k
      FROM {_cv_table(sorted(set(PER_SERIES_MODELS.values())))}) WHERE actual[k] - f[k] IS NOT NULL AND scale IS NOT NULL"""
CTES["rq"] = """
    SELECT demand_type, quantile_cont(e, 0.5) AS r50, quantile_cont(e, 0.8) AS r80, quantile_cont(e, 0.95) AS r95 FROM resid GROUP BY 1"""
CTES["qf"] = """
    SELECT unique_id, demand_type, ds, y, y_pred, y_pred + r50 * u AS q50, y_pred + r80 * u AS q80, y_pred + r95 * u AS q95,
           (r95 - r50) * u AS safety_stock
    FROM (SELECT *, coalesce(naive_mae, 0) AS u FROM bt) LEFT JOIN rq USING (demand_type)"""


@AREA.query("quantile_forecast", sql(f"""
    SELECT unique_id, demand_type, ds, y, {r('y_pred')} AS y_pred, {r('q50')} AS q50, {r('q80')} AS q80, {r('q95')} AS q95 FROM qf"""))
def quantile_forecast(i: Inputs):
    return i.model.quantile_rows().drop("safety_stock")


@AREA.query("safety_stock", sql(f"SELECT unique_id, ds, {r('safety_stock')} AS safety_stock FROM qf"))
def safety_stock(i: Inputs):
    return i.model.quantile_rows().select("unique_id", "ds", "safety_stock")


@AREA.query("quantile_metrics", sql(" UNION ALL ".join(f"""
    SELECT '{q}' AS quantile, CAST({a} AS DOUBLE) AS alpha, {r(f'avg(CASE WHEN y - {q} >= 0 THEN {a} * (y - {q}) ELSE ({a} - 1) * (y - {q}) END)')} AS pinball,
           {r(f'avg(CASE WHEN y <= {q} + 1e-9 THEN 1.0 ELSE 0.0 END)')} AS coverage FROM qf WHERE {q} IS NOT NULL"""
    for q, a in INV.QUANTILES.items())))
def quantile_metrics(i: Inputs):
    return INV.quantile_metrics(i.model.quantile_rows())


@AREA.query("fc_quantile_regression", sql(f"""
    SELECT unique_id, demand_type, ds, y, {r('y_pred')} AS y_pred, y_pred IS NOT NULL AS has_quantiles,
           CASE WHEN y_pred IS NOT NULL THEN true END AS is_ordered FROM bt"""))
def fc_quantile_regression(i: Inputs):
    """Quantiles from a regression on features: every test week with a point forecast has them, in order. Their values are beyond SQL."""
    _, rows = i.model.quantile_regression()
    there = F.col("q50").isNotNull() & F.col("q80").isNotNull() & F.col("q95").isNotNull() & (F.abs("q95") < 1e12)
    return rows.select("unique_id", "demand_type", "ds", "y", "y_pred", there.alias("has_quantiles"),
                       ((F.col("q50") <= F.col("q80")) & (F.col("q80") <= F.col("q95"))).alias("is_ordered"))


@AREA.query("quantile_regression_gain", " UNION ALL ".join(
    f"SELECT '{q}' AS quantile, CAST({a} AS DOUBLE) AS alpha, true AS loss_falls, true AS loss_not_above_rule, true AS coverage_not_worse" for q, a in INV.QUANTILES.items()))
def quantile_regression_gain(i: Inputs):
    """Does the regression pay? The loss on the fitted rows falls, on the test weeks it is at most that of one residual quantile per type,
    and the share of test weeks that a quantile covers is no farther from its aim (to 0.02)."""
    fitted, rows = i.model.quantile_regression()
    falls = F.create_map(*[F.lit(v) for q in INV.QUANTILES for v in (q, fitted.loss_after[q] <= fitted.loss_before[q])])
    rule = INV.quantile_metrics(i.model.quantile_rows()).select("quantile", F.col("pinball").alias("rule"), F.col("coverage").alias("rule_coverage"))
    return INV.quantile_metrics(rows).join(rule, "quantile").select(
        "quantile", "alpha", falls[F.col("quantile")].alias("loss_falls"), (F.col("pinball") <= F.col("rule")).alias("loss_not_above_rule"),
        (F.abs(F.col("coverage") - F.col("alpha")) <= F.abs(F.col("rule_coverage") - F.col("alpha")) + 0.02).alias("coverage_not_worse"))


COVERAGE = "SELECT unique_id, avg(CASE WHEN y <= q95 + 1e-9 THEN 1.0 ELSE 0.0 END) AS c FROM qf WHERE q95 IS NOT NULL GROUP BY 1"


@AREA.query("coverage_by_series", sql(f"""
    SELECT unique_id, {r('c')} AS coverage_q95, CASE WHEN k > n - 2 THEN 'High coverage' WHEN k = n // 2 + 1 THEN 'Median'
           WHEN k <= 2 THEN 'Low coverage' END AS quality
    FROM (SELECT *, row_number() OVER (ORDER BY c, unique_id) AS k, count(*) OVER () AS n FROM ({COVERAGE}))"""))
def coverage_by_series(i: Inputs):
    rows = pin(i.model.quantile_rows())
    cover = INV.coverage_by_series(rows)
    return cover.join(INV.coverage_picks(cover).select("unique_id", "quality"), "unique_id", "left")


@AREA.query("safety_stock_summary", sql(f"""
    WITH_SERIES
    SELECT 'series' AS scope, CAST(NULL AS DATE) AS ds, count(*) AS n, {r('avg(v)')} AS mean, {r('quantile_cont(v, 0.5)')} AS median,
           {r('stddev_samp(v)')} AS std, {r('quantile_cont(v, 0.75)')} AS p75, {r('quantile_cont(v, 0.95)')} AS p95
    FROM (SELECT unique_id, avg(safety_stock) AS v FROM qf WHERE safety_stock IS NOT NULL GROUP BY 1)
    UNION ALL SELECT 'week', ds, count(*), {r('avg(safety_stock)')}, {r('median(safety_stock)')}, NULL, NULL, NULL
    FROM qf WHERE safety_stock IS NOT NULL GROUP BY ds""".replace("WITH_SERIES", "")))
def safety_stock_summary(i: Inputs):
    """Distribution over series and mean / median per forecast week."""
    rows = pin(i.model.quantile_rows())
    series = INV.series_stock_summary(rows).select(
        F.lit("series").alias("scope"), F.lit(None).cast("date").alias("ds"), F.col("n_series").alias("n"), "mean",
        F.col("p50").alias("median"), "std", "p75", "p95")
    none = F.lit(None).cast("double")
    weekly = INV.weekly_stock_summary(rows).join(
        rows.where("safety_stock is not null").groupBy("ds").agg(F.count(F.lit(1)).alias("n")), "ds").select(
        F.lit("week").alias("scope"), "ds", "n", "mean", "median", none.alias("std"), none.alias("p75"), none.alias("p95"))
    return series.unionByName(weekly)


# -- global tree model -----------------------------------------------------------------

# with the default lags and lag transform a forecast needs the mean of 4 weeks ending 26 weeks back
HAS_LAGS = "n + k >= 30"


@AREA.query("fc_gbt", sql(f"""
    SELECT unique_id, CAST(k AS INTEGER) AS step, CAST(last_ds + 7 * k AS DATE) AS ds, {HAS_LAGS} AS has_forecast
    FROM (SELECT *, CAST(unnest([1, 2, 3, 4]) AS INTEGER) AS k FROM packs WHERE demand_type = 'smooth')"""))
def fc_gbt(i: Inputs):
    """Where the tree model has a (finite) forecast; the values themselves are beyond SQL."""
    rows = i.model.tree_forecast("smooth", TR.TreeParams())
    good = F.coalesce(~F.isnan("y_pred") & (F.abs("y_pred") < 1e12), F.lit(False))
    return rows.select("unique_id", "step", "ds", good.alias("has_forecast"))


@AREA.query("gbt_search", f"""
    SELECT CAST(k AS INTEGER) AS rung, CAST(n AS BIGINT) AS n_trials, CAST(w AS INTEGER) AS n_windows, true AS all_scored, true AS trees_in_bounds, true AS best_go_on
    FROM (VALUES {", ".join(str((k, rung.trials, rung.windows)) for k, rung in enumerate(TS.ladder(TR.N_TRIALS, EV.N_WINDOWS)))}) AS t(k, n, w)""")
def gbt_search(i: Inputs):
    """The whole search, 50 trials: every rung has its trials and windows, all have a loss, and those that go on are the best of their rung."""
    found = pin(TS.search(i.model.of_type("smooth"), TR.search_space(), TREE_FEATURES, H))
    later = found.select("trial", (F.col("rung") - 1).alias("rung"), F.lit(True).alias("_on"))
    rows = found.join(later, ["trial", "rung"], "left").withColumn("_on", F.coalesce("_on", F.lit(False)))
    worst_on, best_off = F.max(F.when(F.col("_on"), F.col("mase"))), F.min(F.when(~F.col("_on"), F.col("mase")))
    return rows.groupBy("rung").agg(
        F.count(F.lit(1)).alias("n_trials"), F.max("n_windows").alias("n_windows"), F.bool_and(F.col("mase").isNotNull()).alias("all_scored"),
        F.bool_and(F.col("trees").between(1, F.col("max_iter"))).alias("trees_in_bounds"),
        F.coalesce(worst_on <= best_off, F.lit(True)).alias("best_go_on"))


@AREA.query("feature_importance", """
    SELECT CAST(count(*) AS BIGINT) AS n_features, true AS gains_sum_to_one, true AS finite FROM range(41)""")
def feature_importance(i: Inputs):
    """What must hold of the importances of all features: one row each, gains add up to 1, every value finite."""
    rows = pin(i.model.of_type("smooth"))
    fitted = TR.fit(rows, TR.TreeParams(), TREE_FEATURES)
    found = TR.feature_importance(fitted, rows, top=len(fitted.features))
    return found.agg(F.count(F.lit(1)).alias("n_features"), (F.abs(F.sum("gain") - 1) < 1e-6).alias("gains_sum_to_one"),
                     F.bool_and(~F.isnan("gain") & ~F.isnan("mse_rise")).alias("finite"))


CHOSEN = "SELECT demand_type, arg_min(model, {'s': cv_wape, 'm': model}) AS model, min(cv_wape) AS cv_wape FROM cvs WHERE demand_type <> 'smooth' GROUP BY 1"
ROUTED = sorted({m for models in FC.CANDIDATES.values() for m in models})


@AREA.query("train_predict_roundtrip", sql(f"""
    SELECT unique_id, CAST(last_ds + 7 * k AS DATE) AS ds, {r('f[k]')} AS y_pred, true AS has_forecast, demand_type, model, {r('cv_wape')} AS cv_wape
    FROM (SELECT unique_id, last_ds, demand_type, model, cv_wape, CASE model {' '.join(f"WHEN '{m}' THEN {FORECAST_SQL[m]}" for m in ROUTED)} END AS f,
                 unnest([1, 2, 3, 4]) AS k
          FROM {prepared(f"(SELECT * FROM packs JOIN ({CHOSEN}) USING (demand_type))", 'unique_id', ROUTED)})
    UNION ALL
    SELECT unique_id, CAST(last_ds + 7 * k AS DATE), NULL, {HAS_LAGS}, demand_type, 'GBT', NULL
    FROM (SELECT *, CAST(unnest([1, 2, 3, 4]) AS INTEGER) AS k FROM packs WHERE demand_type = 'smooth')"""))
def train_predict_roundtrip(i: Inputs):
    """Choose, backtest, write metadata, read them and forecast. Values of the tree model are beyond SQL: only where it has one counts."""
    path = scratch(i, "run")
    i.model.train(path, run_date=run_date())
    runs = K.read_metadata(i.spark, path).select("demand_type", "cv_wape")
    trees = F.col("model") == "GBT"
    return i.model.predict(path, run_date()).join(F.broadcast(runs), "demand_type").select(
        "unique_id", "ds", F.when(~trees, F.col("y_pred")).alias("y_pred"), F.col("y_pred").isNotNull().alias("has_forecast"),
        "demand_type", "model", "cv_wape")
