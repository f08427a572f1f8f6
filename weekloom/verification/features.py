"""Holiday, weather, lag and training features."""

from __future__ import annotations

from pyspark.sql import functions as F

from weekloom.operators import demand as D, features as FE, lags as L, panel as P
from weekloom.plans import preparation as PREP
from weekloom.sources import holidays as HOL
from weekloom.verification.common import CTES, H, Inputs, Registry, r, sql

AREA = Registry()


def _holiday_sql() -> str:
    easter = """
        SELECT y, make_date(y, 3, 21) + CAST(l + 7 AS INTEGER) AS e FROM (
          SELECT y, i - (y + y // 4 + i + 2 - c + c // 4) % 7 AS l FROM (
            SELECT y, c, g, h - (h // 28) * (1 - (29 // (h + 1)) * ((21 - g) // 11)) AS i FROM (
              SELECT y, y // 100 AS c, y % 19 AS g,
                     (19 * (y % 19) + y // 100 - (y // 100) // 4 - (8 * (y // 100) + 13) // 25 + 15) % 30 AS h FROM years)))"""
    parts = [f"SELECT make_date(y, {m}, {d}) AS date, '{n}' AS name, CAST(NULL AS VARCHAR) AS subdivision FROM years WHERE y >= {since}"
             for m, d, n, since in HOL.NATIONAL_FIXED]
    parts += [f"SELECT CAST(e + ({k}) AS DATE), '{n}', NULL FROM ({easter})" for k, n in HOL.NATIONAL_MOVABLE]
    parts += [f"SELECT make_date(y, {m}, {d}), '{n}', '{s}' FROM years WHERE y >= {since}" for m, d, n, s, since in HOL.STATE_FIXED]
    parts += [f"SELECT CAST(e + ({k}) AS DATE), '{n}', '{s}' FROM ({easter}) WHERE y >= {since}" for k, n, s, since in HOL.STATE_MOVABLE]
    return " UNION ALL ".join(parts)


STATES = ", ".join(f"({k}, '{s}')" for k, states in HOL.REGION_STATES.items() for s in states)
CTES["hol"] = _holiday_sql()
CTES["states"] = f"SELECT * FROM (VALUES {STATES}) AS t(region_id, subdivision)"
CTES["hweeks"] = """
    SELECT CAST(unnest(generate_series(CAST(min(ds) AS TIMESTAMP), CAST(max(ds) + 28 AS TIMESTAMP), INTERVAL 7 DAY)) AS DATE) AS ds
    FROM rp"""
CTES["hf"] = """
    SELECT ds, region_id, nat > 0 AS is_national_holiday, reg > 0 AS is_regional_holiday, nat + reg > 0 AS is_holiday,
           CAST(nat + reg AS INTEGER) AS n_holidays, t AS holiday_type,
           CASE t WHEN 'carnival' THEN 5 WHEN 'easter' THEN 4 WHEN 'christmas_newyear' THEN 3 WHEN 'other' THEN 2
                  WHEN 'regional' THEN 1 ELSE 0 END AS holiday_type_enc,
           CAST(coalesce(least(min(CASE WHEN nat + reg > 0 THEN k END) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) - k, 4), 4) AS INTEGER)
               AS weeks_to_next_holiday,
           CAST(coalesce(least(k - max(CASE WHEN nat + reg > 0 THEN k END) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 4), 4) AS INTEGER)
               AS weeks_since_last_holiday
    FROM (SELECT *, row_number() OVER (PARTITION BY region_id ORDER BY ds) AS k,
                 CASE WHEN nat > 0 AND (names LIKE '%carnaval%' OR names LIKE '%quaresma%') THEN 'carnival'
                      WHEN nat > 0 AND (names LIKE '%sexta-feira santa%' OR names LIKE '%corpus christi%') THEN 'easter'
                      WHEN nat > 0 AND (names LIKE '%natal%' OR names LIKE '%ano-novo%' OR names LIKE '%confraterniza%') THEN 'christmas_newyear'
                      WHEN nat > 0 THEN 'other' WHEN reg > 0 THEN 'regional' ELSE 'none' END AS t
          FROM (SELECT w.ds, s.region_id,
                   (SELECT count(*) FROM hol h WHERE h.subdivision IS NULL AND h.date BETWEEN w.ds AND w.ds + 6) AS nat,
                   (SELECT strip_accents(lower(string_agg(h.name, ' '))) FROM hol h WHERE h.subdivision IS NULL
                        AND h.date BETWEEN w.ds AND w.ds + 6) AS names,
                   (SELECT count(*) FROM (SELECT DISTINCT h.date, h.name FROM hol h JOIN states s2 USING (subdivision)
                        WHERE s2.region_id = s.region_id AND h.date BETWEEN w.ds AND w.ds + 6
                          AND h.date NOT IN (SELECT date FROM hol WHERE subdivision IS NULL))) AS reg
                FROM hweeks w CROSS JOIN (SELECT DISTINCT region_id FROM states) s))
    WINDOW w AS (PARTITION BY region_id ORDER BY ds)"""
CTES["codes"] = """
    SELECT product_id, CAST(dense_rank() OVER (ORDER BY product_attribute_1) - 1 AS INTEGER) AS product_attribute_1,
           CAST(dense_rank() OVER (ORDER BY product_attribute_2) - 1 AS INTEGER) AS product_attribute_2,
           CAST(dense_rank() OVER (ORDER BY product_attribute_3) - 1 AS INTEGER) AS product_attribute_3 FROM dim_product"""
CTES["stat"] = """
    SELECT unique_id, coalesce(product_attribute_1, -1) AS product_attribute_1, coalesce(product_attribute_2, -1) AS product_attribute_2,
           coalesce(product_attribute_3, -1) AS product_attribute_3, supplier_id, region_id
    FROM (SELECT unique_id, CAST(split_part(unique_id, '/', 1) AS BIGINT) AS supplier_id, split_part(unique_id, '/', 2) AS product_id
          FROM cls) LEFT JOIN sup_reg USING (supplier_id) LEFT JOIN codes USING (product_id)"""
HOLIDAY_LIST, WEATHER_LIST = ", ".join(FE.HOLIDAY_COLUMNS), ", ".join(FE.WEATHER_COLUMNS)
CTES["assembled"] = f"""
    SELECT r.unique_id, r.ds, r.y, r.demand_type, product_attribute_1, product_attribute_2, product_attribute_3, supplier_id, s.region_id,
           {HOLIDAY_LIST}, {WEATHER_LIST}
    FROM rp r LEFT JOIN stat s USING (unique_id) LEFT JOIN hf ON hf.ds = r.ds AND hf.region_id = s.region_id
    LEFT JOIN wx ON wx.ds = r.ds AND wx.region_id = s.region_id"""

WEATHER_SQL = ", ".join(f"{r(c)} AS {c}" for c in ("temp_max", "temp_min", "temp_mean", "precip", "wind_max"))


@AREA.query("holiday_calendar", sql("SELECT * FROM hol"))
def holiday_calendar(i: Inputs):
    return HOL.holiday_table(HOL.years_covered(i.tables.line_dates(), "date", H))


@AREA.query("holiday_features", sql("SELECT * FROM hf"))
def holiday_features(i: Inputs):
    return i.model.holidays


@AREA.query("holiday_summary", sql("""
    SELECT holiday_type, count(*) FILTER (is_holiday) AS n_holiday_weeks FROM hf WHERE region_id = 4 GROUP BY 1"""))
def holiday_summary(i: Inputs):
    return FE.holiday_totals(i.model.holidays, 4)


@AREA.query("weather_weekly", sql(f"""
    SELECT ds, region_id, {WEATHER_SQL}, is_cold, is_hot, is_rainy, fetch_start, fetch_end
    FROM wx, (SELECT min(ds) - 364 AS fetch_start, max(ds) + 28 - 364 AS fetch_end FROM rp)"""))
def weather_weekly(i: Inputs):
    """Shifted weekly weather with the source range it was asked from."""
    span = FE.fetch_range(i.model.span, H)
    return i.model.weather.withColumns({c: span.select(c).scalar() for c in ("fetch_start", "fetch_end")})


def _cycle(name: str, part: str, period: int) -> str:
    angle = f"2 * pi() * {part}(ds) / {period}"
    return f"{r(f'sin({angle})')} AS {name}_sin, {r(f'cos({angle})')} AS {name}_cos"


@AREA.query("calendar_features", sql(f"""
    SELECT unique_id, ds, CAST(year(ds) AS INTEGER) AS year, {_cycle('month', 'month', 12)}, {_cycle('quarter', 'quarter', 4)},
           {_cycle('week', 'weekofyear', 52)} FROM vp"""))
def calendar_features(i: Inputs):
    return FE.calendar_features(PREP.valid_panel(i.tables).select("unique_id", "ds"))


@AREA.query("product_codes", sql("""
    SELECT p_partkey AS product_id, CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS INTEGER) AS product_attribute_1,
           CAST(dense_rank() OVER (ORDER BY p_type) - 1 AS INTEGER) AS product_attribute_2,
           CAST(dense_rank() OVER (ORDER BY CAST(p_size AS VARCHAR)) - 1 AS INTEGER) AS product_attribute_3 FROM part"""))
def product_codes(i: Inputs):
    parts = i.tables.table("part", "p_partkey", "p_brand", "p_type", "p_size")
    named = parts.select(F.col("p_partkey").alias("product_id"), F.col("p_brand").alias("product_attribute_1"),
                         F.col("p_type").alias("product_attribute_2"),
                         F.col("p_size").cast("string").alias("product_attribute_3"))
    return FE.ordinal_codes(named, *FE.STATIC_COLUMNS[:3])


@AREA.query("static_features", sql("SELECT * FROM stat"))
def static_features(i: Inputs):
    return i.model.static


def _rounded_weather() -> str:
    return ", ".join(f"{r(c)} AS {c}" for c in FE.WEATHER_COLUMNS if c != "is_rainy")


@AREA.query("training_dataset", sql(f"""
    SELECT unique_id, ds, y, product_attribute_1, product_attribute_2, product_attribute_3, supplier_id, region_id,
           {HOLIDAY_LIST}, {_rounded_weather()}, is_rainy FROM assembled"""))
def training_dataset(i: Inputs):
    return i.model.dataset


@AREA.query("future_exog", sql(f"""
    SELECT f.unique_id, step, f.ds, product_attribute_1, product_attribute_2, product_attribute_3, supplier_id, s.region_id,
           {HOLIDAY_LIST}, {_rounded_weather()}, is_rainy
    FROM (SELECT unique_id, step, CAST(last + 7 * step AS DATE) AS ds FROM (SELECT unique_id, max(ds) AS last FROM rp GROUP BY 1),
          (SELECT CAST(unnest(range(1, 5)) AS INTEGER) AS step)) f
    LEFT JOIN stat s USING (unique_id) LEFT JOIN hf ON hf.ds = f.ds AND hf.region_id = s.region_id
    LEFT JOIN wx ON wx.ds = f.ds AND wx.region_id = s.region_id"""))
def future_exog(i: Inputs):
    return i.model.future_exogenous


def _lag_sql(lags, window: int, table: str = "o") -> str:
    parts = []
    for k in lags:
        parts.append(f"{r(f'lag(y, {k}) OVER {table}')} AS lag{k}")
        frame = f"({table} ROWS BETWEEN {k + window - 1} PRECEDING AND {k} PRECEDING)"
        parts.append(f"CASE WHEN count(*) OVER {frame} = {window} THEN {r(f'avg(y) OVER {frame}')} END AS rolling_mean_lag{k}_window_size{window}")
    return ", ".join(parts)


EXTENDED = """(SELECT unique_id, ds, CAST(y AS DOUBLE) AS y FROM rp UNION ALL
    SELECT unique_id, CAST(last + 7 * step AS DATE), NULL FROM (SELECT unique_id, max(ds) AS last FROM rp GROUP BY 1),
           (SELECT CAST(unnest(range(1, 5)) AS INTEGER) AS step))"""
DATE_PARTS = "CAST(month(ds) AS INTEGER) AS month, CAST(quarter(ds) AS INTEGER) AS quarter, CAST(weekofyear(ds) AS INTEGER) AS week"


@AREA.query("lag_features", sql(f"""
    SELECT unique_id, ds, {r('y')} AS y, {_lag_sql([4, 8, 13, 26, 52], 13)},
           {r("avg(y) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 4 PRECEDING)")} AS expanding_mean_lag4, {DATE_PARTS}
    FROM {EXTENDED} WINDOW o AS (PARTITION BY unique_id ORDER BY ds)"""))
def lag_features(i: Inputs):
    """Long preset with rolling means for history and horizon, plus an expanding mean."""
    rows = L.lag_features(i.model.panel, L.LAG_PRESETS["long"], "rolling_mean_13", H)
    return rows.withColumn("expanding_mean_lag4", L.lag_columns([4], "expanding_mean")["expanding_mean_lag4"])


@AREA.query("target_transforms", sql(f"""
    SELECT unique_id, ds, demand_type, {r('y')} AS y, {r('d')} AS y_diff, {r('(y - m) / s')} AS y_scaled, {r('ln(1 + y)')} AS y_log1p,
           {r('(power(y + 1, 0.5) - 1) / 0.5')} AS y_boxcox, {r('y')} AS y_from_diff, {r('y')} AS y_from_scaled,
           {r('y')} AS y_from_log1p, {r('y')} AS y_from_boxcox
    FROM (SELECT *, y - lag(y) OVER (PARTITION BY unique_id ORDER BY ds) AS d, avg(y) OVER (PARTITION BY unique_id) AS m,
                 CASE WHEN stddev_pop(y) OVER (PARTITION BY unique_id) > 0 THEN stddev_pop(y) OVER (PARTITION BY unique_id) ELSE 1 END AS s FROM rp)"""))
def target_transforms(i: Inputs):
    return L.target_transforms(i.model.panel)


@AREA.query("training_matrix", sql(f"""
    SELECT * FROM (
      SELECT unique_id, ds, {r('y')} AS y, product_attribute_1, product_attribute_2, product_attribute_3, supplier_id, region_id,
             {HOLIDAY_LIST}, {_rounded_weather()}, is_rainy, {_lag_sql([4, 8, 13, 26], 4)}, {DATE_PARTS}
      FROM assembled WHERE demand_type = 'smooth' WINDOW o AS (PARTITION BY unique_id ORDER BY ds))
    WHERE lag26 IS NOT NULL AND rolling_mean_lag26_window_size4 IS NOT NULL"""))
def training_matrix(i: Inputs):
    rows = i.model.of_type("smooth").withColumn("y", F.col("y").cast("double"))
    return L.training_matrix(rows, L.LAG_PRESETS["medium"], "rolling_mean_4")


@AREA.query("train_stats", sql(f"""
    SELECT v.unique_id, ds, y, is_test, {r('cv')} AS cv, {r('q50')} AS q50, {r('iqr')} AS iqr
    FROM (SELECT *, ds > cutoff AS is_test FROM rp, cut) v JOIN
      (SELECT unique_id, CASE WHEN avg(y) > 0 THEN coalesce(stddev_samp(y), 0) / avg(y) ELSE 0 END AS cv, quantile_cont(CAST(y AS DOUBLE), 0.5) AS q50,
              quantile_cont(CAST(y AS DOUBLE), 0.75) - quantile_cont(CAST(y AS DOUBLE), 0.25) AS iqr
       FROM rp, cut WHERE ds <= cutoff GROUP BY 1) t USING (unique_id)"""))
def train_stats(i: Inputs):
    rows = i.model.panel.select("unique_id", "ds", "y").withColumn("is_test", F.col("ds") > i.model.cutoff)
    return L.add_train_statistics(rows, rows.where(~F.col("is_test")))
