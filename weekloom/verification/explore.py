"""Exploratory aggregates, hierarchy views, diagnostics, clustering, sorts and set operations."""

from __future__ import annotations

import functools
from math import factorial

from pyspark.sql import Column, Window, functions as F

from weekloom.functions.text import fold_accents
from weekloom.operators import demand as D, diagnostics as DG, dimensions as DIM, elastic as EL, inventory as INV, panel as P
from weekloom.operators import profile as PR
from weekloom.plans import preparation as PREP
from weekloom.session import pin
from weekloom.verification.common import CTES, Inputs, Registry, r, sql

AREA = Registry()
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
PRODUCTS = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


def weekly(i: Inputs):
    return i.warehouse.fact


def quick_weekly(i: Inputs, *keys: str):
    """Weekly totals that join only the asked dimensions."""
    sales = i.tables.sales(product="product_id" in keys, region="region_id" in keys)
    return DIM.weekly_totals(sales, *keys).withColumnsRenamed({"ds": "week_date", "y": "units_sold"})


# -- totals ---------------------------------------------------------------------

@AREA.query("sales_yearly", sql("""
    SELECT CAST(year(week_date) AS INTEGER) AS year, min(week_date) AS week_date_start, max(week_date) AS week_date_end,
           CAST(sum(units_sold) AS BIGINT) AS units_sold FROM wfact GROUP BY 1"""))
def sales_yearly(i: Inputs):
    return PR.yearly(quick_weekly(i))


MONTH = "CAST(year(week_date) AS INTEGER) AS year, CAST(month(week_date) AS INTEGER) AS month"
UNITS = "CAST(sum(units_sold) AS BIGINT) AS units_sold"


@AREA.query("sales_monthly", sql(f"SELECT {MONTH}, {UNITS}, make_date(year(week_date), month(week_date), 1) AS period FROM wfact GROUP BY ALL"))
def sales_monthly(i: Inputs):
    return PR.monthly(quick_weekly(i))


@AREA.query("sales_by_region", sql(f"SELECT region_id, {UNITS}, rank() OVER (ORDER BY sum(units_sold) DESC) AS rank FROM wfact GROUP BY 1"))
def sales_by_region(i: Inputs):
    totals = PR.total_by(i.tables.sales(product=False), "region_id")
    # a handful of regions after the aggregate, so one ordered window is enough
    return totals.withColumn("rank", F.rank().over(Window.orderBy(F.col("units_sold").desc())))


@AREA.query("supplier_monthly", sql(f"""
    SELECT {MONTH}, supplier_id, {UNITS}, make_date(year(week_date), month(week_date), 1) AS period FROM wfact GROUP BY ALL"""))
def supplier_monthly(i: Inputs):
    return PR.monthly(quick_weekly(i, "supplier_id"), "supplier_id")


@AREA.query("product_monthly", sql(f"""
    SELECT {MONTH}, product_id, {UNITS}, make_date(year(week_date), month(week_date), 1) AS period FROM wfact GROUP BY ALL"""))
def product_monthly(i: Inputs):
    return PR.monthly(quick_weekly(i, "product_id"), "product_id")


def _pivot_sql(row: str, column: str, values) -> str:
    cells = ", ".join(f"""CAST(coalesce(sum(units) FILTER ({column} = '{v}'), 0) AS BIGINT) AS "{v}" """ for v in values)
    return sql(f"SELECT {row}, {cells} FROM sales GROUP BY 1")


@AREA.query("pivot_supplier_region", _pivot_sql("supplier_id", "region", REGIONS))
def pivot_supplier_region(i: Inputs):
    return PR.pivot_units(i.tables.sales(product=False), "supplier_id", "region", REGIONS)


@AREA.query("pivot_product_supplier", _pivot_sql("supplier_id", "product_id", PRODUCTS))
def pivot_product_supplier(i: Inputs):
    return PR.pivot_units(i.tables.sales(region=False), "supplier_id", "product_id", PRODUCTS)


@AREA.query("entity_counts", sql("""
    SELECT 'weeks' AS entity, count(DISTINCT week_date) AS n FROM wfact UNION ALL
    SELECT 'products', count(DISTINCT product_id) FROM wfact UNION ALL SELECT 'suppliers', count(DISTINCT supplier_id) FROM wfact UNION ALL
    SELECT 'regions', count(DISTINCT region_id) FROM wfact UNION ALL
    SELECT 'series', count(*) FROM (SELECT DISTINCT supplier_id, region_id, product_id FROM wfact)"""))
def entity_counts(i: Inputs):
    return PR.entity_counts(weekly(i))


@AREA.query("describe_units", sql(f"""
    SELECT count(units_sold) AS "count", {r('avg(units_sold)')} AS mean, {r('stddev_samp(units_sold)')} AS std, CAST(min(units_sold) AS DOUBLE) AS min,
           CAST(max(units_sold) AS DOUBLE) AS max, {r('quantile_cont(CAST(units_sold AS DOUBLE), 0.25)')} AS p25,
           {r('quantile_cont(CAST(units_sold AS DOUBLE), 0.5)')} AS p50, {r('quantile_cont(CAST(units_sold AS DOUBLE), 0.75)')} AS p75 FROM wfact"""))
def describe_units(i: Inputs):
    return PR.describe(weekly(i), "units_sold")


@AREA.query("units_histogram", sql(f"""
    SELECT CAST(least(floor((units_sold - lo) / ((hi - lo) / 30.0::DOUBLE)), 29) AS INTEGER) AS bin, count(*) AS n,
           {r('min(lo + least(floor((units_sold - lo) / ((hi - lo) / 30.0::DOUBLE)), 29) * ((hi - lo) / 30.0::DOUBLE))')} AS bin_start
    FROM wfact, (SELECT CAST(min(units_sold) AS DOUBLE) AS lo, CAST(max(units_sold) AS DOUBLE) AS hi FROM wfact) GROUP BY 1"""))
def units_histogram(i: Inputs):
    return INV.equal_width_histogram(weekly(i), "units_sold", 30)


# -- hierarchy --------------------------------------------------------------------

WEEKLY_ROWS_PER_TASK = 250_000
LEVELS = [[], ["supplier_id"], ["region_id"], ["supplier_id", "region_id"], ["supplier_id", "region_id", "product_id"]]


def _level_name(level) -> str:
    return "/".join(level) if level else "total"


def _level_id(level) -> str:
    return " || '/' || ".join(f"CAST({c} AS VARCHAR)" for c in level) if level else "'Total'"


CTES["hier"] = " UNION ALL ".join(
    f"SELECT '{_level_name(lv)}' AS level, {_level_id(lv)} AS unique_id, week_date AS ds, CAST(sum(units_sold) AS BIGINT) AS y FROM wfact GROUP BY ALL"
    for lv in LEVELS)
CTES["hier_dense"] = """
    SELECT g.level, g.unique_id, g.ds, coalesce(h.y, 0) AS y
    FROM (SELECT level, unique_id, CAST(unnest(generate_series(CAST(min(ds) AS TIMESTAMP), CAST(max(ds) AS TIMESTAMP), INTERVAL 7 DAY)) AS DATE) AS ds
          FROM hier GROUP BY 1, 2) g LEFT JOIN hier h USING (level, unique_id, ds)"""


def hierarchy(i: Inputs):
    # each row is expanded to all levels inside its task, so the number of tasks follows the rows
    rows = pin(weekly(i).withColumnsRenamed({"week_date": "ds", "units_sold": "y"}))
    return P.hierarchy_panel(P.spread(rows, ["supplier_id", "ds"], WEEKLY_ROWS_PER_TASK), LEVELS)


def dense_hierarchy(i: Inputs):
    series = ["level", "unique_id"]
    return P.fill_weeks(P.spread(pin(hierarchy(i)), series, WEEKLY_ROWS_PER_TASK), series)


@AREA.query("hierarchy_panel", sql("SELECT * FROM hier"))
def hierarchy_panel(i: Inputs):
    return hierarchy(i)


@AREA.query("hierarchy_membership", sql(" UNION ALL ".join(
    f"SELECT DISTINCT {_level_id(LEVELS[-1])} AS bottom_id, '{_level_name(lv)}' AS level, {_level_id(lv)} AS unique_id FROM wfact" for lv in LEVELS)))
def hierarchy_membership(i: Inputs):
    return P.hierarchy_membership(weekly(i), LEVELS, LEVELS[-1])


CLASS_SQL = """CASE WHEN k = 0 THEN 'Empty' WHEN n / k < 1.32 THEN CASE WHEN power(s / m, 2) < 0.49 THEN 'smooth' ELSE 'erratic' END
    ELSE CASE WHEN power(s / m, 2) < 0.49 THEN 'intermittent' ELSE 'lumpy' END END"""
TYPES = ["smooth", "erratic", "intermittent", "lumpy", "Empty"]


@AREA.query("hierarchy_profile", sql(f"""
    SELECT CASE WHEN level = 'total' THEN 'total' WHEN level = 'supplier_id/region_id/product_id' THEN 'bottom' ELSE 'mid' END AS level,
           {', '.join(f"count(*) FILTER (t = '{t}') AS {t}" for t in TYPES)}
    FROM (SELECT level, unique_id, {CLASS_SQL} AS t FROM (
        SELECT level, unique_id, count(*) AS n, count(*) FILTER (y > 0) AS k, avg(y) FILTER (y > 0) AS m, stddev_pop(y) FILTER (y > 0) AS s
        FROM hier_dense GROUP BY 1, 2)) GROUP BY 1"""))
def hierarchy_profile(i: Inputs):
    """Demand classes by hierarchy depth as a cross table."""
    classes = D.classify(dense_hierarchy(i), "y", ("level", "unique_id"), empty="Empty")
    slashes = F.length("unique_id") - F.length(F.replace("unique_id", F.lit("/")))
    depth = F.when(F.col("unique_id") == "Total", "total").when(slashes == 2, "bottom").otherwise("mid")
    return classes.groupBy(depth.alias("level")).pivot("demand_type", TYPES).count().na.fill(0)


@AREA.query("zero_share_by_level", sql(f"""
    SELECT level, {r('max(z)')} AS max_zero_share, count(*) AS n_series, {r('median(z)')} AS median_zero_share
    FROM (SELECT level, unique_id, avg(CASE WHEN y = 0 THEN 1.0 ELSE 0.0 END) AS z FROM hier_dense GROUP BY 1, 2) GROUP BY 1"""))
def zero_share_by_level(i: Inputs):
    return PR.zero_share_by_level(dense_hierarchy(i))


def dense_series(i: Inputs):
    rows = P.by_series(weekly(i), P.SERIES_KEY)
    return P.fill_weeks(rows, P.SERIES_KEY, "week_date", "units_sold").withColumnsRenamed(
        {"week_date": "ds", "units_sold": "y"})


def _grain(name: str, keys: str) -> str:
    return f"""SELECT '{name}' AS grain, {r('avg(CASE WHEN y = 0 THEN 1.0 ELSE 0.0 END)')} AS zero_rate, count(*) AS cells
        FROM (SELECT sum(units_sold) AS y FROM dense GROUP BY {keys})"""


@AREA.query("zero_cascade", sql(" UNION ALL ".join([
    _grain("year", "year(week_date)"), _grain("year/region", "year(week_date), region_id"),
    _grain("year/region/supplier", "year(week_date), region_id, supplier_id"),
    _grain("month/region/supplier/product", "date_trunc('month', week_date), region_id, supplier_id, product_id"),
    _grain("week/series", "week_date, region_id, supplier_id, product_id")])))
def zero_cascade(i: Inputs):
    return PR.zero_cascade(dense_series(i))


def _cv(name: str, keys: str) -> str:
    return f"SELECT '{name}' AS level, stddev_pop(units_sold) / avg(units_sold) AS cv FROM dense GROUP BY {keys} HAVING avg(units_sold) > 0"


@AREA.query("cv_cascade", sql(f"""
    SELECT level, count(*) AS n, {r('min(cv)')} AS min_cv, {r('max(cv)')} AS max_cv, {r('median(cv)')} AS median_cv FROM (
      SELECT 'national' AS level, stddev_samp(y) / avg(y) AS cv FROM (SELECT sum(units_sold) AS y FROM dense GROUP BY week_date)
      UNION ALL {_cv('region', 'region_id')} UNION ALL {_cv('supplier', 'supplier_id')}
      UNION ALL {_cv('series', 'supplier_id, region_id, product_id')}) GROUP BY 1"""))
def cv_cascade(i: Inputs):
    return PR.cv_cascade(dense_series(i), P.SERIES_KEY)


@AREA.query("sb_plane", sql(f"""
    SELECT unique_id, {r('adi')} AS adi, {r('cv2')} AS cv2, demand_type,
           adi <= (SELECT quantile_cont(adi, 0.98) FROM cls WHERE n_positive >= 2) + 1e-9
             AND cv2 <= (SELECT quantile_cont(cv2, 0.98) FROM cls WHERE n_positive >= 2) + 1e-9 AS in_view
    FROM cls WHERE n_positive >= 2"""))
def sb_plane(i: Inputs):
    classes = D.classify(D.capped_values(PREP.valid_panel(i.tables)), "y_capped")
    return PR.sb_plane(pin(classes))


@AREA.query("demand_kde", sql(f"""
    SELECT demand_type, CAST(i AS INTEGER) AS i, {r('max(pt)')} AS x, {r('sum(w * exp(-0.5 * power((pt - x) / bw, 2)) / (n * bw * sqrt(2 * pi())))')} AS density
    FROM (SELECT demand_type, x, w, n, bw, i, ln(1 + top) * i / 49 AS pt
          FROM (SELECT demand_type, ln(1 + y) AS x, count(*) AS w FROM rp WHERE y > 0 GROUP BY 1, 2)
          JOIN (SELECT demand_type, count(*) AS n, stddev_samp(ln(1 + y)) * power(count(*), -0.2) AS bw FROM rp WHERE y > 0 GROUP BY 1) USING (demand_type),
               (SELECT quantile_cont(CAST(y AS DOUBLE), 0.995) AS top FROM rp WHERE y > 0), (SELECT unnest(range(0, 50)) AS i))
    GROUP BY 1, 2"""))
def demand_kde(i: Inputs):
    return PR.kernel_density(i.model.panel, "y", "demand_type")


# -- regional and national series -----------------------------------------------------

CTES["rmonth"] = """
    SELECT region_id, CAST(date_trunc('month', week_date) AS DATE) AS month_date, CAST(sum(units_sold) AS BIGINT) AS y FROM wfact GROUP BY 1, 2"""
CTES["rgrid"] = """
    SELECT g.region_id, g.month_date, coalesce(y, 0) AS y FROM (
      SELECT region_id, CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS month_date
      FROM (SELECT DISTINCT region_id FROM rmonth), (SELECT min(month_date) AS lo, max(month_date) AS hi FROM rmonth)) g
    LEFT JOIN rmonth USING (region_id, month_date)"""
CTES["nat"] = """
    SELECT 'Total' AS unique_id, week_date AS ds, CAST(sum(units_sold) AS BIGINT) AS y FROM wfact GROUP BY ALL"""


def regional_grid(i: Inputs):
    rows = quick_weekly(i, "region_id").groupBy(
        "region_id", F.trunc("week_date", "month").alias("month_date")).agg(F.sum("units_sold").alias("y"))
    return PR.month_grid(rows, "region_id", "month_date", "y")


def national(i: Inputs):
    """The national weekly series: at most one row per calendar week."""
    return quick_weekly(i).select(F.lit("Total").alias("unique_id"), F.col("week_date").alias("ds"),
                                  F.col("units_sold").alias("y"))


@AREA.query("regional_monthly", sql("SELECT * FROM rgrid"))
def regional_monthly(i: Inputs):
    return regional_grid(i)


@AREA.query("regional_index", sql(f"""
    SELECT region_id, month_date, y, {r('i')} AS trend_index, {r('avg(i) OVER (PARTITION BY region_id ORDER BY month_date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)')} AS trend_index_ma3
    FROM (SELECT *, y / (arg_min(y, month_date) FILTER (y > 0) OVER (PARTITION BY region_id)) * 100 AS i FROM rgrid)"""))
def regional_index(i: Inputs):
    return PR.indexed_trend(regional_grid(i), "region_id", "month_date", "y")


@AREA.query("national_weekly", sql("""
    SELECT g.week_end, coalesce(t.units_sold, 0) AS units_sold FROM (
      SELECT CAST(unnest(generate_series(CAST(min(ds) + 6 AS TIMESTAMP), CAST(max(ds) + 6 AS TIMESTAMP), INTERVAL 7 DAY)) AS DATE) AS week_end FROM nat) g
    LEFT JOIN (SELECT CAST(ds + 6 AS DATE) AS week_end, y AS units_sold FROM nat) t USING (week_end)"""))
def national_weekly(i: Inputs):
    return PR.sunday_weeks(i.tables.sales(product=False, region=False))


@AREA.query("moving_average", sql(f"""
    SELECT ds, y, CASE WHEN count(*) OVER w = 3 THEN {r('avg(y) OVER w')} END AS ma3 FROM nat
    WINDOW w AS (ORDER BY ds ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"""))
def moving_average(i: Inputs):
    rows = national(i)
    return rows.select("ds", "y", PR.trailing_mean(rows, "ds", "y", 3, ["unique_id"]).alias("ma3"))


def acf_sql(table: str, value: str, keys: str, nlags: int) -> str:
    return f"""
      SELECT {keys}, k AS lag, n, c0, CASE WHEN k <= n // 2 - 1 THEN c / nullif(c0, 0) END AS acf
      FROM (SELECT {keys}, k, sum(a.d * b.d) AS c FROM dev a JOIN (SELECT CAST(unnest(range(1, {nlags + 1})) AS INTEGER) AS k) ON true
            JOIN dev b USING ({keys}) WHERE b.i = a.i - k GROUP BY ALL)
      JOIN (SELECT {keys}, count(*) AS n, sum(d * d) AS c0 FROM dev GROUP BY ALL) USING ({keys})""".replace(
        "dev", f"(SELECT {keys}, {value} - avg({value}) OVER (PARTITION BY {keys}) AS d, row_number() OVER (PARTITION BY {keys} ORDER BY ds) AS i FROM {table})")


@AREA.query("acf_national", sql(f"SELECT unique_id, lag, n, {r('acf')} AS acf, {r('1.96 / sqrt(n)')} AS bound FROM ({acf_sql('nat', 'y', 'unique_id', 30)})"))
def acf_national(i: Inputs):
    return DG.acf(national(i), 30)


@AREA.query("pacf_national", sql(f"""
    SELECT unique_id, lag, {r('t')} AS pacf FROM (
      WITH RECURSIVE given AS (SELECT unique_id, list(acf ORDER BY lag) AS rs FROM ({acf_sql('nat', 'y', 'unique_id', 30)}) WHERE acf IS NOT NULL GROUP BY 1),
      levels AS (
        SELECT unique_id, rs, CAST(1 AS INTEGER) AS lag, rs[1] AS t, [rs[1]] AS phi FROM given
        UNION ALL
        SELECT unique_id, rs, lag, t, list_transform(phi, lambda x, j: x - t * phi[len(phi) - j + 1]) || [t] FROM (
          SELECT unique_id, rs, lag + 1 AS lag, phi,
                 (rs[lag + 1] - list_inner_product(phi, list_reverse(rs[1:lag]))) / (1 - list_inner_product(phi, rs[1:lag])) AS t
          FROM levels WHERE lag < len(rs)))
      SELECT unique_id, lag, t FROM levels)"""))
def pacf_national(i: Inputs):
    return DG.pacf(DG.acf(national(i), 30))


ACF_BY_TYPE = acf_sql("rp", "y", "unique_id, demand_type", 26)


@AREA.query("acf_by_type", sql(f"""
    SELECT demand_type, lag, {r('avg(acf)')} AS acf_mean, {r('stddev_pop(acf)')} AS acf_std, count(*) AS n_series,
           {r('1.96 / sqrt((SELECT count(DISTINCT ds) FROM rp))')} AS bound,
           lag IN (4, 8, 13, 26) AND abs(avg(acf)) > 1.96 / sqrt((SELECT count(DISTINCT ds) FROM rp)) AS significant_model_lag
    FROM ({ACF_BY_TYPE}) WHERE n >= 20 AND acf IS NOT NULL GROUP BY 1, 2"""))
def acf_by_type(i: Inputs):
    return DG.acf_by_group(i.model.panel, 26, 20, [4, 8, 13, 26])


CTES["dec"] = """
    SELECT unique_id, ds, y, trend, t, rest - s AS remainder, s AS season_52 FROM (
      SELECT *, m - avg(CASE WHEN t < 52 THEN m END) OVER () AS s FROM (
        SELECT *, avg(rest) OVER (PARTITION BY t % 52) AS m FROM (
          SELECT *, y - trend AS rest FROM (
            SELECT unique_id, ds, y, row_number() OVER (ORDER BY ds) - 1 AS t,
                   CASE WHEN count(*) OVER a = 52 AND count(*) OVER b = 52 THEN (sum(y) OVER a + sum(y) OVER b) / 104.0::DOUBLE END AS trend
            FROM nat WINDOW a AS (ORDER BY ds ROWS BETWEEN 26 PRECEDING AND 25 FOLLOWING), b AS (ORDER BY ds ROWS BETWEEN 25 PRECEDING AND 26 FOLLOWING)))))"""


@AREA.query("decompose", sql(f"SELECT unique_id, ds, y, {r('trend')} AS trend, {r('season_52')} AS season_52, {r('remainder')} AS remainder FROM dec"))
def decompose(i: Inputs):
    return DG.decompose(national(i), [52])


def decomposed_sql(rows: str, periods: list[int]) -> str:
    """Trend over the longest period, then every period's season from what is left."""
    p, half = max(periods), max(periods) // 2
    if p % 2:
        trend = f"CASE WHEN count(*) OVER a = {p} THEN avg(y) OVER a END"
        frames = f"a AS (ORDER BY ds ROWS BETWEEN {half} PRECEDING AND {half} FOLLOWING)"
    else:
        trend = f"CASE WHEN count(*) OVER a = {p} AND count(*) OVER b = {p} THEN (sum(y) OVER a + sum(y) OVER b) / {2.0 * p}::DOUBLE END"
        frames = (f"a AS (ORDER BY ds ROWS BETWEEN {half} PRECEDING AND {half - 1} FOLLOWING), "
                  f"b AS (ORDER BY ds ROWS BETWEEN {half - 1} PRECEDING AND {half} FOLLOWING)")
    out = f"SELECT ds, y, t, trend, y - trend AS rest, 0.0::DOUBLE AS season FROM (SELECT ds, y, row_number() OVER (ORDER BY ds) - 1 AS t, {trend} AS trend FROM ({rows}) WINDOW {frames})"
    for q in periods:
        out = (f"SELECT ds, y, t, trend, rest - s AS rest, season + s AS season FROM (SELECT *, m - avg(CASE WHEN t < {q} THEN m END) OVER () AS s FROM ("
               f"SELECT *, avg(rest) OVER (PARTITION BY t % {q}) AS m FROM ({out})))")
    return out


WEEKLY_PERIODS, MONTHLY_PERIODS = [4, 5, 13, 14, 27, 51], [3, 12]
MONTHS = "SELECT CAST(date_trunc('month', ds) AS DATE) AS ds, CAST(sum(y) AS DOUBLE) AS y FROM nat GROUP BY 1"


@AREA.query("decompose_periods", sql(" UNION ALL ".join(f"""
    SELECT '{scale}' AS scale, ds, {r('y')} AS y, {r('trend')} AS trend, {r('season')} AS season, {r('rest')} AS remainder FROM ({decomposed_sql(rows, periods)})"""
    for scale, rows, periods in (("week", "SELECT ds, CAST(y AS DOUBLE) AS y FROM nat", WEEKLY_PERIODS), ("month", MONTHS, MONTHLY_PERIODS)))))
def decompose_periods(i: Inputs):
    """Several seasons in turn: of weeks and of months."""
    weeks = national(i).select("unique_id", "ds", F.col("y").cast("double").alias("y"))
    months = weeks.groupBy("unique_id", F.trunc("ds", "month").alias("ds")).agg(F.sum("y").alias("y"))

    def parts(rows, periods, scale: str):
        found = DG.decompose(rows, periods)
        season = functools.reduce(Column.__add__, [F.col(f"season_{p}") for p in periods])
        return found.select(F.lit(scale).alias("scale"), "ds", "y", "trend", season.alias("season"), "remainder")

    return parts(weeks, WEEKLY_PERIODS, "week").unionByName(parts(months, MONTHLY_PERIODS, "month"))


CTES["res"] = "SELECT unique_id, ds, remainder FROM dec WHERE remainder IS NOT NULL"


def _tail(k: int) -> str:
    return "exp(-q / 2) * (" + " + ".join(f"power(q / 2, {j}) / {float(factorial(j))}::DOUBLE" for j in range(k // 2)) + ")"


@AREA.query("ljung_box", sql(" UNION ALL ".join(f"""
    SELECT unique_id, {k} AS lag, {r('q')} AS q_stat, {r(_tail(k))} AS p_value FROM (
      SELECT unique_id, max(n) * (max(n) + 2) * sum(acf * acf / (n - lag)) AS q FROM ({acf_sql('res', 'remainder', 'unique_id', 30)})
      WHERE lag <= {k} GROUP BY 1)""" for k in (10, 20, 30))))
def ljung_box(i: Inputs):
    rest = DG.decompose(national(i), [52]).where("remainder is not null")
    return DG.ljung_box(DG.acf(rest, 30, value="remainder"), [10, 20, 30])


@AREA.query("normality_test", sql(f"""
    SELECT unique_id, n, {r('sk')} AS skewness, {r('ku')} AS excess_kurtosis, {r('n / 6.0 * (sk * sk + ku * ku / 4)')} AS jb,
           {r('exp(-(n / 6.0 * (sk * sk + ku * ku / 4)) / 2)')} AS p_value
    FROM (SELECT unique_id, count(*) AS n, avg(power(remainder - mu, 3)) / power(avg(power(remainder - mu, 2)), 1.5) AS sk,
                 avg(power(remainder - mu, 4)) / power(avg(power(remainder - mu, 2)), 2) - 3 AS ku
          FROM res, (SELECT avg(remainder) AS mu FROM res) GROUP BY 1)"""))
def normality_test(i: Inputs):
    return DG.jarque_bera(DG.decompose(national(i), [52]), "remainder")


# -- clustering -------------------------------------------------------------------------

def dtw_sql(a: str, b: str) -> str:
    """Elastic distance of two lists: a fold over the rows of the cost table, each a fold over its cells."""
    cell = f"power(e[1] - {b}[CAST(j[1] AS INTEGER)], 2) + least(prev[CAST(j[1] AS INTEGER)], prev[CAST(j[1] AS INTEGER) + 1], acc[-1])"
    far = "CAST('inf' AS DOUBLE)"
    cells = f"list_transform(range(1, len({b}) + 1), lambda q: [CAST(q AS DOUBLE)])"
    start = f"list_prepend(CAST(0 AS DOUBLE), list_transform({b}, lambda q: {far}))"
    row = f"list_reduce(list_prepend([{far}], {cells}), lambda acc, j: list_append(acc, {cell}))"
    return f"sqrt(list_reduce(list_prepend({start}, list_transform({a}, lambda q: [q])), lambda prev, e: {row})[-1])"


def standardised_sql(table: str, key: str, date: str) -> str:
    return f"""SELECT {key}, list(z ORDER BY {date}) AS zs FROM (
        SELECT {key}, {date}, coalesce((y - avg(y) OVER w) / nullif(stddev_pop(y) OVER w, 0), 0) AS z FROM {table} WINDOW w AS (PARTITION BY {key})) GROUP BY 1"""


CTES["rvec"] = standardised_sql("rgrid", "region_id", "month_date")
CTES["rdist"] = f"SELECT a.region_id, b.region_id AS other, {dtw_sql('a.zs', 'b.zs')} AS d FROM rvec a, rvec b"
# the three regions to which all are nearest, of all choices of three
CTES["rmedoids"] = """
    SELECT x, y, z FROM (SELECT a.region_id AS x, b.region_id AS y, c.region_id AS z FROM rvec a, rvec b, rvec c WHERE a.region_id < b.region_id AND b.region_id < c.region_id),
        LATERAL (SELECT sum(least(p.d, q.d, s.d)) AS total FROM rdist p JOIN rdist q USING (region_id) JOIN rdist s USING (region_id) WHERE p.other = x AND q.other = y AND s.other = z)
    ORDER BY round(total, 9), x, y, z LIMIT 1"""
CTES["rlabels"] = """
    SELECT region_id, CAST(arg_min(cluster, {'d': d, 'c': cluster}) AS INTEGER) AS cluster, min(d) AS d
    FROM (SELECT region_id, d, CASE other WHEN x THEN 0 WHEN y THEN 1 ELSE 2 END AS cluster FROM rdist, rmedoids WHERE other IN (x, y, z)) GROUP BY 1"""


def region_vectors(i: Inputs):
    return pin(DG.standardised_vectors(regional_grid(i), "region_id"))


def clustered(i: Inputs):
    """Regions around three of them: ``region_id, cluster, distance``."""
    _, labels = EL.medoids(region_vectors(i), "region_id", 3)
    return labels.withColumn("region_id", F.col("key").cast("int")).drop("key")


@AREA.query("region_clusters", sql(f"SELECT region_id, cluster, {r('d')} AS distance FROM rlabels"))
def region_clusters(i: Inputs):
    return clustered(i)


@AREA.query("dtw_pairs", sql(f"SELECT region_id, other, {r('d')} AS dtw FROM rdist, rmedoids WHERE other IN (x, y, z)"))
def dtw_pairs(i: Inputs):
    """Elastic distance of every region to every medoid."""
    vectors = region_vectors(i)
    keys, _ = EL.medoids(vectors, "region_id", 3)
    centres = vectors.where(F.col("region_id").cast("string").isin(keys)).agg(F.collect_list(F.struct(F.col("region_id").alias("other"), F.col("zs").alias("c")))).scalar()
    return vectors.select("region_id", "zs", F.inline(centres)).select("region_id", "other", DG.elastic_distance(F.col("zs"), F.col("c")).alias("dtw"))


@AREA.query("cluster_monthly", sql("""
    SELECT cluster, month_date, CAST(sum(y) AS BIGINT) AS y, count(DISTINCT region_id) AS n_regions FROM rgrid JOIN rlabels USING (region_id) GROUP BY 1, 2"""))
def cluster_monthly(i: Inputs):
    labels = clustered(i).select("region_id", "cluster")
    return regional_grid(i).join(F.broadcast(labels), "region_id").groupBy("cluster", "month_date").agg(
        F.sum("y").alias("y"), F.count_distinct("region_id").alias("n_regions"))


CTES["squarters"] = """
    SELECT s.supplier_id, q.ds, coalesce(sum(f.units_sold), 0) AS y
    FROM (SELECT DISTINCT supplier_id FROM wfact) s CROSS JOIN (SELECT DISTINCT quarter_date AS ds FROM
             (SELECT CAST(date_trunc('quarter', CAST(unnest(generate_series(CAST(min(date_trunc('month', week_date)) AS TIMESTAMP), CAST(max(week_date) AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE)) AS DATE) AS quarter_date FROM wfact)) q
    LEFT JOIN wfact f ON f.supplier_id = s.supplier_id AND CAST(date_trunc('quarter', date_trunc('month', f.week_date)) AS DATE) = q.ds GROUP BY 1, 2"""
CTES["svec"] = standardised_sql("squarters", "supplier_id", "ds")
CTES["spairs"] = f"SELECT a.supplier_id, b.supplier_id AS other, {dtw_sql('a.zs', 'b.zs')} AS d FROM svec a JOIN svec b ON a.supplier_id < b.supplier_id"


@AREA.query("series_neighbours", sql(f"""
    SELECT CAST(supplier_id AS VARCHAR) AS supplier_id, CAST(other AS VARCHAR) AS neighbour, CAST(k AS INTEGER) AS rank, {r('d')} AS distance
    FROM (SELECT *, row_number() OVER (PARTITION BY supplier_id ORDER BY d, CAST(other AS VARCHAR)) AS k
          FROM (SELECT supplier_id, other, d FROM spairs UNION ALL SELECT other, supplier_id, d FROM spairs)) WHERE k <= 3"""))
def series_neighbours(i: Inputs):
    """The three suppliers whose quarterly sales have the most alike course, for every supplier."""
    rows = quick_weekly(i, "supplier_id").groupBy("supplier_id", F.trunc("week_date", "month").alias("month_date")).agg(F.sum("units_sold").alias("y"))
    quarters = PR.month_grid(rows, "supplier_id", "month_date", "y").groupBy("supplier_id", F.trunc("month_date", "quarter").alias("month_date")).agg(F.sum("y").alias("y"))
    return EL.neighbours(pin(DG.standardised_vectors(quarters, "supplier_id")), "supplier_id", 3).withColumnRenamed("key", "supplier_id")


# -- samples, sorts, sets, functions -------------------------------------------------------

@AREA.query("sample_series", sql(f"""
    SELECT demand_type, w.ds, {r('avg(coalesce(y, 0))')} AS mean_y, {r('median(coalesce(y, 0))')} AS median_y, count(*) AS n_series
    FROM (SELECT demand_type, unique_id FROM (SELECT DISTINCT demand_type, unique_id FROM rp)
          QUALIFY row_number() OVER (PARTITION BY demand_type ORDER BY md5(unique_id || '/42'), unique_id) <= 20) c
    CROSS JOIN (SELECT CAST(unnest(generate_series(CAST(min(ds) AS TIMESTAMP), CAST(max(ds) AS TIMESTAMP), INTERVAL 7 DAY)) AS DATE) AS ds FROM rp) w
    LEFT JOIN (SELECT unique_id, ds, y FROM rp) p ON p.unique_id = c.unique_id AND p.ds = w.ds GROUP BY 1, 2"""))
def sample_series(i: Inputs):
    """Mean and median per week over a seeded sample of series per type, on a common week grid."""
    chosen = PR.sample_series(i.model.panel, 20, 42)
    return PR.sample_profile(PR.sampled_grid(i.model.panel, chosen))


@AREA.query("sort_limit_topk", sql("""
    SELECT 'best_products' AS list, product_id AS key, units, k FROM (SELECT product_id, CAST(sum(units) AS BIGINT) AS units,
        row_number() OVER (ORDER BY sum(units) DESC, product_id) AS k FROM sales GROUP BY 1) WHERE k <= 3
    UNION ALL SELECT 'last_weeks', CAST(ds AS VARCHAR), y, row_number() OVER (ORDER BY ds DESC) FROM (SELECT * FROM nat ORDER BY ds DESC LIMIT 20)
    UNION ALL SELECT 'top_suppliers_' || region, CAST(supplier_id AS VARCHAR), units, k FROM (SELECT region, supplier_id, CAST(sum(units) AS BIGINT) AS units,
        row_number() OVER (PARTITION BY region ORDER BY sum(units) DESC, supplier_id) AS k FROM sales GROUP BY 1, 2) WHERE k <= 2
    UNION ALL SELECT 'weakest_region', arg_min(region, units), min(units), 1 FROM (SELECT region, CAST(sum(units) AS BIGINT) AS units FROM sales GROUP BY 1)"""))
def sort_limit_topk(i: Inputs):
    """Ranked totals, last rows, top-k per group and the arg-min of a small result."""
    products = PR.total_by(i.tables.sales(region=False), "product_id").orderBy(
        F.col("units_sold").desc(), "product_id").limit(3)
    best = products.select(F.lit("best_products").alias("list"), F.col("product_id").alias("key"), F.col("units_sold").alias("units"),
                           F.row_number().over(Window.orderBy(F.col("units_sold").desc(), "product_id")).alias("k"))
    weeks = national(i).orderBy(F.col("ds").desc()).limit(20)
    last = weeks.select(F.lit("last_weeks").alias("list"), F.col("ds").cast("string").alias("key"), F.col("y").alias("units"),
                        F.row_number().over(Window.orderBy(F.col("ds").desc())).alias("k"))
    by_region = PR.total_by(i.tables.sales(product=False), "region", "supplier_id")
    order = Window.partitionBy("region").orderBy(F.col("units_sold").desc(), "supplier_id")
    top = by_region.withColumn("k", F.row_number().over(order)).where("k <= 2").select(
        F.concat(F.lit("top_suppliers_"), "region").alias("list"), F.col("supplier_id").cast("string").alias("key"),
        F.col("units_sold").alias("units"), "k")
    regions = PR.total_by(by_region, "region")
    weakest = regions.agg(F.min_by("region", "units_sold").alias("key"), F.min("units_sold").alias("units")).select(
        F.lit("weakest_region").alias("list"), "key", "units", F.lit(1).alias("k"))
    return best.unionByName(last).unionByName(top).unionByName(weakest)


@AREA.query("set_operations", sql("""
    SELECT 'union_all' AS op, count(*) AS n FROM (SELECT unique_id FROM vp UNION ALL SELECT unique_id FROM filled WHERE segment <> 'valid')
    UNION ALL SELECT 'union_distinct', count(*) FROM (SELECT CAST(l_shipdate AS DATE) AS d FROM lineitem UNION SELECT CAST(o_orderdate AS DATE) FROM orders)
    UNION ALL SELECT 'distinct_on_key', count(*) FROM (SELECT DISTINCT supplier_id, product_id FROM sales)
    UNION ALL SELECT 'difference', count(*) FROM (SELECT CAST(l_shipdate AS DATE) AS d FROM lineitem EXCEPT SELECT CAST(o_orderdate AS DATE) FROM orders)"""))
def set_operations(i: Inputs):
    panel, excluded = PREP.valid_panel(i.tables).select("unique_id"), PREP.excluded_panel(i.tables).select("unique_id")
    shipped = i.tables.line_dates()
    ordered = i.tables.table("orders", "o_orderdate").select(F.col("o_orderdate").cast("date").alias("date"))
    frames = {
        "union_all": panel.unionByName(excluded),
        "union_distinct": shipped.union(ordered).distinct(),
        "distinct_on_key": i.tables.sales(region=False).select("supplier_id", "product_id").dropDuplicates(["supplier_id", "product_id"]),
        "difference": shipped.distinct().join(ordered.distinct(), "date", "left_anti"),
    }
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(op).alias("op"), "n") for op, df in frames.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@AREA.query("scalar_functions", sql(f"""
    SELECT supplier_id, product_id, d, strftime(d, '%Y%m%d') AS d_compact, strftime(d, '%Y-%m') AS d_month,
           CAST(strptime(strftime(d, '%Y%m%d'), '%Y%m%d') AS DATE) AS d_parsed, CAST(isodow(d) - 1 AS INTEGER) AS weekday,
           CAST(date_trunc('quarter', d) AS DATE) AS quarter_start, CAST(d - 182 AS DATE) AS half_year_ago,
           CAST(floor((DATE '2002-01-01' - d) / 7) AS INTEGER) AS weeks_to_2002, 'Supplier ' || supplier_id AS label,
           lower(product_id) AS folded, contains(lower(product_id), 'o') AS has_o, supplier_id || '/' || product_id AS path,
           split_part(supplier_id || '/' || product_id, '/', 2) AS leaf, {r('ln(1 + units)')} AS log_units, {r('sqrt(units)')} AS root_units,
           {r('sin(units)')} AS sin_units, least(greatest(units, 5), 40) AS clipped, CAST(trunc(units / 7.0::DOUBLE) AS BIGINT) AS truncated,
           CASE WHEN units < 10 THEN 'low' WHEN units < 30 THEN 'mid' ELSE 'high' END AS band,
           coalesce(CASE WHEN units > 25 THEN units END, 0) AS filled_units, units // 2 AS json_half, n
    FROM (SELECT supplier_id, product_id, d, CAST(sum(units) AS BIGINT) AS units, count(*) AS n FROM sales GROUP BY 1, 2, 3)"""))
def scalar_functions(i: Inputs):
    """The scalar families in one projection over daily sales."""
    rows = i.tables.sales(region=False).groupBy("supplier_id", "product_id", F.col("date").alias("d")).agg(
        F.sum("units_sold").alias("u"), F.count(F.lit(1)).alias("n"))
    d, u = F.col("d"), F.col("u")
    path = F.concat_ws("/", F.col("supplier_id").cast("string"), "product_id")
    packed = F.to_json(F.struct(F.floor(u / 2).alias("half")))
    return rows.select(
        "supplier_id", "product_id", "d",
        F.date_format(d, "yyyyMMdd").alias("d_compact"), F.date_format(d, "yyyy-MM").alias("d_month"),
        F.to_date(F.date_format(d, "yyyyMMdd"), "yyyyMMdd").alias("d_parsed"), F.weekday(d).alias("weekday"),
        F.trunc(d, "quarter").alias("quarter_start"), F.date_sub(d, 182).alias("half_year_ago"),
        F.floor(F.datediff(F.lit("2002-01-01").cast("date"), d) / 7).cast("int").alias("weeks_to_2002"),
        F.concat(F.lit("Supplier "), "supplier_id").alias("label"), fold_accents(F.col("product_id")).alias("folded"),
        F.contains(F.lower("product_id"), F.lit("o")).alias("has_o"), path.alias("path"),
        F.element_at(F.split(path, "/"), -1).alias("leaf"), F.log1p(u).alias("log_units"), F.sqrt(u).alias("root_units"),
        F.sin(u).alias("sin_units"), F.least(F.greatest(u, F.lit(5)), F.lit(40)).alias("clipped"),
        (u / 7).cast("bigint").alias("truncated"),
        F.when(u < 10, "low").when(u < 30, "mid").otherwise("high").alias("band"),
        F.coalesce(F.when(u > 25, u), F.lit(0)).alias("filled_units"),
        F.get_json_object(packed, "$.half").cast("bigint").alias("json_half"), "n")
