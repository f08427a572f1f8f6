"""Shared pieces of the registered queries and of their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from weekloom.plans.modelling import Modelling
from weekloom.plans.warehouse import Warehouse
from weekloom.sources.retail import RetailTables

Query = Callable[[SparkSession, str], DataFrame]
DIGITS = 6
NUDGE = 1e-9
H = 4


class Registry:
    """Queries and oracle statements of one area, filled by decorators."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def query(self, name: str, oracle: str | None = None) -> Callable:
        def add(build: Callable[["Inputs"], DataFrame]) -> Callable:
            self.queries[name] = lambda spark, folder: rounded(build(Inputs(spark, folder)))
            if oracle is not None:
                self.oracles[name] = oracle
            return build
        return add


class Inputs:
    """What a query may start from: tables, warehouse and model plan of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark = spark
        self.tables = RetailTables(spark, folder)
        self.warehouse = Warehouse(self.tables)
        self.model = Modelling(self.tables, H)


def rounded(df: DataFrame) -> DataFrame:
    """Doubles rounded to ``DIGITS``, since engines add in different orders.

    ``NUDGE`` moves exact decimal ties off the rounding edge, where the last bit would decide.
    """
    return df.select(*[
        F.round(F.col(f.name) + NUDGE, DIGITS).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
        for f in df.schema.fields
    ])


def r(expression: str) -> str:
    return f"(round(CAST({expression} AS DOUBLE) + {NUDGE}::DOUBLE, {DIGITS}) + 0.0)"


# -- named table expressions ---------------------------------------------------

CTES: dict[str, str] = {
    "regions": "SELECT r_regionkey, r_name, CAST(row_number() OVER (ORDER BY r_name) AS INTEGER) AS region_id FROM region",
    "sup_reg": """
        SELECT s_suppkey AS supplier_id, r_name AS region, region_id
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN regions ON n_regionkey = r_regionkey""",
    "sales": """
        SELECT CAST(l_shipdate AS DATE) AS d, l_suppkey AS supplier_id, CAST(l_quantity AS BIGINT) AS units,
               p_type AS product_id, p_brand AS a1, p_type AS a2, CAST(p_size AS VARCHAR) AS a3, region, region_id
        FROM lineitem JOIN part ON l_partkey = p_partkey JOIN sup_reg ON l_suppkey = supplier_id""",
    "cal": """
        SELECT date, CAST(year(date) AS INTEGER) AS year,
               CASE WHEN month(date) <= 6 THEN 1 ELSE 2 END AS semester,
               make_date(year(date), CASE WHEN month(date) <= 6 THEN 1 ELSE 7 END, 1) AS semester_date,
               CASE WHEN month(date) <= 6 THEN 'H1' ELSE 'H2' END AS semester_name,
               CAST(quarter(date) AS INTEGER) AS quarter, CAST(date_trunc('quarter', date) AS DATE) AS quarter_date,
               'Q' || quarter(date) AS quarter_name, CAST(month(date) AS INTEGER) AS month, monthname(date) AS month_name,
               CAST(date_trunc('month', date) AS DATE) AS month_date, CAST(day(date) AS INTEGER) AS day,
               CAST(weekofyear(date) AS INTEGER) AS week, CAST(date_trunc('week', date) AS DATE) AS week_date,
               CAST(isodow(date) - 1 AS INTEGER) AS day_of_week, dayname(date) AS day_of_week_name
        FROM (SELECT CAST(g AS DATE) AS date FROM (
            SELECT unnest(generate_series(date_trunc('week', min(l_shipdate)), CAST(max(CAST(l_shipdate AS DATE)) AS TIMESTAMP), INTERVAL 1 DAY)) AS g
            FROM lineitem))""",
    "wcal": """
        SELECT week_date, week, min(date) OVER w AS start_date, max(date) OVER w AS end_date, year, semester, semester_date,
               semester_name, quarter, quarter_date, quarter_name, month, month_name, month_date
        FROM cal WINDOW w AS (PARTITION BY week_date)
        QUALIFY row_number() OVER (PARTITION BY week_date ORDER BY date) = 1""",
    "wfact": """
        SELECT CAST(date_trunc('week', d) AS DATE) AS week_date, supplier_id, region_id, product_id,
               CAST(sum(units) AS BIGINT) AS units_sold
        FROM sales GROUP BY ALL""",
    "series_ends": """
        SELECT supplier_id, region_id, product_id, min(week_date) AS first_week_date, max(week_date) AS last_week_date
        FROM wfact GROUP BY ALL""",
    "dense": """
        SELECT g.supplier_id, g.region_id, g.product_id, g.week_date, coalesce(f.units_sold, 0) AS units_sold
        FROM (SELECT supplier_id, region_id, product_id, CAST(unnest(generate_series(
                CAST(first_week_date AS TIMESTAMP), CAST(last_week_date AS TIMESTAMP), INTERVAL 7 DAY)) AS DATE) AS week_date
              FROM series_ends) g
        LEFT JOIN wfact f USING (supplier_id, region_id, product_id, week_date)""",
    "registry": """
        SELECT CAST(row_number() OVER (ORDER BY supplier_id, region_id, product_id) AS INTEGER) AS time_series_id, *,
               num_week_with_sales / total_weeks_length AS sales_weeks_ratio,
               std_weekly_sales / (avg_weekly_sales + 1e-6) AS cv, q75_sales - q25_sales AS iqr
        FROM (SELECT supplier_id, region_id, product_id, min(week_date) AS first_week_date, max(week_date) AS last_week_date,
                count(*) AS total_weeks_length, count(*) FILTER (units_sold > 0) AS num_week_with_sales,
                count(*) FILTER (units_sold = 0) AS num_week_with_zeros, CAST(sum(units_sold) AS BIGINT) AS sales_units,
                avg(units_sold) AS avg_weekly_sales, coalesce(stddev_samp(units_sold), 0) AS std_weekly_sales,
                max(units_sold) AS max_weekly_sales, min(units_sold) AS min_weekly_sales,
                quantile_cont(CAST(units_sold AS DOUBLE), 0.25) AS q25_sales,
                quantile_cont(CAST(units_sold AS DOUBLE), 0.5) AS q50_sales,
                quantile_cont(CAST(units_sold AS DOUBLE), 0.75) AS q75_sales
              FROM dense GROUP BY ALL) WHERE num_week_with_sales > 0""",
    "dim_product": """
        SELECT product_id, a.x AS product_attribute_1, a.y AS product_attribute_2, a.z AS product_attribute_3,
               'Product ' || product_id AS product_name
        FROM (SELECT product_id, min({'x': a1, 'y': a2, 'z': a3}) AS a FROM sales GROUP BY 1)""",
    # modelling panel
    "mw": """
        SELECT CASE WHEN grouping(product_id) = 1 THEN CAST(supplier_id AS VARCHAR)
                    ELSE supplier_id || '/' || product_id END AS unique_id, ds, CAST(sum(units) AS BIGINT) AS y
        FROM (SELECT l_suppkey AS supplier_id, p_type AS product_id, CAST(date_trunc('week', l_shipdate) AS DATE) AS ds,
                     CAST(l_quantity AS BIGINT) AS units
              FROM lineitem JOIN part ON l_partkey = p_partkey)
        GROUP BY GROUPING SETS ((supplier_id, ds), (supplier_id, product_id, ds))""",
    "ref": "SELECT CAST(date_trunc('week', max(l_shipdate)) AS DATE) AS ref_date FROM lineitem",
    "seg": """
        SELECT unique_id, first, last, n, CASE WHEN n < 26 THEN 'cold_start'
                 WHEN last < ref_date - 182 THEN 'discontinued' ELSE 'valid' END AS segment,
               CAST(floor((ref_date - last) / 7) AS INTEGER) AS weeks_since_last_sale
        FROM (SELECT unique_id, min(ds) AS first, max(ds) AS last, (max(ds) - min(ds)) / 7 + 1 AS n FROM mw GROUP BY 1), ref""",
    "filled": """
        SELECT g.unique_id, g.ds, coalesce(m.y, 0) AS y, segment, weeks_since_last_sale
        FROM (SELECT unique_id, segment, weeks_since_last_sale, CAST(unnest(generate_series(CAST(first AS TIMESTAMP),
                CAST(last AS TIMESTAMP), INTERVAL 7 DAY)) AS DATE) AS ds FROM seg) g
        LEFT JOIN mw m USING (unique_id, ds)""",
    "vp": "SELECT unique_id, ds, y FROM filled WHERE segment = 'valid'",
    "near": """
        SELECT unique_id, ds, y,
               median(CAST(y AS DOUBLE)) FILTER (y > 0) OVER w AS med, mad(CAST(y AS DOUBLE)) FILTER (y > 0) OVER w AS mad,
               count(*) FILTER (y > 0) OVER w AS k, count(*) FILTER (y > 0) OVER (PARTITION BY unique_id) AS npos
        FROM vp WINDOW w AS (PARTITION BY unique_id ORDER BY ds ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING)""",
    "flags": """
        SELECT unique_id, ds, y, b AS rolling_baseline, s AS rolling_std, b + 3.0 * s AS upper_threshold,
               0.0 AS lower_threshold, coalesce(y > 0 AND y > b + 3.0 * s, false) AS is_outlier,
               CASE WHEN coalesce(y > 0 AND y > b + 3.0 * s, false) THEN CAST(trunc(b + 3.0 * s) AS BIGINT) ELSE y END AS y_capped
        FROM (SELECT *, CASE WHEN npos >= 13 AND k >= 3 THEN med END AS b,
                     CASE WHEN npos >= 13 AND k >= 3 THEN 1.4826 * mad END AS s FROM near)""",
    "cls": """
        SELECT unique_id, n, n_positive, n / n_positive AS adi, power(s / m, 2) AS cv2,
               CASE WHEN n_positive = 0 THEN 'lumpy'
                    WHEN n / n_positive < 1.32 THEN CASE WHEN power(s / m, 2) < 0.49 THEN 'smooth' ELSE 'erratic' END
                    ELSE CASE WHEN power(s / m, 2) < 0.49 THEN 'intermittent' ELSE 'lumpy' END END AS demand_type
        FROM (SELECT unique_id, count(*) AS n, count(*) FILTER (y_capped > 0) AS n_positive,
                     avg(y_capped) FILTER (y_capped > 0) AS m, stddev_pop(y_capped) FILTER (y_capped > 0) AS s
              FROM flags GROUP BY 1)""",
    "rp": "SELECT f.unique_id, f.ds, f.y_capped AS y, c.demand_type FROM flags f JOIN cls c USING (unique_id)",
    "packs": """
        SELECT unique_id, demand_type, list(CAST(y AS DOUBLE) ORDER BY ds) AS ys, count(*) AS n, max(ds) AS last_ds
        FROM rp GROUP BY 1, 2""",
    "cut": "SELECT max(ds) AS m, max(ds) - 28 AS cutoff FROM rp",
    "ho": """
        SELECT unique_id, demand_type, list_slice(ys, 1, n - t) AS ys, list_slice(ys, n - t + 1, n) AS actual,
               n - t AS n, CAST(last_ds - 7 * t AS DATE) AS last_ds, cutoff
        FROM (SELECT *, CAST(greatest(floor((last_ds - cutoff) / 7), 0) AS INTEGER) AS t FROM packs, cut) WHERE n > t""",
    # holidays and weather
    "years": """
        SELECT unnest(range(year(min(l_shipdate)), year(max(CAST(l_shipdate AS DATE)) + 34) + 1)) AS y FROM lineitem""",
    "wxd": """
        SELECT CAST(o_orderdate AS DATE) AS date, region_id, max(o_totalprice / 12347) AS temperature_2m_max,
               min(o_totalprice / 12347) AS temperature_2m_min, avg(o_totalprice / 12347) AS temperature_2m_mean,
               count(*) * 5.0 AS precipitation_sum, CAST(max(o_orderkey % 80) AS DOUBLE) AS windspeed_10m_max
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
             JOIN regions ON n_regionkey = r_regionkey GROUP BY 1, 2""",
    "wx": """
        SELECT ds, region_id, temp_max, temp_min, temp_mean, precip, wind_max, CAST(temp_mean < 15 AS INTEGER) AS is_cold,
               CAST(temp_mean > 30 AS INTEGER) AS is_hot, CAST(precip > 50 AS INTEGER) AS is_rainy
        FROM (SELECT CAST(date + CAST((8 - isodow(date)) % 7 + 364 AS INTEGER) AS DATE) AS ds, region_id, max(temperature_2m_max) AS temp_max,
                     min(temperature_2m_min) AS temp_min, avg(temperature_2m_mean) AS temp_mean,
                     sum(precipitation_sum) AS precip, max(windspeed_10m_max) AS wind_max
              FROM wxd GROUP BY 1, 2), (SELECT min(ds) AS lo, max(ds) + 28 AS hi FROM rp)
        WHERE ds BETWEEN lo AND hi""",
}


def sql(body: str, *extra: str) -> str:
    """``body`` with the table expressions it names, and those they name, in definition order."""
    import re

    def named(text: str) -> set[str]:
        return {n for n in CTES if re.search(rf"\b{n}\b", text)}

    wanted, queue = set(extra), list(named(body) | set(extra))
    while queue:
        name = queue.pop()
        if name in wanted and name not in extra:
            continue
        wanted.add(name)
        queue += [n for n in named(CTES[name]) if n not in wanted]
    ordered = [n for n in CTES if n in wanted]
    if not ordered:
        return body
    listed = ",\n".join(f"{n} AS ({CTES[n]})" for n in ordered)
    return f"WITH {listed}\n{body}"
