"""Sources, dimensions, facts, spines and the series registry."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from weekloom.operators import calendar as C, dimensions as DIM, panel as P, profile as PR
from weekloom.plans import preparation as PREP
from weekloom.session import ensure_checkpoint_dir
from weekloom.sources import bronze as B, sinks as K
from weekloom.sources.tables import LAYERS, TableCatalog
from weekloom.verification.common import H, Inputs, Registry, r, sql

AREA = Registry()


def scratch(inputs: Inputs, name: str) -> str:
    """A new folder under the shared checkpoint folder for queries that write and read back."""
    ensure_checkpoint_dir(inputs.spark)
    return os.path.join(inputs.spark.sparkContext.getCheckpointDir(), f"{name}-{uuid.uuid4().hex}")


BRONZE = """SELECT d AS week_date, supplier_id, product_id, region, units AS units_sold, a1 AS product_attribute_1,
       a2 AS product_attribute_2, a3 AS product_attribute_3 FROM sales"""


@AREA.query("ingest_bronze", sql(BRONZE))
def ingest_bronze(i: Inputs):
    """Sales rows written as CSV text, read back by position and typed."""
    path = scratch(i, "raw_sales")
    rows = i.warehouse.bronze.withColumn("week_date", F.date_format("week_date", "yyyy-MM-dd"))
    rows.write.option("header", True).csv(path)
    return B.to_bronze(B.read_raw_csv(i.spark, path))


@AREA.query("ingest_rejects", sql("""
    SELECT CASE supplier_id % 10 WHEN 3 THEN 'unreadable units_sold' WHEN 5 THEN 'unreadable week_date'
             WHEN 7 THEN 'missing product_id' WHEN 9 THEN 'columns' ELSE 'accepted' END AS reason,
           count(*) AS n_rows, CAST(sum(CASE WHEN supplier_id % 10 NOT IN (3, 5, 7, 9) THEN units END) AS BIGINT) AS units_sold
    FROM sales GROUP BY 1"""))
def ingest_rejects(i: Inputs):
    """All sales rows as CSV text, those of some suppliers spoilt in four ways; every spoilt line is told apart by its reason."""
    path = scratch(i, "spoilt_sales")
    rows = i.warehouse.bronze.withColumn("week_date", F.date_format("week_date", "yyyy-MM-dd"))
    kind, names = F.col("supplier_id") % 10, rows.columns
    spoilt = rows.select(
        F.when(kind == 5, F.lit("2024-13-45")).otherwise(F.col("week_date")).alias("week_date"), "supplier_id",
        F.when(kind != 7, F.col("product_id")).alias("product_id"), "region",
        F.when(kind == 3, F.concat("units_sold", F.lit("x"))).otherwise(F.col("units_sold").cast("string")).alias("units_sold"), *names[5:])
    whole, cut = F.to_csv(F.struct(*names)), F.to_csv(F.struct(*names[:3]))
    spoilt.select(F.when(kind == 9, cut).otherwise(whole)).write.text(path)
    return B.ingest_counts(B.read_checked_csv(i.spark, path, header=False))


@AREA.query("roundtrip_layers", sql("""
    SELECT w.week_date, week, year, month, start_date, end_date, CAST(sum(units_sold) AS BIGINT) AS units_sold,
           count(*) AS n_rows
    FROM wfact w JOIN wcal USING (week_date) GROUP BY ALL"""))
def roundtrip_layers(i: Inputs):
    """Fact and calendar written to their layers and joined from the written copies."""
    catalog = TableCatalog(i.spark, scratch(i, "layers"), LAYERS)
    K.write_table(i.warehouse.fact, catalog.path("silver", "fact_sales_weekly"))
    K.write_table(i.warehouse.dim_weekly_calendar, catalog.path("gold", "dim_weekly_calendar"))
    fact = catalog.read("silver", "fact_sales_weekly", columns=["week_date", "units_sold"])
    weeks = catalog.read("gold", "dim_weekly_calendar",
                         columns=["week_date", "week", "year", "month", "start_date", "end_date"])
    totals = fact.groupBy("week_date").agg(F.sum("units_sold").alias("units_sold"), F.count(F.lit(1)).alias("n_rows"))
    return totals.join(weeks, "week_date")


@AREA.query("dim_calendar", sql("SELECT * FROM cal"))
def dim_calendar(i: Inputs):
    return i.warehouse.dim_calendar


@AREA.query("dim_weekly_calendar", sql("SELECT * FROM wcal"))
def dim_weekly_calendar(i: Inputs):
    return i.warehouse.dim_weekly_calendar


@AREA.query("dim_supplier", sql("SELECT DISTINCT supplier_id, 'Supplier ' || supplier_id AS supplier_name FROM sales"))
def dim_supplier(i: Inputs):
    return i.warehouse.dim_supplier


@AREA.query("dim_region", sql("SELECT DISTINCT region_id, region AS region_name FROM sales"))
def dim_region(i: Inputs):
    return i.warehouse.dim_region


@AREA.query("dim_product", sql("SELECT * FROM dim_product"))
def dim_product(i: Inputs):
    return i.warehouse.dim_product


@AREA.query("fact_sales_weekly", sql("""
    SELECT *, row_number() OVER (ORDER BY week_date, supplier_id, product_id, region_id) AS sales_id FROM wfact"""))
def fact_sales_weekly(i: Inputs):
    return i.warehouse.fact_with_key


REGISTRY_COLUMNS = ", ".join(
    ["time_series_id", "supplier_id", "region_id", "product_id", "first_week_date", "last_week_date", "total_weeks_length",
     "num_week_with_sales", "num_week_with_zeros", "sales_units", f"{r('avg_weekly_sales')} AS avg_weekly_sales",
     f"{r('std_weekly_sales')} AS std_weekly_sales", "max_weekly_sales", "min_weekly_sales"]
    + [f"{r(c)} AS {c}" for c in ("q25_sales", "q50_sales", "q75_sales", "sales_weeks_ratio", "cv", "iqr")])


@AREA.query("series_registry", sql(f"SELECT {REGISTRY_COLUMNS} FROM registry"))
def series_registry(i: Inputs):
    return i.warehouse.registry


@AREA.query("empty_series", sql(f"""
    SELECT count(*) AS n_series, count(*) FILTER (top <= 0) AS n_empty, {r('avg(CASE WHEN top <= 0 THEN 1.0 ELSE 0.0 END)')} AS empty_share
    FROM (SELECT max(units_sold) AS top FROM wfact GROUP BY supplier_id, region_id, product_id)"""))
def empty_series(i: Inputs):
    return P.empty_series_report(i.warehouse.fact)


@AREA.query("dw_fact_sales", sql("""
    SELECT week_date, supplier_id, region_id, product_id, time_series_id, units_sold
    FROM wfact JOIN registry USING (supplier_id, region_id, product_id)"""))
def dw_fact_sales(i: Inputs):
    return i.warehouse.dw_fact


@AREA.query("weekly_spine", sql(f"""
    SELECT supplier_id, region_id, product_id, d.week_date, units_sold, total_weeks_length, sales_units, {r('cv')} AS cv
    FROM dense d JOIN registry USING (supplier_id, region_id, product_id)"""))
def weekly_spine(i: Inputs):
    """Gap-filled weeks with series metadata, keyed by the natural series key."""
    fact = P.by_series(i.warehouse.fact, P.SERIES_KEY)
    dense = P.fill_weeks(fact, P.SERIES_KEY, "week_date", "units_sold")
    stats = P.all_series(i.warehouse.fact).where("num_week_with_sales > 0")
    return dense.join(stats.select(*P.SERIES_KEY, "total_weeks_length", "sales_units", "cv"), P.SERIES_KEY)


BASE_STATS = ["first_week_date", "last_week_date", "total_weeks_length", "num_week_with_sales", "num_week_with_zeros",
              "sales_units", "max_weekly_sales", "min_weekly_sales"]
BASE_DOUBLES = ["avg_weekly_sales", "std_weekly_sales", "q25_sales", "q50_sales", "q75_sales", "sales_weeks_ratio", "cv", "iqr"]


@AREA.query("base_dataset", sql(f"""
    SELECT g.time_series_id, d.week_date, d.supplier_id, d.region_id, d.product_id, d.units_sold,
           week, start_date, end_date, year, semester, semester_date, semester_name, quarter, quarter_date, quarter_name,
           month, month_name, month_date, {', '.join('g.' + c for c in BASE_STATS)}, {', '.join(f'{r("g." + c)} AS {c}' for c in BASE_DOUBLES)},
           {r('nz.m')} AS avg_weekly_sales_non_zero, {r('nz.s')} AS std_weekly_sales_non_zero,
           'Supplier ' || d.supplier_id AS supplier_name, rg.r_name AS region_name, product_name,
           product_attribute_1, product_attribute_2, product_attribute_3
    FROM dense d JOIN registry g USING (supplier_id, region_id, product_id)
    JOIN (SELECT supplier_id, region_id, product_id, avg(units_sold) FILTER (units_sold > 0) AS m,
                 coalesce(stddev_samp(units_sold) FILTER (units_sold > 0), 0) AS s FROM dense GROUP BY ALL) nz
      USING (supplier_id, region_id, product_id)
    LEFT JOIN regions rg ON rg.region_id = d.region_id LEFT JOIN dim_product USING (product_id)
    LEFT JOIN wcal ON wcal.week_date = d.week_date"""))
def base_dataset(i: Inputs):
    return i.warehouse.base_dataset


@AREA.query("train_test_split", sql("SELECT *, ds > (SELECT max(ds) - 28 FROM vp) AS is_test FROM vp"))
def train_test_split(i: Inputs):
    return P.split_by_horizon(PREP.valid_panel(i.tables), H)


@AREA.query("future_frame", sql("""
    SELECT unique_id, step, CAST(last + 7 * step AS DATE) AS ds
    FROM (SELECT unique_id, max(ds) AS last FROM vp GROUP BY 1), (SELECT CAST(unnest(range(1, 5)) AS INTEGER) AS step)"""))
def future_frame(i: Inputs):
    return P.future_weeks(PREP.valid_panel(i.tables), H)


@AREA.query("recent_history", sql("""
    SELECT unique_id, ds, y FROM vp QUALIFY row_number() OVER (PARTITION BY unique_id ORDER BY ds DESC) <= 52"""))
def recent_history(i: Inputs):
    return P.recent_rows(PREP.valid_panel(i.tables), 52)


@AREA.query("detect_freq", sql("""
    SELECT weekday, 'W-' || ['MON','TUE','WED','THU','FRI','SAT','SUN'][weekday + 1] AS freq
    FROM (SELECT CAST(isodow(ds) - 1 AS INTEGER) AS weekday, count(*) AS k FROM mw GROUP BY 1 ORDER BY k DESC, 1 LIMIT 1)"""))
def detect_freq(i: Inputs):
    return C.anchor_weekday(PREP.model_weekly(i.tables))


@AREA.query("integrity_report", sql(f"""
    SELECT 'null_share' AS "check", 'unique_id' AS subject, {r('avg(CASE WHEN unique_id IS NULL THEN 1.0 ELSE 0.0 END)')} AS value FROM vp
    UNION ALL SELECT 'null_share', 'ds', {r('avg(CASE WHEN ds IS NULL THEN 1.0 ELSE 0.0 END)')} FROM vp
    UNION ALL SELECT 'null_share', 'y', {r('avg(CASE WHEN y IS NULL THEN 1.0 ELSE 0.0 END)')} FROM vp
    UNION ALL SELECT 'duplicate_keys', 'unique_id/ds', CAST(count(*) AS DOUBLE) FROM
        (SELECT unique_id, ds FROM vp GROUP BY 1, 2 HAVING count(*) > 1)
    UNION ALL SELECT 'panel', 'rows', CAST(count(*) AS DOUBLE) FROM vp
    UNION ALL SELECT 'panel', 'series', CAST(count(DISTINCT unique_id) AS DOUBLE) FROM vp
    UNION ALL SELECT 'panel', 'zero_rate', {r('avg(CASE WHEN y = 0 THEN 1.0 ELSE 0.0 END)')} FROM vp
    UNION ALL SELECT 'panel', 'full_grid_rows', CAST(count(DISTINCT unique_id) * ((max(ds) - min(ds)) / 7 + 1) AS DOUBLE) FROM vp"""))
def integrity_report(i: Inputs):
    return PR.integrity_report(PREP.valid_panel(i.tables), ["unique_id", "ds", "y"], ["unique_id", "ds"], "y")
