"""Bronze, silver and gold tables as lazy frames over the retail tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, Window, functions as F

from weekloom.operators import calendar as C, dimensions as DIM, panel as P
from weekloom.sources.retail import RetailTables
from weekloom.sources.sinks import write_table
from weekloom.sources.tables import TableCatalog


class Warehouse:
    """The star schema and the series registry of one folder of retail tables."""

    def __init__(self, tables: RetailTables):
        self.tables = tables

    @cached_property
    def bronze(self) -> DataFrame:
        rows = self.tables.sales(attributes=True)
        return rows.select(
            F.col("date").alias("week_date"), "supplier_id", "product_id", "region", "units_sold",
            "product_attribute_1", "product_attribute_2", "product_attribute_3")

    @cached_property
    def dim_calendar(self) -> DataFrame:
        return C.daily_calendar(self.tables.line_dates())

    @cached_property
    def dim_weekly_calendar(self) -> DataFrame:
        return C.weekly_calendar(self.dim_calendar)

    @cached_property
    def dim_supplier(self) -> DataFrame:
        return DIM.supplier_dimension(self.bronze)

    @cached_property
    def dim_region(self) -> DataFrame:
        return DIM.region_dimension(self.bronze)

    @cached_property
    def dim_product(self) -> DataFrame:
        return DIM.product_dimension(self.bronze)

    @cached_property
    def fact(self) -> DataFrame:
        """Weekly fact without the surrogate key."""
        return DIM.weekly_sales(self.bronze, self.dim_calendar, self.dim_region)

    @cached_property
    def fact_with_key(self) -> DataFrame:
        return DIM.with_sales_id(self.fact)

    @cached_property
    def registry(self) -> DataFrame:
        return P.series_registry(self.fact)

    @cached_property
    def dw_fact(self) -> DataFrame:
        return P.fact_with_series_id(self.fact, self.registry)

    @cached_property
    def spine(self) -> DataFrame:
        return P.series_spine(self.dw_fact, self.registry)

    @cached_property
    def base_dataset(self) -> DataFrame:
        return base_dataset(self.spine, self.dim_region, self.dim_product, self.dim_supplier,
                            self.dim_weekly_calendar)

    def write(self, catalog: TableCatalog) -> list[str]:
        """Write every layer table; later layers are then read back from the written ones."""
        plan = [
            (("bronze", "sales"), self.bronze),
            (("silver", "dim_calendar"), self.dim_calendar),
            (("silver", "dim_supplier"), self.dim_supplier),
            (("silver", "dim_region"), self.dim_region),
            (("silver", "dim_product"), self.dim_product),
            (("silver", "fact_sales_weekly"), self.fact_with_key),
            (("gold", "dim_weekly_calendar"), self.dim_weekly_calendar),
            (("gold", "dim_time_series"), self.registry),
            (("gold", "fact_sales_weekly"), self.dw_fact),
        ]
        return [write_table(df, catalog.path(*keys)) for keys, df in plan]


LEADING = [
    "time_series_id", "week_date", "supplier_id", "region_id", "product_id", "units_sold",
    "week", "start_date", "end_date", "year", "semester", "semester_date", "semester_name",
    "quarter", "quarter_date", "quarter_name", "month", "month_name", "month_date",
    "first_week_date", "last_week_date", "total_weeks_length", "num_week_with_sales", "num_week_with_zeros",
    "sales_weeks_ratio", "sales_units", "avg_weekly_sales", "avg_weekly_sales_non_zero",
    "std_weekly_sales", "std_weekly_sales_non_zero", "max_weekly_sales", "min_weekly_sales",
    "q25_sales", "q50_sales", "q75_sales", "iqr", "cv",
    "supplier_name", "region_name", "product_name",
    "product_attribute_1", "product_attribute_2", "product_attribute_3",
]


def base_dataset(spine: DataFrame, regions: DataFrame, products: DataFrame, suppliers: DataFrame,
                 weekly_calendar: DataFrame) -> DataFrame:
    """Spine joined with the four dimensions, columns in a fixed order, small integers narrowed.

    The calendar and the regions are bounded and broadcast; suppliers and products grow with the
    business, so Spark decides by their size. Moments of the weeks with sales come from a window on
    the series, which the spine is already partitioned by.
    """
    whole = Window.partitionBy("time_series_id")
    sold = F.when(F.col("units_sold") > 0, F.col("units_sold"))
    rows = (
        spine.withColumns({
            "avg_weekly_sales_non_zero": F.avg(sold).over(whole),
            "std_weekly_sales_non_zero": F.coalesce(F.stddev_samp(sold).over(whole), F.lit(0.0)),
        })
        .join(F.broadcast(regions), "region_id", "left")
        .join(products, "product_id", "left")
        .join(suppliers, "supplier_id", "left")
        .join(F.broadcast(weekly_calendar), "week_date", "left")
    )
    first = [c for c in LEADING if c in rows.columns]
    ordered = rows.select(*first, *[c for c in rows.columns if c not in first])
    small = {c: F.col(c).cast("smallint") for c in ("year", "semester", "quarter", "month", "week")}
    return ordered.withColumns({**small, "time_series_id": F.col("time_series_id").cast("int")})
