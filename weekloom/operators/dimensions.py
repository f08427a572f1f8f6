"""Star schema: dimensions and the weekly fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from weekloom.functions import dates as D
from weekloom.functions.ranks import global_row_number

FACT_KEY = ["week_date", "supplier_id", "region_id", "product_id"]


def supplier_dimension(bronze: DataFrame) -> DataFrame:
    return bronze.select("supplier_id").distinct().withColumn(
        "supplier_name", F.concat(F.lit("Supplier "), F.col("supplier_id"))
    )


def region_dimension(bronze: DataFrame) -> DataFrame:
    """Region ids 1..k by name. The regions of a country are few, so one ordered window is enough."""
    names = bronze.select(F.col("region").alias("region_name")).distinct()
    return names.select(F.row_number().over(Window.orderBy("region_name")).alias("region_id"), "region_name")


def product_dimension(bronze: DataFrame) -> DataFrame:
    """One row per product. Attributes that differ within a product are settled to the smallest
    combination, so that joining the dimension never multiplies fact rows."""
    levels = [f"product_attribute_{i}" for i in (1, 2, 3)]
    return (
        bronze.groupBy("product_id").agg(F.min(F.struct(*levels)).alias("a"))
        .select("product_id", *[F.col(f"a.{c}").alias(c) for c in levels],
                F.concat(F.lit("Product "), F.col("product_id")).alias("product_name"))
    )


def weekly_sales(bronze: DataFrame, calendar: DataFrame, regions: DataFrame) -> DataFrame:
    """Units per (week, supplier, region, product).

    The calendar and region joins swap the date for its Monday and the name for its id; both
    tables are bounded (days of the period, regions of a country).
    """
    return (
        bronze.withColumnRenamed("week_date", "date")
        .join(F.broadcast(calendar.select("date", "week_date")), "date", "left")
        .join(F.broadcast(regions.withColumnRenamed("region_name", "region")), "region", "left")
        .groupBy(*FACT_KEY)
        .agg(F.sum("units_sold").alias("units_sold"))
    )


def with_sales_id(fact: DataFrame) -> DataFrame:
    """Surrogate key 1..n in the order (week, supplier, product, region)."""
    return global_row_number(fact, ["week_date", "supplier_id", "product_id", "region_id"], "sales_id")


def weekly_totals(sales: DataFrame, *keys: str, date: str = "date", units: str = "units_sold") -> DataFrame:
    """Weekly units per key set straight from dated rows (combined before the shuffle)."""
    return sales.groupBy(*keys, D.week_start(F.col(date)).alias("ds")).agg(F.sum(units).alias("y"))
