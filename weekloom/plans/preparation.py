"""From sales rows to the refined modelling panel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from weekloom.operators import demand, panel as P, series as S
from weekloom.sources.retail import RetailTables

MODEL_LEVELS = [["supplier_id"], ["supplier_id", "product_id"]]
WEEKS_PER_TASK = 1_000_000


def last_sales_week(tables: RetailTables) -> Column:
    """Latest week of the whole table as a scalar."""
    return tables.weekly.agg(F.max("ds")).scalar()


def model_weekly(tables: RetailTables) -> DataFrame:
    """Weekly totals of the modelling levels (supplier, supplier/product) before gap filling."""
    return P.hierarchy_panel(tables.weekly.select("supplier_id", "product_id", "ds", "y"), MODEL_LEVELS)


def segmented_weekly(tables: RetailTables) -> DataFrame:
    """Weekly rows (gaps not filled) with the maturity segment of their series."""
    rows = P.by_series(model_weekly(tables).select("unique_id", "ds", "y"), ["unique_id"])
    return demand.segment_weekly(rows, last_sales_week(tables))


def valid_panel(tables: RetailTables) -> DataFrame:
    """Gap-filled weeks of the valid series."""
    rows = segmented_weekly(tables).where(F.col("segment") == "valid").select("unique_id", "ds", "y")
    return P.fill_weeks(rows, ["unique_id"])


def excluded_panel(tables: RetailTables) -> DataFrame:
    """Gap-filled weeks of the other series, with the reason."""
    rows = segmented_weekly(tables).where(F.col("segment") != "valid")
    return P.fill_weeks(rows, ["unique_id"])


def series_segments(tables: RetailTables) -> DataFrame:
    """One row per series: segment and weeks since the last sale."""
    ends = model_weekly(tables).groupBy("unique_id").agg(F.min("ds").alias("_first"), F.max("ds").alias("last_week_date"))
    length = F.datediff("last_week_date", "_first") / 7 + 1
    return demand.segment_by_maturity(
        ends.withColumn("total_weeks_length", length), "unique_id", last_sales_week(tables))


def valid_span(tables: RetailTables) -> DataFrame:
    """One row: the first and the last week of any valid series, without filling gaps."""
    ends = model_weekly(tables).groupBy("unique_id").agg(F.min("ds").alias("_first"), F.max("ds").alias("_last"))
    segment, _ = demand.maturity_columns(F.datediff("_last", "_first") / 7 + 1, F.col("_last"), last_sales_week(tables))
    return ends.where(segment == "valid").agg(F.min("_first").alias("ds_min"), F.max("_last").alias("ds_max"))


def treated_panel(tables: RetailTables) -> DataFrame:
    """Valid series with capped values and demand class: ``unique_id, ds, y, is_outlier, y_capped, demand_type``.

    After the weekly totals everything runs in one exchange on ``unique_id``.
    """
    return demand.with_demand_type(demand.capped_values(valid_panel(tables)), "y_capped")


def refined_panel(tables: RetailTables) -> DataFrame:
    """``unique_id, ds, y, demand_type`` with ``y`` capped: the input of all modelling."""
    return treated_panel(tables).select("unique_id", "ds", F.col("y_capped").alias("y"), "demand_type")


def refined_series(tables: RetailTables) -> DataFrame:
    """``refined_panel`` with one row per series: ``unique_id, demand_type, weeks, values, last_ds, n``."""
    return S.refined(segmented_weekly(tables).where(F.col("segment") == "valid").select("unique_id", "ds", "y"))


def unpacked(series: DataFrame) -> DataFrame:
    """``refined_panel`` from written ``refined_series``, partitioned by the series.

    The exchange moves one row per series; its partitions grow in number with the weeks, so that no task holds more of them at larger inputs.
    Series are sorted before their weeks are unpacked, so the sorts of later windows and joins over the series find their rows in order.
    """
    spark = series.sparkSession
    weeks = series.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-weeks // WEEKS_PER_TASK))
    dealt = series.repartition(partitions, "unique_id").sortWithinPartitions("unique_id")
    rows = dealt.select("unique_id", "demand_type", F.explode(F.arrays_zip("weeks", "values")).alias("r"))
    return rows.select("unique_id", F.col("r.weeks").alias("ds"), F.col("r.values").alias("y"), "demand_type")
