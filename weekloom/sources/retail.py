"""Sales rows and daily weather derived from order-line tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from weekloom.functions import dates as D
from weekloom.session import pin
from weekloom.sources.tables import read_parquet


class RetailTables:
    """The order-line star schema in one folder, read with the columns that are asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str, *columns: str) -> DataFrame:
        return read_parquet(self.spark, f"{self.folder}/{name}.parquet", columns or None)

    def regions(self) -> DataFrame:
        """Region key, name and 1-based id by name order (a fixed handful of rows)."""
        r = self.table("region", "r_regionkey", "r_name")
        return r.withColumn("region_id", F.row_number().over(Window.orderBy("r_name")))

    def supplier_regions(self) -> DataFrame:
        """Region name and id of each supplier."""
        s = self.table("supplier", "s_suppkey", "s_nationkey")
        n = self.table("nation", "n_nationkey", "n_regionkey")
        return (
            s.join(n, F.col("s_nationkey") == F.col("n_nationkey"))
            .join(self.regions(), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(F.col("s_suppkey").alias("supplier_id"), F.col("r_name").alias("region"), "region_id")
        )

    @cached_property
    def weekly(self) -> DataFrame:
        """Weekly units per supplier and product with the first and last sale date in each week, written once.

        One scan of the order lines serves whatever works on weeks: panel, segments, span, calendar bounds.
        """
        sales = self.sales(product=True, region=False)
        return pin(sales.groupBy("supplier_id", "product_id", D.week_start(F.col("date")).alias("ds")).agg(
            F.sum("units_sold").alias("y"), F.min("date").alias("first_date"), F.max("date").alias("last_date")))

    def sold_products(self) -> DataFrame:
        """Product and attributes of every part that was sold, from a one-column scan of the order lines."""
        sold = self.table("lineitem", "l_partkey").distinct()
        parts = self.table("part", "p_partkey", "p_type", "p_brand", "p_size")
        return parts.join(sold, F.col("p_partkey") == F.col("l_partkey"), "left_semi").select(
            F.col("p_type").alias("product_id"), F.col("p_brand").alias("product_attribute_1"),
            F.col("p_type").alias("product_attribute_2"), F.col("p_size").cast("string").alias("product_attribute_3"))

    def date_bounds(self) -> DataFrame:
        """Dates that hold the first and the last sale date, from the weekly table."""
        ends = self.weekly.agg(F.min("first_date").alias("lo"), F.max("last_date").alias("hi"))
        return ends.select(F.explode(F.array("lo", "hi")).alias("date"))

    def line_dates(self) -> DataFrame:
        """Only the sale date of every line, for calendar bounds."""
        return self.table("lineitem", "l_shipdate").select(F.col("l_shipdate").cast("date").alias("date"))

    def sales(self, *, product: bool = True, region: bool = True, attributes: bool = False) -> DataFrame:
        """Sales rows ``(date, supplier_id, units_sold [, product_id, attributes] [, region, region_id])``.

        Only the asked dimensions are joined, so a supplier-level total never touches the parts.
        Join sides are sized by Spark (automatic broadcast below the threshold, skew-aware
        shuffle join above it).
        """
        keys = ["l_suppkey", "l_quantity", "l_shipdate"] + (["l_partkey"] if product or attributes else [])
        lines = self.table("lineitem", *keys)
        out = lines.withColumns({
            "date": F.col("l_shipdate").cast("date"),
            "supplier_id": F.col("l_suppkey"),
            "units_sold": F.col("l_quantity").cast("bigint"),
        })
        columns = ["date", "supplier_id", "units_sold"]
        if product or attributes:
            wanted = ["p_partkey", "p_type"] + (["p_brand", "p_size"] if attributes else [])
            parts = self.table("part", *wanted)
            out = out.join(parts, F.col("l_partkey") == F.col("p_partkey")).withColumn("product_id", F.col("p_type"))
            columns.append("product_id")
            if attributes:
                out = out.withColumns({
                    "product_attribute_1": F.col("p_brand"),
                    "product_attribute_2": F.col("p_type"),
                    "product_attribute_3": F.col("p_size").cast("string"),
                })
                columns += ["product_attribute_1", "product_attribute_2", "product_attribute_3"]
        if region:
            out = out.join(self.supplier_regions(), "supplier_id")
            columns += ["region", "region_id"]
        return out.select(*columns)

    def weather_daily(self) -> DataFrame:
        """Daily measures per region, a stand-in made from the orders of each day and region."""
        o = self.table("orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
        c = self.table("customer", "c_custkey", "c_nationkey")
        n = self.table("nation", "n_nationkey", "n_regionkey")
        geo = (
            c.join(n, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(self.regions(), F.col("n_regionkey") == F.col("r_regionkey"))
            .select("c_custkey", "region_id")
        )
        heat = F.col("o_totalprice") / 12347
        return (
            o.join(geo, F.col("o_custkey") == F.col("c_custkey"))
            .groupBy(F.col("o_orderdate").cast("date").alias("date"), "region_id")
            .agg(
                F.max(heat).alias("temperature_2m_max"),
                F.min(heat).alias("temperature_2m_min"),
                F.avg(heat).alias("temperature_2m_mean"),
                (F.count(F.lit(1)) * 5.0).alias("precipitation_sum"),
                F.max(F.col("o_orderkey") % 80).cast("double").alias("windspeed_10m_max"),
            )
        )
