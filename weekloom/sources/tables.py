"""Named tables: a nested mapping of names to paths, read lazily as DataFrames."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql import functions as F


def read_parquet(spark: SparkSession, path: str, columns: Iterable[str] | None = None) -> DataFrame:
    """Read a parquet table, optionally only some columns; zone-less timestamps become dates on demand."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns is not None else df


def timestamps_to_dates(df: DataFrame, *names: str) -> DataFrame:
    """Cast the named (or all zone-less timestamp) columns to DATE."""
    chosen = names or [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({n: F.col(n).cast("date") for n in chosen})


class TableCatalog:
    """Look tables up by a chain of keys.

    ``layout`` is a nested mapping whose leaves are paths relative to ``root``, for example
    ``{"silver": {"fact": "silver/fact_sales_weekly"}}``. Leaves are found by ``path("silver", "fact")``.
    """

    def __init__(self, spark: SparkSession, root: str, layout: Mapping[str, Any]):
        self.spark = spark
        self.root = root.rstrip("/")
        self.layout = layout

    def path(self, *keys: str) -> str:
        entry: Any = self.layout
        for position, key in enumerate(keys):
            if not isinstance(entry, Mapping) or key not in entry:
                raise KeyError(f"no entry {' / '.join(keys[: position + 1])}")
            entry = entry[key]
        if isinstance(entry, Mapping):
            raise ValueError(f"{' / '.join(keys)} is a section; it holds {sorted(entry)}")
        return f"{self.root}/{entry}"

    def read(self, *keys: str, columns: Iterable[str] | None = None) -> DataFrame:
        return read_parquet(self.spark, self.path(*keys), columns)

    def read_optional(self, *keys: str, columns: Iterable[str] | None = None) -> DataFrame | None:
        """Like ``read`` but ``None`` when nothing has been written at the path yet."""
        where = self.path(*keys)
        hadoop_path = self.spark._jvm.org.apache.hadoop.fs.Path(where)
        fs = hadoop_path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return self.read(*keys, columns=columns) if fs.exists(hadoop_path) else None

    def register_views(self, *keys: str) -> list[str]:
        """Expose every table of a section as a temporary view named by its last key."""
        entry: Any = self.layout
        for key in keys:
            entry = entry[key]
        for name in entry:
            self.read(*keys, name).createOrReplaceTempView(name)
        return list(entry)


LAYERS = {
    "bronze": {"sales": "bronze/sales"},
    "silver": {
        "dim_calendar": "silver/dim_calendar",
        "dim_supplier": "silver/dim_supplier",
        "dim_region": "silver/dim_region",
        "dim_product": "silver/dim_product",
        "fact_sales_weekly": "silver/fact_sales_weekly",
    },
    "gold": {
        "dim_weekly_calendar": "gold/dim_weekly_calendar",
        "dim_time_series": "gold/dim_time_series",
        "fact_sales_weekly": "gold/fact_sales_weekly",
    },
    "forecasting": {
        "base": "forecasting/base",
        "refined": "forecasting/refined",
        "excluded": "forecasting/excluded",
        "tags": "forecasting/tags",
        "features": {
            "static": "forecasting/features/static",
            "holidays": "forecasting/features/holidays",
            "weather": "forecasting/features/weather",
        },
        "backtest": "forecasting/backtest",
        "forecast": "forecasting/forecast",
        "metadata": "forecasting/metadata",
    },
}
