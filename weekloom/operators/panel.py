"""Series panels: gap filling, series statistics, hierarchy levels, future weeks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from weekloom.functions.ranks import global_row_number

SERIES_KEY = ["supplier_id", "region_id", "product_id"]
STAT_COLUMNS = [
    "first_week_date", "last_week_date", "total_weeks_length", "num_week_with_sales", "num_week_with_zeros",
    "sales_units", "avg_weekly_sales", "std_weekly_sales", "max_weekly_sales", "min_weekly_sales",
    "q25_sales", "q50_sales", "q75_sales", "sales_weeks_ratio", "cv", "iqr",
]


def by_series(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One exchange on the series key that the following window steps share.

    The number of partitions is the configured one, explicitly: gap filling multiplies rows after the
    exchange, which merging of small partitions by their bytes cannot know.
    """
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def spread(written: DataFrame, keys: Sequence[str], rows_per_task: int) -> DataFrame:
    """A written table dealt by its keys over as many partitions as its rows need, so that a task's groups do not grow with the table."""
    least = int(written.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return written.repartition(max(least, -(-written.count() // rows_per_task)), *keys)


def fill_weeks(weekly: DataFrame, keys: Sequence[str], date: str = "ds", value: str = "y") -> DataFrame:
    """Dense Monday grid per series between its first and last row; missing weeks get 0.

    Each row also emits the empty weeks up to the next row of its series: no grid table, no join, and
    no exchange beyond the one on the series key.
    """
    order = Window.partitionBy(*keys).orderBy(date)
    gap = F.coalesce((F.datediff(F.lead(date).over(order), F.col(date)) / 7).cast("int"), F.lit(1))
    stepped = weekly.withColumn("_gap", gap).withColumn("_step", F.explode(F.sequence(F.lit(0), F.col("_gap") - 1)))
    return stepped.withColumns({
        date: F.date_add(date, F.col("_step") * 7),
        value: F.when(F.col("_step") == 0, F.col(value)).otherwise(F.lit(0)),
    }).drop("_gap", "_step")


def series_statistics(dense: DataFrame, keys: Sequence[str], date: str, value: str) -> DataFrame:
    """Length, zero counts, moments and quartiles per series. A group is one series, so its size is
    bounded by the number of weeks."""
    y = F.col(value)
    stats = dense.groupBy(*keys).agg(
        F.min(date).alias("first_week_date"),
        F.max(date).alias("last_week_date"),
        F.count(F.lit(1)).alias("total_weeks_length"),
        F.count_if(y > 0).alias("num_week_with_sales"),
        F.count_if(y == 0).alias("num_week_with_zeros"),
        F.sum(y).alias("sales_units"),
        F.avg(y).alias("avg_weekly_sales"),
        F.coalesce(F.stddev_samp(y), F.lit(0.0)).alias("std_weekly_sales"),
        F.max(y).alias("max_weekly_sales"),
        F.min(y).alias("min_weekly_sales"),
        F.percentile(y, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("_q"),
    )
    return stats.withColumns({
        "q25_sales": F.col("_q")[0], "q50_sales": F.col("_q")[1], "q75_sales": F.col("_q")[2],
        "sales_weeks_ratio": F.col("num_week_with_sales") / F.col("total_weeks_length"),
        "cv": F.col("std_weekly_sales") / (F.col("avg_weekly_sales") + 1e-6),
        "iqr": F.col("_q")[2] - F.col("_q")[0],
    }).select(*keys, *STAT_COLUMNS)


def all_series(fact: DataFrame) -> DataFrame:
    rows = by_series(fact.select(*SERIES_KEY, "week_date", "units_sold"), SERIES_KEY)
    dense = fill_weeks(rows, SERIES_KEY, "week_date", "units_sold")
    return series_statistics(dense, SERIES_KEY, "week_date", "units_sold")


def series_registry(fact: DataFrame) -> DataFrame:
    """Active series (any week with sales) with statistics and ``time_series_id`` in key order."""
    active = all_series(fact).where(F.col("num_week_with_sales") > 0)
    numbered = global_row_number(active, SERIES_KEY, "time_series_id")
    return numbered.select(F.col("time_series_id").cast("int"), *SERIES_KEY, *STAT_COLUMNS)


def empty_series_report(fact: DataFrame) -> DataFrame:
    """How many series never sold anything, and their share."""
    sold = fact.groupBy(*SERIES_KEY).agg(F.max("units_sold").alias("top"))
    return sold.agg(
        F.count(F.lit(1)).alias("n_series"),
        F.count_if(F.col("top") <= 0).alias("n_empty"),
        F.avg((F.col("top") <= 0).cast("double")).alias("empty_share"),
    )


def fact_with_series_id(fact: DataFrame, registry: DataFrame) -> DataFrame:
    """Attach the series id; series missing from the registry (the empty ones) drop out."""
    ids = registry.select(*SERIES_KEY, "time_series_id")
    return fact.join(ids, SERIES_KEY, "inner").select(
        "week_date", *SERIES_KEY, "time_series_id", "units_sold")


def series_spine(fact_with_id: DataFrame, registry: DataFrame) -> DataFrame:
    """Weekly spine of the registered series with zero-filled units and the series statistics."""
    dense = fill_weeks(by_series(fact_with_id, ["time_series_id"]), ["time_series_id"], "week_date", "units_sold")
    return dense.join(registry.drop(*SERIES_KEY), "time_series_id", "left")


def level_id(level: Sequence[str]) -> Column:
    """Series id of a hierarchy level: its key values joined by ``/``; ``Total`` for no keys."""
    return F.concat_ws("/", *[F.col(c).cast("string") for c in level]) if level else F.lit("Total")


def hierarchy_panel(weekly: DataFrame, levels: Sequence[Sequence[str]], date: str = "ds",
                    value: str = "y") -> DataFrame:
    """Weekly totals at several levels in one pass, ``(level, unique_id, ds, y)``.

    Grouping sets expand each (already weekly) row once per level and combine before the shuffle.
    """
    columns = list(dict.fromkeys(c for lv in levels for c in lv))
    grouped = weekly.groupingSets([[F.col(c) for c in [*lv, date]] for lv in levels],
                                  *[F.col(c) for c in [*columns, date]])
    out = grouped.agg(F.sum(value).alias("y"), F.grouping_id().alias("_gid"))
    width = len(columns) + 1
    name, uid = F.lit(None).cast("string"), F.lit(None).cast("string")
    for lv in levels:
        gid = sum(1 << (width - 1 - i) for i, c in enumerate([*columns, date]) if c not in lv and c != date)
        here = F.col("_gid") == gid
        name = F.when(here, "/".join(lv) if lv else "total").otherwise(name)
        uid = F.when(here, level_id(lv)).otherwise(uid)
    return out.select(name.alias("level"), uid.alias("unique_id"), F.col(date).alias("ds"), "y")


def hierarchy_membership(weekly: DataFrame, levels: Sequence[Sequence[str]], bottom: Sequence[str]) -> DataFrame:
    """Which bottom series adds into which aggregate: the non-zero cells of the summing matrix."""
    cells = F.array(*[
        F.struct(F.lit("/".join(lv) if lv else "total").alias("level"), level_id(lv).alias("unique_id"))
        for lv in levels
    ])
    return (
        weekly.select(*bottom).distinct()
        .select(level_id(bottom).alias("bottom_id"), F.explode(cells).alias("c"))
        .select("bottom_id", "c.level", "c.unique_id")
    )


def future_weeks(panel: DataFrame, h: int, date: str = "ds", keys: Sequence[str] = ("unique_id",)) -> DataFrame:
    """The ``h`` Mondays after the last week of each series."""
    last = panel.groupBy(*keys).agg(F.max(date).alias("_last"))
    return last.select(
        *keys, F.explode(F.sequence(F.lit(1), F.lit(h))).alias("step"), "_last",
    ).select(*keys, "step", F.date_add("_last", F.col("step") * 7).alias(date))


def split_by_horizon(panel: DataFrame, h: int, date: str = "ds") -> DataFrame:
    """Flag the last ``h`` weeks of the whole table as test rows (``is_test``).

    The cutoff counts from the global last week, so a series that ended earlier has no test rows.
    """
    cutoff = panel.agg(F.date_sub(F.max(date), 7 * h).alias("c"))
    return panel.withColumn("is_test", F.col(date) > cutoff.scalar())


def recent_rows(panel: DataFrame, n: int, date: str = "ds", keys: Sequence[str] = ("unique_id",)) -> DataFrame:
    """Last ``n`` rows of each series."""
    order = Window.partitionBy(*keys).orderBy(F.col(date).desc())
    return panel.withColumn("_rn", F.row_number().over(order)).where(F.col("_rn") <= n).drop("_rn")
