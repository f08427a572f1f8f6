"""Exploratory aggregates over the sales and the panel."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from weekloom.functions import dates as D
from weekloom.functions.ranks import exact_quantiles
from weekloom.session import pin


def total_by(sales: DataFrame, *keys: str, value: str = "units_sold") -> DataFrame:
    return sales.groupBy(*keys).agg(F.sum(value).alias(value))


def yearly(weekly: DataFrame) -> DataFrame:
    return weekly.groupBy(F.year("week_date").alias("year")).agg(
        F.min("week_date").alias("week_date_start"), F.max("week_date").alias("week_date_end"),
        F.sum("units_sold").alias("units_sold"))


def monthly(weekly: DataFrame, *keys: str) -> DataFrame:
    """Units per month (of the week's Monday) and key set, with the month's first day."""
    return weekly.groupBy(F.year("week_date").alias("year"), F.month("week_date").alias("month"), *keys).agg(
        F.sum("units_sold").alias("units_sold")).withColumn("period", F.make_date("year", "month", F.lit(1)))


def pivot_units(sales: DataFrame, row: str, column: str, values: Sequence[str]) -> DataFrame:
    """Units by ``row`` with one column per named value, 0 where nothing was sold."""
    return sales.groupBy(row).pivot(column, list(values)).agg(F.sum("units_sold")).na.fill(0)


def entity_counts(weekly: DataFrame) -> DataFrame:
    """Distinct weeks, products, suppliers, regions and series.

    Each kind is reduced to its distinct values on its own (combined before the shuffle), then counted.
    """
    series = F.struct("supplier_id", "region_id", "product_id")
    kinds: Mapping[str, Column] = {
        "weeks": F.col("week_date"), "products": F.col("product_id"), "suppliers": F.col("supplier_id"),
        "regions": F.col("region_id"), "series": series,
    }
    parts = [weekly.select(c.alias("v")).distinct().agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(kind).alias("entity"), "n") for kind, c in kinds.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def describe(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles of a numeric column, exact at any size."""
    moments = df.agg(
        F.count(column).alias("count"), F.avg(column).alias("mean"), F.stddev_samp(column).alias("std"),
        F.min(column).cast("double").alias("min"), F.max(column).cast("double").alias("max"))
    probs = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    return with_quantiles(moments, df, column, probs)


def with_quantiles(moments: DataFrame, df: DataFrame, column: str, probs: Mapping[str, float]) -> DataFrame:
    """Add the column's quantiles to a one-row table; they come as one scalar, not through a join."""
    found = exact_quantiles(df, [], column, probs).select(F.struct(*probs).alias("q")).scalar()
    return moments.withColumn("_q", found).select(*moments.columns, *[F.col(f"_q.{p}").alias(p) for p in probs])


def integrity_report(panel: DataFrame, columns: Sequence[str], key: Sequence[str], value: str) -> DataFrame:
    """NULL share per column, duplicate keys, rows against series x weeks, and the zero rate, as
    ``(check, subject, value)`` rows."""
    per_key = panel.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(value) == 0).alias("z"),
        *[F.count_if(F.col(c).isNull()).alias(f"_null_{c}") for c in columns])
    per_series = per_key.groupBy(key[0]).agg(
        F.sum("n").alias("n"), F.sum("z").alias("z"), F.count_if(F.col("n") > 1).alias("twice"),
        F.min(key[1]).alias("lo"), F.max(key[1]).alias("hi"), *[F.sum(f"_null_{c}").alias(f"_null_{c}") for c in columns])
    total = F.sum("n")
    found = [("null_share", c, F.sum(f"_null_{c}") / total) for c in columns]
    found += [
        ("duplicate_keys", "/".join(key), F.sum("twice")), ("panel", "rows", total), ("panel", "series", F.count(F.lit(1))),
        ("panel", "zero_rate", F.sum("z") / total),
        ("panel", "full_grid_rows", F.count(F.lit(1)) * (F.datediff(F.max("hi"), F.min("lo")) / 7 + 1)),
    ]
    cells = F.array(*[F.struct(F.lit(check).alias("check"), F.lit(subject).alias("subject"), v.cast("double").alias("value"))
                      for check, subject, v in found])
    return per_series.agg(cells.alias("cells")).select(F.explode("cells").alias("c")).select("c.*")


def month_grid(monthly_rows: DataFrame, key: str, date: str, value: str) -> DataFrame:
    """Every key with every month between the overall first and last month, 0 where absent."""
    span = monthly_rows.agg(F.struct(F.min(date).alias("lo"), F.max(date).alias("hi"))).scalar()
    keys = monthly_rows.select(key).distinct()
    months = F.sequence(span["lo"], span["hi"], F.expr("interval 1 month"))
    grid = keys.withColumn(date, F.explode(months))
    return grid.join(monthly_rows, [key, date], "left").withColumn(value, F.coalesce(value, F.lit(0)))


def indexed_trend(grid: DataFrame, key: str, date: str, value: str) -> DataFrame:
    """Index to the first positive month = 100 and its trailing mean over up to three months."""
    order = Window.partitionBy(key).orderBy(date)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    base = F.first(F.when(F.col(value) > 0, F.col(value)), ignorenulls=True).over(whole)
    indexed = grid.withColumn("trend_index", F.col(value) / base * 100)
    return indexed.withColumn("trend_index_ma3", F.avg("trend_index").over(order.rowsBetween(-2, 0)))


def trailing_mean(rows: DataFrame, date: str, value: str, n: int, keys: Sequence[str] = ()) -> Column:
    """Mean of the last ``n`` rows, NULL until ``n`` rows are there."""
    order = (Window.partitionBy(*keys) if keys else Window).orderBy(date).rowsBetween(-(n - 1), 0)
    return F.when(F.count(F.lit(1)).over(order) == n, F.avg(value).over(order))


def sunday_weeks(sales: DataFrame, date: str = "date", value: str = "units_sold") -> DataFrame:
    """National total per Sunday-ending week with empty weeks as 0."""
    totals = sales.groupBy(D.week_closing_sunday(F.col(date)).alias("week_end")).agg(F.sum(value).alias(value))
    span = totals.agg(F.min("week_end").alias("lo"), F.max("week_end").alias("hi"))
    grid = span.select(F.explode(F.sequence("lo", "hi", F.expr("interval 7 days"))).alias("week_end"))
    return grid.join(totals, "week_end", "left").withColumn(value, F.coalesce(value, F.lit(0)))


def sb_plane(classified: DataFrame) -> DataFrame:
    """Interval and variation of series with at least two sales, flagged inside the 98th percentiles."""
    rows = classified.where("n_positive >= 2").select("unique_id", "adi", "cv2", "demand_type")
    a = exact_quantiles(rows, [], "adi", {"q": 0.98}).scalar()
    c = exact_quantiles(rows, [], "cv2", {"q": 0.98}).scalar()
    return rows.withColumn("in_view", (F.col("adi") <= a) & (F.col("cv2") <= c))


def zero_share_by_level(panel: DataFrame) -> DataFrame:
    """Median and maximum of the series' zero share per hierarchy level."""
    # one row per series, read several times: the weeks are made once
    per = pin(panel.groupBy("level", "unique_id").agg(F.avg((F.col("y") == 0).cast("double")).alias("z")))
    top = per.groupBy("level").agg(F.max("z").alias("max_zero_share"), F.count(F.lit(1)).alias("n_series"))
    return top.join(exact_quantiles(per, ["level"], "z", {"median_zero_share": 0.5}), "level")


def zero_cascade(dense: DataFrame) -> DataFrame:
    """Share of zero cells at five planning grains, coarse to fine.

    Each grain is summed from the finest one that contains it, so rows shrink from step to step. The monthly
    cells, which also count the weekly ones, are written once: the weekly rows are made a single time.
    """
    fine = dense.withColumns({"year": F.year("ds"), "month_date": D.month_start(F.col("ds"))})
    series = ["region_id", "supplier_id", "product_id"]
    tactical = pin(fine.groupBy("year", "month_date", *series).agg(
        F.sum("y").alias("y"), F.count_if(F.col("y") == 0).alias("zeros"), F.count(F.lit(1)).alias("weeks")))
    by_supplier = tactical.groupBy("year", "region_id", "supplier_id").agg(F.sum("y").alias("y"))
    by_region = by_supplier.groupBy("year", "region_id").agg(F.sum("y").alias("y"))
    national = by_region.groupBy("year").agg(F.sum("y").alias("y"))
    grains = [("year", national), ("year/region", by_region), ("year/region/supplier", by_supplier),
              ("month/region/supplier/product", tactical)]
    parts = [df.agg(F.avg((F.col("y") == 0).cast("double")).alias("zero_rate"), F.count(F.lit(1)).alias("cells"))
             .select(F.lit(name).alias("grain"), "zero_rate", "cells") for name, df in grains]
    parts.append(tactical.agg((F.sum("zeros") / F.sum("weeks")).alias("zero_rate"), F.sum("weeks").alias("cells"))
                 .select(F.lit("week/series").alias("grain"), "zero_rate", "cells"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def cv_cascade(dense: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Median and range of the weekly coefficient of variation by region, supplier and series, and the
    national one (sample deviation)."""
    def spread(key: Sequence[str], name: str) -> DataFrame:
        return dense.groupBy(*key).agg(F.avg("y").alias("m"), F.stddev_pop("y").alias("s")).where("m > 0").select(
            F.lit(name).alias("level"), (F.col("s") / F.col("m")).alias("cv"))

    nat = dense.groupBy("ds").agg(F.sum("y").alias("y")).agg(
        F.avg("y").alias("m"), F.stddev_samp("y").alias("s")).select(
        F.lit("national").alias("level"), F.when(F.col("m") > 0, F.col("s") / F.col("m")).otherwise(F.lit(0.0)).alias("cv"))
    rows = pin(
        nat.unionByName(spread(["region_id"], "region")).unionByName(spread(["supplier_id"], "supplier"))
        .unionByName(spread(keys, "series")))
    ends = rows.groupBy("level").agg(F.count(F.lit(1)).alias("n"), F.min("cv").alias("min_cv"), F.max("cv").alias("max_cv"))
    return ends.join(exact_quantiles(rows, ["level"], "cv", {"median_cv": 0.5}), "level")


def kernel_density(rows: DataFrame, value: str, group: str, points: int = 50, trim: float = 0.995) -> DataFrame:
    """Gaussian kernel density of ``log1p(value)`` per group on ``points`` grid steps up to the trimmed top.

    Equal values are counted first and values share few distinct levels, so a grid point is
    evaluated once per distinct value, weighted by its count. Bandwidth: Scott's rule per group.
    """
    counts = rows.where(F.col(value) > 0).groupBy(group, F.log1p(value).alias("x")).agg(F.count(F.lit(1)).alias("w"))
    m, m2, n = F.sum(F.col("w") * F.col("x")), F.sum(F.col("w") * F.col("x") * F.col("x")), F.sum("w")
    moments = counts.groupBy(group).agg(n.alias("n"), m.alias("sx"), m2.alias("sxx"))
    sd = F.sqrt((F.col("sxx") - F.col("sx") * F.col("sx") / F.col("n")) / (F.col("n") - 1))
    bands = moments.select(group, "n", (sd * F.pow(F.col("n").cast("double"), F.lit(-0.2))).alias("bw")).where("n > 1 and bw > 0")
    top = F.log1p(exact_quantiles(rows.where(F.col(value) > 0), [], value, {"q": trim}).scalar())
    spread = counts.join(F.broadcast(bands), group).withColumn("_top", top)
    at = F.col("_top") * F.col("i") / (points - 1)
    kernel = F.col("w") * F.exp(-0.5 * F.pow((at - F.col("x")) / F.col("bw"), F.lit(2))) / (
        F.col("n") * F.col("bw") * F.sqrt(2 * F.pi()))
    return (
        spread.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
        .groupBy(group, "i").agg(F.max(at).alias("x"), F.sum(kernel).alias("density"))
    )


def sample_series(panel: DataFrame, n: int, seed: int, group: str = "demand_type") -> DataFrame:
    """``n`` series per group drawn by a seeded digest: the same draw on every run, cluster and engine."""
    pick = F.md5(F.concat("unique_id", F.lit(f"/{seed}")))
    order = Window.partitionBy(group).orderBy(pick, "unique_id")
    ids = panel.select(group, "unique_id").distinct()
    chosen = ids.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= n).drop("_r")
    return chosen


def sampled_grid(panel: DataFrame, chosen: DataFrame, group: str = "demand_type") -> DataFrame:
    """Sampled series on the common week grid, absent weeks 0.

    Only the drawn series' rows take part in the join: judged by packed series, all rows of an unpacked panel look small enough to be broadcast.
    """
    chosen = pin(chosen)  # at most n a group, read for the grid and for the rows
    drawn = panel.join(F.broadcast(chosen.select("unique_id").distinct()), "unique_id", "left_semi")
    span = panel.agg(F.struct(F.min("ds").alias("lo"), F.max("ds").alias("hi"))).scalar()
    weeks = F.sequence(span["lo"], span["hi"], F.expr("interval 7 days"))
    grid = chosen.withColumn("ds", F.explode(weeks))
    return grid.join(drawn.select("unique_id", "ds", "y"), ["unique_id", "ds"], "left").withColumn(
        "y", F.coalesce("y", F.lit(0)))


def sample_profile(grid: DataFrame, group: str = "demand_type") -> DataFrame:
    """Mean and median over the sampled series per week; a week holds at most the sampled series."""
    return grid.groupBy(group, "ds").agg(
        F.avg("y").alias("mean_y"), F.percentile("y", F.lit(0.5)).alias("median_y"), F.count(F.lit(1)).alias("n_series"))
