"""Calendar, product, holiday, weather and assembly of model features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from weekloom.functions import dates as D
from weekloom.functions.ranks import rank_in_group
from weekloom.functions.text import contains_any, fold_accents

STATIC_COLUMNS = [
    "product_attribute_1", "product_attribute_2", "product_attribute_3", "supplier_id", "region_id",
]
HOLIDAY_COLUMNS = ["is_national_holiday", "is_holiday", "weeks_to_next_holiday", "weeks_since_last_holiday"]
WEATHER_COLUMNS = ["temp_max", "temp_min", "temp_mean", "precip", "wind_max", "is_rainy"]

# fixed values: holiday types by rising code, and the keywords that decide the three strongest
HOLIDAY_TYPES = ["none", "regional", "other", "christmas_newyear", "easter", "carnival"]
HOLIDAY_KEYWORDS = {
    "carnival": ["carnaval", "quaresma"],
    "easter": ["sexta-feira santa", "corpus christi"],
    "christmas_newyear": ["natal", "ano-novo", "confraterniza"],
}
PROXIMITY_CAP = 4

# fixed values: weather flags and the shift that makes last year's climate the known proxy
COLD_BELOW = 15
HOT_ABOVE = 30
RAINY_ABOVE = 50
WEATHER_LAG_WEEKS = 52


def cyclic(part: Column, period: int) -> tuple[Column, Column]:
    angle = 2 * F.pi() * part / period
    return F.sin(angle), F.cos(angle)


def calendar_features(panel: DataFrame, date: str = "ds") -> DataFrame:
    """Year and the sine / cosine of month, quarter and ISO week."""
    d = F.col(date)
    parts = {"month": (F.month(d), 12), "quarter": (F.quarter(d), 4), "week": (F.weekofyear(d), 52)}
    columns = {"year": F.year(d)}
    for name, (part, period) in parts.items():
        columns[f"{name}_sin"], columns[f"{name}_cos"] = cyclic(part, period)
    return panel.withColumns(columns)


def ordinal_codes(df: DataFrame, *columns: str) -> DataFrame:
    """Replace category columns by their 0-based code in sorted order; missing becomes -1.

    The dictionary of a column is its distinct values; all dictionaries are numbered in one pass
    without a single-task sort, and Spark broadcasts one only while it is small.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("_c"), F.col(c).alias("_v")) for c in columns])
    known = df.select(F.explode(cells).alias("s")).select("s.*").where("_v is not null").distinct()
    codes = rank_in_group(known, ["_c"], ["_v"], "_code", few_groups=True)
    for c in columns:
        mine = codes.where(F.col("_c") == c).select("_v", (F.col("_code") - 1).alias("_code"))
        df = (
            df.join(mine, F.col(c) == F.col("_v"), "left")
            .withColumn(c, F.coalesce("_code", F.lit(-1)).cast("int")).drop("_v", "_code")
        )
    return df


def static_features(rows: DataFrame, columns: Sequence[str] = STATIC_COLUMNS, key: str = "unique_id",
                    order: Sequence[str] = ()) -> DataFrame:
    """First row per series (by ``order``, else by the columns themselves)."""
    pick = F.min(F.struct(*[F.col(c) for c in [*order, *columns]])).alias("s")
    return rows.groupBy(key).agg(pick).select(key, *[F.col(f"s.{c}").alias(c) for c in columns])


# -- holidays ----------------------------------------------------------------

def holiday_type(name: Column) -> Column:
    """Type of a national holiday by the first matching keyword group."""
    folded = fold_accents(name)
    out = F.lit("other")
    for kind in reversed(list(HOLIDAY_KEYWORDS)):
        out = F.when(contains_any(folded, HOLIDAY_KEYWORDS[kind]), kind).otherwise(out)
    return out


def holiday_type_code(kind: Column) -> Column:
    return F.coalesce(F.array_position(F.array(*[F.lit(k) for k in HOLIDAY_TYPES]), kind) - 1, F.lit(0)).cast("int")


def regional_holidays(holidays: DataFrame, region_states: DataFrame) -> DataFrame:
    """State holidays of each region on dates that are not national; equal (date, name) pairs count once."""
    national = holidays.where(F.col("subdivision").isNull()).select("date").distinct()
    state = holidays.where(F.col("subdivision").isNotNull())
    return (
        state.join(national, "date", "left_anti")
        .join(region_states, "subdivision")
        .select("region_id", "date", "name").distinct()
    )


def weekly_holiday_counts(weeks: DataFrame, holidays: DataFrame, region_states: DataFrame) -> DataFrame:
    """Per (ds, region): national and regional holidays of the week and the strongest national type code.

    ``weeks`` holds Monday dates, so the seven-day range test is an equality on the week start.
    """
    in_week = D.week_start(F.col("date")).alias("ds")
    national = (
        holidays.where(F.col("subdivision").isNull())
        .groupBy(in_week)
        .agg(F.count(F.lit(1)).alias("n_national"), F.max(holiday_type_code(holiday_type(F.col("name")))).alias("code"))
    )
    regional = (
        regional_holidays(holidays, region_states).groupBy(in_week, "region_id")
        .agg(F.count(F.lit(1)).alias("n_regional"))
    )
    regions = region_states.agg(F.collect_set("region_id").alias("ids")).scalar()
    grid = weeks.select("ds").distinct().withColumn("region_id", F.explode(regions))
    return grid.join(F.broadcast(national), "ds", "left").join(F.broadcast(regional), ["ds", "region_id"], "left")


def holiday_features(weeks: DataFrame, holidays: DataFrame, region_states: DataFrame) -> DataFrame:
    """Flags, counts, type and the distance to the nearest holiday weeks per ``(ds, region_id)``."""
    n_nat, n_reg = F.coalesce("n_national", F.lit(0)), F.coalesce("n_regional", F.lit(0))
    flagged = weekly_holiday_counts(weeks, holidays, region_states).select(
        "ds", "region_id",
        (n_nat > 0).alias("is_national_holiday"),
        (n_reg > 0).alias("is_regional_holiday"),
        (n_nat + n_reg > 0).alias("is_holiday"),
        (n_nat + n_reg).cast("int").alias("n_holidays"),
        F.when(n_nat > 0, F.col("code")).when(n_reg > 0, 1).otherwise(0).cast("int").alias("holiday_type_enc"),
    )
    order = Window.partitionBy("region_id").orderBy("ds")
    at = F.row_number().over(order)
    placed = flagged.withColumn("_at", at).withColumn("_hit", F.when(F.col("is_holiday"), F.col("_at")))
    ahead = F.first("_hit", ignorenulls=True).over(order.rowsBetween(0, Window.unboundedFollowing))
    behind = F.last("_hit", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    cap = F.lit(PROXIMITY_CAP)
    kinds = F.array(*[F.lit(k) for k in HOLIDAY_TYPES])
    return placed.withColumns({
        "holiday_type": F.element_at(kinds, F.col("holiday_type_enc") + 1),
        "weeks_to_next_holiday": F.coalesce(F.least(ahead - F.col("_at"), cap), cap).cast("int"),
        "weeks_since_last_holiday": F.coalesce(F.least(F.col("_at") - behind, cap), cap).cast("int"),
    }).drop("_at", "_hit")


def date_span(panel: DataFrame, date: str = "ds") -> DataFrame:
    """One row with the first and the last week of a panel: ``ds_min, ds_max``."""
    return panel.agg(F.min(date).alias("ds_min"), F.max(date).alias("ds_max"))


def weeks_through_horizon(span: DataFrame, h: int) -> DataFrame:
    """Every Monday from the first week of the span through ``h`` weeks after its last."""
    end = F.date_add("ds_max", 7 * h)
    return span.select(F.explode(F.sequence("ds_min", end, F.expr("interval 7 days"))).alias("ds"))


def holiday_totals(features: DataFrame, region_id: int) -> DataFrame:
    """Holiday weeks per type in one region."""
    return (
        features.where(F.col("region_id") == region_id)
        .groupBy("holiday_type").agg(F.count_if("is_holiday").alias("n_holiday_weeks"))
    )


# -- weather -----------------------------------------------------------------

def weekly_weather(daily: DataFrame, closing_monday: bool = True) -> DataFrame:
    """Weekly weather per region. Weeks carry the Monday that closes a Tuesday-to-Monday bin, or with
    ``closing_monday=False`` the Monday that opens a Monday-to-Sunday week."""
    d = F.col("date")
    week = D.week_closing_monday(d) if closing_monday else D.week_start(d)
    out = daily.groupBy(week.alias("ds"), "region_id").agg(
        F.max("temperature_2m_max").alias("temp_max"),
        F.min("temperature_2m_min").alias("temp_min"),
        F.avg("temperature_2m_mean").alias("temp_mean"),
        F.sum("precipitation_sum").alias("precip"),
        F.max("windspeed_10m_max").alias("wind_max"),
    )
    return out.withColumns({
        "is_cold": (F.col("temp_mean") < COLD_BELOW).cast("int"),
        "is_hot": (F.col("temp_mean") > HOT_ABOVE).cast("int"),
        "is_rainy": (F.col("precip") > RAINY_ABOVE).cast("int"),
    })


def fetch_range(span: DataFrame, h: int, lag_weeks: int = WEATHER_LAG_WEEKS) -> DataFrame:
    """Source dates needed so that the shifted weather covers the span and ``h`` further weeks."""
    return span.select(
        F.date_sub("ds_min", 7 * lag_weeks).alias("fetch_start"),
        F.date_add("ds_max", 7 * (h - lag_weeks)).alias("fetch_end"),
    )


def shifted_weather(weekly: DataFrame, span: DataFrame, h: int, lag_weeks: int = WEATHER_LAG_WEEKS) -> DataFrame:
    """Weather moved ``lag_weeks`` ahead and kept within the span plus ``h`` weeks."""
    moved = weekly.withColumn("ds", F.date_add("ds", 7 * lag_weeks))
    end = span.select(F.date_add("ds_max", 7 * h)).scalar()
    return moved.where(F.col("ds").between(span.select("ds_min").scalar(), end))


# -- assembly ----------------------------------------------------------------

def assemble(panel: DataFrame, static: DataFrame, holidays: DataFrame | None = None,
             weather: DataFrame | None = None) -> DataFrame:
    """Panel plus static, holiday and weather columns; an absent table is skipped.

    Holidays and weather are (weeks x regions) tables, bounded by the calendar, hence broadcast.
    """
    return with_weeks(panel.drop("demand_type").join(static, "unique_id", "left"), holidays, weather)


def with_weeks(rows: DataFrame, holidays: DataFrame | None = None, weather: DataFrame | None = None) -> DataFrame:
    """Holiday and weather columns on rows with ``ds`` and ``region_id``."""
    out = rows
    if holidays is not None:
        out = out.join(F.broadcast(holidays.select("ds", "region_id", *HOLIDAY_COLUMNS)), ["ds", "region_id"], "left")
    if weather is not None:
        out = out.join(F.broadcast(weather.select("ds", "region_id", *WEATHER_COLUMNS)), ["ds", "region_id"], "left")
    return out


def available(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c in df.columns]
