"""Schemas of the layer tables. Dates are DATE and missing values are NULL, never NaN."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, LONG, INT, DOUBLE, DATE = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.DateType()


def table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


RAW_SALES = table(
    week_dt=STRING, dsupp_id=STRING, product_id=STRING, region_nm=STRING, units_qty=STRING,
    product_attr_1=STRING, product_attr_2=STRING, product_attr_3=STRING)

BRONZE_SALES = table(
    week_date=DATE, supplier_id=LONG, product_id=STRING, region=STRING, units_sold=LONG,
    product_attribute_1=STRING, product_attribute_2=STRING, product_attribute_3=STRING)

PANEL = table(unique_id=STRING, ds=DATE, y=LONG)

HOLIDAY_SOURCE = table(date=DATE, name=STRING, subdivision=STRING)

WEATHER_DAILY = table(
    date=DATE, region_id=INT, temperature_2m_max=DOUBLE, temperature_2m_min=DOUBLE, temperature_2m_mean=DOUBLE,
    precipitation_sum=DOUBLE, windspeed_10m_max=DOUBLE)

METRICS = table(mase=DOUBLE, smape=DOUBLE, wape=DOUBLE, n_series=LONG)

RUN_METADATA = T.StructType([
    *table(demand_type=STRING, **{"class": STRING}, saved_at=STRING, freq=STRING, horizon=INT, n_windows=INT).fields,
    T.StructField("baseline_metrics", METRICS),
    T.StructField("model_metrics", METRICS),
    *table(delta_wape_pct=DOUBLE, model_col=STRING, cv_wape=DOUBLE, best_params=STRING).fields,
])
