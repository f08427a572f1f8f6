"""Maturity, outliers, demand classes and the refined panel."""

from __future__ import annotations

from pyspark.sql import functions as F

from weekloom.functions.ranks import global_row_number
from weekloom.operators import demand as D
from weekloom.plans import preparation as PREP
from weekloom.sources import sinks as K
from weekloom.verification.common import Inputs, Registry, r, sql
from weekloom.verification.warehouse import scratch

AREA = Registry()


@AREA.query("maturity_segments", sql("""
    SELECT supplier_id, product, CASE WHEN n < 26 THEN 'cold_start' WHEN last < ref - 182 THEN 'discontinued' ELSE 'valid' END AS segment,
           CAST(floor((ref - last) / 7) AS INTEGER) AS weeks_since_last_sale
    FROM (SELECT *, max(last) OVER () AS ref FROM (
        SELECT l_suppkey AS supplier_id, p_brand AS product, CAST(date_trunc('week', max(l_shipdate)) AS DATE) AS last,
               (CAST(date_trunc('week', max(l_shipdate)) AS DATE) - CAST(date_trunc('week', min(l_shipdate)) AS DATE)) / 7 + 1 AS n
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2))"""))
def maturity_segments(i: Inputs):
    """Segments at the (supplier, brand) grain, which holds every segment."""
    rows = i.tables.sales(region=False, attributes=True)
    week = F.date_trunc("week", F.col("date")).cast("date")
    ends = rows.groupBy("supplier_id", F.col("product_attribute_1").alias("product")).agg(
        F.min(week).alias("first_week_date"), F.max(week).alias("last_week_date"))
    registry = ends.withColumns({
        "total_weeks_length": F.datediff("last_week_date", "first_week_date") / 7 + 1,
        "key": F.struct("supplier_id", "product")})
    out = D.segment_by_maturity(registry, "key")
    return out.select("key.supplier_id", "key.product", "segment", "weeks_since_last_sale")


@AREA.query("valid_panel", sql("SELECT * FROM vp"))
def valid_panel(i: Inputs):
    return PREP.valid_panel(i.tables)


FLAG_COLUMNS = ", ".join(
    ["unique_id", "ds", "y", "is_outlier"]
    + [f"{r(c)} AS {c}" for c in ("rolling_baseline", "rolling_std", "upper_threshold", "lower_threshold")])


@AREA.query("outlier_flags", sql(f"SELECT {FLAG_COLUMNS} FROM flags"))
def outlier_flags(i: Inputs):
    return D.outlier_thresholds(PREP.valid_panel(i.tables))


@AREA.query("capped_series", sql("SELECT unique_id, ds, y, is_outlier, y_capped FROM flags"))
def capped_series(i: Inputs):
    return D.capped_values(PREP.valid_panel(i.tables))


TWO_SIDED = f"""
    SELECT unique_id, ds, y, {r('b')} AS rolling_baseline, {r('s')} AS rolling_std, {r('b + 3.0 * s')} AS upper_threshold,
           {r('CASE WHEN b IS NOT NULL THEN greatest(b - 3.0 * s, 0.0) END')} AS lower_threshold,
           coalesce(y > 0 AND (y > b + 3.0 * s OR y < greatest(b - 3.0 * s, 0.0)), false) AS is_outlier,
           CASE WHEN coalesce(y > 0 AND y > b + 3.0 * s, false) THEN CAST(trunc(b + 3.0 * s) AS BIGINT)
                WHEN coalesce(y > 0 AND y < greatest(b - 3.0 * s, 0.0), false) THEN CAST(trunc(greatest(b - 3.0 * s, 0.0)) AS BIGINT)
                ELSE y END AS y_capped
    FROM (SELECT *, CASE WHEN k >= 3 THEN med END AS b, CASE WHEN k >= 3 THEN 1.4826 * mad END AS s FROM near)"""


@AREA.query("outlier_flags_two_sided", sql(TWO_SIDED))
def outlier_flags_two_sided(i: Inputs):
    return D.cap_outliers(D.outlier_thresholds(PREP.valid_panel(i.tables), two_sided=True))


@AREA.query("outlier_summary", sql(f"""
    SELECT CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(k) AS BIGINT) AS n_outliers, {r('sum(k) / sum(n)')} AS outlier_share,
           count(*) AS n_series, count(*) FILTER (k > 0) AS n_series_affected
    FROM (SELECT unique_id, count(*) AS n, count(*) FILTER (is_outlier) AS k FROM flags GROUP BY 1)"""))
def outlier_summary(i: Inputs):
    return D.outlier_summary(D.capped_values(PREP.valid_panel(i.tables)))


@AREA.query("outlier_ranking", sql(f"""
    SELECT unique_id, n_outliers, rank, CASE WHEN rank = 1 THEN 'top' WHEN rank = n // 2 + 1 THEN 'median' END AS pick
    FROM (SELECT *, row_number() OVER (ORDER BY n_outliers DESC, unique_id) AS rank, count(*) OVER () AS n
          FROM (SELECT unique_id, count(*) AS n_outliers FROM ({TWO_SIDED}) WHERE is_outlier GROUP BY 1))"""))
def outlier_ranking(i: Inputs):
    """Series ranked by outlier count, with the top and the middle one marked."""
    flagged = D.outlier_thresholds(PREP.valid_panel(i.tables), two_sided=True)
    counts = flagged.where("is_outlier").groupBy("unique_id").agg(F.count(F.lit(1)).alias("n_outliers"))
    ranked = global_row_number(counts, [F.col("n_outliers").desc(), "unique_id"], "rank")
    n = ranked.agg(F.count(F.lit(1))).scalar()
    pick = F.when(F.col("rank") == 1, "top").when(F.col("rank") == F.floor(n / 2) + 1, "median")
    return ranked.withColumn("pick", pick)


@AREA.query("demand_classes", sql(f"""
    SELECT unique_id, n, n_positive, {r('adi')} AS adi, {r('cv2')} AS cv2, demand_type FROM cls"""))
def demand_classes(i: Inputs):
    treated = D.capped_values(PREP.valid_panel(i.tables))
    return D.classify(treated, "y_capped")


@AREA.query("refined_datasets", sql("SELECT unique_id, ds, y, demand_type FROM rp"))
def refined_datasets(i: Inputs):
    """Written with one folder per demand type and read back as one panel."""
    path = K.write_refined(i.model.panel, scratch(i, "refined"))
    parts = [K.read_refined(i.spark, path, kind) for kind in D.DEMAND_TYPES]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select("unique_id", "ds", "y", F.col("demand_type").cast("string").alias("demand_type"))


@AREA.query("excluded_series", sql("""
    SELECT unique_id, ds, y, segment, weeks_since_last_sale FROM filled WHERE segment <> 'valid'"""))
def excluded_series(i: Inputs):
    path = K.write_table(PREP.excluded_panel(i.tables), scratch(i, "excluded"))
    return i.spark.read.parquet(path)


@AREA.query("series_tags", sql("""
    SELECT seg.unique_id, segment, weeks_since_last_sale, n_outliers, demand_type
    FROM seg LEFT JOIN (SELECT unique_id, count(*) FILTER (is_outlier) AS n_outliers FROM flags GROUP BY 1) o USING (unique_id)
    LEFT JOIN cls USING (unique_id)"""))
def series_tags(i: Inputs):
    return D.series_tags(PREP.series_segments(i.tables), PREP.treated_panel(i.tables), "unique_id")


@AREA.query("segment_counts", sql("""
    SELECT demand_type, count(DISTINCT unique_id) AS n_series, count(*) AS n_rows FROM rp GROUP BY 1"""))
def segment_counts(i: Inputs):
    per = i.model.panel.groupBy("demand_type", "unique_id").agg(F.count(F.lit(1)).alias("k"))
    return per.groupBy("demand_type").agg(F.count(F.lit(1)).alias("n_series"), F.sum("k").alias("n_rows"))
