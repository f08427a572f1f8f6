"""Global ranks and exact quantiles that never bring a whole group into one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from weekloom.session import pin

_ROW_BITS = 33
FINE_BITS = 21  # parts of a bucket of exact_quantiles: 2 ** FINE_BITS


def global_row_number(df: DataFrame, order: Sequence[Column | str], name: str) -> DataFrame:
    """Number all rows 1..n in ``order`` without a single-partition sort.

    The rows are pinned first, as sampling the ranges and placing the rows each read them; then they are
    range-partitioned and sorted, pinned again so that positions survive task retries, and
    numbered by partition offset + position. ``order`` must be a unique key.
    """
    laid_out = (
        pin(df).repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    fixed = (
        pin(laid_out)
        .withColumn("_part", F.shiftright("_at", _ROW_BITS))
        .withColumn("_pos", F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
        .drop("_at")
    )
    # one row per partition, so this window and the broadcast are bounded by the partition count
    sizes = fixed.groupBy("_part").agg((F.max("_pos") + 1).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (
        fixed.join(F.broadcast(offsets), "_part")
        .withColumn(name, (F.col("_before") + F.col("_pos") + 1).cast("bigint"))
        .drop("_part", "_pos", "_before")
    )


def rank_in_group(df: DataFrame, group: Sequence[str], order: Sequence[Column | str], name: str,
                  size_name: str | None = None, few_groups: bool = False) -> DataFrame:
    """Row number inside each group for groups of any size (``group`` + ``order`` must be unique).

    With ``few_groups`` the caller vouches that the number of groups does not grow with the data (demand
    types, column names); their spans are then broadcast and the numbered rows stay where they are.
    Without groups the whole table is one.
    """
    numbered = global_row_number(df, [*group, *order], "_g")
    if not group:
        size = numbered.agg(F.count(F.lit(1))).scalar()
        out = numbered.withColumnRenamed("_g", name)
        return out.withColumn(size_name, size) if size_name else out
    spans = numbered.groupBy(*group).agg(F.min("_g").alias("_g0"), F.count(F.lit(1)).alias("_gn"))
    spans = F.broadcast(spans) if few_groups else spans
    out = numbered.join(spans, list(group)).withColumn(name, F.col("_g") - F.col("_g0") + 1)
    if size_name:
        out = out.withColumn(size_name, F.col("_gn"))
    return out.drop("_g", "_g0", "_gn")


def _code(v: Column) -> Column:
    """Order-preserving whole number of a double: its position on a logarithmic scale.

    Its upper part (``code >> FINE_BITS``) is a bucket about 0.1 % wide, at most some 1.5 million of them per sign over all doubles.
    A code stands for some 3 million neighbouring doubles at most. NaN comes last, as in Spark's order.
    """
    steps = F.floor((F.least(F.log(F.abs(v)), F.lit(710.0)) + 746.0) * (1000.0 * (1 << FINE_BITS))) + 1
    return F.when(F.isnan(v), F.lit(1 << 60)).when(v == 0, F.lit(0)).when(v > 0, steps).otherwise(-steps).cast("bigint")


def _placed(counts: DataFrame, within: Sequence[str], part: str) -> DataFrame:
    """Per value of ``part``: how many rows of its group ``within`` come before it, up to it and in all."""
    sums = counts.groupBy(*within, part).agg(F.sum("_n").alias("_pn"))
    whole = Window.partitionBy(*within)
    upto = whole.orderBy(part).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return sums.select(
        *within, part,
        (F.sum("_pn").over(upto) - F.col("_pn")).alias("_before"),
        F.sum("_pn").over(upto).alias("_upto"),
        F.sum("_pn").over(whole).alias("_total"),
    )


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, float]) -> DataFrame:
    """Linear-interpolated quantiles per group, exact, for groups of any size and any skew.

    Equal values are counted first (combined before the shuffle). Bucket totals tell in which bucket each wanted rank lies,
    totals of the 2 million fine parts of those buckets tell in which part, and only those parts are sorted. So no task sorts
    more than some 3 million different values, however close together the values of a group lie.
    """
    grouped = bool(keys)
    keys = list(keys) if grouped else ["_whole"]
    src = df if grouped else df.withColumn("_whole", F.lit(1))
    counts = (
        src.where(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).cast("double").alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_c", _code(F.col("_v")))
        .withColumn("_b", F.shiftright("_c", FINE_BITS))
    )
    wanted = []
    for name, p in probs.items():
        pos = F.lit(float(p)) * (F.col("_total") - 1)
        low = F.floor(pos)
        frac = pos - low
        wanted += [
            F.struct(F.lit(name).alias("q"), low.alias("r"), (1 - frac).alias("w")),
            F.struct(F.lit(name).alias("q"), (low + 1).alias("r"), frac.alias("w")),
        ]

    def hit(wants: Column) -> Column:
        return F.filter(wants, lambda t: (t["w"] > 0) & (t["r"] >= F.col("_before")) & (t["r"] < F.col("_upto")))

    buckets = (
        _placed(counts, keys, "_b")
        .withColumn("_want", hit(F.array(*wanted)))
        .where(F.size("_want") > 0)
        .select(*keys, "_b", F.col("_before").alias("_first"), F.col("_want").alias("_asked"))
    )
    parts = (
        _placed(counts.join(buckets.select(*keys, "_b"), [*keys, "_b"], "left_semi"), [*keys, "_b"], "_c")
        .join(buckets, [*keys, "_b"])
        .withColumn("_before", F.col("_before") + F.col("_first"))
        .withColumn("_upto", F.col("_upto") + F.col("_first"))
        .withColumn("_want", hit(F.col("_asked")))
        .where(F.size("_want") > 0)
        .select(*keys, "_c", "_before", "_want")
    )
    inside = Window.partitionBy(*keys, "_c").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = counts.join(parts, [*keys, "_c"])
    ranked = joined.withColumn("_hi", F.col("_before") + F.sum("_n").over(inside))
    found = (
        ranked.withColumn("_t", F.explode("_want"))
        .where((F.col("_t.r") < F.col("_hi")) & (F.col("_t.r") >= F.col("_hi") - F.col("_n")))
        .groupBy(*keys)
        .agg(*[
            F.sum(F.when(F.col("_t.q") == name, F.col("_t.w") * F.col("_v"))).alias(name) for name in probs
        ])
    )
    return found if grouped else found.drop("_whole")
