"""Raw CSV in, typed bronze table out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from weekloom.schemas import BRONZE_SALES, RAW_SALES


def read_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read the flat sales file as text columns; column names come from the schema by position."""
    return spark.read.schema(RAW_SALES).option("header", True).option("enforceSchema", True).csv(path)


def parse_raw_lines(lines: DataFrame, column: str = "line") -> DataFrame:
    """The same raw columns from a DataFrame that holds one CSV line per row."""
    parsed = F.from_csv(F.col(column), ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RAW_SALES))
    return lines.select(parsed.alias("r")).select("r.*")


def to_bronze(raw: DataFrame, date_format: str = "yyyy-MM-dd") -> DataFrame:
    """Rename the raw columns by position and cast them to the bronze types."""
    renamed = raw.toDF(*BRONZE_SALES.names)
    typed = {
        f.name: (F.to_date(f.name, date_format) if f.name == "week_date" else F.col(f.name).cast(f.dataType))
        for f in BRONZE_SALES.fields
    }
    return renamed.select(*[expr.alias(name) for name, expr in typed.items()])


CORRUPT = "_corrupt_record"
REQUIRED = ("week_date", "supplier_id", "product_id", "units_sold")


def read_checked_csv(spark: SparkSession, path: str, header: bool = True, date_format: str = "yyyy-MM-dd") -> DataFrame:
    """Bronze columns of every line, bad ones included: ``line`` is the record, ``reason`` what is wrong with it, else NULL.

    A line with too few or too many fields is ``columns``. Otherwise a value that its type cannot hold is ``unreadable`` and an empty one of
    ``REQUIRED`` is ``missing``; several faults of a line are listed in column order. One pass; nothing raises and nothing is dropped.
    """
    given = T.StructType([*RAW_SALES.fields, T.StructField(CORRUPT, T.StringType())])
    raw = spark.read.schema(given).options(
        header=header, enforceSchema=True, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT).csv(path)
    texts = raw.toDF(*BRONZE_SALES.names, CORRUPT)
    values, faults = {}, []
    for f in BRONZE_SALES.fields:
        text = F.col(f.name)
        if f.name == "week_date":
            value = F.try_to_timestamp(text, F.lit(date_format)).cast("date")
        else:
            value = text.try_cast(f.dataType)
        values[f.name] = value
        faults.append(F.when(text.isNotNull() & value.isNull(), F.lit(f"unreadable {f.name}")))
        if f.name in REQUIRED:
            faults.append(F.when(text.isNull(), F.lit(f"missing {f.name}")))
    listed = F.concat_ws(", ", *faults)
    reason = F.when(F.col(CORRUPT).isNotNull(), F.lit("columns")).when(listed != "", listed)
    line = F.coalesce(F.col(CORRUPT), F.to_csv(F.struct(*BRONZE_SALES.names)))
    return texts.select(*[v.alias(n) for n, v in values.items()], F.when(reason.isNotNull(), line).alias("line"), reason.alias("reason"))


def accepted(checked: DataFrame) -> DataFrame:
    """The typed rows without a fault."""
    return checked.where(F.col("reason").isNull()).drop("line", "reason")


def rejects(checked: DataFrame) -> DataFrame:
    """``line, reason`` of the others, to be kept beside the bronze table."""
    return checked.where(F.col("reason").isNotNull()).select("line", "reason")


def ingest_counts(checked: DataFrame) -> DataFrame:
    """``reason, n_rows, units_sold``: accepted rows and rejected ones by reason."""
    return checked.groupBy(F.coalesce("reason", F.lit("accepted")).alias("reason")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.when(F.col("reason").isNull(), F.col("units_sold"))).alias("units_sold"))
