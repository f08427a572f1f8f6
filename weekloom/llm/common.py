"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, types as T
from pyspark.sql import functions as F

CHECKPOINT_KEY = "spark.checkpoint.dir"
ROWS = 256  # rows turned into Python objects at a time


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: the session's ``spark.checkpoint.dir``.

    Only a local session without the setting (tests) gets a folder of its own; any other master raises.
    """
    where = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that every executor can reach")
        where = tempfile.mkdtemp(prefix="weekloom-llm-")
        spark.conf.set(CHECKPOINT_KEY, where)
    return where.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and go on from the written copy; this cuts the lineage."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_slices(df: DataFrame, schema: str | T.StructType, work: Callable[..., Sequence[list]], rows: int = ROWS) -> DataFrame:
    """Apply ``work`` to slices of at most ``rows`` rows, one Python list per column of ``df``.

    ``work`` returns one list (or Arrow array) per column of ``schema``; they may be longer or shorter than the input.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    shape = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    names, width = shape.names, len(shape.names)

    def run(batches):
        import pyarrow as pa

        arrow = to_arrow_schema(shape)
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                columns = work(*(part.column(i).to_pylist() for i in range(part.num_columns)))
                assert len(columns) == width
                if len(columns[0]):
                    yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, arrow.field(n).type) for n, c in zip(names, columns)], names=names)

    return df.mapInArrow(run, shape)


def lower_ascii(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


ASCII_LOWER = {i: i + 32 for i in range(65, 91)}  # for str.translate
