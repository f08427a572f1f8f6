"""Session set-up and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_setting = threading.RLock()


def build_session(app: str = "weekloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every operator assumes.

    Only semantics (UTC, AQE) and fair sharing between concurrent jobs are fixed here; memory, cores and the number of shuffle
    partitions belong to the cluster and are passed through ``conf``.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.scheduler.mode", "FAIR")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's ``spark.checkpoint.dir``; make a folder only for local sessions without one."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    shared = sc.getConf().get(CHECKPOINT_KEY) or spark.conf.get(CHECKPOINT_KEY, None)
    if shared:
        sc.setCheckpointDir(shared)
        return
    if not sc.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that every executor can reach")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="weekloom-checkpoint-"))


def pin(df: DataFrame) -> DataFrame:
    """Write ``df`` as a parquet table under the checkpoint folder and continue from the written copy.

    Needed where row positions must not change when a task is run again, and where a costly result is
    read more than once. Readers of the copy still get column pruning, filters and sizes. Shuffle files of the write are deleted at its
    end, else those of all writes of a run lie on the executors' disks until the driver happens to collect garbage.
    """
    spark = df.sparkSession
    path = f"{pinned_folder(spark)}/{uuid.uuid4().hex}"
    with shuffles_cleaned(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """What is planned meanwhile has ``key`` set to ``value``; if another thread holds a setting just now, it goes on as it is."""
    mine = _setting.acquire(blocking=False)
    before = spark.conf.get(key, None) if mine else None
    try:
        if mine:
            spark.conf.set(key, value)
        yield
    finally:
        if mine:
            spark.conf.unset(key) if before is None else spark.conf.set(key, before)
            _setting.release()


def shuffles_cleaned(spark: SparkSession) -> AbstractContextManager[None]:
    """Writes and collects started meanwhile leave no shuffle files."""
    return setting(spark, CLEANUP_KEY, "true")


def unpin(df: DataFrame) -> None:
    """Delete a pinned table before the end of the run; nothing may read it any more."""
    spark = df.sparkSession
    for path in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        _delete(spark, path)


def pinned_folder(spark: SparkSession) -> str:
    """Where this application's pinned tables lie."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/pinned-{spark.sparkContext.applicationId}"


def release(spark: SparkSession) -> None:
    """Delete this application's pinned tables, at the end of a run; results still to be read must be written before."""
    _delete(spark, pinned_folder(spark))


def _delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
