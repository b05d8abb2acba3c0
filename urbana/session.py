"""Session defaults, table reads and lineage cuts shared by all operators."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession

SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(master: str = "local[*]", shuffle_partitions: int | None = None, app: str = "urbana") -> SparkSession:
    """A session with the settings the operators assume: UTC, AQE with skew handling, Arrow."""
    b = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("URBANA_DRIVER_MEMORY", "8g"))
    )
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return b.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``. Where it is unset a temporary one, in local mode only."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured.rstrip("/")
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return sc._jsc.sc().getCheckpointDir().get().rstrip("/")


_scopes: list[list[str]] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, for a table that a job writes and reads again. It goes with the innermost ``scratch_scope``, if there is one."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Removes, at its end, the scratch tables that were begun in it, whatever the file system. Store the result of a query inside the scope:

        with scratch_scope(spark):
            query(spark, folder).write.parquet(target)
    """
    _scopes.append([])
    try:
        yield
    finally:
        discard(spark, *_scopes.pop())


def discard(spark: SparkSession, *paths: str) -> None:
    """Removes scratch tables that nothing reads any more."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(hadoop).delete(at, True)


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is written in it leaves no shuffle files: they go with the job, and not when the driver happens to collect its garbage."""
    before = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLES_GO)
        else:
            spark.conf.set(SHUFFLES_GO, before)


def cut(df: DataFrame, folder: str | None = None) -> DataFrame:
    """Cut lineage: write the rows to the shared folder, or to a ``scratch_path`` in it, and read them again; the shuffles behind them go.

    A lost executor costs a reread and not a recomputation, and later plans see the size that the rows really have
    (a checkpointed plan keeps its source's estimate, which joins multiply round by round).
    """
    spark, folder = df.sparkSession, folder or scratch_path(df.sparkSession, "cut")
    with shuffles_removed(spark):
        df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def settled(spark: SparkSession, make: Callable[[], DataFrame]) -> DataFrame:
    """The rows that ``make`` gives, as by ``cut``; the scratch tables begun for them go."""
    folder = scratch_path(spark, "settled")
    with scratch_scope(spark):
        return cut(make(), folder)
