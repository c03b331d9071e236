"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Whether the shuffle files of a query go when it ends, not when the driver happens to
#: collect its garbage.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: str = "8", **extra: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tillroll")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cores)
        # The given files have one split each.
        .config("spark.tillroll.spread.scans", cores)
        # Small inputs of costly text work keep one task per core.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster a
    machine-local path would be lost with its executor.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tillroll-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Steps this process has written and not removed.
_steps: list[str] = []


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    The copy outlives an executor, and unlike a checkpoint it can be read by
    column and has a size the optimizer knows. It stays until ``remove_steps``; what was
    shuffled to make it goes at once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "step")
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEAN_UP) if before is None else spark.conf.set(CLEAN_UP, before)
    _steps.append(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder this library wrote."""
    context = spark.sparkContext
    found = context._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(context._jsc.hadoopConfiguration()).delete(found, True)


def remove_steps(spark: SparkSession) -> None:
    """Delete the steps written so far, once the results built on them are written."""
    while _steps:
        remove_path(spark, _steps.pop())
