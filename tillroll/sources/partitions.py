"""What a partitioned tree holds, told by its file listing; no data file is opened.

Spark lists the files (in parallel beyond a few folders) and reads the partition
columns from the folder names, with the types a read of the data gives them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.sources.readers import read_files

_OF_A_FILE = ("path", "modificationTime", "length", "content")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, in whatever store Spark reads."""
    context = spark.sparkContext
    found = context._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(context._jsc.hadoopConfiguration()).exists(found)


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """The columns that stand in folder names."""
    return [c for c in spark.read.format("binaryFile").load(path).columns if c not in _OF_A_FILE]


def partition_files(spark: SparkSession, path: str) -> DataFrame:
    """(partition columns, n_files, n_bytes, changed): one row for each partition.

    Number, size and newest change of its files: what differs after any write to it.
    """
    files = spark.read.format("binaryFile").load(path)
    return files.groupBy(*partition_columns(spark, path)).agg(
        F.count(F.lit(1)).alias("n_files"),
        F.sum("length").alias("n_bytes"),
        F.max("modificationTime").alias("changed"),
    )


def newest_partition_values(
    spark: SparkSession, path: str, value: Column, n: int, schema: T.StructType | None = None, fmt: str = "parquet"
) -> list:
    """The ``n`` greatest values of an expression over partition columns, such as the
    ingestion day, that have a row; newest first.

    The listing proposes them; a look at the row counts of so many partitions at a time
    drops those whose files are empty, and older ones take their places.
    """
    listed = partition_files(spark, path).select(value.alias("v")).where("v is not null").distinct()
    rows = read_files(spark, path, fmt, schema=schema)
    found: list = []
    below: Column = F.lit(True)
    while len(found) < n:
        some = [r.v for r in listed.where(below).orderBy(F.col("v").desc()).limit(n - len(found)).collect()]
        if not some:
            break
        # No column of the data is read.
        there = {r.v for r in rows.where(value.isin(some)).select(value.alias("v")).distinct().collect()}
        found += [v for v in some if v in there]
        below = F.col("v") < F.lit(some[-1])
    return found


def rows_of_newest(
    spark: SparkSession, path: str, value: Column, n: int, schema: T.StructType | None = None, fmt: str = "parquet"
) -> DataFrame:
    """Rows of the ``n`` newest values; the scan lists the chosen partitions only."""
    chosen = newest_partition_values(spark, path, value, n, schema, fmt)
    rows = read_files(spark, path, fmt, schema=schema)
    return rows.where(value.isin(chosen) if chosen else F.lit(False))
