"""Writes. Rows are shuffled by partition first, so a task opens few files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators.shape import BUSINESS_PARTITION, INGESTION_PARTITION

OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def _by_partition(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """``rebalance`` lets AQE split a partition that holds most of the rows."""
    if not columns:
        return df
    return df.hint("rebalance", *[F.col(c) for c in columns])


def append_partitioned(
    df: DataFrame, path: str, partition: tuple[str, ...] = INGESTION_PARTITION, fmt: str = "parquet"
) -> None:
    _by_partition(df, partition).write.format(fmt).mode("append").partitionBy(*partition).save(path)


def overwrite_partitions(
    df: DataFrame, path: str, partition: tuple[str, ...] = BUSINESS_PARTITION, fmt: str = "parquet"
) -> None:
    """Replace only the partitions present in ``df``; a rerun gives the same tree."""
    (
        _by_partition(df, partition)
        .write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition)
        .save(path)
    )


def overwrite_partitions_of_table(
    df: DataFrame, table: str, partition: tuple[str, ...] = BUSINESS_PARTITION, fmt: str = "parquet"
) -> None:
    """As above for a catalogue table, which is created when absent.

    An insert into a table takes the mode from its session, not from a write option.
    The insert runs in a session of its own, so no other job of this one sees it.
    """
    spark = df.sparkSession
    rows = _by_partition(df, partition)
    if not spark.catalog.tableExists(table):
        rows.write.format(fmt).partitionBy(*partition).saveAsTable(table)
        return
    view = f"rows_of_{uuid.uuid4().hex}"
    rows.select(*spark.table(table).columns).createGlobalTempView(view)
    try:
        insert = f"INSERT OVERWRITE TABLE {table} SELECT * FROM global_temp.{view}"
        _session_with(spark, OVERWRITE_MODE, "dynamic").sql(insert)
    finally:
        spark.catalog.dropGlobalTempView(view)
    spark.catalog.refreshTable(table)


def _session_with(spark: SparkSession, key: str, value: str) -> SparkSession:
    """A session like this one, of the same application, with one other setting."""
    other = spark.newSession()
    for name, setting in spark.conf.getAll.items():
        if spark.conf.isModifiable(name):
            other.conf.set(name, setting)
    other.conf.set(key, value)
    other.catalog.setCurrentDatabase(spark.catalog.currentDatabase())
    return other


def overwrite_table(df: DataFrame, table: str, fmt: str = "parquet") -> None:
    df.write.format(fmt).mode("overwrite").saveAsTable(table)
