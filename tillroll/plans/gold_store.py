"""A gold table on disk that a run reads and writes only where it has something new.

Gold is partitioned by the touched date of its spec, a part of the key: all rows of a
key are in one partition. The dates of a run's snapshot therefore name all partitions
the run can change. They become a static filter on the gold scan and the partitions
of the overwrite; every other partition is neither listed for reading nor written.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.operators.skew import DEFAULT_RULE, HotRule
from tillroll.plans.incremental import INGESTION, GoldSpec, build_gold, merge_newest, read_silver
from tillroll.plans.publish import Check, publish
from tillroll.session import cut_lineage
from tillroll.sources.partitions import path_exists
from tillroll.sources.readers import read_files

#: The partition column; it follows from the touched date, which stays in the files.
PARTITION = "gold_partition"
#: A run that touches more dates merges all of gold instead of naming them.
MOST_TOUCHED = 5_000


def partition_of(touched: Column) -> Column:
    """Text that no reader takes for a number, a date or a missing value."""
    return F.coalesce(F.concat(F.lit("v"), touched.cast("string")), F.lit("none"))


def read_gold(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return read_files(spark, path, fmt).drop(PARTITION)


def gold_rows(
    spark: SparkSession, path: str, schema: T.StructType, names: Sequence[str] | None, fmt: str = "parquet"
) -> DataFrame:
    """Stored gold, of the named partitions if names are given."""
    stored = read_files(spark, path, fmt, schema=T.StructType([*schema.fields, T.StructField(PARTITION, T.StringType())]))
    return (stored if names is None else stored.where(F.col(PARTITION).isin(list(names)))).drop(PARTITION)


def merge_into_gold(
    spark: SparkSession,
    silver: DataFrame,
    spec: GoldSpec,
    asof: dt.date,
    path: str,
    checks: Sequence[Check] = (),
    rule: HotRule | None = DEFAULT_RULE,
    most_touched: int = MOST_TOUCHED,
    fmt: str = "parquet",
) -> list[str] | None:
    """Merge a silver snapshot into the gold at ``path``; the first run makes it.

    Gives the names of the partitions replaced, None for all. Gold must be what this
    function wrote; the result is then that of ``build_gold`` on the whole of it. Rows
    without an ingestion date never survive a merge and touch nothing. ``checks`` see
    the partitions to be replaced; if one fails, gold stays as it was.
    """
    if spec.touched_by not in spec.keys:
        raise ValueError("gold is partitioned by a date that is part of its key")
    if not path_exists(spark, path):
        _publish(build_gold(silver, spec, asof, rule=rule), spec, path, checks, fmt)
        return None
    fresh = cut_lineage(read_silver(silver, spec, asof, full_load=False).where(F.col(INGESTION).isNotNull()))
    touched = fresh.select(partition_of(F.col(spec.touched_by)).alias("p")).distinct().limit(most_touched + 1).collect()
    if not touched:
        return []
    names = sorted(r.p for r in touched) if len(touched) <= most_touched else None
    gold = gold_rows(spark, path, fresh.schema, names, fmt)
    _publish(merge_newest(gold, fresh, spec, rule), spec, path, checks, fmt)
    return names


def _publish(rows: DataFrame, spec: GoldSpec, path: str, checks: Sequence[Check], fmt: str) -> None:
    named = rows.withColumn(PARTITION, partition_of(F.col(spec.touched_by)))
    publish(named, path, checks, (PARTITION,), fmt)
