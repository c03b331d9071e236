"""History files -> partitioned lakehouse tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.parse import day_text
from tillroll.operators import filters as keep
from tillroll.operators.audit import range_profile
from tillroll.operators.dedup import distinct_rows
from tillroll.operators.shape import (
    INGESTION_PARTITION,
    drop_audit_columns,
    drop_columns,
    lower_names,
    with_day_parts,
    with_half_month_parts,
)
from tillroll.session import cut_lineage
from tillroll.sources.readers import read_files, read_years
from tillroll.sources.writers import append_partitioned, overwrite_partitions


@dataclass(frozen=True)
class BackfillSpec:
    """One history source.

    ``day`` is the date the partition comes from; without it the partition
    columns are already there. ``extra_drop`` names columns only this source
    must lose.
    """

    keep: Callable[[DataFrame], DataFrame] = lambda df: df
    day: Callable[[], Column] | None = None
    half_months: bool = False
    lower: bool = False
    whole_row_distinct: bool = False
    partition: tuple[str, ...] = INGESTION_PARTITION
    replace: bool = False
    merge_schema: bool = False
    extra_drop: tuple[str, ...] = ()


def shape_history(history: DataFrame, spec: BackfillSpec) -> DataFrame:
    """Filter, add partition columns, drop audit columns, name style."""
    rows = spec.keep(history)
    if spec.whole_row_distinct:
        rows = distinct_rows(drop_columns(rows, ("filename",)))
    if spec.day is not None:
        day = spec.day()
        rows = (
            with_half_month_parts(rows, day)
            if spec.half_months
            else with_day_parts(rows, day, INGESTION_PARTITION)
        )
    rows = drop_columns(drop_audit_columns(rows), spec.extra_drop)
    return lower_names(rows) if spec.lower else rows


def validate_history(history: DataFrame, day: Column) -> DataFrame:
    return range_profile(history, day)


def write_history(rows: DataFrame, spec: BackfillSpec, *paths: str) -> None:
    """Append to, or replace partitions of, each layer; rows are computed once."""
    if len(paths) > 1:
        rows = cut_lineage(rows)
    for path in paths:
        if spec.replace:
            overwrite_partitions(rows, path, spec.partition)
        else:
            append_partitioned(rows, path, spec.partition)


def backfill(
    spark: SparkSession, source: str | list[str], spec: BackfillSpec, *paths: str, fmt: str = "parquet"
) -> DataFrame:
    """Read one tree, or one glob per year, and write it; gives the rows written."""
    if isinstance(source, str):
        history = read_files(spark, source, fmt, spec.merge_schema)
    else:
        history = read_years(spark, source, fmt, spec.merge_schema)
    rows = shape_history(history, spec)
    write_history(rows, spec, *paths)
    return rows


def before(column: str, cut: dt.date, fmt: str = "dd/MM/yyyy") -> Callable[[DataFrame], DataFrame]:
    return lambda df: keep.before_day(df, column, fmt, cut)


def current_before(cut: dt.date) -> Callable[[DataFrame], DataFrame]:
    """Current rows created before ``cut``, the day read as ``created`` reads it."""
    return lambda df: keep.current_version(df.where(created() < F.lit(cut)))


def up_to_year(column: str, year: int, fmt: str) -> Callable[[DataFrame], DataFrame]:
    return lambda df: keep.up_to_year(df, day_text(column, fmt), year)


def created() -> Column:
    """Day a history row was created; the text may carry a time."""
    return day_text(F.substring("createdDate", 1, 10), "yyyy-MM-dd")


# The history sources. Dates and columns are fixed values. ---------------------
ISO, SLASHED = "yyyy-MM-dd", "dd/MM/yyyy"

HISTORIES = {
    "sales_by_day_2024_07_04": BackfillSpec(
        keep=before("data", dt.date(2024, 7, 4), SLASHED), day=created, lower=True, merge_schema=True
    ),
    "stock_by_day_2024_05_13": BackfillSpec(
        keep=before("data", dt.date(2024, 5, 13), SLASHED), day=created, lower=True, merge_schema=True
    ),
    "sales_by_day_2024_07_08": BackfillSpec(
        keep=before("data", dt.date(2024, 7, 8), SLASHED), day=created, lower=True
    ),
    "sales_by_day_2024_08_20": BackfillSpec(
        keep=before("data_venda", dt.date(2024, 8, 20), SLASHED), day=created
    ),
    "current_sales_2024_09_19": BackfillSpec(
        keep=current_before(dt.date(2024, 9, 19)), day=created, lower=True
    ),
    "current_stock_2024_09_19": BackfillSpec(
        keep=current_before(dt.date(2024, 9, 19)), day=created,
        extra_drop=("DATA",),
    ),
    "created_day": BackfillSpec(day=created),
    "fact_by_business_day": BackfillSpec(
        partition=("ano_partition", "mes_partition", "dia_partition"), replace=True
    ),
    "current_catalogue": BackfillSpec(keep=keep.current_version, partition=()),
    "half_months": BackfillSpec(
        keep=up_to_year("DATA", 2023, ISO), day=lambda: day_text("DATA", ISO), half_months=True,
        whole_row_distinct=True, replace=True, merge_schema=True,
    ),
    "created_up_to_2023": BackfillSpec(
        keep=up_to_year("DATA", 2023, ISO), day=created, replace=True
    ),
}
