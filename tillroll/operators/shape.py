"""Projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.parse import as_column

# Fixed values -------------------------------------------------------------
AUDIT_COLUMNS = ("filename", "createdDate", "updatedDate", "lastReceived")
INGESTION_PARTITION = ("year", "month", "day")
BUSINESS_PARTITION = ("ano_partition", "mes_partition", "dia_partition")
# ---------------------------------------------------------------------------


def drop_columns(df: DataFrame, columns: list[str] | tuple[str, ...]) -> DataFrame:
    """Drop columns; names that are absent are ignored."""
    return df.drop(*columns)


def drop_audit_columns(df: DataFrame) -> DataFrame:
    return drop_columns(df, AUDIT_COLUMNS)


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def upper_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().upper() for c in df.columns])


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().lower() for c in df.columns])


def pick(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*columns)


def all_except(df: DataFrame, columns: list[str] | tuple[str, ...]) -> DataFrame:
    gone = {c.lower() for c in columns}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in gone])


def with_constants(df: DataFrame, values: dict[str, object]) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def with_typed_nulls(df: DataFrame, types: dict[str, T.DataType]) -> DataFrame:
    return df.withColumns({name: F.lit(None).cast(kind) for name, kind in types.items()})


def with_row_id(df: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """Surrogate id from the row's own key, so a rerun gives the same id.

    A NULL is part of the key: the place it stands in counts.
    """
    key = F.to_json(F.struct(*[F.col(f"`{k}`") for k in keys]), {"ignoreNullFields": "false"})
    return df.withColumn(name, F.sha2(key, 256))


def keep_original(df: DataFrame, column: str, suffix: str = "_ORIGINAL") -> DataFrame:
    return df.withColumn(f"{column}{suffix}", F.col(column))


def with_day_parts(
    df: DataFrame, day: Column | str, names: tuple[str, str, str] = BUSINESS_PARTITION
) -> DataFrame:
    d = as_column(day)
    return df.withColumns(
        {names[0]: F.year(d), names[1]: F.month(d), names[2]: F.dayofmonth(d)}
    )


def half_month(day: Column | str) -> Column:
    """1 for days 1-15, 16 for the rest."""
    return F.when(F.dayofmonth(as_column(day)) < 16, F.lit(1)).otherwise(F.lit(16))


def with_half_month_parts(df: DataFrame, day: Column | str) -> DataFrame:
    """Ingestion partition with two buckets per month."""
    d = as_column(day)
    year, month, part = INGESTION_PARTITION
    return df.withColumns({year: F.year(d), month: F.month(d), part: half_month(d)})
