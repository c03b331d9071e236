"""Row selection. Dates come in as parameters, never from the clock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.parse import as_column, bigint_or_zero, day_text, locale_decimal


def known_code(df: DataFrame, column: str) -> DataFrame:
    """Drop rows whose code is absent, unreadable or the sentinel 0."""
    return df.where(bigint_or_zero(column) != 0)


def before_day(df: DataFrame, column: str, fmt: str, cut: dt.date) -> DataFrame:
    """Backfill cut-off: strictly before ``cut``."""
    return df.where(day_text(column, fmt) < F.lit(cut))


def current_version(df: DataFrame, column: str = "updatedDate") -> DataFrame:
    """Rows that were never superseded carry an empty update date."""
    return df.where(F.col(column) == "")


def rolling_window(
    df: DataFrame, column: str, asof: dt.date, window_days: int | None = 60
) -> DataFrame:
    """Last ``window_days`` up to ``asof``; everything on the 1st of a month."""
    if window_days is None or asof.day == 1:
        return df
    first = asof - dt.timedelta(days=window_days)
    return df.where(F.col(column).between(F.lit(first), F.lit(asof)))


def ingested_since(df: DataFrame, ingestion: Column | str, asof: dt.date, days: int) -> DataFrame:
    """Ingestion look-back. Apply it on the scan so partitions are pruned."""
    return df.where(as_column(ingestion) >= F.lit(asof - dt.timedelta(days=days)))


def last_ingestions(df: DataFrame, ingestion: str, n: int = 4) -> DataFrame:
    """Rows of the ``n`` newest distinct ingestion dates.

    The date list has at most ``n`` rows, so broadcasting it is bounded.
    """
    newest = (
        df.select(ingestion)
        .where(F.col(ingestion).isNotNull())
        .distinct()
        .orderBy(F.col(ingestion).desc())
        .limit(n)
    )
    return df.join(F.broadcast(newest), ingestion, "left_semi")


def without_header_rows(df: DataFrame, column: str, header: str) -> DataFrame:
    """Drop header lines repeated inside the data, and NULL with them."""
    return df.where(F.col(column) != header)


def sold_or_stocked(df: DataFrame, sold: str, stock: str) -> DataFrame:
    """Sale above zero, or stock at or above zero, compared as numbers."""
    return df.where((locale_decimal(sold) > 0) | (locale_decimal(stock) >= 0))


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull())


def is_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def equals(df: DataFrame, column: str, value: object) -> DataFrame:
    return df.where(F.col(column) == F.lit(value))


def differs(df: DataFrame, column: str, value: object) -> DataFrame:
    return df.where(F.col(column) != F.lit(value))


def point_lookup(df: DataFrame, key: dict[str, object]) -> DataFrame:
    """Rows of one composite key; each test is pushed to the scan."""
    for column, value in key.items():
        df = equals(df, column, value)
    return df


def between_days(df: DataFrame, day: Column | str, first: dt.date, last: dt.date) -> DataFrame:
    return df.where(as_column(day).between(F.lit(first), F.lit(last)))


def up_to_year(df: DataFrame, day: Column | str, year: int) -> DataFrame:
    return df.where(F.year(as_column(day)) <= F.lit(year))


def like_upper(c: Column | str, pattern: str) -> Column:
    return F.upper(as_column(c)).like(pattern)


def complete_rows(df: DataFrame, may_be_null: tuple[str, ...] = ()) -> DataFrame:
    """Drop rows with a NULL outside ``may_be_null``."""
    return df.dropna(subset=[c for c in df.columns if c not in may_be_null])
