"""Column builders for text feeds.

Every raw feed column is text. The builders here never raise on bad text: they
give NULL or the stated default, and the same value with ANSI mode on or off.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values -------------------------------------------------------------
NOT_INFORMED = "NAO INFORMADO"
MEASURE = T.DecimalType(38, 6)
DEFAULT_DAY_COMPACT = "19000101"
DEFAULT_DAY_SLASHED = "01/01/1900"
DEFAULT_DAY_ISO = "1900-01-01"
MULTIPLIER_MARK = " X "
# ---------------------------------------------------------------------------


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def locale_decimal(c: Column | str, to: T.DecimalType = MEASURE) -> Column:
    """``'1,5'`` -> 1.500000; NULL -> 0; text that is no number -> NULL."""
    text = F.coalesce(as_column(c), F.lit("0"))
    return F.translate(text, ",", ".").try_cast(to)


def bigint_or_zero(c: Column | str) -> Column:
    """Numeric code as bigint, 0 when absent or unreadable.

    The hop through a decimal keeps codes exported as ``'7891991002608.0'``.
    """
    number = F.trim(as_column(c)).try_cast(MEASURE)
    return F.coalesce(number.try_cast(T.LongType()), F.lit(0).cast(T.LongType()))


def text_or_default(c: Column | str, default: str = NOT_INFORMED) -> Column:
    return F.upper(F.coalesce(as_column(c), F.lit(default)))


def day_compact(c: Column | str) -> Column:
    """``yyyyMMdd`` with or without dashes; NULL -> 1900-01-01; junk -> NULL."""
    text = F.trim(F.translate(as_column(c), "-", ""))
    return F.try_to_date(F.coalesce(text, F.lit(DEFAULT_DAY_COMPACT)), "yyyyMMdd")


def day_slashed_or_default(c: Column | str) -> Column:
    """``dd/MM/yyyy``; NULL -> 1900-01-01; junk -> NULL."""
    text = F.coalesce(F.trim(as_column(c)), F.lit(DEFAULT_DAY_SLASHED))
    return F.try_to_date(text, "d/M/yyyy")


def day_slashed(c: Column | str) -> Column:
    """``dd/MM/yyyy``, else NULL."""
    return F.try_to_date(as_column(c), "d/M/yyyy")


def day_any_format(c: Column | str) -> Column:
    """ISO or slashed, else 1900-01-01. Always a date.

    The slash decides the format, so a row is parsed once: a failed parse costs
    far more than a successful one.
    """
    text = F.substring_index(F.trim(as_column(c)), " ", 1)
    parsed = F.when(text.contains("/"), F.try_to_date(text, "d/M/yyyy")).otherwise(
        F.try_to_date(text, "yyyy-M-d")
    )
    return F.coalesce(parsed, F.lit(DEFAULT_DAY_ISO).cast("date"))


def day_text(c: Column | str, fmt: str) -> Column:
    """A date read with one stated format, NULL when it does not fit."""
    return F.try_to_date(as_column(c), fmt)


def ingestion_day(
    year: Column | str = "year", month: Column | str = "month", day: Column | str = "day"
) -> Column:
    """Date of an ingestion partition; an impossible day gives NULL."""
    parts = [as_column(p).cast("string") for p in (year, month, day)]
    return F.try_to_date(F.concat_ws("-", *parts), "yyyy-M-d")


def yes_no(condition: Column) -> Column:
    return F.when(condition, F.lit("S")).otherwise(F.lit("N"))


def equals_upper(c: Column | str, value: str) -> Column:
    return F.upper(as_column(c)) == F.lit(value)


def relabel(c: Column | str, labels: dict[str, str]) -> Column:
    """Upper-case text with some values renamed."""
    upper = F.upper(as_column(c))
    out = upper
    for old, new in labels.items():
        out = F.when(upper == F.lit(old), F.lit(new)).otherwise(out)
    return out


def multiplier_part(c: Column | str, index: int) -> Column:
    """One side of ``'12 X 2'``; NULL when that side is absent."""
    return F.get(F.split(as_column(c), MULTIPLIER_MARK), index).try_cast(MEASURE)


def per_pack(value: Column, boxes: Column, packs: Column) -> Column:
    """Units -> packs; NULL when the multiplier is absent or zero."""
    units = F.try_multiply(boxes, packs).try_cast(MEASURE)
    return F.try_divide(value, units).try_cast(MEASURE)


def fill_when(c: Column | str, condition: Column, value: object) -> Column:
    """NULL -> ``value`` only where ``condition`` holds."""
    target = as_column(c)
    return F.when(condition & target.isNull(), F.lit(value)).otherwise(target)


def single_space(c: Column | str) -> Column:
    return F.trim(F.regexp_replace(as_column(c), " +", " "))


def safe_cast(c: Column | str, to: T.DataType | str) -> Column:
    return as_column(c).try_cast(to)


def nan_text_to_null(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The text ``NaN`` becomes NULL in every text column not in ``keep``."""
    keep_lower = {k.lower() for k in keep}
    out = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType) and field.name.lower() not in keep_lower:
            c = F.nullif(c, F.lit("NaN")).alias(field.name)
        out.append(c)
    return df.select(*out)


def equal_flags(left: str, right: str, columns: list[str]) -> list[Column]:
    """One null-safe boolean per column of two aliased frames."""
    return [
        F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")).alias(f"{c}_equal") for c in columns
    ]
