"""Counts, control totals and comparisons of lakehouse layers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.parse import MEASURE, as_column, equal_flags
from tillroll.operators.dedup import first_per_key, with_known_keys
from tillroll.operators.skew import same_key
from tillroll.operators.sketch import column_sketches, estimated_profile


def count_by(df: DataFrame, name: str = "n_rows", **keys: Column | str) -> DataFrame:
    """Row count per partition, business date, source file or any expression."""
    return df.groupBy(*[as_column(c).alias(k) for k, c in keys.items()]).agg(
        F.count(F.lit(1)).alias(name)
    )


def range_profile(
    df: DataFrame, value: Column | str, sums: dict[str, Column | str] | None = None
) -> DataFrame:
    """Least and greatest value, row count and optional sums of a whole table."""
    return df.agg(*_profile(value, sums))


def range_profile_by(
    df: DataFrame,
    keys: list[str],
    value: Column | str,
    sums: dict[str, Column | str] | None = None,
) -> DataFrame:
    return df.groupBy(*keys).agg(*_profile(value, sums))


def _profile(value: Column | str, sums: dict[str, Column | str] | None) -> list[Column]:
    v = as_column(value)
    totals = [F.try_sum(as_column(c)).alias(name) for name, c in (sums or {}).items()]
    return [
        F.min(v).alias("min_value"),
        F.max(v).alias("max_value"),
        F.count(F.lit(1)).alias("n_rows"),
        *totals,
    ]


def control_totals(
    df: DataFrame, keys: dict[str, Column | str], sums: dict[str, Column | str]
) -> DataFrame:
    """Row count and sums per key expression."""
    totals = [F.try_sum(as_column(c)).alias(name) for name, c in sums.items()]
    return df.groupBy(*[as_column(c).alias(k) for k, c in keys.items()]).agg(
        F.count(F.lit(1)).alias("n_rows"), *totals
    )


def share_of_total(df: DataFrame, key: str) -> DataFrame:
    """Rows per key next to the row count of the whole table.

    The total is a scalar subquery that reads no column.
    """
    total = df.agg(F.count(F.lit(1)))
    return count_by(df, **{key: key}).select("*", total.scalar().alias("n_rows_total"))


def distinct_values(df: DataFrame, **columns: Column | str) -> DataFrame:
    return df.select(*[as_column(c).alias(k) for k, c in columns.items()]).distinct()


def newest_values(df: DataFrame, value: Column | str, n: int, name: str = "value") -> DataFrame:
    """The ``n`` greatest distinct values, such as the last ingestion dates."""
    values = distinct_values(df, **{name: value}).where(F.col(name).isNotNull())
    return values.orderBy(F.col(name).desc()).limit(n)


def listing(df: DataFrame, *order: Column | str, n: int | None = None) -> DataFrame:
    """Rows in a stated order, at most ``n`` of them when ``n`` is given."""
    ordered = df.orderBy(*[as_column(c) for c in order])
    return ordered if n is None else ordered.limit(n)


def reconcile(
    source: DataFrame,
    target: DataFrame,
    keys: dict[str, Column | str],
    sums: dict[str, Column | str],
) -> DataFrame:
    """Counts and totals of two layers side by side, with their differences.

    Both sides are aggregated before they meet, so the join sees one row per
    key and side. A side without the key counts as zero.
    """
    measures = ["n_rows", *sums]
    left = control_totals(source, keys, sums).withColumnsRenamed(
        {m: f"source_{m}" for m in measures}
    )
    right = control_totals(target, keys, sums).withColumnsRenamed(
        {m: f"target_{m}" for m in measures}
    )
    right = right.withColumnsRenamed({k: f"{k}__t" for k in keys})
    joined = left.join(right, same_key(list(keys), "__t"), "full_outer")
    out = [F.coalesce(F.col(k), F.col(f"{k}__t")).alias(k) for k in keys]
    for m in measures:
        s = F.coalesce(F.col(f"source_{m}"), F.lit(0))
        t = F.coalesce(F.col(f"target_{m}"), F.lit(0))
        out += [s.alias(f"source_{m}"), t.alias(f"target_{m}")]
        difference = F.try_subtract(s, t)
        if m != "n_rows":
            difference = difference.try_cast(MEASURE)
        out.append(difference.alias(f"difference_{m}"))
    return joined.select(*out)


def missing_days(df: DataFrame, day: Column | str, name: str = "missing_day") -> DataFrame:
    """Calendar days between the first and last one that have no row."""
    days = distinct_values(df, **{name: day}).where(F.col(name).isNotNull())
    calendar = days.agg(F.min(name).alias("_first"), F.max(name).alias("_last")).select(
        F.explode(F.sequence("_first", "_last")).alias(name)
    )
    return calendar.join(days, name, "left_anti")


def column_profile(df: DataFrame, exact: bool = True) -> DataFrame:
    """Type, NULL count and distinct count of every column.

    ``exact=False`` estimates the distinct counts from mergeable sketches (standard
    error 1.6 %, see ``sketch``): one row for each column and task is shuffled instead
    of the distinct values. An empty table then has no row, as here.

    The columns are turned into rows and counted per value first, so a value
    that fills a column is one row before the shuffle; no column is gathered in
    one place, as several distinct counts in one aggregate would do.
    """
    if not exact:
        return estimated_profile(column_sketches(df))
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.lit(kind).alias("kind"), _as_text(c, df))
            for c, kind in kinds.items()
        ]
    )
    per_value = (
        df.select(F.explode(cells).alias("cell"))
        .groupBy("cell.column", "cell.kind", "cell.value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return per_value.groupBy("column", "kind").agg(
        F.sum("n").alias("n_rows"),
        F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("n_nulls"),
        F.count("value").alias("n_distinct"),
    )


def _as_text(column: str, df: DataFrame) -> Column:
    c = F.col(f"`{column}`")
    kind = df.schema[column].dataType
    simple = not isinstance(kind, (T.ArrayType, T.StructType, T.MapType))
    return (c.cast("string") if simple else F.to_json(c)).alias("value")


def row_differences(
    left: DataFrame, right: DataFrame, keys: list[str], columns: list[str]
) -> DataFrame:
    """One row per key and column whose values differ between two snapshots.

    Each side is cut to one row per known key, which also partitions it for the
    join: no side is shuffled twice.
    """
    a = first_per_key(with_known_keys(left.select(*keys, *columns), keys), keys)
    b = first_per_key(with_known_keys(right.select(*keys, *columns), keys), keys)
    a = a.withColumn("_l", F.lit(True))
    b = b.withColumnsRenamed({c: f"{c}__r" for c in columns}).withColumn("_r", F.lit(True))
    pair = a.join(b, keys, "full_outer")
    sides = (
        F.when(F.col("_r").isNull(), F.lit("left"))
        .when(F.col("_l").isNull(), F.lit("right"))
        .otherwise(F.lit("both"))
    )
    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(c).cast("string").alias("left_value"),
                F.col(f"{c}__r").cast("string").alias("right_value"),
                F.col(c).eqNullSafe(F.col(f"{c}__r")).alias("same"),
            )
            for c in columns
        ]
    )
    return (
        pair.select(
            *keys,
            sides.alias("found_in"),
            F.explode(F.filter(cells, lambda x: ~x["same"])).alias("cell"),
        )
        .select(*keys, "found_in", "cell.column_name", "cell.left_value", "cell.right_value")
    )


def row_equality(
    left: DataFrame, right: DataFrame, keys: list[str], columns: list[str]
) -> DataFrame:
    """One boolean per column for the rows both snapshots have."""
    a = first_per_key(left.select(*keys, *columns), keys).alias("a")
    b = first_per_key(right.select(*keys, *columns), keys).alias("b")
    same = reduce(lambda x, y: x & y, [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys])
    return a.join(b, same, "inner").select(
        *[F.col(f"a.{k}") for k in keys], *equal_flags("a", "b", columns)
    )


def match_rate(df: DataFrame, label: str = "PRODUCT_MATCH_TYPE") -> DataFrame:
    return count_by(df, **{label: label})

