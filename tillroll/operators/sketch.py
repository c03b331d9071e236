"""Column profiles as mergeable sketches.

A profile of any split of a table is one small row for each column: row and NULL counts
and a HyperLogLog sketch of the values. Profiles of splits merge into that of the whole,
so a stored profile of every partition answers for any set of them, and a table that
gains a partition is not read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: 2**12 registers: a standard error of 1.6 % in 4 KB a column.
LG_REGISTERS = 12
#: Tasks' sketches are first merged in so many groups, then to one.
SLOTS = 64

_NUMBERS = (T.IntegerType, T.LongType)
_NESTED = (T.ArrayType, T.StructType, T.MapType)


def standard_error(lg_registers: int = LG_REGISTERS) -> float:
    """The relative standard error of an estimate; small counts are exact."""
    return 1.04 / 2 ** (lg_registers / 2)


def _sketchable(field: T.StructField) -> Column:
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, _NUMBERS):
        return c
    if isinstance(field.dataType, T.BinaryType):
        return F.when(c.isNotNull(), F.xxhash64(c))
    text = F.to_json(c) if isinstance(field.dataType, _NESTED) else c.cast("string")
    # The sketch passes over empty texts.
    return F.concat(F.lit("="), text)


def column_sketches(df: DataFrame, by: dict[str, Column] | None = None, lg_registers: int = LG_REGISTERS) -> DataFrame:
    """(``by``, column, kind, n_rows, n_nulls, sketch): a row for each column of ``df`` and
    each value of ``by``; without ``by`` one for each column.

    One aggregate over one scan: a task sends a row for each group, not for each cell.
    """
    if by:
        return _sketches_by(df, by, lg_registers)
    slot = F.pmod(F.spark_partition_id(), F.lit(SLOTS))
    return merge_sketches(_sketches_by(df, {"_slot": slot}, lg_registers))


def _sketches_by(df: DataFrame, by: dict[str, Column], lg_registers: int) -> DataFrame:
    aggregates = [F.count(F.lit(1)).alias("_n")]
    for i, field in enumerate(df.schema.fields):
        aggregates.append(F.count(F.col(f"`{field.name}`")).alias(f"_c{i}"))
        aggregates.append(F.hll_sketch_agg(_sketchable(field), lg_registers).alias(f"_s{i}"))
    wide = df.groupBy(*[c.alias(name) for name, c in by.items()]).agg(*aggregates)
    cells = [
        F.struct(
            F.lit(field.name).alias("column"),
            F.lit(field.dataType.simpleString()).alias("kind"),
            F.col("_n").alias("n_rows"),
            (F.col("_n") - F.col(f"_c{i}")).alias("n_nulls"),
            F.col(f"_s{i}").alias("sketch"),
        )
        for i, field in enumerate(df.schema.fields)
    ]
    return wide.select(*by, F.inline(F.array(*cells)))


def merge_sketches(profiles: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Profiles of disjoint splits as one, for each value of ``by``."""
    return profiles.groupBy(*by, "column", "kind").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_nulls").alias("n_nulls"), F.hll_union_agg("sketch").alias("sketch")
    )


def estimated_profile(profiles: DataFrame) -> DataFrame:
    """The profile in numbers: ``n_distinct`` is estimated from the sketch."""
    rest = [c for c in profiles.columns if c != "sketch"]
    return profiles.select(*rest, F.hll_sketch_estimate("sketch").alias("n_distinct"))
