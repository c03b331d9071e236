"""Reads. Every reader gives a lazy frame and states what it needs."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_required_table(spark: SparkSession, name: str) -> DataFrame:
    """The table, or an error when it is absent or has no row.

    Emptiness is one task's look at the first row, not a full count.
    """
    if not spark.catalog.tableExists(name):
        raise FileNotFoundError(f"table {name} was not found")
    df = spark.table(name)
    if df.isEmpty():
        raise ValueError(f"table {name} is empty")
    return df


def read_files(
    spark: SparkSession,
    paths: str | list[str],
    fmt: str = "parquet",
    merge_schema: bool = False,
    schema: T.StructType | None = None,
) -> DataFrame:
    """One or more paths or globs of one format.

    Give a schema on large trees: merging reads the footer of every file.
    """
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    elif merge_schema:
        reader = reader.option("mergeSchema", True)
    return reader.load(paths)


def read_zone(spark: SparkSession, root: str, country: str, path: str, fmt: str = "parquet") -> DataFrame:
    return read_files(spark, f"{root.rstrip('/')}/{country}/{path.strip('/')}", fmt)


def read_path_sql(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """``SELECT * FROM fmt.`path```."""
    return spark.sql(f"SELECT * FROM {fmt}.`{path}`")


def read_years(
    spark: SparkSession, globs: list[str], fmt: str = "parquet", merge_schema: bool = True
) -> DataFrame:
    """Yearly loads with drifting columns: columns meet by name, gaps are NULL."""
    frames = [read_files(spark, g, fmt, merge_schema) for g in globs]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


#: Names the columns of a row whose value did not fit the declared type.
MISFITS = "misfits"


def read_years_as(
    spark: SparkSession,
    globs: list[str],
    schema: T.StructType,
    fmt: str = "parquet",
    from_text: Mapping[str, Callable[[Column], Column]] | None = None,
) -> DataFrame:
    """Yearly loads whose types drift, as the declared ``schema`` and a column ``misfits``.

    Every glob is read with a schema of its own and cast column by column, so nothing is
    left to a common type that the years happen to have. A column a year lacks is NULL,
    one that is not declared is left out (``undeclared_columns`` tells). ``from_text``
    gives columns a parser for years that hold them as text. A value that is there but
    does not fit becomes NULL and its column's name is in ``misfits``.
    """
    return reduce(
        lambda a, b: a.unionByName(b),
        [_declared(read_files(spark, g, fmt, merge_schema=True), schema, from_text or {}) for g in globs],
    )


def _declared(
    df: DataFrame, schema: T.StructType, from_text: Mapping[str, Callable[[Column], Column]]
) -> DataFrame:
    held = {f.name.lower(): f for f in df.schema.fields}
    out, misfits = [], []
    for wanted in schema.fields:
        field = held.get(wanted.name.lower())
        if field is None:
            out.append(F.lit(None).cast(wanted.dataType).alias(wanted.name))
            continue
        raw = F.col(f"`{field.name}`")
        parse = from_text.get(wanted.name) if isinstance(field.dataType, T.StringType) else None
        fitted = (parse(raw) if parse else raw).try_cast(wanted.dataType)
        out.append(fitted.alias(wanted.name))
        misfits.append(F.when(raw.isNotNull() & fitted.isNull(), F.lit(wanted.name)))
    none = F.array().cast("array<string>")
    return df.select(*out, (F.array_compact(F.array(*misfits)) if misfits else none).alias(MISFITS))


def count_misfits(rows: DataFrame) -> DataFrame:
    """(column, n_rows): how many values of each column did not fit; none: no row."""
    return rows.select(F.explode(MISFITS).alias("column")).groupBy("column").agg(F.count(F.lit(1)).alias("n_rows"))


def undeclared_columns(spark: SparkSession, globs: list[str], schema: T.StructType, fmt: str = "parquet") -> dict[str, list[str]]:
    """For each glob the columns its files have and ``schema`` has not."""
    declared = {f.name.lower() for f in schema.fields}
    held = {g: read_files(spark, g, fmt, merge_schema=True).columns for g in globs}
    return {g: out for g, columns in held.items() if (out := [c for c in columns if c.lower() not in declared])}


def inline_rows(spark: SparkSession, rows: list, columns: list[str] | T.StructType | str) -> DataFrame:
    return spark.createDataFrame(rows, columns)


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df
