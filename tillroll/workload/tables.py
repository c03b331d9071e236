"""The given tables, and SQL pieces the equivalent queries share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


#: Session setting of the benchmark and the tests, whose files have one split each:
#: scans that feed costly text work are dealt out to so many tasks. Unset elsewhere.
SPREAD = "spark.tillroll.spread.scans"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    tasks = df.sparkSession.conf.get(SPREAD, None)
    return df.repartition(int(tasks)) if tasks else df


def dec(x: str) -> str:
    """Text with a decimal comma -> decimal(38,6)."""
    return f"try_cast(replace(coalesce({x}, '0'), ',', '.') as decimal(38,6))"


def big(x: str) -> str:
    return f"coalesce(try_cast(trunc(try_cast(trim({x}) as decimal(38,6))) as bigint), 0)"


def upper_or(x: str) -> str:
    return f"upper(coalesce({x}, 'NAO INFORMADO'))"


def day(x: str, fmt: str) -> str:
    return f"cast(try_strptime({x}, '{fmt}') as date)"


def comma(x: str) -> str:
    """A double as text with a decimal comma."""
    return f"replace(cast(cast({x} as decimal(18,2)) as varchar), '.', ',')"
