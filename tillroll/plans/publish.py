"""Staged publishing: a load is written aside, checked as written, then swapped in.

The target changes only in the last step, Spark's commit of a partition overwrite, so a
failed check or a lost job leaves it as it was.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.operators import audit, dedup
from tillroll.operators.shape import BUSINESS_PARTITION
from tillroll.session import remove_path, scratch_path
from tillroll.sources.readers import read_files
from tillroll.sources.writers import overwrite_partitions


@dataclass(frozen=True)
class Check:
    """``faults`` gives the rows that show a load to be wrong; none: it passes."""

    name: str
    faults: Callable[[DataFrame], DataFrame]


class CheckFailed(Exception):
    """Which checks a load failed, and how many faults each found."""

    def __init__(self, failed: dict[str, int]) -> None:
        super().__init__(", ".join(f"{name}: {n} faults" for name, n in failed.items()))
        self.failed = failed


def no_duplicates(keys: Sequence[str]) -> Check:
    return Check(f"one row for each of {', '.join(keys)}", lambda df: dedup.duplicate_keys(df, list(keys)))


def no_nulls(*columns: str) -> Check:
    def faults(df: DataFrame) -> DataFrame:
        missing = F.lit(False)
        for c in columns:
            missing = missing | F.col(c).isNull()
        return df.where(missing).select(*columns)

    return Check(f"no null in {', '.join(columns)}", faults)


def no_missing_days(day: Column | str) -> Check:
    return Check("no day missing", lambda df: audit.missing_days(df, day))


def same_totals(
    source: DataFrame, keys: dict[str, Column | str], sums: dict[str, Column | str]
) -> Check:
    """Row counts and sums for each key as in ``source``, which has the same columns."""
    def faults(df: DataFrame) -> DataFrame:
        both = audit.reconcile(source, df, keys, sums)
        differs = F.lit(False)
        for m in ("n_rows", *sums):
            differs = differs | ~F.col(f"difference_{m}").eqNullSafe(F.lit(0))
        return both.where(differs)

    return Check("totals as in the source", faults)


def at_least(n_rows: int) -> Check:
    """A load that came in short."""
    return Check(
        f"{n_rows} rows or more",
        lambda df: df.agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") < n_rows),
    )


def publish(
    rows: DataFrame,
    path: str,
    checks: Sequence[Check] = (),
    partition: tuple[str, ...] = BUSINESS_PARTITION,
    fmt: str = "parquet",
) -> None:
    """Replace the partitions of ``path`` that ``rows`` has, once all checks pass.

    Raises ``CheckFailed`` with every failed check, and leaves ``path`` untouched. Checks
    read the staged files, so they see what would be published, and the rows are computed
    once. The staged copy is removed either way; ``rows`` may be read from ``path``.
    """
    spark = rows.sparkSession
    staging = scratch_path(spark, "staging")
    try:
        overwrite_partitions(rows, staging, partition, fmt)
        staged = read_files(spark, staging, fmt, schema=rows.schema)
        found = {c.name: c.faults(staged).count() for c in checks}
        if failed := {name: n for name, n in found.items() if n}:
            raise CheckFailed(failed)
        overwrite_partitions(staged, path, partition, fmt)
    finally:
        remove_path(spark, staging)
