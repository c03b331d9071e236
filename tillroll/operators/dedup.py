"""Newest version, one row per key, duplicate detection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.operators.skew import DEFAULT_RULE, HotRule, key_hash, same_key, split_hot
from tillroll.session import cut_lineage

# Hashes of repeated keys up to this many are broadcast.
MOST_REPEATED = 1_000_000


def total_order(df: DataFrame, first: list[Column], keys: list[str]) -> list[Column]:
    """``first``, then every orderable column not in ``keys``: no ties left."""
    rest = [c for c in df.columns if c not in keys]
    return [*first, *[F.col(f"`{c}`").asc_nulls_first() for c in rest]]


def first_per_key(
    df: DataFrame, keys: list[str], order: list[Column] | None = None
) -> DataFrame:
    """One row per key, the first under a total order.

    ``row_number = 1`` is cut to one row per key and task before the shuffle,
    so a key with very many rows costs no more than any other.
    """
    ordering = total_order(df, order or [], keys)
    if not ordering:
        return df.dropDuplicates()
    w = Window.partitionBy(*keys).orderBy(*ordering)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def split_repeated(
    df: DataFrame, keys: list[str], most: int = MOST_REPEATED
) -> tuple[DataFrame | None, DataFrame]:
    """``(rows whose key no other row has, all other rows)``; the first is None, and the
    other all of ``df``, where more than ``most`` keys repeat.

    Keys are counted by a hash, so only numbers are shuffled. Rows of different keys with
    one hash count as repeated, which is what they are compared for. ``df`` is read three
    times: give one made of stored tables.
    """
    hashes = df.select(key_hash(keys).alias("_hash")).groupBy("_hash").agg(F.count(F.lit(1)).alias("_n"))
    repeated = cut_lineage(hashes.where("_n > 1").select("_hash"))
    if repeated.count() > most:
        return None, df
    hashed = df.withColumn("_hash", key_hash(keys))
    alone, rest = (hashed.join(F.broadcast(repeated), "_hash", how).drop("_hash") for how in ("left_anti", "left_semi"))
    return alone, rest


def newest_per_key(
    df: DataFrame,
    keys: list[str],
    ingestion: str,
    distinct: bool = False,
    rule: HotRule | None = DEFAULT_RULE,
) -> DataFrame:
    """All rows of the newest ingestion of each key.

    Ties survive; rows without an ingestion date never do. ``distinct`` drops
    equal rows afterwards: for cold keys the rows are already partitioned by
    the key, which a whole-row dedup can reuse; rows of hot keys are first cut
    to their newest ingestion without a shuffle and then dedupped by whole row,
    which spreads them.
    """
    dated = df.where(F.col(ingestion).isNotNull())
    if rule is None:
        return _newest_by_rank(dated, keys, ingestion, distinct)
    cold_rows, hot_rows, _ = split_hot(dated, keys, rule)
    newest = _newest_by_rank(cold_rows, keys, ingestion, distinct)
    if hot_rows is None:
        return newest
    return newest.unionByName(_newest_of_few(hot_rows, keys, ingestion, distinct))


def _newest_by_rank(df: DataFrame, keys: list[str], ingestion: str, distinct: bool) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.col(ingestion).desc())
    out = df.withColumn("_r", F.rank().over(w)).where("_r = 1").drop("_r")
    return out.dropDuplicates() if distinct else out


def _newest_of_few(df: DataFrame, keys: list[str], ingestion: str, distinct: bool) -> DataFrame:
    newest = df.groupBy(*[F.col(k).alias(f"{k}__n") for k in keys]).agg(
        F.max(ingestion).alias("_newest")
    )
    same = same_key(keys, "__n") & (F.col(ingestion) == F.col("_newest"))
    out = df.join(F.broadcast(newest), same, "left_semi")
    return out.dropDuplicates() if distinct else out


def newest_versions(df: DataFrame, keys: list[str], changed: str) -> DataFrame:
    """Distinct ``(keys, newest change)``; a key never dated keeps NULL."""
    return df.groupBy(*keys).agg(F.max(changed).alias(changed))


def newest_of_equal_rows(df: DataFrame, ingestion: str) -> DataFrame:
    """Rows equal but for the ingestion date collapse to the newest one."""
    rest = [c for c in df.columns if c != ingestion]
    return df.groupBy(*rest).agg(F.max(ingestion).alias(ingestion))


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def with_known_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows without a NULL key; each test is pushed to the scan."""
    for key in keys:
        df = df.where(F.col(key).isNotNull())
    return df


def duplicate_keys(df: DataFrame, keys: list[str], count_name: str = "n_rows") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name)).where(
        F.col(count_name) > 1
    )


def duplicate_rows(
    df: DataFrame,
    keys: list[str],
    count_name: str = "n_rows",
    rule: HotRule | None = DEFAULT_RULE,
) -> DataFrame:
    """Every row of a key that occurs more than once, with the key's count.

    A key with a NULL part never counts as a duplicate, as in an equi join.
    """
    known = with_known_keys(df, keys)
    if rule is None:
        return _counted_by_window(known, keys, count_name)
    cold_rows, hot_rows, _ = split_hot(known, keys, rule)
    counted = _counted_by_window(cold_rows, keys, count_name)
    if hot_rows is None:
        return counted
    counts = duplicate_keys(hot_rows, keys, count_name)
    return counted.unionByName(hot_rows.join(F.broadcast(counts), keys, "inner"))


def _counted_by_window(df: DataFrame, keys: list[str], count_name: str) -> DataFrame:
    w = Window.partitionBy(*keys)
    return df.withColumn(count_name, F.count(F.lit(1)).over(w)).where(F.col(count_name) > 1)
