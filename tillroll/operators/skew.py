"""Keys that hold too many rows.

One key may hold a third of a feed (a sentinel code, a default store, a word
that is in every description). A shuffle on that key puts all its rows in one
task. The helpers here find such keys with one narrow pass and give their rows
a path that never shuffles on the key.

Finding them is approximate, using them is not: the list only says which path
a row takes, and both paths give the same rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class HotRule:
    """A key is hot above ``min_rows`` rows, whatever the size of the feed.

    ``tracked`` bounds the sketch and ``limit`` the list of numbers that goes to
    the driver and back. The list holds the most frequent keys, so a key that
    misses it has less than ``1 / limit`` of the rows.
    """

    min_rows: int = 1_000_000
    tracked: int = 100_000
    limit: int = 20_000
    slots: int = 64


DEFAULT_RULE = HotRule()

# Lookups of up to this many rows and bytes are broadcast.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 256 << 20


def key_hash(keys: list[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def hot_keys(df: DataFrame, keys: list[str], rule: HotRule = DEFAULT_RULE) -> list[int]:
    """The hashes of the hot keys, at most ``rule.limit`` numbers.

    Runs one job that reads the key columns only. Sketches are merged in two
    steps, so no task merges one per input split.
    """
    per_slot = (
        df.select(
            key_hash(keys).alias("_hash"),
            F.pmod(F.spark_partition_id(), F.lit(rule.slots)).alias("_slot"),
        )
        .groupBy("_slot")
        .agg(
            F.expr(f"approx_top_k_accumulate(_hash, {rule.tracked})").alias("_sketch")
        )
    )
    # Grouped by a constant: an empty feed then gives no row, not a null sketch.
    merged = per_slot.groupBy(F.lit("all").alias("_all")).agg(
        F.expr(f"approx_top_k_combine(_sketch, {rule.tracked})").alias("_sketch")
    )
    hot = (
        merged.select(
            F.explode(F.expr(f"approx_top_k_estimate(_sketch, {rule.limit})")).alias("_top")
        )
        .where(F.col("_top.count") > F.lit(rule.min_rows))
        .select(F.col("_top.item").alias("_hot"))
    )
    return [row[0] for row in hot.collect()]


def is_hot(keys: list[str], hashes: list[int]) -> Column:
    return key_hash(keys).isin(hashes)


def split_hot(
    df: DataFrame, keys: list[str], rule: HotRule = DEFAULT_RULE
) -> tuple[DataFrame, DataFrame | None, list[int]]:
    """``(cold rows, hot rows or None, hot hashes)``.

    Without a hot key, which is the usual case, ``df`` comes back unchanged and
    the plan is the one without any of this.
    """
    hashes = hot_keys(df, keys, rule)
    if not hashes:
        return df, None, hashes
    return df.where(~is_hot(keys, hashes)), df.where(is_hot(keys, hashes)), hashes


def same_key(keys: list[str], suffix: str) -> Column:
    """Null-safe equality of ``keys`` with their copies named ``key + suffix``."""
    return reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{k}{suffix}")) for k in keys]
    )


def fits(df: DataFrame, rows: int, most_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether the stored table ``df`` has at most ``rows`` rows, and as text at most
    ``most_bytes`` bytes. The text is only measured where the rows are few enough."""
    if df.count() > rows:
        return False
    size = F.sum(F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))).cast("long"))
    return (df.agg(size).collect()[0][0] or 0) <= most_bytes


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that is not broadcast on an estimate.

    The optimizer takes a stored table for as large as its compressed files, and the
    few columns a query reads for a small share of that: ten million numbers look like
    a few megabytes, and as a hash table they would fill the driver.
    """
    return df.hint("merge")


def lookup_join(
    df: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    how: str = "left",
    rule: HotRule | None = DEFAULT_RULE,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Join ``df`` to ``lookup``, which has at most one row per key.

    A lookup that is counted, measured and found small is broadcast, and ``df`` is not
    shuffled at all; give ``broadcast_rows=0`` for one that is not a stored table,
    as counting would compute it twice. Beyond that, rows of hot keys meet a
    broadcast of the few lookup rows they can match, and all others take a
    ``shuffled`` join. ``rule=None`` is for keys known to be unique in ``df`` as well,
    or leaves skew to the engine.
    """
    if broadcast_rows and fits(lookup, broadcast_rows):
        return df.join(F.broadcast(lookup), keys, how)
    if rule is None:
        return df.join(shuffled(lookup), keys, how)
    cold_rows, hot_rows, hashes = split_hot(df, keys, rule)
    joined = cold_rows.join(shuffled(lookup), keys, how)
    if hot_rows is None:
        return joined
    few = lookup.where(is_hot(keys, hashes))
    return joined.unionByName(hot_rows.join(F.broadcast(few), keys, how))
