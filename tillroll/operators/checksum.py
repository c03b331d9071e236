"""Comparing two layers by order-free checksums; rows meet only where these differ.

A layer becomes one small row for each partition and key bucket: the number of rows, sums
of the parts of a 64-bit row hash and the exclusive or of another one. All of them are
independent of the order of rows and of how they are dealt over tasks, and are
aggregated before anything is shuffled. Equal layers cost two scans and a join of a few
thousand rows; a layer with some changed rows, the rows of their buckets.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.operators import audit
from tillroll.operators.dedup import with_known_keys

BUCKETS = 4096
#: Differing partitions and buckets beyond this number are not named one by one.
MOST_NAMED = 50_000
#: A row hash is summed in parts of so many bits: sums stay in a long for 2**41 rows.
_PART_BITS = 22


def _told_apart(columns: Sequence[str]) -> list[Column]:
    """Hash inputs; a null is otherwise skipped, so that (null, 1) is (1, null)."""
    return [x for c in columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]


def bucket_of(keys: Sequence[str], buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(*_told_apart(keys)), F.lit(buckets)).cast("int")


def layer_checksums(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], partition: Sequence[str] = (), buckets: int = BUCKETS
) -> DataFrame:
    """(partition, bucket, n_rows, checksums): equal for equal rows in any order, repeats
    counted. Sums and exclusive or use two hashes, 128 bits together."""
    inputs = _told_apart([*keys, *columns])
    one, two = F.xxhash64(*inputs), F.xxhash64(F.lit("other"), *inputs)
    mask = F.lit((1 << _PART_BITS) - 1)
    parts = [F.shiftrightunsigned("_one", _PART_BITS * i).bitwiseAND(mask) for i in range(3)]
    rows = df.select(*[F.col(f"`{c}`") for c in partition], bucket_of(keys, buckets).alias("bucket"), one.alias("_one"), two.alias("_two"))
    return rows.groupBy(*partition, "bucket").agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.sum(x).alias(f"sum_{i}") for i, x in enumerate(parts)], F.bit_xor("_two").alias("xor")
    )


_SUMS = ("n_rows", "sum_0", "sum_1", "sum_2", "xor")


def differing_buckets(left: DataFrame, right: DataFrame, partition: Sequence[str] = ()) -> DataFrame:
    """(partition, bucket, left_rows, right_rows) where two tables of checksums differ;
    a side without the bucket has no rows there."""
    b = right.withColumnsRenamed({c: f"{c}__r" for c in right.columns})
    key = [*partition, "bucket"]
    pair = left.join(b, reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"{k}__r")) for k in key]), "full_outer")
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"{c}__r")) for c in _SUMS])
    return pair.where(~same).select(
        *[F.coalesce(k, f"{k}__r").alias(k) for k in key],
        F.coalesce("n_rows", F.lit(0)).alias("left_rows"),
        F.coalesce("n_rows__r", F.lit(0)).alias("right_rows"),
    )


def differing_partitions(
    left: DataFrame, right: DataFrame, partition: Sequence[str], keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """(partition, n_buckets, left_rows, right_rows): where two layers are not the same."""
    sides = [layer_checksums(df, keys, columns, partition) for df in (left, right)]
    totals = [F.count(F.lit(1)).alias("n_buckets"), F.sum("left_rows").alias("left_rows"), F.sum("right_rows").alias("right_rows")]
    return differing_buckets(*sides, partition).groupBy(*partition).agg(*totals)


def narrowed(
    left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str], partition: Sequence[str] = (),
    buckets: int = BUCKETS, most_named: int = MOST_NAMED,
) -> tuple[DataFrame, DataFrame]:
    """Both sides without rows of buckets that are the same on both.

    The differing buckets become literals of a filter on the scan, and partition columns,
    where given, one that prunes partitions; with more than ``most_named`` of them both
    sides come back whole, since little would be saved. A partition column must be part
    of the key, so that all rows of a key are compared or none.
    """
    if not set(partition) <= set(keys):
        raise ValueError("a partition column that is no part of the key can split the rows of a key")
    sides = [with_known_keys(df.select(*keys, *columns), list(keys)) for df in (left, right)]
    sums = [layer_checksums(df, keys, columns, partition, buckets) for df in sides]
    found = differing_buckets(*sums, partition).select(*partition, "bucket").limit(most_named + 1).collect()
    if len(found) > most_named:
        return tuple(sides)
    chosen = bucket_of(keys, buckets).isin(sorted({r.bucket for r in found})) if found else F.lit(False)
    for column in partition:
        chosen = F.col(column).isin(sorted({r[column] for r in found})) & chosen if found else chosen
    return tuple(df.where(chosen) for df in sides)


def row_differences(
    left: DataFrame, right: DataFrame, keys: list[str], columns: list[str], partition: Sequence[str] = (), buckets: int = BUCKETS
) -> DataFrame:
    """As ``audit.row_differences``, on the rows of differing buckets only."""
    return audit.row_differences(*narrowed(left, right, keys, columns, partition, buckets), keys, columns)


def same_layer(left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> bool:
    """Whether both hold the same rows, as often; null keys included."""
    sides = [layer_checksums(df, keys, columns) for df in (left, right)]
    return differing_buckets(*sides).isEmpty()
