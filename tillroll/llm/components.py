"""Connected components of a link table by alternating stars.

Every step is one aggregate and one join on the node, so a node with very many
links is pre-aggregated and its rows can be split; no neighbour list, component
or link table is ever gathered. Rounds grow with the logarithm of a component's
size; each round is a written table, so lost executors cost one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.session import cut_lineage


def _stars(links: DataFrame) -> DataFrame:
    """Large star: every larger neighbour of u is tied to the smallest around u."""
    both = links.union(links.select("v", "u"))
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    tied = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.where("u <> v").distinct()


def _flattened(links: DataFrame) -> DataFrame:
    """Small star: u (the larger end) and its smaller neighbours are tied to the
    smallest of them."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    tied = links.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.union(least.select("u", "m")).where("u <> v").distinct()


def _state(links: DataFrame) -> tuple:
    mark = F.xxhash64("u", "v").cast("decimal(38,0)")
    row = links.agg(F.count("*").alias("n"), F.sum(mark).alias("s")).collect()[0]
    return row["n"], row["s"]


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) of every node with a link; component: its smallest node.

    ``a`` and ``b`` are long columns; direction, repeats and self links do not
    matter, a link with a null end is none. No links give no rows.
    """
    clean = links.select(
        F.greatest(F.col(a), F.col(b)).alias("u"), F.least(F.col(a), F.col(b)).alias("v")
    ).where(f"`{a}` is not null and `{b}` is not null")
    now = cut_lineage(clean.where("u <> v").distinct())
    state = _state(now)
    while state[0]:
        now = cut_lineage(_flattened(_stars(now)))
        before, state = state, _state(now)
        if state == before:
            break
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        roots.select("node", F.col("node").alias("component"))
    )
