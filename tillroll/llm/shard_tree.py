"""Sharding by a hierarchical weighted hash tree.

A shard is a leaf under a rack under a region. A row descends the tree: at every
level each child draws ``-ln(u) / weight``, where u in (0, 1) follows from a hash of
the row's id and the child's name, and the least draw wins. So a child gets rows in
proportion to its weight (an inner node's is the sum below it), and a draw depends on
nothing but the id, the child and its weight. If weights change, a row moves only if
a child whose weight changed wins or loses: rows of a region, and within it of a rack,
whose weights stay keep their shards, and nothing moves between siblings that stay.

A heavier region also draws rows that then fall to its older shards. Where one more
shard must take rows only into itself, it opens a region of its own (``grown``).

Ids and weights decide alone: not the size of a row, its text or the other rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.session import cut_lineage
from tillroll.workload.tables import table

#: Bytes a row takes besides its text.
ROW_BYTES = 16


@dataclass(frozen=True)
class Shard:
    """A leaf; ``rack`` is unique within its region only."""

    number: int
    region: str
    rack: str
    weight: float = 1.0


def even_tree(shards: int, regions: int = 2, racks: int = 4) -> list[Shard]:
    """Shards 0, 1, ... of equal weight, as evenly over racks and regions as it goes."""
    places = regions * racks
    place = [k * places // shards if shards >= places else k for k in range(shards)]
    return [Shard(k, f"region{p // racks}", f"rack{p % racks}") for k, p in enumerate(place)]


def grown(tree: list[Shard], weight: float = 1.0) -> list[Shard]:
    """``tree`` and one more shard, in a region of its own: rows move to it alone."""
    number = max((s.number for s in tree), default=-1) + 1
    return [*tree, Shard(number, f"region-of-{number}", "rack0", weight)]


def _checked(tree: list[Shard]) -> list[Shard]:
    if any(not 0 <= s.weight < float("inf") for s in tree):
        raise ValueError("a weight is a finite number, zero or more")
    if len({s.number for s in tree}) < len(tree):
        raise ValueError("two shards have one number")
    used = [s for s in tree if s.weight > 0]
    if not used:
        raise ValueError("no shard has a weight")
    return used


def _levels(tree: list[Shard]) -> list[dict[str, dict[str, float]]]:
    """For each level, the children of every node with their weights."""
    levels: list[dict[str, dict[str, float]]] = [{}, {}, {}]
    for s in _checked(tree):
        path = ["", s.region, f"{s.region}/{s.rack}", str(s.number)]
        for level, parent, child in zip(levels, path, path[1:]):
            below = level.setdefault(parent, {})
            below[child] = below.get(child, 0.0) + s.weight
    return levels


def draw(row_id: Column, child: Column, weight: Column) -> Column:
    """Exponential in the hash of id and child, at the rate of the weight."""
    bits = F.shiftrightunsigned(F.xxhash64(row_id.cast("string"), child), 11)
    return -F.ln((bits + F.lit(0.5)) * F.lit(2.0**-53)) / weight


def shard_of(row_id: Column, tree: list[Shard]) -> Column:
    """The number of the shard that ``row_id`` descends to; a null id is one id of its own."""
    node = F.lit("")
    for level in _levels(tree):
        pairs = []
        for parent, below in level.items():
            named = [F.struct(F.lit(c).alias("child"), F.lit(w).alias("weight")) for c, w in below.items()]
            pairs += [F.lit(parent), F.array(*named)]
        children = F.element_at(F.create_map(*pairs), node)
        drawn = F.transform(
            children, lambda c: F.struct(draw(row_id, c["child"], c["weight"]).alias("draw"), c["child"].alias("child"))
        )
        node = F.array_min(drawn)["child"]
    return node.cast("int")


def with_shards(
    docs: DataFrame, tree: list[Shard], bigger: list[Shard] | None = None, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row.

    ``size`` is the text's UTF-8 bytes plus 16; a null text has none and checksum 0,
    as an empty one. ``slot`` numbers a shard's rows from 0 without gaps, by doc_id
    (nulls first), size and checksum; rows equal in all three get theirs in any order.
    ``grown_shard`` is the shard in the tree ``bigger``. Repeated ids share a shard,
    null ids too. Extra columns are not carried. An empty table gives no rows.

    Slots come from one range partitioning over all rows, so a shard, and an id that
    a third of all rows have, is spread over many tasks; only the numbers of rows
    per task and shard are gathered, one for each shard and task boundary.
    """
    own, words = F.col(f"`{doc_id}`"), F.coalesce(F.col(f"`{text}`"), F.lit(""))
    more = shard_of(own, bigger) if bigger else F.lit(None).cast("int")
    placed = cut_lineage(
        docs.select(
            own.alias("doc_id"),
            (F.octet_length(words).cast("long") + ROW_BYTES).alias("size"),
            F.crc32(words).alias("text_crc32"),
            shard_of(own, tree).alias("shard"),
            more.alias("grown_shard"),
            # Equal rows, too, must be apart for the range partitioning.
            F.monotonically_increasing_id().alias("row"),
        )
    )
    order = ["shard", "doc_id", "size", "text_crc32", "row"]
    # The id of a row in a sorted task: the task's number, then 33 bits of its place.
    place = F.monotonically_increasing_id()
    dealt = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    stored = cut_lineage(
        dealt.withColumn("place", place).select("*", F.shiftright("place", 33).alias("task")).drop("row")
    )
    # One row for each shard of each task: as many as tasks and shards together.
    parts = stored.groupBy("shard", "task").agg(F.count("*").alias("rows"), F.min("place").alias("first"))
    before = F.expr("sum(rows) over (partition by shard order by task rows between unbounded preceding and current row)")
    starts = parts.select("shard", "task", (before - F.col("rows") - F.col("first")).alias("start"))
    return stored.join(F.broadcast(starts), ["shard", "task"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("place") + F.col("start")).alias("slot"), "grown_shard",
    )


def op11_hash_tree_shards(spark: SparkSession, folder: str) -> DataFrame:
    tree = even_tree(40)
    return with_shards(table(spark, folder, "documents"), tree, grown(tree))


QUERIES = {"op11_hash_tree_shards": (op11_hash_tree_shards, None)}
