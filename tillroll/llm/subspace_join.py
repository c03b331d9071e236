"""Embedding near-duplicates by a subspace pigeonhole join.

For unit vectors a cosine of t is a squared distance of 2 - 2t. A fixed random
rotation spreads it evenly; the rotated vector is split into ``BLOCKS`` subspaces
and each gets the share of the squared distance its dimensions have. A pair within
the whole distance is within the share in at least one subspace, so range-joining
every subspace misses none.

The range join of a subspace uses cells along its first coordinate, as wide as its
radius: partners are in the same or in a neighbouring cell. A pair of cells is cut
into tiles of at most about ``TILE`` x ``TILE`` vectors, so a crowded cell (or a
label that holds a third of all rows) is many bounded tasks. Inside a tile numpy
first compares the subspace, then the whole vectors in double precision. A pair is
counted in the first subspace whose share holds it, so in one tile only; tiles
return link counts and a spanning forest, never pairs.

Equal vectors of one label are one class throughout.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.components import components
from tillroll.session import cut_lineage
from tillroll.workload.tables import table

BLOCKS = 4
#: Vectors on a side of a tile, about.
TILE = 2048
#: Rows of a tile compared at once, and pairs verified at once.
STRIP, VERIFIED = 256, 1 << 14
#: Added to shares and radii; far above rounding, far below any distance that counts.
SLACK = 1e-9


@lru_cache(maxsize=8)
def rotation(dim: int) -> np.ndarray:
    """A fixed random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(dim).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def block_edges(dim: int) -> np.ndarray:
    """Where the subspaces of ``dim`` dimensions begin and end."""
    n = min(BLOCKS, dim)
    return np.linspace(0, dim, n + 1).round().astype(int)


def shares(dim: int, cosine: float) -> np.ndarray:
    """The squared distance of each subspace: in proportion to its dimensions."""
    return (2 - 2 * cosine) * np.diff(block_edges(dim)) / dim + SLACK


def rotated(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    units = scaled / np.linalg.norm(scaled, axis=1, keepdims=True)
    return units @ rotation(vectors.shape[1])


def cell_finder(cosine: float):
    """An Arrow function from a vector to its cell in every subspace."""

    @F.arrow_udf("array<long>")
    def cells(vectors: pa.Array) -> pa.Array:
        out: list = [None] * len(vectors)
        sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
        flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        starts = np.cumsum(sizes) - sizes
        for dim in np.unique(sizes):
            rows = np.flatnonzero(sizes == dim)
            turned = rotated(flat[starts[rows][:, None] + np.arange(dim)])
            wide = np.sqrt(shares(dim, cosine)) + SLACK
            found = np.floor(turned[:, block_edges(dim)[:-1]] / wide).astype(np.int64)
            for row, cell in zip(rows.tolist(), found.tolist()):
                out[row] = cell
        return pa.array(out, pa.list_(pa.int64()))

    return cells


def usable(vector: Column) -> Column:
    """Not null, not zero, and every component a finite number."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _tiled(placed: DataFrame) -> DataFrame:
    """A row for every tile a vector takes part in.

    Tile (cell, i, j) holds part i of the cell on its left; j below the cell's
    number of parts is a part of the same cell, above it one of the next cell.
    """
    key = ["label", "dim", "block", "cell"]
    counted = placed.groupBy(*key).agg(F.ceil(F.count("*") / TILE).cast("long").alias("parts"))
    around = [
        counted.select("label", "dim", "block", (F.col("cell") + step).alias("cell"), F.col("parts").alias(name))
        for step, name in ((0, "parts"), (1, "before"), (-1, "after"))
    ]
    sizes = around[0].join(around[1], key, "left").join(around[2], key, "left").na.fill(0, ["before", "after"])
    part = placed.join(sizes, key).withColumn("part", F.pmod(F.xxhash64("id", "block"), F.col("parts")))

    def tiles(first: str, last: Column, build) -> Column:
        some = F.sequence(F.lit(0).cast("long"), last)
        return F.when(last >= 0, F.transform(some, build)).otherwise(F.array().cast(TILE_TYPE))

    def tile(cell: Column, i: Column, j: Column, left: bool) -> Column:
        return F.struct(cell.alias("cell"), i.alias("i"), j.alias("j"), F.lit(left).alias("left"))

    cell, k, n = F.col("cell"), F.col("part"), F.col("parts")
    wanted = F.concat(
        tiles("same", n - 1 - k, lambda x: tile(cell, k, k + x, True)),
        tiles("next", F.col("after") - 1, lambda x: tile(cell, k, n + x, True)),
        tiles("same", k - 1, lambda x: tile(cell, x, k, False)),
        tiles("next", F.col("before") - 1, lambda x: tile(cell - 1, x, F.col("before") + k, False)),
    )
    return part.select("label", "dim", "block", "id", "weight", "vector", F.inline(wanted))


TILE_TYPE = "array<struct<cell: long, i: long, j: long, left: boolean>>"
FOUND = "id long, root long, links long"


def tile_matcher(cosine: float):
    """The links of one tile: of each linked vector its count and its forest root."""

    def match(key: tuple, rows: pa.Table) -> pa.Table:
        dim, block, i, j = (key[n].as_py() for n in (1, 2, 4, 5))
        vectors = rows["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        vectors = vectors.astype(np.float64).reshape(-1, dim)
        left = rows["left"].combine_chunks().to_numpy(zero_copy_only=False).astype(bool)
        one_part = i == j
        a = np.flatnonzero(left)
        b = a if one_part else np.flatnonzero(~left)
        linked = links_between(vectors, a, b, block, cosine, one_part)
        ids = rows["id"].to_numpy()
        weights = rows["weight"].to_numpy()
        count = np.zeros(len(ids), dtype=np.int64)
        np.add.at(count, a, linked @ weights[b])
        np.add.at(count, b, linked.T @ weights[a])
        used = np.flatnonzero(count)
        root = forest(ids, a, b, linked)
        return pa.table({"id": ids[used], "root": root[used], "links": count[used]})

    return match


def links_between(
    vectors: np.ndarray, a: np.ndarray, b: np.ndarray, block: int, cosine: float, one_part: bool
) -> np.ndarray:
    """Which of ``a`` and ``b`` link, as a boolean matrix, for pairs this subspace owns."""
    out = np.zeros((len(a), len(b)), dtype=bool)
    if not out.size:
        return out
    turned, edges = rotated(vectors), block_edges(vectors.shape[1])
    share = shares(vectors.shape[1], cosine)
    inside = turned[:, edges[block] : edges[block + 1]]
    squares = (inside**2).sum(axis=1)
    norms = np.sqrt((vectors**2).sum(axis=1))
    for start in range(0, len(a), STRIP):
        strip = a[start : start + STRIP]
        apart = squares[strip][:, None] + squares[b][None, :] - 2 * inside[strip] @ inside[b].T
        x, y = np.nonzero(apart <= share[block] + 1e-6)
        if one_part:
            later = x + start < y
            x, y = x[later], y[later]
        for at in range(0, len(x), VERIFIED):
            p, q = x[at : at + VERIFIED], y[at : at + VERIFIED]
            u, v = strip[p], b[q]
            near = np.add.reduceat((turned[u] - turned[v]) ** 2, edges[:-1], axis=1) <= share
            owned = near[:, block] & ~near[:, :block].any(axis=1)
            p, q, u, v = p[owned], q[owned], u[owned], v[owned]
            dots = np.einsum("ij,ij->i", vectors[u], vectors[v])
            hit = dots / (norms[u] * norms[v]) >= cosine
            out[start + p[hit], q[hit]] = True
    return out


def forest(ids: np.ndarray, a: np.ndarray, b: np.ndarray, linked: np.ndarray) -> np.ndarray:
    """For every vector of a tile the smallest id it reaches inside the tile."""
    root = ids.copy()
    rows, columns = np.flatnonzero(linked.any(axis=1)), np.flatnonzero(linked.any(axis=0))
    if not len(rows):
        return root
    some, u, v = linked[np.ix_(rows, columns)], a[rows], b[columns]
    top = np.iinfo(np.int64).max
    while True:
        before = root.copy()
        for s in range(0, len(u), STRIP):
            least = np.where(some[s : s + STRIP], root[v][None, :], top).min(axis=1)
            np.minimum.at(root, u[s : s + STRIP], least)
        for s in range(0, len(v), STRIP):
            least = np.where(some.T[s : s + STRIP], root[u][None, :], top).min(axis=1)
            np.minimum.at(root, v[s : s + STRIP], least)
        if (root == before).all():
            return root


def near_duplicates(
    rows: DataFrame, cosine: float, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    Rows link when their labels are equal and not null, their vectors equally long
    and the cosine in double precision reaches ``cosine`` (0 to 1). A vector that
    is null, empty, zero or holds a null or a number that is not finite links with
    nothing. Equal vectors count one by one. Repeated ids keep their rows; a null id
    is never the smallest of a group. Extra columns are not carried. An empty table
    gives no rows.
    """
    clean = rows.select(
        F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{vector}`").alias("vector"), F.col(f"`{label}`").alias("label")
    )
    takes_part = usable(F.col("vector")) & F.col("label").isNotNull()
    classes = cut_lineage(
        clean.where(takes_part)
        .groupBy("label", "vector")
        .agg(F.count("*").alias("weight"), F.min("vec_id").alias("first"))
        .withColumn("id", F.monotonically_increasing_id())
    )
    placed = classes.select(
        "id", "label", "vector", "weight", F.size("vector").alias("dim"), F.posexplode(cell_finder(cosine)("vector")).alias("block", "cell")
    )
    tiles = _tiled(placed).groupBy("label", "dim", "block", "cell", "i", "j")
    found = cut_lineage(tiles.applyInArrow(tile_matcher(cosine), FOUND))

    counts = found.groupBy("id").agg(F.sum("links").alias("others"))
    member = components(found, "id", "root").withColumnRenamed("node", "id")
    linked = cut_lineage(classes.select("id", "first").join(member, "id", "left").withColumn("component", F.coalesce("component", "id")))
    smallest = linked.groupBy("component").agg(F.min("first").alias("component_id"))
    of_class = (
        classes.join(counts, "id", "left")
        .join(linked.join(smallest, "component").select("id", "component_id"), "id")
        .select("label", "vector", (F.coalesce("others", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id")
    )
    alone = clean.where(~takes_part).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    together = clean.where(takes_part).join(of_class, ["label", "vector"]).select("vec_id", "n_links", "component_id")
    return together.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op6_subspace_join(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "embeddings"), 0.93)


OP6_SQL = """
with recursive usable as (
  select vec_id, label, embedding::double[] v from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0
), links as (
  select a.vec_id a, b.vec_id b from usable a join usable b
  on a.label = b.label and len(a.v) = len(b.v) and a.vec_id <> b.vec_id
  where list_cosine_similarity(a.v, b.v) >= 0.93
), reach as (
  select vec_id x, vec_id y from embeddings
  union select r.x, l.b from reach r join links l on r.y = l.a
), group_of as (select x, min(y) c from reach group by x)
select e.vec_id, (select count(*) from links l where l.a = e.vec_id) n_links, g.c component_id, e.vec_id = g.c kept
from embeddings e join group_of g on g.x = e.vec_id
"""

QUERIES = {"op6_subspace_join": (op6_subspace_join, OP6_SQL)}
