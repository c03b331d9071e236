"""Benchmark decontamination by a size-partitioned MinHash containment search.

An item is in a document if at least ``containment`` of the item's distinct
shingles are among the document's. Both are sets of 64-bit shingle hashes. Items
are short, documents may be very long, so a similarity of the two says little;
the search is partitioned by the size of the document's set instead. A partition
of up to u shingles is sketched by one hash into u / LOAD bins of which each keeps
its minimum (one-permutation MinHash): a hash the document shares with an item is
its bin's minimum with a probability that does not depend on the document's size.
Every item is sketched once for each partition. A shared minimum makes a
candidate, and candidates are verified on the exact sets.

An item with few shingles might share no minimum, so items are partitioned by size
as well: the fewer shingles, the more bins, up to one bin for each possible hash
(every hash is then a minimum). ``MISS`` bounds the chance to miss a pair in any
partition.

An item of fewer words than a shingle is one shingle of its own length, and found
where a document holds its words in a row.

The items are the query set: Spark shingles them, and they are handled in blocks of
at most ``BLOCK`` shingles, each broadcast to one pass over the documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.simhash import shingle_hashes
from tillroll.llm.texts import by_bytes, slices
from tillroll.session import cut_lineage
from tillroll.workload.tables import table

WORDS, CONTAINMENT = 5, 0.8
#: Shingles of items that are broadcast together (8 bytes each, some times over).
BLOCK = 1 << 18
#: Most chance to miss a pair at the threshold.
MISS = 1e-9
#: Expected hashes per bin that are tried, from the coarsest sketch to the finest;
#: 0 stands for a bin per possible hash.
LOADS = (4.0, 2.0, 1.0, 0.5, 0.25, 0.0)


def survival(load: float) -> float:
    """The chance that a hash is the minimum of its bin."""
    return (1 - math.exp(-load)) / load if load else 1.0


def load_for(shingles: int, containment: float) -> float:
    """The coarsest sketch that misses an item of that many shingles rarely enough.

    The item is sketched into the same bins, so a shared hash must be the minimum
    twice; its own few hashes seldom meet, and ``shingles / 2`` allows for it.
    """
    shared = max(1, math.ceil(containment * shingles / 2))
    for load in LOADS:
        if (1 - survival(load)) ** shared <= MISS:
            return load
    return 0.0


def bins_of(size: int, load: float) -> int:
    """A power of two of bins for the partition that holds sets of ``size``."""
    upper = 1 << max(0, int(size - 1).bit_length())
    return max(1, int(upper / load)) if load else 0


def minima(hashes: np.ndarray, bins: int) -> np.ndarray:
    """The sorted distinct hashes that are the minimum of their bin."""
    if not bins:
        return hashes
    found = hashes % np.uint64(bins)
    order = np.lexsort((hashes, found))
    first = np.ones(len(order), dtype=bool)
    first[1:] = found[order][1:] != found[order][:-1]
    return hashes[order[first]]


class Items:
    """A block of items, and for every partition the items each minimum points to."""

    def __init__(self, items: list[tuple[int, np.ndarray]], containment: float):
        self.items = items
        self.need = [math.ceil(containment * len(h) - 1e-9) for _, h in items]
        self.loads = np.array([load_for(len(h), containment) for _, h in items])
        self.sketches: dict[tuple[float, int], tuple[np.ndarray, np.ndarray]] = {}

    def sketch(self, load: float, bins: int) -> tuple[np.ndarray, np.ndarray]:
        """Sorted minima of the items with this load, and whose each is."""
        if (load, bins) not in self.sketches:
            who = np.flatnonzero(self.loads == load)
            parts = [minima(self.items[k][1], bins) for k in who]
            keys = np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64)
            owner = np.repeat(who, [len(p) for p in parts])
            order = np.argsort(keys, kind="stable")
            self.sketches[(load, bins)] = keys[order], owner[order]
        return self.sketches[(load, bins)]

    def candidates(self, hashes: np.ndarray) -> np.ndarray:
        """Items that share a minimum with the document in its partition."""
        out = [np.zeros(0, dtype=np.int64)]
        for load in np.unique(self.loads):
            bins = bins_of(len(hashes), load)
            keys, owner = self.sketch(load, bins)
            # Only a hash some item has as its minimum can be a shared one.
            at = np.searchsorted(keys, hashes)
            shared = hashes[keys[np.minimum(at, len(keys) - 1)] == hashes]
            if not len(shared):
                continue
            shared = shared[np.isin(shared, minima(hashes, bins))]
            low, high = np.searchsorted(keys, shared), np.searchsorted(keys, shared, side="right")
            out += [owner[a:b] for a, b in zip(low, high)]
        return np.unique(np.concatenate(out))

    def matches(self, hashes: np.ndarray) -> list[dict]:
        """The items whose share of shingles in the document is large enough."""
        out = []
        for k in self.candidates(hashes).tolist():
            item_id, wanted = self.items[k]
            n = int(np.isin(wanted, hashes, assume_unique=True).sum())
            if n >= self.need[k]:
                out.append({"item_id": item_id, "n_shared": n, "n_shingles": len(wanted)})
        return out


MATCHES = "array<struct<item_id: long, n_shared: long, n_shingles: long>>"
MATCHES_ARROW = pa.list_(
    pa.struct([("item_id", pa.int64()), ("n_shared", pa.int64()), ("n_shingles", pa.int64())])
)


#: Items by the words of their shingles.
Block = dict[int, Items]


def matches_of(text: str | None, block: Block) -> list[dict]:
    """The items of a block that are in a text."""
    out = []
    for words, items in block.items():
        hashes = np.unique(shingle_hashes(text, words))
        if len(hashes):
            out += items.matches(hashes)
    return out


def matcher(block):
    """An Arrow function from texts to the items of the broadcast block in them."""

    @F.arrow_udf(MATCHES)
    def match(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        items = block.value
        for batch in batches:
            yield pa.array([matches_of(t, items) for part in slices(batch) for t in part], MATCHES_ARROW)

    return match


SHINGLES = "struct<words: int, hashes: array<long>>"


def shingled(words: int):
    """An Arrow function from items to the words of their shingles and the distinct hashes."""

    @F.arrow_udf(SHINGLES)
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            texts = [t for part in slices(batch) for t in part]
            # No more words than a shingle has need be told apart.
            lengths = [min(words, len(t.encode().split(None, words))) if t else 0 for t in texts]
            hashes = [np.unique(shingle_hashes(t, words)).view(np.int64) for t in texts]
            yield pa.StructArray.from_arrays(
                [pa.array(lengths, pa.int32()), pa.array(hashes, pa.list_(pa.int64()))], ["words", "hashes"]
            )

    return of


def item_blocks(items: DataFrame, words: int, item_id: str, text: str, containment: float) -> Iterator[Block]:
    """The items in blocks of bounded size, fetched one block at a time."""
    rows = items.select(F.col(f"`{item_id}`").alias("item_id"), shingled(words)(F.col(f"`{text}`")).alias("s"))
    found = cut_lineage(rows.select("item_id", "s.*")).where("words > 0").toLocalIterator()
    for some in by_bytes(found, lambda r: len(r.hashes), BLOCK):
        block: dict[int, list[tuple[int | None, np.ndarray]]] = {}
        for r in some:
            block.setdefault(r.words, []).append((r.item_id, np.array(r.hashes, dtype=np.int64).view(np.uint64)))
        yield {n: Items([(k, np.sort(h)) for k, h in held], containment) for n, held in block.items()}


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    words: int = WORDS,
    containment: float = CONTAINMENT,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(doc_id, item_id, n_shared, n_shingles): every item found in every row of ``docs``.

    Words are separated by ASCII white space, letters A-Z count as lower case. An
    item of fewer words than a shingle is in the documents that hold its words in a
    row; a null or empty text, on either side, matches nothing. Repeated rows match
    once each, an item with a null id like any other. Extra columns are not carried.
    Empty tables give no rows.
    """
    spark = docs.sparkSession
    found = None
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    for block in item_blocks(items, words, item_id, item_text, containment):
        match = matcher(spark.sparkContext.broadcast(block))
        part = source.select("doc_id", F.inline(match("text")))
        found = part if found is None else found.union(part)
    if found is None:
        return spark.createDataFrame([], f"doc_id {docs.schema[doc_id].dataType.simpleString()}, item_id long, n_shared long, n_shingles long")
    return found


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    words: int = WORDS,
    containment: float = CONTAINMENT,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``docs`` without the rows that hold an item; other rows and all columns stay.

    Every row is judged by its own text, as in ``contaminated``.
    """
    for block in item_blocks(items, words, item_id, item_text, containment):
        match = matcher(docs.sparkSession.sparkContext.broadcast(block))
        docs = docs.where(F.size(match(F.col(f"`{text}`"))) == 0)
    return docs


def op10_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def words_sql(source: str, row_id: str) -> str:
    """The words of each row."""
    return (
        f"select {row_id}, list_filter(string_split_regex(translate(coalesce(text, ''), "
        r"'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') w "
        f"from {source}"
    )


def shingle_sql(row_id: str, source: str) -> str:
    """Distinct shingles of five words of each row that has so many."""
    return f"""
  select distinct {row_id}, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) s
  from {source} where len(w) >= 5"""


OP10_SQL = f"""
with dw as ({words_sql("documents", "doc_id")}), bw as ({words_sql("benchmark", "item_id")}),
d as ({shingle_sql("doc_id", "dw")}), b as ({shingle_sql("item_id", "bw")}),
sizes as (select item_id, count(*) n_shingles from b group by item_id),
shared as (select doc_id, item_id, count(*) n_shared from d join b using (s) group by doc_id, item_id)
select doc_id, item_id, n_shared, n_shingles from shared join sizes using (item_id)
where n_shared >= ceil(0.8 * n_shingles - 1e-9)
union all
select doc_id, item_id, 1, 1 from dw join bw on contains(' ' || array_to_string(dw.w, ' ') || ' ', ' ' || array_to_string(bw.w, ' ') || ' ')
where len(bw.w) between 1 and 4
"""

QUERIES = {"op10_benchmark_decontamination": (op10_benchmark_decontamination, OP10_SQL)}
