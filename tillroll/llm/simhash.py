"""SimHash near-duplicates, searched with Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into three segments. Two fingerprints that differ in
at most two bits agree fully in one segment and differ in at most one bit in the
next one (going round). The first segment is a key as it is. The second is
decoded by the binary Golay code: every 23-bit word lies within 3 bits of exactly
one codeword, so a word one bit away lies within 4 bits of it. One side looks up
its own codeword, the other is filed under every codeword within 4 bits (at most
six). Key matches are verified on the whole fingerprint inside the join.

Only distinct fingerprints are joined; a group of copies is one row there.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.components import components
from tillroll.llm.texts import slices
from tillroll.session import cut_lineage
from tillroll.workload.tables import table

SEED = 42
#: The generator polynomial of the binary [23, 12, 7] Golay code.
GENERATOR = 0b101011100011
#: Bits of the three segments, from the lowest.
SEGMENTS = (22, 21, 21)
#: No pair of codewords is nearer than 7 bits, so a segment has one codeword
#: within 3 bits and at most five more at 4 bits.
FILED = 6


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """XXH64 of every shingle of ``words`` words, repeats included."""
    found = text.encode().lower().split() if text else []
    if not found:
        return np.zeros(0, dtype=np.uint64)
    hashed = xxhash.xxh64_intdigest
    if len(found) < words:
        return np.array([hashed(b" ".join(found), SEED)], dtype=np.uint64)
    runs = map(b" ".join, zip(*(found[k:] for k in range(words))))
    return np.fromiter((hashed(run, SEED) for run in runs), np.uint64, len(found) - words + 1)


def fingerprint_of(hashes: np.ndarray) -> int:
    """Bit i is 1 if it is set in over half of the hashes; none: zero (as signed)."""
    if not len(hashes):
        return 0
    ones = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    bits = ones.sum(axis=0, dtype=np.int64) * 2 > len(hashes)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(words: int):
    """An Arrow function from texts to signed 64-bit fingerprints."""

    @F.arrow_udf("long")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = [fingerprint_of(shingle_hashes(t, words)) for part in slices(batch) for t in part]
            yield pa.array(out, pa.int64())

    return of


def _remainders() -> np.ndarray:
    """Check bits of every 12-bit message."""
    out = np.arange(1 << 12, dtype=np.int64) << 11
    for bit in range(22, 10, -1):
        out = np.where(out >> bit & 1, out ^ (GENERATOR << (bit - 11)), out)
    return out


def _errors() -> np.ndarray:
    """Row s: the error patterns of at most 4 bits with syndrome s, shortest first."""
    remainders = _remainders()
    out = np.full((1 << 11, FILED), -1, dtype=np.int64)
    seen = np.zeros(1 << 11, dtype=int)
    for n in range(5):
        for bits in combinations(range(23), n):
            word = sum(1 << b for b in bits)
            s = (word & 0x7FF) ^ remainders[word >> 11]
            out[s, seen[s]] = word
            seen[s] += 1
    return out


class Golay:
    """Codeword indices near 23-bit words; the tables follow from the generator."""

    def __init__(self) -> None:
        self.remainders, self.errors = _remainders(), _errors()

    def near(self, words: np.ndarray) -> np.ndarray:
        """(n, 6) indices of codewords within 4 bits, the nearest first; -1: none."""
        patterns = self.errors[(words & 0x7FF) ^ self.remainders[words >> 11]]
        return np.where(patterns < 0, -1, (words[:, None] ^ patterns) >> 11)


def segment_words(prints: np.ndarray) -> list[np.ndarray]:
    prints, out, at = prints.view(np.uint64), [], 0
    for bits in SEGMENTS:
        out.append((prints >> np.uint64(at) & np.uint64((1 << bits) - 1)).astype(np.int64))
        at += bits
    return out


def fuzzy_keys(prints: np.ndarray, golay: Golay, filed: bool) -> np.ndarray:
    """(n, 3) keys to look up, or (n, 18) to be filed under; -1: none."""
    words = segment_words(prints)
    out = []
    for k, exact in enumerate(words):
        near = golay.near(words[(k + 1) % len(words)])
        near = near if filed else near[:, :1]
        out.append(np.where(near < 0, -1, (k << 34 | exact << 12)[:, None] | near))
    return np.concatenate(out, axis=1)


def key_maker(filed: bool):
    """An Arrow function from fingerprints to their keys."""
    golay = Golay()

    @F.arrow_udf("array<long>")
    def keys(prints: pa.Array) -> pa.Array:
        made = fuzzy_keys(prints.to_numpy(zero_copy_only=False), golay, filed)
        there = made >= 0
        ends = np.concatenate([[0], np.cumsum(there.sum(axis=1))]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(made[there]))

    return keys


def fingerprint_links(prints: DataFrame, differing: int = 2) -> DataFrame:
    """(a, b), a < b: pairs of the distinct values of ``fp`` at most ``differing`` bits apart."""
    if not 0 <= differing <= 2:
        raise ValueError("the keys find pairs of up to two differing bits")
    asked = prints.select(F.col("fp").alias("a"), F.explode(key_maker(False)("fp")).alias("key"))
    filed = prints.select(F.col("fp").alias("b"), F.explode(key_maker(True)("fp")).alias("key"))
    near = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= differing)
    return asked.join(filed, (asked["key"] == filed["key"]) & near).select("a", "b").distinct()


def hex_of(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def with_near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = 3,
    differing: int = 2,
    names: tuple[str, str] = ("fingerprint", "component_id"),
) -> DataFrame:
    """``docs`` with the fingerprint (16 hexadecimal digits) and the group of each row.

    A group is everything reachable by links of at most ``differing`` bits; its id
    is its smallest ``doc_id`` (nulls apart: a group of null ids has a null id). A
    text without words, null included, has fingerprint zero and links like any
    other. Repeated rows stay; other columns pass through, the new names replace
    columns of theirs. An empty table gives none.
    """
    print_, group = names
    kept = [c for c in docs.columns if c not in names]
    printed = _printed(docs, kept, text, words)
    groups = fingerprint_groups(printed, F.col("row")[doc_id], differing)
    return printed.join(groups, "fp").select(
        *[F.col("row")[c].alias(c) for c in kept], hex_of(F.col("fp")).alias(print_), F.col("first").alias(group)
    )


def without_near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3, differing: int = 2
) -> DataFrame:
    """One row of each group (see ``with_near_duplicates``): the one with the smallest
    id (nulls last; of repeated ids one row). Columns stay as they are."""
    printed = _printed(docs, docs.columns, text, words)
    own = F.col("row")[doc_id]
    groups = fingerprint_groups(printed, own, differing).select("fp", "component")
    # Narrow rows choose who stays; whole rows are only filtered.
    order = F.struct(own.isNull().alias("last"), own.alias("id"), F.col("number"))
    stays = (
        printed.select("fp", order.alias("order"))
        .join(groups, "fp")
        .groupBy("component")
        .agg(F.min("order").alias("order"))
        .select(F.col("order.number").alias("number"))
    )
    return printed.join(stays, "number", "left_semi").select(*[F.col("row")[c].alias(c) for c in docs.columns])


def _printed(docs: DataFrame, columns: list[str], text: str, words: int) -> DataFrame:
    """A stored table of the rows, numbered, with their fingerprints."""
    row = F.struct(*[F.col(f"`{c}`") for c in columns])
    fp = fingerprints(words)(F.col(f"`{text}`"))
    return cut_lineage(docs.select(row.alias("row"), F.monotonically_increasing_id().alias("number"), fp.alias("fp")))


def fingerprint_groups(printed: DataFrame, doc_id: Column, differing: int) -> DataFrame:
    """(fp, component, first) of every fingerprint of a stored table: the smallest
    fingerprint and the smallest id of its group."""
    classes = cut_lineage(printed.groupBy("fp").agg(F.min(doc_id).alias("own")))
    found = components(fingerprint_links(classes.select("fp"), differing), "a", "b")
    linked = cut_lineage(classes.join(found.withColumnRenamed("node", "fp"), "fp"))
    smallest = linked.groupBy("component").agg(F.min("own").alias("first"))
    groups = linked.select("fp", "component").join(smallest, "component")
    alone = F.coalesce("component", "fp").alias("component")
    first = F.when(F.col("component").isNull(), F.col("own")).otherwise(F.col("first")).alias("first")
    return classes.join(groups, "fp", "left").select("fp", alone, first)


def op7_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    # The texts are needed for the fingerprints only.
    printed = _printed(docs, ["doc_id"], "text", 3)
    groups = fingerprint_groups(printed, F.col("row.doc_id"), 2)
    return printed.join(groups, "fp").select(
        "row.doc_id", hex_of(F.col("fp")).alias("fingerprint"), F.col("first").alias("component_id")
    )


QUERIES = {"op7_simhash_near_dedup": (op7_simhash_near_dedup, None)}
