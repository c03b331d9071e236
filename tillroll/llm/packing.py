"""Best-fit packing of token sequences by a linear grouping scheme.

Documents are encoded once; their pieces (id, place, length, checksum) are a
written table. The plan (``packing_plan``) sees only how many pieces have each
length. Every piece then finds its place from its rank among the pieces of its
length. Ranks come from counts per (length, bucket), so a length that a third of
all pieces share is ranked in many tasks.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.llm.packing_plan import plan
from tillroll.llm.texts import by_bytes, slices, tokenizer, tokenizer_path
from tillroll.session import cut_lineage
from tillroll.workload.tables import table

VOCABULARY = "byte_bpe_50k.json"
CAPACITY = 2048
#: The id that ends every document.
END = np.array([0], dtype="<u4").tobytes()
#: Pieces of text whose ids a worker keeps, and the longest it keeps.
KEPT, KEPT_CHARS = 600_000, 64
ENCODE_BYTES = 1 << 18
#: Pieces of one length that one task ranks, about.
RANKED_TOGETHER = 4096

_ids: dict[str, dict[str, bytes]] = {}


def chunks(text: str) -> list[str]:
    """Parts of ``text`` that the vocabulary's pre-tokenizer never joins.

    It ties a single space to the word behind it and keeps a single line feed
    alone. Where white space is not of that kind (or the text holds characters
    that cannot be printed), only the cuts before a space between two plain words
    are safe.
    """
    flat = text.replace("\n", " ")
    if "  " not in flat and flat.isprintable() and flat[0] != " " != flat[-1]:
        return text.replace(" ", f"{CUT} ").replace("\n", f"{CUT}\n{CUT}").split(CUT)
    return SAFE_CUT.split(text)


#: Marks cuts; no printable text holds it.
CUT = "\x01"
#: Before a single space that has no white space on either side.
SAFE_CUT = re.compile(r"(?<=[!-~])(?= [!-~])")


def encode_batch(texts: list[str | None], path: str) -> list[bytes]:
    """The ids of each text as little-endian unsigned 32-bit numbers."""
    kept = _ids.setdefault(path, {})
    parts = [chunks(t) if t else [] for t in texts]
    fresh = set(chain.from_iterable(parts)).difference(kept)
    passing: list[str] = []
    if fresh:
        encode = tokenizer(path).encode_batch_fast
        room = KEPT - len(kept)
        for group in by_bytes(sorted(fresh, key=len), len, ENCODE_BYTES):
            for part, found in zip(group, encode(group, add_special_tokens=False)):
                kept[part] = struct.pack(f"<{len(found)}I", *found.ids)
            passing += [p for p in group if len(p) > KEPT_CHARS] if room > 0 else group
            room -= len(group)
    out = [b"".join(map(kept.__getitem__, p)) for p in parts]
    for p in passing:
        del kept[p]
    return out


PIECES = "array<struct<piece: int, start: long, length: long, ids_crc32: long>>"


def piece_maker(path: str, capacity: int):
    """An Arrow function from texts to the pieces of their ids and the end id."""

    @F.arrow_udf(PIECES)
    def pieces(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = []
            for part in slices(batch):
                for ids in encode_batch(part, path):
                    ids += END
                    n = len(ids) // 4
                    cuts = [0, *range((n - 1) % capacity + 1, n + 1, capacity)]
                    rows.append(
                        [
                            {"piece": k, "start": a, "length": b - a, "ids_crc32": zlib.crc32(ids[4 * a : 4 * b])}
                            for k, (a, b) in enumerate(zip(cuts, cuts[1:]))
                        ]
                    )
            yield pa.array(rows, PIECES_ARROW)

    return pieces


PIECES_ARROW = pa.list_(
    pa.struct([("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
)


def cut_into_pieces(docs: DataFrame, path: str, capacity: int, doc_id: str, text: str) -> DataFrame:
    """One row per piece: doc_id, row, piece, start, length, ids_crc32.

    ``row`` tells repeated rows of one document id apart.
    """
    made = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.monotonically_increasing_id().alias("row"),
        piece_maker(path, capacity)(F.col(f"`{text}`")).alias("pieces"),
    )
    return made.select("doc_id", "row", F.inline("pieces"))


def place(pieces: DataFrame, capacity: int) -> DataFrame:
    """``pieces`` (a stored table) with ``sequence_id`` and ``offset``."""
    by_length = pieces.groupBy("length").agg(F.count("*").alias("count")).collect()  # at most ``capacity`` rows
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for r in by_length:
        counts[r["length"]] = r["count"]
    _, runs = plan(counts, capacity)

    # As many buckets as a length needs: most lengths are ranked in one.
    needed = [(n, -(-int(counts[n]) // RANKED_TOGETHER)) for n in np.flatnonzero(counts).tolist()]
    buckets = F.broadcast(pieces.sparkSession.createDataFrame(needed, "length long, buckets long"))
    bucketed = pieces.join(buckets, "length").withColumn("bucket", F.pmod(F.xxhash64("row", "piece"), "buckets"))
    per_bucket = bucketed.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = per_bucket.select("length", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("length", "bucket").orderBy("row", "piece")
    ranked = (
        bucketed.withColumn("at", F.row_number().over(inside))
        .join(base, ["length", "bucket"])
        .withColumn("rank", F.col("base") + F.col("at") - 1)
    )
    return ranked.withColumn("place", place_finder(runs)("length", "rank"))


def place_finder(runs):
    """An Arrow function from (length, rank) to the place the plan gives it."""
    # One number orders runs by length, then rank; ranks stay below 2**48.
    keys = np.array(runs.length, dtype=np.int64) << 48 | np.array(runs.rank, dtype=np.int64)
    order = np.argsort(keys)
    keys = keys[order]
    first = np.array(runs.first, dtype=np.int64)[order]
    rank = np.array(runs.rank, dtype=np.int64)[order]
    offset = np.array(runs.offset, dtype=np.int64)[order]

    @F.arrow_udf("struct<sequence_id: long, offset: long>")
    def find(length: pa.Array, at: pa.Array) -> pa.Array:
        at = at.to_numpy(zero_copy_only=False)
        wanted = length.to_numpy(zero_copy_only=False).astype(np.int64) << 48 | at
        i = np.searchsorted(keys, wanted, side="right") - 1
        return pa.StructArray.from_arrays(
            [pa.array(first[i] + at - rank[i]), pa.array(offset[i])], ["sequence_id", "offset"]
        )

    return find


def pack(
    docs: DataFrame, path: str, capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Every piece of every document with its sequence and offset.

    Columns: doc_id, piece, start, length, ids_crc32, sequence_id, offset; extra
    columns of ``docs`` are not carried, so none can clash. A null or empty text
    is one piece that holds the end id. Repeated rows are packed once each. An
    empty table packs to no rows.
    """
    pieces = cut_lineage(cut_into_pieces(docs, path, capacity, doc_id, text))
    return place(pieces, capacity).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "place.sequence_id", "place.offset"
    )


def op9_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"), tokenizer_path(VOCABULARY))


QUERIES = {"op9_best_fit_packing": (op9_best_fit_packing, None)}
