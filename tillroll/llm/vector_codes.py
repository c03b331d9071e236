"""Vector codes by product quantisation in exact integers.

Components become integers, vectors are cut into parts, and each part position has a
codebook of integer entries. A part's squared distances to all entries are
|p|^2 - 2 p.c + |c|^2. The dot products come from matrix products in double precision
made exact by limbs: integers are broken into limbs so short that a sum of products of
two limbs stays below 2**53, where doubles hold every integer; the products of limbs
are shifted and added in int64. The code is the first least distance, so ties go to
the lower index and neither the order of rows nor the number of tasks matters.

Codebooks are the only state between rounds: entries times the length of a vector,
whatever the number of rows. A task returns counts and sums per entry, which Spark adds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tillroll.llm.integer_vectors import extent, integers, matrix
from tillroll.session import cut_lineage
from tillroll.workload.tables import table

#: Doubles hold every integer up to this power of two.
EXACT_BITS = 53
#: Integers up to here keep all distances of a part of up to 2**10 components in a long.
MOST = 2**25


def limb_bits(length: int) -> int:
    """Bits of a limb, so that ``length`` products of two limbs add up to below 2**53."""
    return (EXACT_BITS - 1 - max(length - 1, 0).bit_length()) // 2


def limbs(values: np.ndarray, bits: int) -> list[np.ndarray]:
    """Limbs from the lowest, as doubles: all but the last from 0 to 2**bits - 1, the
    last with the sign and at most 2**bits in absolute value."""
    out = []
    while values.size and max(int(values.max()), -int(values.min())) > 1 << bits:
        out.append((values & ((1 << bits) - 1)).astype(np.float64))
        values = values >> bits
    return [*out, values.astype(np.float64)]


def exact_dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T of int64 matrices, exact where the result fits."""
    bits = limb_bits(a.shape[1])
    out = np.zeros((len(a), len(b)), dtype=np.int64)
    others = limbs(b, bits)
    for i, x in enumerate(limbs(a, bits)):
        for j, y in enumerate(others):
            out += (x @ y.T).astype(np.int64) << bits * (i + j)
    return out


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of every part the first nearest entry and its squared distance."""
    apart = (parts**2).sum(axis=1)[:, None] - 2 * exact_dots(parts, book) + (book**2).sum(axis=1)[None, :]
    index = apart.argmin(axis=1)
    return index, apart[np.arange(len(parts)), index]


def cut(vectors: np.ndarray, parts: int) -> list[np.ndarray]:
    return np.split(vectors, parts, axis=1)


def entry_sums(books: list[np.ndarray], width: int):
    """A task's counts and sums of the parts of each entry, for ``mapInArrow``."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape = len(books), len(books[0])
        counts, sums = np.zeros(shape, dtype=np.int64), np.zeros((*shape, width // len(books)), dtype=np.int64)
        for batch in batches:
            for k, part in enumerate(cut(matrix(batch.column(0), width), len(books))):
                index, _ = nearest(part, books[k])
                counts[k] += np.bincount(index, minlength=shape[1])
                np.add.at(sums[k], index, part)
        k, e = np.nonzero(counts)
        yield pa.RecordBatch.from_pydict(
            {"part": k, "entry": e, "rows": counts[k, e], "sums": pa.array(list(sums[k, e]), pa.list_(pa.int64()))}
        )

    return of


def coder(books: list[np.ndarray], width: int):
    """An Arrow function from vectors to their code and squared error."""

    @F.arrow_udf("struct<code: string, error: long>")
    def of(vectors: pa.Array) -> pa.Array:
        found = [nearest(p, b) for p, b in zip(cut(matrix(vectors, width), len(books)), books)]
        codes = np.stack([index for index, _ in found], axis=1).astype(np.uint8)
        error = sum(apart for _, apart in found)
        return pa.StructArray.from_arrays(
            [pa.array([c.tobytes().hex() for c in codes], pa.string()), pa.array(error, pa.int64())], ["code", "error"]
        )

    return of


def next_books(books: list[np.ndarray], kept: DataFrame, width: int) -> list[np.ndarray]:
    """Each entry becomes the componentwise floor of its parts' mean; unused ones stay."""
    some = kept.select("x").mapInArrow(entry_sums(books, width), "part long, entry long, rows long, sums array<long>")
    # As many rows as there are entries reach the driver.
    whole = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width // len(books))]
    out = [b.copy() for b in books]
    for r in some.groupBy("part", "entry").agg(F.sum("rows").alias("rows"), *whole).collect():
        out[r.part][r.entry] = [s // r.rows for s in r[3:]]
    return out


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def with_codes(
    rows: DataFrame,
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
    scale: int = 4096,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every row with a finite vector.

    Rows whose vector is null or holds nulls or non-finite components are dropped. A
    component x is floor(scale * x); one beyond 2**25 is an error, since distances would
    leave a long. Vectors are cut into ``parts`` equal parts; where lengths differ or
    do not divide, vectors count as filled up with zeros to the greatest length, rounded
    up. Codebooks start from the ``entries`` smallest ids (at most 256; of repeated ids
    the smaller vectors first, null ids last); fewer rows give fewer entries. Repeated
    rows count one by one; null labels are one label. Extra columns are not carried. An
    empty table gives no rows.
    """
    if not 0 < entries <= 256:
        raise ValueError("an entry's number has two hexadecimal digits")
    names = {"vec_id": vec_id, "label": label}
    kept = integers(rows, vector, names, scale)
    n, longest = extent(kept, MOST)
    if not n:
        field = rows.schema[vec_id].dataType
        kinds = [("vec_id", field), ("code", StringType()), ("error", LongType()), ("label_error", LongType()), ("codebooks_sha256", StringType())]
        return rows.sparkSession.createDataFrame([], StructType([StructField(*k) for k in kinds]))
    width = max(-(-longest // parts), 1) * parts
    start = kept.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).select("x").collect()
    books = cut(matrix(pa.array([r.x for r in start], pa.list_(pa.int64())), width), parts)
    for _ in range(rounds):
        books = next_books(books, kept, width)
    coded = cut_lineage(kept.select("vec_id", "label", coder(books, width)("x").alias("made")).select("vec_id", "label", "made.*"))
    by_label = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of")
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")
    )


def op12_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return with_codes(table(spark, folder, "embeddings"))


def codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """The same codes in DuckDB: one assignment and one update for each round."""
    steps = [
        f"""kept as materialized (
  select vec_id, label, list_transform(embedding, lambda c: cast(floor({scale} * cast(c as double)) as bigint)) x,
    row_number() over (order by vec_id) r
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0
), pieces as materialized (
  select r, p, x[p * (len(x) // {parts}) + 1 : (p + 1) * (len(x) // {parts})] v from kept, range({parts}) t(p)
), book0 as materialized (select p, r - 1 e, v c from pieces where r <= {entries})"""
    ]
    for k in range(rounds + 1):
        # Distance and index in one number: its least is the first nearest entry.
        steps.append(f"""near{k} as materialized (
  select r, p, any_value(v) v, min(list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) * 256 + e) m
  from pieces join book{k} using (p) group by r, p
)""")
        if k < rounds:
            steps.append(f"""mean{k} as materialized (
  select p, e, list(cast((s - ((s % n + n) % n)) / n as bigint) order by i) c from (
    select p, e, i, cast(sum(y) as bigint) s, count(*) n
    from (select p, m % 256 e, unnest(v) y, generate_subscripts(v, 1) i from near{k}) group by p, e, i
  ) group by p, e
), book{k + 1} as materialized (
  select b.p, b.e, coalesce(m.c, b.c) c from book{k} b left join mean{k} m using (p, e)
)""")
    return f"""with {', '.join(steps)}, coded as (
  select r, string_agg(printf('%02x', cast(m % 256 as integer)), '' order by p) code, cast(sum(m // 256) as bigint) error
  from near{rounds} group by r
), whole as (select vec_id, label, code, error from kept join coded using (r)
), all_books as (select sha256(string_agg(array_to_string(c, ','), ',' order by p, e)) h from book{rounds})
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) label_error, h codebooks_sha256
from whole, all_books
"""


QUERIES = {"op12_vector_codes": (op12_vector_codes, codes_sql())}
