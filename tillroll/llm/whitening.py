"""Embedding whitening by pivoted Cholesky and one-sided Jacobi.

Vectors become integers x, so their count n and sums S are exact and n*x - S is the
exact centred vector times n. Centred vectors are multiplied in every task, and Spark
adds the tasks' scatter matrices. On the driver, whose work is one matrix as wide as a
vector, the scatter M is factored with pivoting, P'MP = LL', stopping where the rest
is nothing but rounding. One-sided Jacobi then rotates the columns of L against each other until
they are orthogonal: LL' does not change, the squared column norms are the eigenvalues
of M and the normalised columns, rows back in their places, its eigenvectors. Working
on L keeps small eigenvalues to high relative precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from tillroll.llm.integer_vectors import extent, integers, matrix
from tillroll.session import cut_lineage
from tillroll.workload.tables import table

SCALE, OFFSET = 1024, 100_000
#: Integers up to here: n*x stays a long for 2**30 rows.
MOST = 2**32
#: Sweeps of rotations; each squares what is left off the diagonal, so few are needed.
SWEEPS = 60
ROUNDING = np.finfo(np.float64).eps


def pivoted_cholesky(m: np.ndarray) -> np.ndarray:
    """L with L @ L.T = m for a positive semidefinite m, rows in their own places; as many
    columns as m has rank, at the precision of its entries."""
    rest, columns = np.array(m, dtype=np.float64), []
    least = len(m) * ROUNDING * max(np.diag(m).max(initial=0.0), 0.0)
    for _ in range(len(m)):
        at = int(np.diag(rest).argmax())
        if rest[at, at] <= least:
            break
        column = rest[:, at] / np.sqrt(rest[at, at])
        rest -= np.outer(column, column)
        rest[at, :] = rest[:, at] = 0.0
        columns.append(column)
    return np.array(columns).T.reshape(len(m), len(columns))


def tournament(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rounds of disjoint pairs in which each of n columns meets every other once."""
    ring = list(range(n + n % 2))
    for _ in range(len(ring) - 1):
        half = len(ring) // 2
        pairs = [(a, b) for a, b in zip(ring[:half], ring[:half - 1:-1]) if max(a, b) < n]
        if pairs:
            yield tuple(np.array(pairs).T)
        ring = [ring[0], ring[-1], *ring[1:-1]]


def rotated(columns: np.ndarray) -> np.ndarray:
    """The columns after one-sided Jacobi rotations: orthogonal, with the same L @ L.T."""
    out = np.array(columns, dtype=np.float64)
    rounds = list(tournament(out.shape[1]))
    for _ in range(SWEEPS):
        still = True
        for a, b in rounds:
            x, y = out[:, a], out[:, b]
            p, q, r = (x * x).sum(axis=0), (y * y).sum(axis=0), (x * y).sum(axis=0)
            turn = np.abs(r) > 4 * ROUNDING * np.sqrt(p * q)
            if not turn.any():
                continue
            still = False
            half = (q - p) / (2 * np.where(turn, r, 1.0))
            tangent = np.where(turn, np.where(half < 0, -1.0, 1.0) / (np.abs(half) + np.hypot(1.0, half)), 0.0)
            cosine = 1 / np.sqrt(1 + tangent**2)
            sine = cosine * tangent
            out[:, a], out[:, b] = cosine * x - sine * y, sine * x + cosine * y
        if still:
            break
    return out


def principal(scatter: np.ndarray, n: int, most: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Up to ``most`` unit components as columns, their eigenvalues of the covariance
    scatter / n, largest first, and its trace."""
    columns = rotated(pivoted_cholesky(scatter))
    norms = np.sqrt((columns**2).sum(axis=0))
    order = np.argsort(-norms, kind="stable")[:most]
    return columns[:, order] / norms[order], norms[order] ** 2 / n, float(np.trace(scatter)) / n


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """n*x - S exactly, and x - S/n."""
    times = n * x - sums
    return times, times / n


def column_sums(width: int, fill: int):
    """A task's sums by dimension in one row."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, dtype=np.int64)
        for batch in batches:
            total += matrix(batch.column(0), width, fill).sum(axis=0)
        yield pa.RecordBatch.from_pydict({"sums": pa.array([total], pa.list_(pa.int64()))})

    return of


def scatters(width: int, fill: int, n: int, sums: np.ndarray):
    """A task's scatter of the centred vectors, one row for each of its rows."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            _, apart = centred(matrix(batch.column(0), width, fill), n, sums)
            total += apart.T @ apart
        yield pa.RecordBatch.from_pydict({"row": np.arange(width, dtype=np.int32), "sums": pa.array(list(total), pa.list_(pa.float64()))})

    return of


def squares(times: np.ndarray) -> list[int | None]:
    """Exact sums of squares; None beyond a long."""
    if not times.size:
        return [0] * len(times)
    if float(np.abs(times).max()) ** 2 * times.shape[1] < 2**62:
        return (times**2).sum(axis=1).tolist()
    found = (times.astype(object) ** 2).sum(axis=1).tolist()
    return [s if s < 2**63 else None for s in found]


def whitener(fill: int, n: int, sums: np.ndarray, components: np.ndarray, spread: np.ndarray):
    """An Arrow function from x to its deviation and its whitened coordinates."""

    @F.arrow_udf("struct<deviation: long, whitened: array<double>>")
    def of(vectors: pa.Array) -> pa.Array:
        times, apart = centred(matrix(vectors, len(sums), fill), n, sums)
        made = apart @ components / spread
        return pa.StructArray.from_arrays(
            [pa.array(squares(times), pa.int64()), pa.array(list(made), pa.list_(pa.float64()))], ["deviation", "whitened"]
        )

    return of


def summed(df: DataFrame, width: int, *keys: str) -> list:
    """The rows of ``sums`` added up by ``keys``, on the driver: one for each key."""
    return df.groupBy(*keys).agg(*[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)]).collect()


def identity_error(made: DataFrame, n: int, count: int) -> float:
    """The largest entry by which the whitened rows' covariance, centred, is not the identity."""
    w = [F.col("whitened")[i] for i in range(count)]
    means = made.agg(*[(F.sum(x) / n).alias(f"m{i}") for i, x in enumerate(w)]).collect()[0]
    apart = [x - F.lit(float(m)) for x, m in zip(w, means)]
    pairs = [(i, j) for i in range(count) for j in range(i + 1)]
    products = made.agg(*[(F.sum(apart[i] * apart[j]) / n).alias(f"p{k}") for k, (i, j) in enumerate(pairs)]).collect()[0]
    return max(abs(p - (i == j)) for p, (i, j) in zip(products, pairs))


def whiten(rows: DataFrame, components: int = 8, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): for every row
    with a finite vector one row for each component, numbered from 1.

    Rows whose vector is null or holds nulls or non-finite components are dropped;
    all others are fitted. x is floor(1024 * c) + 100000; beyond 2**32 it is an error.
    Shorter vectors count as filled up with zeros to the greatest length. A covariance
    of lower rank gives as many components as it has rank (equal vectors, or a single
    one: no rows). ``deviation`` is null where it exceeds a long. Repeated rows count
    and are returned one by one, null ids too. Extra columns are not carried. An empty
    table gives no rows. Components of equal eigenvalues are any basis of theirs.
    """
    if components < 1:
        raise ValueError("at least one component is asked for")
    spark = rows.sparkSession
    kept = integers(rows, vector, {"vec_id": vec_id}, SCALE, OFFSET)
    n, width = extent(kept, MOST)
    found = spread = np.zeros((0,))
    if width:
        x = kept.select("x")
        sums = np.array(summed(x.mapInArrow(column_sums(width, OFFSET), "sums array<long>"), width)[0], dtype=np.int64)
        scatter = np.zeros((width, width))
        for r in summed(x.mapInArrow(scatters(width, OFFSET, n, sums), "row int, sums array<double>"), width, "row"):
            scatter[r.row] = r[1:]
        found, spread, trace = principal((scatter + scatter.T) / 2, n, components)
    if not len(spread):
        fields = [("component", IntegerType()), ("n", LongType()), ("deviation", LongType())]
        fields += [(name, DoubleType()) for name in ("whitened", "explained", "identity_error")]
        kinds = [("vec_id", rows.schema[vec_id].dataType), *fields]
        return spark.createDataFrame([], StructType([StructField(*k) for k in kinds]))
    made = cut_lineage(
        kept.select("vec_id", whitener(OFFSET, n, sums, found, np.sqrt(spread))("x").alias("made")).select("vec_id", "made.*")
    )
    error = identity_error(made, n, len(spread))
    explained = F.array(*[F.lit(float(e / trace)) for e in spread])
    return made.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        explained[F.col("at")].alias("explained"),
        F.lit(float(error)).alias("identity_error"),
    )


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whiten(table(spark, folder, "embeddings"))


QUERIES = {"op13_whitening": (op13_whitening, None)}
