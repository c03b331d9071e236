"""Vectors as integers, for the operators that compute on them exactly."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.session import cut_lineage


def finite(vector: Column) -> Column:
    """Not null, and every component a finite number."""
    return F.coalesce(F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False))), F.lit(False))


def integers(rows: DataFrame, vector: str, columns: dict[str, str], scale: int, offset: int = 0) -> DataFrame:
    """A stored table of ``columns`` (name -> source) and ``x``: of every component c of a
    finite vector floor(scale * c) + offset, in double precision, as a long."""
    v, bound = F.col(f"`{vector}`"), F.lit(2.0**53)
    # Far beyond what ``extent`` lets pass, but still a long.
    scaled = lambda c: F.greatest(F.least(c.cast("double") * scale, bound), -bound)
    x = F.transform(v, lambda c: F.floor(scaled(c)) + F.lit(offset).cast("long"))
    return cut_lineage(rows.where(finite(v)).select(*[F.col(f"`{c}`").alias(n) for n, c in columns.items()], x.alias("x")))


def extent(kept: DataFrame, most: int) -> tuple[int, int]:
    """Rows of a stored table and its greatest length; a component beyond ``most`` is an error."""
    bound = F.max(F.array_max(F.transform("x", F.abs)))
    n, width, largest = kept.agg(F.count("*"), F.max(F.size("x")), bound).collect()[0]
    if (largest or 0) > most:
        raise ValueError(f"a component is {largest} as an integer; exact sums of long hold up to {most}")
    return n, width or 0


def matrix(lists: pa.Array, width: int, fill: int = 0) -> np.ndarray:
    """The lists as rows of int64; shorter ones are filled up to ``width``."""
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.full((len(sizes), width), fill, dtype=np.int64)
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return out
