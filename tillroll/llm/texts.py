"""Helpers the corpus operators share: Arrow slices, tokenizers, held-out rows."""

from __future__ import annotations

import functools
import os
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A worker handles this many bytes of text at a time.
SLICE_BYTES = 1 << 21


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[list[str | None]]:
    """The texts in order, in lists of about ``most`` bytes; a longer text is alone."""
    sizes = texts.cast(pa.large_string()).cast(pa.large_binary())
    lengths = pa.compute.binary_length(sizes).fill_null(0).to_pylist()
    start = total = 0
    for i, n in enumerate(lengths):
        if i > start and total + n > most:
            yield texts.slice(start, i - start).to_pylist()
            start, total = i, 0
        total += n
    if start < len(lengths):
        yield texts.slice(start).to_pylist()


def by_bytes(items: Iterable, size, most: int) -> Iterator[list]:
    """Lists of items of about ``most`` bytes each."""
    out: list = []
    total = 0
    for item in items:
        n = size(item)
        if out and total + n > most:
            yield out
            out, total = [], 0
        out.append(item)
        total += n
    if out:
        yield out


def tokenizer_path(name: str) -> str:
    """Where the installed public vocabulary ``name`` lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.lru_cache(maxsize=4)
def tokenizer(path: str):
    """The tokenizer of ``path``, once per worker; Spark does the parallel work."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    out = Tokenizer.from_file(path)
    out.no_truncation()
    out.no_padding()
    return out


def unused(df: DataFrame, name: str) -> str:
    """``name``, or a longer one if ``df`` has such a column."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows no model learns from: crc32 of the id's text divides by five."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))
