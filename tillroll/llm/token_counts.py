"""Token counts: Arrow batches in, lengths out.

A batch is balanced by bytes and every text is cut at ASCII white space, which no
token of the vocabulary crosses (its normaliser turns white space into a space
that its pre-tokenizer drops). Texts of any length therefore cost bounded memory,
and a piece seen before is not encoded again.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.texts import by_bytes, slices, tokenizer, tokenizer_path
from tillroll.workload.tables import table

VOCABULARY = "word_bpe_49k.json"
#: Pieces whose counts a worker keeps, and the longest piece it keeps.
KEPT, KEPT_BYTES = 500_000, 64
#: Bytes of new pieces that are encoded at once.
ENCODE_BYTES = 1 << 18

_counts: dict[str, dict[bytes, int]] = {}


def count_batch(texts: list[str | None], path: str) -> list[int]:
    """Tokens of each text, as the library counts the whole text."""
    kept = _counts.setdefault(path, {})
    pieces = [t.encode().split() if t else [] for t in texts]
    fresh = set(chain.from_iterable(pieces)).difference(kept)
    passing: list[bytes] = []
    if fresh:
        encode = tokenizer(path).encode_batch_fast
        room = KEPT - len(kept)
        # Equal sizes stand together, so a batch holds no single outlier.
        for group in by_bytes(sorted(fresh, key=len), len, ENCODE_BYTES):
            found = encode([p.decode() for p in group], add_special_tokens=False)
            kept.update(zip(group, map(len, found)))
            passing += [p for p in group if len(p) > KEPT_BYTES] if room > 0 else group
            room -= len(group)
    out = [sum(map(kept.__getitem__, p)) for p in pieces]
    for p in passing:
        del kept[p]
    return out


def token_counter(path: str):
    """An Arrow function from texts to their token counts (null: 0)."""

    @F.arrow_udf("long")
    def counts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = [n for part in slices(batch) for n in count_batch(part, path)]
            yield pa.array(out, pa.int64())

    return counts


def with_token_counts(
    docs: DataFrame,
    path: str,
    limit: int,
    text: str = "text",
    names: tuple[str, str, str] = ("n_bytes", "n_tokens", "over_limit"),
) -> DataFrame:
    """``docs`` with the bytes and tokens of ``text``, and whether they exceed ``limit``.

    ``path`` names a vocabulary whose pre-tokenizer drops white space. A null text
    counts as empty. Other columns pass through; one of the new names is replaced.
    Rows are neither dropped nor merged, so ties and repeats keep their rows.
    """
    n_bytes, n_tokens, over = names
    source = F.col(f"`{text}`")
    return docs.withColumns(
        {n_bytes: F.octet_length(F.coalesce(source, F.lit(""))).cast("long"), n_tokens: token_counter(path)(source)}
    ).withColumn(over, F.col(f"`{n_tokens}`") > limit)


def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    counted = with_token_counts(docs, tokenizer_path(VOCABULARY), limit=2048)
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


QUERIES = {"op8_token_counts": (op8_token_counts, None)}
