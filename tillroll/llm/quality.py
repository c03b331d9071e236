"""Quality classifier: text statistics scored by an additive model (``gam``).

The model learns from a bounded sample of labelled rows (``SAMPLE``), taken by a
hash of the id; a few thousand numbers then score every whole text. Labels,
language, source and id never enter a score.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import gam
from tillroll.llm.texts import held_out, slices
from tillroll.workload.tables import table

#: Labelled rows the model learns from, at most.
SAMPLE = 8_000
#: A document is kept from this score on.
KEEP = 0.3

FEATURES = (
    "bytes", "words", "word_bytes", "upper", "digits", "not_ascii", "bars", "exclamations", "symbols",
    "stops", "commas", "other_marks", "words_per_line", "distinct", "top_word", "repeated_next", "repeated_lines", "capitals",
)


def features_of(text: str | None) -> list[float]:
    """Statistics of one whole text; an empty one has zeros."""
    raw = (text or "").encode()
    words = raw.split()
    if not words:
        return [0.0] * len(FEATURES)
    seen = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    n, w = len(raw), len(words)
    upper, lower, digits = int(seen[65:91].sum()), int(seen[97:123].sum()), int(seen[48:58].sum())
    marks = int(seen[33:48].sum() + seen[58:65].sum() + seen[91:97].sum() + seen[123:127].sum())
    symbols = int(seen[list(b"#$%&*")].sum())
    bars, cries, stops, commas = (int(seen[c]) for c in b"|!.,")
    counts = Counter(words)
    lines = [x for x in raw.split(b"\n") if x]
    alike = sum(map(eq, words, words[1:]))
    capitals = sum(x[:1].isupper() for x in words)
    return [
        np.log1p(n), np.log1p(w), (n - int(seen[32]) - int(seen[10])) / w, upper / (upper + lower + 1), digits / n,
        int(seen[128:].sum()) / n, bars / w, cries / w, symbols / w, stops / w, commas / w,
        (marks - symbols - bars - cries - stops - commas) / w, np.log1p(w / len(lines)),
        np.log(len(counts)) / np.log(w + 1), max(counts.values()) / w, alike / w, 1 - len(set(lines)) / len(lines), capitals / w,
    ]


def features():
    """An Arrow function from texts to their statistics."""

    @F.arrow_udf("array<double>")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = [features_of(t) for part in slices(batch) for t in part]
            yield pa.array(out, pa.list_(pa.float64()))

    return of


def scorer(model: gam.Gam):
    """An Arrow function from texts to scores."""

    @F.arrow_udf("double")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = [features_of(t) for part in slices(batch) for t in part]
            yield pa.array(model.score(np.array(rows).reshape(-1, len(FEATURES))), pa.float64())

    return of


def learn(
    docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE
) -> gam.Gam:
    """A model from at most ``sample`` labelled rows that are not held out.

    Labels other than 0 and 1 (null too) teach nothing; a document with several
    labels counts once for each.
    """
    some = (
        labels.where(~held_out(doc_id))
        .where(F.col(f"`{label}`").isin(0, 1) & F.col(f"`{doc_id}`").isNotNull())
        .select(F.col(f"`{doc_id}`").alias("labelled"), F.col(f"`{label}`").cast("int").alias("y"))
        .orderBy(F.xxhash64("labelled"), "labelled", "y")
        .limit(sample)
    )
    source = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    # The sample is bounded by its limit, so it may be broadcast.
    joined = source.join(F.broadcast(some), F.col("id") == F.col("labelled"))
    got = joined.select("id", "y", features()("text").alias("x")).limit(2 * sample).collect()
    got.sort(key=lambda r: (r["id"], r["y"], r["x"]))
    x = np.array([r["x"] for r in got], dtype=float).reshape(-1, len(FEATURES))
    return gam.fit(x, np.array([r["y"] for r in got], dtype=float))


def with_quality(
    docs: DataFrame, model: gam.Gam, text: str = "text", keep: float = KEEP, names: tuple[str, str] = ("score", "predicted")
) -> DataFrame:
    """``docs`` with a score from 0 to 1 and whether it reaches ``keep`` (1 or 0).

    Null and empty texts get the score of a text without words. Rows stay as they
    are, repeats too; other columns pass through, the two names are replaced.
    """
    score, predicted = names
    scored = docs.withColumn(score, scorer(model)(F.col(f"`{text}`")))
    return scored.withColumn(predicted, (F.col(f"`{score}`") >= keep).cast("int"))


def op5_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = learn(docs, table(spark, folder, "labels"))
    scored = with_quality(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


QUERIES = {"op5_quality_classifier": (op5_quality_classifier, None)}
