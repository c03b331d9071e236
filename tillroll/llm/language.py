"""Language identification by segmentation-marginalised unigrams.

Every language has its own probabilities for the pieces of one fixed public
vocabulary. The probability of a word is the sum over all ways to cut it into
pieces, by a forward algorithm; that of a text is the product over its words. The
probabilities are learned by expectation maximisation: forward and backward sums
give the expected count of every piece over all segmentations.

Words are runs of letters in lower case with the vocabulary's word mark in front.
All words of one length are computed at once, for all languages. A word may have any
length: sums of long ones are scaled as they go, and very long ones are followed one
by one, with the pieces of all places found at once.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.llm.texts import held_out, slices, tokenizer_path, unused
from tillroll.workload.tables import table

VOCABULARY = "piece_bpe_32k.model"
MARK = "▁"
UNKNOWN = "und"
#: Documents of each language the model learns from, at most.
SAMPLE = 400
#: Rounds of expectation maximisation, and what is added to expected counts.
ROUNDS, ADDED = 4, 0.02
#: Probability of a character that is no piece, the same in every language.
STRAY = 1e-7
#: Letters up to which the sums of a word need no scaling and its scores are kept, and
#: up to which words of one length are computed together.
WORD, TOGETHER = 31, 256
#: Steps between scalings: so many stray characters are far from the least double.
STEPS = 16
#: Words whose scores a worker keeps.
KEPT = 400_000

LETTERS = re.compile(r"[^\W\d_]+")
BASE = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[str]:
    return LETTERS.findall(text.lower())


def roll(hashes: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Hashes of strings one character longer."""
    return (hashes ^ codes) * BASE + (hashes >> np.uint64(29))


@lru_cache(maxsize=2)
def pieces_of(path: str) -> list[str]:
    """The pieces made of letters, with or without the mark, in natural order."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    every = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    return sorted({p for p in every if p.removeprefix(MARK).isalpha() or p == MARK})


class Lattice:
    """Finds the pieces inside words: a sorted table of piece hashes."""

    def __init__(self, pieces: list[str]):
        hashes = np.zeros(len(pieces), dtype=np.uint64)
        for size in {len(p) for p in pieces}:
            at = [k for k, p in enumerate(pieces) if len(p) == size]
            codes = np.array([[ord(c) for c in pieces[k]] for k in at], dtype=np.uint64)
            h = np.zeros(len(at), dtype=np.uint64)
            for c in range(size):
                h = roll(h, codes[:, c])
            hashes[at] = h
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        self.longest = max(map(len, pieces), default=1)
        self.size = len(pieces)

    def spans(self, words: list[str]) -> Iterator[tuple[int, int, np.ndarray]]:
        """(from, to, piece of every word or -1) of all spans of equally long words;
        a single character that is no piece has the number after the last piece."""
        codes = np.array([[ord(c) for c in w] for w in words], dtype=np.uint64)
        n = codes.shape[1]
        for start in range(n):
            h = np.zeros(len(words), dtype=np.uint64)
            for end in range(start + 1, min(n, start + self.longest) + 1):
                h = roll(h, codes[:, end - 1])
                at = np.minimum(np.searchsorted(self.hashes, h), self.size - 1)
                found = np.where(self.hashes[at] == h, self.order[at], -1)
                if end == start + 1:
                    found = np.where(found < 0, self.size, found)
                yield start, end, found

    def endings(self, word: str) -> np.ndarray:
        """Row e, column k: the piece of k + 1 characters whose last is character e, or
        the number after the last piece (a stray character), or the next one (none)."""
        codes = np.array([ord(c) for c in word], dtype=np.uint64)
        n = len(codes)
        out = np.full((n, self.longest), self.size + 1)
        h = np.zeros(n, dtype=np.uint64)
        for k in range(min(self.longest, n)):
            h = roll(h[: n - k], codes[k:])
            at = np.minimum(np.searchsorted(self.hashes, h), self.size - 1)
            out[k:, k] = np.where(self.hashes[at] == h, self.order[at], self.size + (k > 0))
        return out


def log_sums(endings: np.ndarray, chances: np.ndarray) -> np.ndarray:
    """Row t: the log of the sum over all segmentations of the first t characters."""
    n, longest = endings.shape
    out = np.zeros((n + 1, chances.shape[1]))
    recent, scale = np.zeros((longest, chances.shape[1])), np.zeros(chances.shape[1])
    recent[0] = 1
    for e in range(n):
        new = (recent * chances[endings[e]]).sum(axis=0)
        recent[1:] = recent[:-1].copy()
        recent[0] = new
        out[e + 1] = scale + np.log(new)
        if e % STEPS == STEPS - 1:
            recent /= new
            scale = out[e + 1]
    return out


def expected_counts(endings: np.ndarray, chances: np.ndarray) -> np.ndarray:
    """How often each piece is expected in a word, over all its segmentations."""
    n, longest = endings.shape
    ahead = log_sums(endings, chances)
    beginnings = np.full_like(endings, len(chances) - 1)
    for k in range(min(longest, n)):
        beginnings[k:, k] = endings[k:, k][::-1]
    behind = log_sums(beginnings, chances)[::-1]
    out = np.zeros_like(chances)
    for k in range(min(longest, n)):
        share = np.exp(ahead[: n - k] + behind[k + 1 :] - ahead[n]) * chances[endings[k:, k]]
        for lang in range(chances.shape[1]):
            out[:, lang] += np.bincount(endings[k:, k], share[:, lang], len(chances))
    return out


@dataclass
class Model:
    """Languages, and for every piece (the last row: a stray character) its probability
    in each."""

    languages: list[str]
    path: str
    chances: np.ndarray
    index: dict[str, int] = field(default_factory=dict)
    scores: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))

    def lattice(self) -> Lattice:
        return _lattice(self.path)

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Log probability of each word in each language, over all segmentations."""
        out = np.zeros((len(words), len(self.languages)))
        lengths = np.array([len(w) for w in words])
        for n in np.unique(lengths[lengths <= TOGETHER]):
            at = np.flatnonzero(lengths == n)
            for some in np.array_split(at, -(-len(at) * int(n) // 400_000)):
                ahead = np.zeros((n + 2, len(some), len(self.languages)))
                ahead[0] = 1
                scaled = 0
                for start, end, piece in self.lattice().spans([MARK + words[k] for k in some]):
                    if n > WORD and start >= scaled + STEPS:
                        out[some] += np.log(ahead[start])
                        ahead[start + 1 :] /= ahead[start]
                        ahead[start] = 1
                        scaled = start
                    hit = np.flatnonzero(piece >= 0)
                    ahead[end, hit] += ahead[start, hit] * self.chances[piece[hit]]
                out[some] += np.log(ahead[n + 1])
        for k in np.flatnonzero(lengths > TOGETHER):
            out[k] = log_sums(self.lattice().endings(MARK + words[k]), with_none(self.chances))[-1]
        return out

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """The most likely language of each text and its posterior (equal priors)."""
        lists = [words_of(t) if t else [] for t in texts]
        if not self.languages:
            return [(UNKNOWN, 0.0)] * len(texts)
        before = len(self.index)
        # The longest last: their scores are not kept.
        fresh = sorted(set().union(*lists).difference(self.index), key=len)
        if fresh:
            self.index.update(zip(fresh, range(before, before + len(fresh))))
            new = self.word_scores(fresh)
            self.scores = np.concatenate([self.scores, new]) if before else new
        out = []
        for found in lists:
            if not found:
                out.append((UNKNOWN, 0.0))
                continue
            at = np.fromiter(map(self.index.__getitem__, found), np.int64, len(found))
            total = self.scores[at].sum(axis=0)
            share = np.exp(total - total.max())
            best = int(np.argmax(total))
            out.append((self.languages[best], float(share[best] / share.sum())))
        kept = 0 if len(self.index) > KEPT else sum(len(w) <= WORD for w in fresh)
        if kept < len(fresh):
            for word in fresh[kept:]:
                del self.index[word]
            self.scores = self.scores[: before + kept].copy()
        return out


def with_none(chances: np.ndarray) -> np.ndarray:
    """``chances`` and a row of zeros, for spans that are no piece."""
    return np.vstack([chances, np.zeros((1, chances.shape[1]))])


@lru_cache(maxsize=2)
def _lattice(path: str) -> Lattice:
    return Lattice(pieces_of(path))


def train(languages: list[str], words: list[str], counts: np.ndarray, path: str) -> Model:
    """``counts[k, l]``: how often word k was seen in language l."""
    n_pieces, n_langs = len(pieces_of(path)), len(languages)
    chances = np.zeros((n_pieces + 1, n_langs))
    chances[:n_pieces] = 1 / n_pieces
    chances[n_pieces] = STRAY
    model = Model(languages, path, chances)
    lengths = np.array([len(w) for w in words], dtype=int)
    groups = []
    for n in np.unique(lengths[lengths <= WORD]):
        at = np.flatnonzero(lengths == n)
        for some in np.array_split(at, -(-len(at) // 5000)):
            spans = [
                (start, end, hit, piece[hit])
                for start, end, piece in model.lattice().spans([MARK + words[k] for k in some])
                if len(hit := np.flatnonzero(piece >= 0))
            ]
            groups.append((n + 1, some, spans))
    long = [(k, model.lattice().endings(MARK + words[k])) for k in np.flatnonzero(lengths > WORD)]
    for _ in range(ROUNDS):
        expected = np.full((n_pieces + 1, n_langs), ADDED)
        for n, some, spans in groups:
            ahead, behind = np.zeros((2, n + 1, len(some), n_langs))
            ahead[0] = behind[n] = 1
            for start, end, hit, piece in spans:
                ahead[end, hit] += ahead[start, hit] * model.chances[piece]
            for start, end, hit, piece in sorted(spans, key=lambda s: -s[0]):
                behind[start, hit] += behind[end, hit] * model.chances[piece]
            weight = counts[some] / ahead[n]
            for start, end, hit, piece in spans:
                share = weight[hit] * ahead[start, hit] * model.chances[piece] * behind[end, hit]
                for lang in range(n_langs):
                    expected[:, lang] += np.bincount(piece, share[:, lang], n_pieces + 1)
        for k, endings in long:
            expected += counts[k] * expected_counts(endings, with_none(model.chances))[:-1]
        model.chances[:n_pieces] = expected[:n_pieces] / expected[:n_pieces].sum(axis=0)
    return model


WORDS_SEEN = "array<struct<word: string, n: long>>"
WORDS_SEEN_ARROW = pa.list_(pa.struct([("word", pa.string()), ("n", pa.int64())]))


def word_counter():
    """An Arrow function from texts to their words and how often each occurs."""

    @F.arrow_udf(WORDS_SEEN)
    def seen(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = [
                [{"word": w, "n": n} for w, n in Counter(words_of(t) if t else []).items()]
                for part in slices(batch)
                for t in part
            ]
            yield pa.array(out, WORDS_SEEN_ARROW)

    return seen


def learn(
    docs: DataFrame, path: str, lang: str = "lang", doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE
) -> Model:
    """A model of every language among the rows that are not held out and have one.

    Each language learns from at most ``sample`` documents, the first by a hash of
    the id; a task passes on no more of them than that.
    """
    rows = docs.where(~held_out(doc_id)).select(
        F.col(f"`{lang}`").alias("lang"), F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text")
    )
    first = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    chosen = rows.select("lang", "id").where("lang is not null and id is not null")
    chosen = chosen.withColumn("at", F.row_number().over(first)).where(F.col("at") <= sample)
    some = rows.join(F.broadcast(chosen.select("lang", "id").distinct()), ["lang", "id"])
    found = some.select("lang", F.inline(word_counter()("text"))).groupBy("lang", "word").agg(F.sum("n").alias("n"))
    # Bounded by the sample: the words of so many documents.
    seen = found.toArrow().to_pydict()
    languages = sorted(set(chosen.select("lang").distinct().toArrow()["lang"].to_pylist()))
    words = sorted(set(seen["word"]))
    place = {w: k for k, w in enumerate(words)}
    at = {w: k for k, w in enumerate(languages)}
    counts = np.zeros((len(words), len(languages)))
    for name, word, n in zip(seen["lang"], seen["word"], seen["n"]):
        counts[place[word], at[name]] += n
    return train(languages, words, counts, path)


def predictor(model):
    """An Arrow function from texts to (language, score) by a broadcast model."""

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = model.value
        for batch in batches:
            found = [p for part in slices(batch) for p in own.predict(part)]
            names, scores = [p[0] for p in found], [p[1] for p in found]
            yield pa.StructArray.from_arrays(
                [pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"]
            )

    return predict


def with_language(
    docs: DataFrame, model: Model, text: str = "text", names: tuple[str, str] = ("lang_pred", "score")
) -> DataFrame:
    """``docs`` with the likeliest language of each whole text and its posterior.

    A null text or one without a letter is ``und`` with score 0, as is every text
    if nothing was learned; equal chances go to the first language by name. Rows
    and other columns pass through, the two names are replaced.
    """
    lang, score = names
    known = docs.sparkSession.sparkContext.broadcast(model)
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in names]
    found = unused(docs, "found")
    made = docs.withColumn(found, predictor(known)(F.col(f"`{text}`")))
    return made.select(*kept, F.col(f"{found}.lang_pred").alias(lang), F.col(f"{found}.score").alias(score))


def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = learn(docs, tokenizer_path(VOCABULARY))
    return with_language(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score"
    )


QUERIES = {"op2_language_id": (op2_language_id, None)}
