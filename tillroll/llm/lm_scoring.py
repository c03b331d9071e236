"""Documents scored by masked pseudo-likelihood.

Tokens are words. The ``WORDS`` most frequent ones of the whole corpus are tokens of
their own, in classes of ``MEMBERS`` words of like frequency; all others share ``SHARED``
tokens by a hash. A window network (``window_net``) predicts every token from both
sides, first its class and then the token in it, and the conditional log probabilities
of a document's tokens are summed.

Arrow splits texts and finds the different words of a slice, so that a word is looked up
once in it. Texts are turned into token numbers once, as a stored table of two bytes a
token. Training covers all tokens of all documents, each once: in every round each task
runs over its rows from the same start and hands back its weights, which are averaged by
the positions they were trained on. So the weights depend a little on how the rows are
dealt over tasks. What is gathered (word counts, weights of each task) grows with the
corpus; what reaches the driver is the token list and one set of weights.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.texts import SLICE_BYTES, unused
from tillroll.llm.window_net import Net, Trainer
from tillroll.session import cut_lineage
from tillroll.workload.tables import table

MEMBERS = 64
WORDS, SHARED = 80 * MEMBERS, 16 * MEMBERS
#: Rounds of training; in each, one position of ``EVERY`` is masked. The rounds
#: together mask every position once.
ROUNDS, EVERY = 2, 2
#: Different words a task counts before it passes them on, and whose numbers it keeps.
COUNTED, KEPT = 400_000, 400_000
#: Tokens laid end to end at once.
LAID = 1 << 19
#: A task hands back its weights in rows of so many.
PACKED = 128
#: A token's number as stored; all are below 2**16.
NUMBER = np.dtype("<u2")


def words_of(text: str | None) -> list[bytes]:
    return text.encode().lower().split() if text else []


def runs(lengths: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """(from, to) of rows that together have ``most`` at most; a longer row is alone."""
    ends, start = np.cumsum(lengths), 0
    while start < len(lengths):
        before = ends[start] - lengths[start]
        stop = max(int(np.searchsorted(ends, before + most, "right")), start + 1)
        yield start, stop
        start = stop


def words_in(texts: pa.Array) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """``words_of`` some texts at a time: all their words, and how many each text has."""
    texts = pc.fill_null(texts, "")
    for start, stop in runs(pc.binary_length(texts).to_numpy(), SLICE_BYTES):
        # Joined, a slice stands at the start of its bytes, as ascii_lower wants it.
        own = pa.concat_arrays([texts.slice(start, stop - start), pa.array([], texts.type)])
        found = pc.ascii_split_whitespace(pc.ascii_lower(own))
        words, lengths = found.flatten().cast(pa.binary()), found.value_lengths().to_numpy()
        # White space around a text leaves an empty word.
        proper = pc.binary_length(words).to_numpy() > 0
        if not proper.all():
            rows = np.repeat(np.arange(len(lengths)), lengths)
            words, lengths = words.filter(pa.array(proper)), np.bincount(rows[proper], minlength=len(lengths))
        yield words, lengths


class Numbers(dict):
    """Numbers of words; those of rare words follow from their hash."""

    def __missing__(self, word: bytes) -> int:
        number = WORDS + zlib.crc32(word) % SHARED
        if len(self) < KEPT:
            self[word] = number
        return number


class Tokens:
    """Numbers of words: the frequent ones in order of frequency, then the shared."""

    def __init__(self, frequent: list[bytes]):
        self.frequent = frequent
        self.known = pa.array(frequent, pa.binary())
        self.size = WORDS + SHARED
        self.numbers = Numbers()
        self.numbers.update((w, k) for k, w in enumerate(frequent))

    def __reduce__(self) -> tuple:
        return Tokens, (self.frequent,)

    def of(self, text: str | None) -> np.ndarray:
        found = words_of(text)
        return np.fromiter(map(self.numbers.__getitem__, found), np.int64, len(found))

    def of_words(self, words: pa.Array) -> np.ndarray:
        """The numbers of words; each different one is looked up once."""
        coded = words.dictionary_encode()
        places = pc.index_in(coded.dictionary, value_set=self.known)
        numbers, rare = pc.fill_null(places, 0).to_numpy().astype(NUMBER), places.is_null()
        others = coded.dictionary.filter(rare).to_numpy(zero_copy_only=False)
        shared = np.fromiter(map(zlib.crc32, others), np.int64, len(others)) % SHARED
        numbers[rare.to_numpy(zero_copy_only=False)] = WORDS + shared
        return numbers[coded.indices.to_numpy()]


def count_words(docs: DataFrame, text: str) -> DataFrame:
    """(word, n) over all documents; each task adds up its own first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, added = [], 0

        def summed() -> pa.Table:
            grouped = pa.concat_tables(held).group_by("word", use_threads=False)
            return grouped.aggregate([("n", "sum")]).select(["word", "n_sum"]).rename_columns(["word", "n"])

        for batch in batches:
            for words, _ in words_in(batch.column(0)):
                values, counts = words.value_counts().flatten()
                held.append(pa.table({"word": values, "n": counts}))
                added += len(values)
                if added > COUNTED:
                    held, added = [summed()], 0
                    if held[0].num_rows > COUNTED:
                        yield from held.pop().to_batches()
        if held:
            yield from summed().to_batches()

    made = docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(count, "word binary, n long")
    return made.groupBy("word").agg(F.sum("n").alias("n"))


def learn_tokens(docs: DataFrame, text: str) -> tuple[Tokens, np.ndarray]:
    """The tokens of the corpus, and how often each occurs in it."""
    counts = cut_lineage(count_words(docs, text))
    top = counts.orderBy(F.col("n").desc(), "word").limit(WORDS)
    found = top.collect()
    tokens = Tokens([bytes(r["word"]) for r in found])
    unigram = np.zeros(tokens.size)
    shared = F.lit(WORDS) + F.crc32("word") % SHARED
    rare = counts.join(F.broadcast(top.select("word")), "word", "left_anti")
    for r in rare.groupBy(shared.alias("k")).agg(F.sum("n").alias("n")).collect():
        unigram[r["k"]] = r["n"]
    for k, r in enumerate(found):
        unigram[k] = r["n"]
    return tokens, unigram


def with_numbers(docs: DataFrame, tokens: Tokens, text: str, out: str) -> DataFrame:
    """``docs`` with the token numbers of each text, in bytes, as column ``out``."""
    known = docs.sparkSession.sparkContext.broadcast(tokens)

    @F.arrow_udf("binary")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = known.value
        for batch in batches:
            found = [(own.of_words(words), lengths) for words, lengths in words_in(batch)]
            yield stored(*map(np.concatenate, zip(*found))) if found else pa.array([], pa.binary())

    return docs.withColumn(out, of(F.col(f"`{text}`")))


def stored(numbers: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """The numbers of each text in bytes."""
    ends = np.concatenate([[0], np.cumsum(lengths) * NUMBER.itemsize]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(ends), pa.py_buffer(numbers)])


def lists_of(found: pa.Array) -> pa.Array:
    """The lists of numbers that ``stored`` put into bytes."""
    found, kind = found.cast(pa.large_binary()), pa.from_numpy_dtype(NUMBER)
    if not len(found):
        return pa.array([], pa.large_list(kind))
    _, ends, data = found.buffers()
    ends = np.frombuffer(ends, np.int64)[found.offset : found.offset + len(found) + 1] // NUMBER.itemsize
    flat = pa.Array.from_buffers(kind, ends[-1], [None, data]) if ends[-1] else pa.array([], kind)
    return pa.LargeListArray.from_arrays(ends, flat)


def laid(lists: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Token numbers and lengths of texts, about ``LAID`` tokens at a time."""
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat, ends = lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(lengths)
    for start, stop in runs(lengths, LAID):
        yield flat[ends[start] - lengths[start] : ends[stop - 1]], lengths[start:stop]


def train_round(numbered: DataFrame, numbers: str, size: int, net: Net, turn: int) -> Net:
    """The average of what every task learns from its documents."""
    classes = size // MEMBERS
    known = numbered.sparkSession.sparkContext.broadcast(net.flat())

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer = Trainer(Net.shaped(known.value, classes, MEMBERS))
        for batch in batches:
            for tokens, lengths in laid(lists_of(batch.column(0))):
                trainer.learn(tokens, lengths, EVERY, turn)
        if trainer.positions:
            learned = trainer.net.flat().astype(np.float64) * trainer.positions
            rows = np.append(learned, np.zeros(-len(learned) % PACKED)).reshape(-1, PACKED)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(len(rows)), pa.int64()),
                    pa.array(list(rows), pa.list_(pa.float64())),
                    pa.array(np.full(len(rows), trainer.positions), pa.int64()),
                ],
                ["row", "weighted", "positions"],
            )

    made = numbered.select(F.col(f"`{numbers}`").alias("x")).mapInArrow(learn, "row long, weighted array<double>, positions long")
    means = [(F.sum(F.col("weighted")[i]) / F.sum("positions")).alias(f"w{i}") for i in range(PACKED)]
    # One set of weights, whatever the number of tasks.
    mean = made.groupBy("row").agg(*means).orderBy("row").toArrow()
    if not mean.num_rows:
        return net
    flat = np.stack([mean[f"w{i}"].to_numpy() for i in range(PACKED)], axis=1).ravel()
    return Net.shaped(flat, classes, MEMBERS)


def train(numbered: DataFrame, numbers: str, unigram: np.ndarray, rounds: int = ROUNDS) -> Net:
    net = Net.start(unigram, MEMBERS)
    for turn in range(rounds):
        net = train_round(numbered, numbers, len(unigram), net, turn)
    return net


def learn(docs: DataFrame, text: str = "text", rounds: int = ROUNDS) -> tuple[Tokens, Net]:
    tokens, unigram = learn_tokens(docs, text)
    own = docs.select(F.col(f"`{text}`").alias("text"))
    return tokens, train(cut_lineage(with_numbers(own, tokens, "text", "x").select("x")), "x", unigram, rounds)


def scorer(known, classes: int):
    """An Arrow function from token numbers to their summed log probability."""

    @F.arrow_udf("double")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        net = Net.shaped(known.value, classes, MEMBERS)
        for batch in batches:
            totals = [net.score(tokens, lengths) for tokens, lengths in laid(lists_of(batch))]
            yield pa.array(np.concatenate(totals) if totals else np.zeros(0), pa.float64())

    return of


NAMES = ("n_tokens", "pseudo_log_likelihood", "mean_log_likelihood")


def scored(numbered: DataFrame, numbers: str, net: Net, names: tuple[str, str, str] = NAMES) -> DataFrame:
    """Rows with token numbers, which give way to the columns ``names``."""
    n_tokens, total, mean = names
    known = numbered.sparkSession.sparkContext.broadcast(net.flat())
    made = unused(numbered, "made")
    size, sum_ = F.shiftright(F.octet_length(f"`{numbers}`"), NUMBER.itemsize // 2).cast("long"), F.col(made)
    kept = [F.col(f"`{c}`") for c in numbered.columns if c not in (*names, numbers)]
    return numbered.withColumn(made, scorer(known, net.members.shape[0])(F.col(f"`{numbers}`"))).select(
        *kept, size.alias(n_tokens), sum_.alias(total), F.when(size > 0, sum_ / size).alias(mean)
    )


def with_pseudo_likelihood(
    docs: DataFrame, model: tuple[Tokens, Net], text: str = "text", names: tuple[str, str, str] = NAMES
) -> DataFrame:
    """``docs`` with its tokens, their summed conditional log probabilities and the mean.

    A null text or one without words has no tokens, sum 0 and a null mean. Rows
    stay, repeats too; other columns pass through, the names are replaced. Without
    any words to learn from every token of a class is equally likely. An empty table
    gives no rows.
    """
    tokens, net = model
    numbers = unused(docs, "numbers")
    return scored(with_numbers(docs, tokens, text, numbers), numbers, net, names)


def op4_masked_pseudo_likelihood(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    tokens, unigram = learn_tokens(docs, "text")
    numbered = cut_lineage(with_numbers(docs, tokens, "text", "numbers").select("doc_id", "numbers"))
    return scored(numbered, "numbers", train(numbered, "numbers", unigram))


QUERIES = {"op4_masked_pseudo_likelihood": (op4_masked_pseudo_likelihood, None)}
