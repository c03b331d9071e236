"""Catalogue vocabulary and typo repair.

A word is repaired to the vocabulary word with the best similarity ratio
2M / (a + b), where M counts matched characters, if that is at least 0.90.
Such a pair differs by at most a tenth of its joint length in single-character
removals, which gives exact equi-join keys: no word meets the whole vocabulary.
"""

from __future__ import annotations

import difflib
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions import fixed_values as fixed
from tillroll.operators.skew import DEFAULT_RULE, HotRule, fits, lookup_join
from tillroll.session import cut_lineage
from tillroll.sources.readers import inline_rows

# With a joint length below 11 no two different words reach the cutoff.
SHORTEST_PAIR = 11
# From this joint length on, three or more removals are allowed.
LONG_PAIR = 30
# Words of a pair shorter than LONG_PAIR have at most this many letters.
LONGEST_SHORT_WORD = 15
SHORTEST_LONG_WORD = 14
# From this length on a word may lose two letters.
SHORTEST_TWO = 11
# Vocabulary keys (short texts) up to this many rows are broadcast.
MOST_BROADCAST_KEYS = 2_000_000


def vocabulary(master: DataFrame, column: str) -> DataFrame:
    """Distinct words of more than one letter, plus the fixed key terms."""
    words = master.select(F.explode(F.split(F.col(column), " ")).alias("word"))
    terms = inline_rows(master.sparkSession, [(t,) for t in fixed.KEY_TERMS], "word string")
    return words.unionByName(terms).where(F.length("word") > 1).distinct()


def _needs_check(word: Column) -> Column:
    """Words that could be repaired at all: long enough, no volume, no number."""
    return (
        (F.length(word) * 2 >= F.lit(SHORTEST_PAIR - 1))
        & ~word.contains(fixed.VOLUME_SUFFIX)
        & ~word.rlike("^[0-9]*$")
    )


def _one_removed(word: Column) -> Column:
    return F.array_distinct(
        F.transform(
            F.sequence(F.lit(1), F.length(word)),
            lambda i: F.concat(
                F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, F.length(word))
            ),
        )
    )


def _allowed(joint: Column) -> Column:
    return F.floor(joint / 10).cast("int")


def _hashed(kind: str, *parts: Column) -> Column:
    """A key: words of equal parts meet; others that do are told apart by their score."""
    return F.xxhash64(F.lit(kind), *parts)


def _without(word: Column, i: Column) -> Column:
    """The word without its letter ``i``; all of it for 0."""
    rest = F.substring(word, i + 1, F.length(word))
    return F.when(i == 0, word).otherwise(F.concat(F.substring(word, F.lit(1), i - 1), rest))


def _removal_keys(words: DataFrame) -> DataFrame:
    """The words with no letter or one removed."""
    n = F.length("word")
    one = words.where(n <= LONGEST_SHORT_WORD).select("word", F.explode(F.sequence(F.lit(0), n)).alias("i"))
    i = F.col("i")
    return one.select("word", _hashed("=", _without(F.col("word"), i)).alias("key"), F.least(i, F.lit(1)).alias("removed"))


def _two_removed_keys(vocab: DataFrame) -> DataFrame:
    """The words with two letters removed, for partners shorter by two.

    These are only needed from 11 letters on.
    """
    some = vocab.where(F.length("word").between(SHORTEST_TWO, LONGEST_SHORT_WORD))
    two = F.array_distinct(F.flatten(F.transform(_one_removed(F.col("word")), _one_removed)))
    left = some.select("word", F.explode(two).alias("left"))
    return left.select("word", _hashed("=", F.col("left")).alias("key"), F.lit(2).alias("removed"))


def _half_keys(df: DataFrame, as_candidate: bool) -> DataFrame:
    """Keys of a word and a candidate that is the word without two letters.

    Of the two, at most one stands before the end of the candidate's first half, or none
    after it. So the halves' ends agree: the first half is the word's start of one letter
    more, without one, or the second is the word's end. That takes a key for each
    letter of half a word, where removing any two letters takes one for each pair.
    """
    word = F.col("word")
    n = F.length(word) if as_candidate else F.length(word) - 2
    half = F.floor(n / 2).cast("int")
    some = df.where(n.between(SHORTEST_TWO - 2, LONGEST_SHORT_WORD - 2))
    end = _hashed("end", n, F.substring(word, F.length(word) - (n - half) + 1, n - half))
    removed = F.lit(0 if as_candidate else 2).alias("removed")
    ends = some.select("word", end.alias("key"), removed)
    if as_candidate:
        starts = some.select("word", _hashed("start", n, F.substring(word, F.lit(1), half)).alias("key"), removed)
    else:
        each = some.select("word", F.explode(F.sequence(F.lit(1), half + 1)).alias("i"))
        start = _without(F.substring(word, F.lit(1), half + 1), F.col("i"))
        starts = each.select("word", _hashed("start", n, start).alias("key"), removed)
    return starts.union(ends)


def _pieces(word: Column, as_candidate: bool) -> Column:
    """Keys of a long word: a short piece of it that the candidate holds too.

    The word is cut into pieces of ``size`` letters from its start. A pair
    within the cutoff loses at most ``d``, a tenth of the joint length, and that is
    at most 2/9 of the word's length, so it touches fewer pieces than there are
    (sizes follow from that). One piece is in the candidate unchanged, shifted by at
    most ``d``. Up to 63 letters a key names the piece, and a candidate the few pieces
    that near; beyond, it names a stretch of letters longer than any ``d``, and a
    candidate its own stretch and both neighbours. Sizes and stretches depend on the
    word's length class, a power of two; a candidate has at most three classes of
    partners. The words, which are many, have the few keys; those of a long one are in
    proportion to its length on both sides.
    """
    n = F.length(word)

    def of_class(k: Column) -> Column:
        size = F.when(k >= 5, 4).otherwise(3)
        # Twice a class's shortest length is above its longest, so this is above 2/9 of it.
        stretch = F.pow(F.lit(2.0), k - 1)
        last = F.greatest(n - size, F.lit(0))
        at = F.sequence(F.lit(0), last, F.lit(1) if as_candidate else size)

        def keys(i: Column) -> Column:
            home = F.floor(i / stretch).cast("int")
            d = F.floor(n * 2 / 9)
            first = F.greatest(F.ceil((i - d) / size), F.lit(0)).cast("int")
            if as_candidate:
                near = F.sequence(first, F.floor((i + d) / size).cast("int"))
                homes = F.when(k < 6, near).otherwise(F.array(home - 1, home, home + 1))
            else:
                homes = F.array(F.when(k < 6, (i / size).cast("int")).otherwise(home))
            text = F.substring(word, i + 1, size)
            return F.transform(homes, lambda h: _hashed("#", k, h, text))

        return F.flatten(F.transform(at, keys))

    def length_class(length: Column) -> Column:
        return F.floor(F.log2(length)).cast("int")

    if not as_candidate:
        return of_class(length_class(n))
    # 0.9 <= 2 min / (n + m)
    classes = F.sequence(length_class(F.ceil(n * 9 / 11)), length_class(F.floor(n * 11 / 9)))
    return F.array_distinct(F.flatten(F.transform(classes, of_class)))


def _piece_keys(df: DataFrame, as_candidate: bool) -> DataFrame:
    long = df.where(F.length("word") >= SHORTEST_LONG_WORD)
    pieces = _pieces(F.col("word"), as_candidate)
    return long.select("word", F.explode(pieces).alias("key"), F.lit(0).alias("removed"))


def _keys(df: DataFrame, out: str, as_candidate: bool) -> DataFrame:
    """``(out, key, removed)``: one row per key of each word.

    Keys are numbers made row by row from an exploded position, not arrays of texts.
    """
    kinds = [_removal_keys(df), _half_keys(df, as_candidate), _piece_keys(df, as_candidate)]
    if as_candidate:
        kinds.append(_two_removed_keys(df))
    keys = reduce(DataFrame.union, kinds)
    return keys.select(F.col("word").alias(out), "key", F.col("removed").alias(f"removed_{out}"))


def _within_reach(word: Column, candidate: Column) -> Column:
    """Whether few enough edits lead from one word to the other.

    M matched letters leave n + m - 2M to be removed on either side, which are as many
    edits or more; at the cutoff that is a tenth of the joint length, and it is odd
    where that length is. Native, and it stops counting at the bound.
    """
    joint = F.length(word) + F.length(candidate)
    most = _allowed(joint) - (joint - _allowed(joint)) % 2
    return F.call_function("levenshtein", word, candidate, most) >= 0


def candidate_pairs(words: DataFrame, vocab: DataFrame) -> DataFrame:
    """Distinct pairs that can reach the cutoff; no pair that does is missing.

    A pair goes on only if the edits between its words are few enough. The keys
    of a vocabulary of usual size are broadcast after counting them, so the many
    keys of the words are not shuffled.
    """
    right = _keys(vocab, "candidate", True)
    if right.count() <= MOST_BROADCAST_KEYS:
        right = F.broadcast(right)
    joint = F.length("word") + F.length("candidate")
    removed = F.col("removed_word") + F.col("removed_candidate")
    least = F.least(F.length("word"), F.length("candidate"))
    short = (joint >= SHORTEST_PAIR) & (removed <= _allowed(joint))
    near = 20 * least >= 9 * joint
    return (
        _keys(words, "word", False)
        .join(right, "key")
        .where(near & ((joint >= LONG_PAIR) | short))
        .select("word", "candidate")
        .distinct()
        .where(_within_reach(F.col("word"), F.col("candidate")))
    )


@F.pandas_udf(T.DoubleType())
def similarity(candidate: pd.Series, word: pd.Series) -> pd.Series:
    """The standard library's matching ratio of each pair."""
    matcher = difflib.SequenceMatcher()
    out = []
    last = None
    for c, w in zip(candidate, word):
        if w != last:
            matcher.set_seq2(w)
            last = w
        matcher.set_seq1(c)
        out.append(matcher.ratio())
    return pd.Series(out, dtype="float64")


def corrections(
    words: DataFrame, vocab: DataFrame, cutoff: float = fixed.TYPO_CUTOFF
) -> DataFrame:
    """``(word, repaired)`` for the distinct words that have a close match.

    Equal scores go to the greatest candidate.
    """
    if cutoff < fixed.TYPO_CUTOFF:
        raise ValueError("the candidate keys are complete from 0.90 on")
    vocab = cut_lineage(vocab)
    unknown = cut_lineage(
        words.select("word")
        .where(_needs_check(F.col("word")))
        .distinct()
        .join(vocab, "word", "left_anti")
    )
    scored = candidate_pairs(unknown, vocab).withColumn("score", similarity("candidate", "word"))
    return (
        scored.where(F.col("score") >= F.lit(cutoff))
        .groupBy("word")
        .agg(F.max(F.struct("score", "candidate")).alias("best"))
        .select("word", F.col("best.candidate").alias("repaired"))
    )


@F.pandas_udf(T.StringType())
def _mended(text: pd.Series, words: pd.Series, repairs: pd.Series) -> pd.Series:
    """Each text with its ``words`` replaced; a word whose repair is null goes.

    A map column is searched from its start for every word, so this looks them up in
    a dictionary: a text costs its own length.
    """
    out = []
    for t, w, r in zip(text, words, repairs):
        if t is None:
            out.append(None)
            continue
        found = dict(zip(w, r))
        kept = (found.get(part, part) for part in t.split(" "))
        out.append(" ".join(part for part in kept if part is not None))
    return pd.Series(out, dtype="object")


def repair_typos(
    df: DataFrame,
    text: str,
    vocab: DataFrame,
    out: str,
    unmatched: str = "keep",
    rule: HotRule | None = DEFAULT_RULE,
    broadcast_rows: int = 1_000_000,
) -> DataFrame:
    """``text`` with its misspelt words repaired, as column ``out``.

    Only words and hashes of texts travel: the repairs of a text come back as one small
    map, and each row mends its own text. Few repairs are broadcast and meet the words
    where they are; many meet the words of distinct texts, so repeated rows, of one id or
    of many, cost one text. ``unmatched="drop"`` also removes unknown words that have no
    close match.
    """
    if unmatched not in ("keep", "drop"):
        raise ValueError("unmatched is 'keep' or 'drop'")
    name = [f"_text{i}" for i in (1, 2)]
    source = F.col(text)
    # Texts are told apart by two hashes, 128 bits, so that no join carries a text.
    rows = cut_lineage(df.withColumns({name[0]: F.xxhash64(source), name[1]: F.xxhash64(F.lit("other"), source)}))
    texts = rows.where(source != "")
    words = texts.select(F.explode(F.split(source, " ")).alias("word"))
    if unmatched == "drop":
        words = cut_lineage(words.distinct())
    found = corrections(words, vocab)
    if unmatched == "drop":
        # Every checked word that is unknown gets an entry, NULL when unmatched.
        unknown = (
            words.where(~F.col("word").contains(fixed.VOLUME_SUFFIX))
            .where(~F.col("word").rlike("^[0-9]*$"))
            .join(vocab, "word", "left_anti")
        )
        found = unknown.join(found, "word", "left")
    found = cut_lineage(found)
    if broadcast_rows and fits(found, broadcast_rows):
        tokens = texts.select(*name, F.explode(F.split(source, " ")).alias("word"))
        hits = tokens.join(F.broadcast(found), "word")
    else:
        one = texts.groupBy(*name).agg(F.first(source).alias("_text"))
        word = F.explode(F.array_distinct(F.split("_text", " "))).alias("word")
        hits = lookup_join(cut_lineage(one.select(*name, word)), found, ["word"], "inner", rule, 0)
    per_text = hits.groupBy(*name).agg(
        F.map_from_entries(F.collect_set(F.struct("word", "repaired"))).alias("_repairs")
    )
    repairs = F.col("_repairs")
    known = F.when(repairs.isNotNull(), F.make_valid_utf8(source))
    mended = _mended(known, F.map_keys(repairs), F.map_values(repairs))
    joined = lookup_join(rows, cut_lineage(per_text), name, "left", rule, broadcast_rows)
    mend = F.when(source != "", F.when(repairs.isNull(), source).otherwise(mended))
    return joined.withColumn(out, mend).drop(*name, "_repairs")
