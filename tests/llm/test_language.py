import math
from fractions import Fraction

import numpy as np

import __spark_entry__ as repo
from tillroll.llm import language as lg
from tillroll.llm.texts import tokenizer_path

PATH = tokenizer_path(lg.VOCABULARY)


def all_segmentations(word, pieces):
    if not word:
        yield []
    for n in range(1, len(word) + 1):
        if word[:n] in pieces or n == 1:
            for rest in all_segmentations(word[n:], pieces):
                yield [word[:n], *rest]


def test_word_scores_sum_all_segmentations():
    pieces = lg.pieces_of(PATH)
    at = {p: k for k, p in enumerate(pieces)}
    chances = np.random.default_rng(1).uniform(size=(len(pieces) + 1, 2))
    chances /= chances.sum(axis=0)
    model = lg.Model(["x", "y"], PATH, chances)
    words = ["the", "a", "cat", "über", "日x", "nation", "qzx"]
    got = model.word_scores(words)
    for word, scores in zip(words, got):
        total = sum(np.prod([chances[at.get(p, len(pieces))] for p in cut], axis=0) for cut in all_segmentations("▁" + word, at))
        assert np.allclose(scores, np.log(total))


def exact(word, at, chances):
    """The forward sum of one language in exact fractions."""
    ahead = [Fraction(1)]
    for end in range(1, len(word) + 1):
        starts = [k for k in range(max(0, end - 20), end) if word[k:end] in at or k == end - 1]
        ahead.append(sum(ahead[k] * Fraction(chances[at.get(word[k:end], len(at))]) for k in starts))
    return math.log(ahead[-1].numerator) - math.log(ahead[-1].denominator)


def test_long_words_are_summed_whole():
    pieces = lg.pieces_of(PATH)
    assert max(map(len, pieces)) == 16
    at = {p: k for k, p in enumerate(pieces)}
    chances = np.random.default_rng(2).uniform(size=(len(pieces) + 1, 2)) ** 9
    chances /= chances.sum(axis=0)
    model = lg.Model(["x", "y"], PATH, chances)
    words = ["nation" * 5, "internationalresponsibilities" * 4, "ünstqx" * 20, "responsibilities" * 17, "日本語のqz" * 60, "q" * 700]
    for word, scores in zip(words, model.word_scores(words)):
        assert np.allclose(scores, [exact("▁" + word, at, chances[:, k]) for k in (0, 1)], rtol=1e-9)


def test_learning_is_the_same_word_by_word(monkeypatch):
    words, counts = ["the", "nations", "a", "über", "responsibilities"], np.array([[9, 1], [5, 0], [7, 0], [0, 9], [1, 6]], float)
    want = lg.train(["a", "b"], words, counts, PATH).chances
    monkeypatch.setattr(lg, "WORD", 0)
    assert np.allclose(lg.train(["a", "b"], words, counts, PATH).chances, want, rtol=1e-9)


def test_learning_raises_the_likelihood(monkeypatch):
    words, counts = ["the", "then", "that", "der", "dem", "den"], np.array([[9, 1], [5, 0], [7, 0], [0, 9], [1, 6], [0, 7]], float)
    before = -math.inf
    for rounds in (0, 1, 3, 8):
        monkeypatch.setattr(lg, "ROUNDS", rounds)
        monkeypatch.setattr(lg, "ADDED", 1e-9)
        now = (lg.train(["a", "b"], words, counts, PATH).word_scores(words) * counts).sum()
        assert now >= before
        before = now


def test_a_full_cache_changes_nothing(monkeypatch):
    words, counts = ["the", "der"], np.array([[9.0, 1], [1, 9]])
    texts = ["the the der", "und", "x" * 5000, "the", "der der"]
    want = lg.train(["a", "b"], words, counts, PATH).predict(texts)
    monkeypatch.setattr(lg, "KEPT", 1)
    model = lg.train(["a", "b"], words, counts, PATH)
    assert [model.predict([t])[0] for t in texts] == want


def test_nulls_long_texts_clashes_and_empty_tables(spark):
    rows = [(k, "the cat and the dog of that house", "en", "x") for k in range(20)]
    rows += [(k, "der hund und die katze in dem haus", "de", "x") for k in range(20, 40)]
    rows += [(50, None, "en", "x"), (51, " 12 !!", None, "x"), (52, "und der hund " * 40_000, None, "x"), (53, "q" * 200_000, None, "x"), (1, "the cat", "en", "x"), (None, "the dog", None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    model = lg.learn(df, PATH)
    assert model.languages == ["de", "en"]
    got = lg.with_language(df, model)
    out = {r.doc_id: (r.lang_pred, r.score) for r in got.collect()}
    assert out[50] == out[51] == ("und", 0.0) and out[52][0] == "de" and out[None][0] == "en"
    assert all(out[k][0] == ("en" if k < 20 else "de") for k in range(40))
    assert all(0 <= s <= 1 for _, s in out.values()) and got.count() == len(rows)
    assert lg.with_language(df.limit(0), model).count() == 0
    nothing = lg.learn(df.limit(0), PATH)
    assert {r.lang_pred for r in lg.with_language(df, nothing).collect()} == {"und"}


def test_query_on_held_out_rows(session):
    folder = repo.SMALL.replace("0.001", "0.01")
    docs = session.read.parquet(f"{folder}/documents.parquet").where("lang is not null")
    rows = repo.queries()["op2_language_id"](session, folder).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == docs.count() and sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held) > 0
