import random
from collections import Counter

import numpy as np
import pyarrow as pa

import __spark_entry__ as repo
from tillroll.llm import lm_scoring as lm
from tillroll.llm import window_net
from tillroll.llm.window_net import SIDE, Net, Trainer


MEMBERS = 3


def plain_log(m, near, wanted):
    """The definition: the class, then the token in it."""
    hidden = np.tanh(sum(m.embed[t] @ m.into[k] for k, t in enumerate(near)) + m.into_bias)
    c, place = divmod(wanted, m.members.shape[2])
    total = 0.0
    for scores, at in ((hidden @ m.classes + m.classes_bias, c), (hidden @ m.members[c] + m.members_bias[c], place)):
        total += scores[at] - np.log(np.exp(scores).sum())
    return total


def plain_score(net, text):
    """One position at a time."""
    padded = [net.edge] * SIDE + list(text) + [net.edge] * SIDE
    return sum(plain_log(net, padded[i : i + SIDE] + padded[i + SIDE + 1 : i + 2 * SIDE + 1], w) for i, w in enumerate(text))


def some_net(n=9):
    rng = np.random.default_rng(1)
    net = Net.start(np.arange(n, dtype=float), MEMBERS)
    net.classes += rng.normal(0, 1, net.classes.shape)
    net.members += rng.normal(0, 1, net.members.shape)
    return net


def laid(texts):
    return np.concatenate([np.zeros(0, dtype=np.int64), *texts]), np.array([len(t) for t in texts], dtype=np.int64)


def test_scores_follow_the_definition(monkeypatch):
    net, rng = some_net(), np.random.default_rng(2)
    texts = [rng.integers(0, 9, n) for n in (5, 0, 1, 30)]
    for most in (4096, 7):
        monkeypatch.setattr(window_net, "SCORED", most)
        assert np.allclose(net.score(*laid(texts)), [plain_score(net, t) for t in texts], atol=1e-4)
    assert net.score(*laid([np.zeros(0, dtype=np.int64)])).tolist() == [0.0]
    assert np.isclose(sum(np.exp(plain_log(net, [0, 1, 9, 9], w)) for w in range(9)), 1)


def test_only_far_scores_are_shifted():
    """Near ones need no search for the largest of every row; far ones stay right."""
    near = np.array([[1, -2, 3], [0, 50, -59]], dtype=np.float32)
    powers, lost = window_net._powers(near.copy())
    assert lost == 0 and np.allclose(powers, np.exp(near))
    far = np.array([[1000, 999, 0], [-2000, -2001, -2000]], dtype=np.float32)
    powers, lost = window_net._powers(far.copy())
    assert lost.tolist() == [1000, -2000] and np.isfinite(powers).all()
    slopes = window_net._slopes(far.copy(), np.array([0, 2]))
    share = np.exp(far - far.max(axis=1, keepdims=True))
    share /= share.sum(axis=1, keepdims=True)
    assert np.allclose(slopes, (share - np.array([[1, 0, 0], [0, 0, 1]])) / 2, atol=1e-6)
    net, texts = some_net(), [np.array([0, 5, 8, 1, 1])]
    for part, size in ((net.classes_bias, 300), (net.members_bias, 70)):
        part += size * np.arange(part.size).reshape(part.shape)
    assert np.allclose(net.score(*laid(texts)), [plain_score(net, t) for t in texts], rtol=1e-5)


def test_a_step_moves_the_biases_of_the_net():
    """They are rows of the same table as their weights, moved at once."""
    trainer = Trainer(some_net())
    before = [p.copy() for p in trainer.net.parts()]
    trainer.step(np.array([[0, 1, 2, 9]]), np.array([4]))
    assert trainer.net.members_bias.base is trainer.net.members.base is trainer.members
    assert trainer.net.classes_bias.base is trainer.net.classes.base is trainer.classes
    assert all((p != b).any() for p, b in zip(trainer.net.parts(), before))


def test_slopes_equal_differences():
    net = some_net(6)
    shaped = lambda f: Net.shaped(f, 2, MEMBERS)
    trainer = Trainer(shaped(net.flat()))
    near, wanted = np.array([[0, 1, 2, 6], [3, 3, 1, 0], [5, 0, 0, 6]]), np.array([2, 1, 4])
    trainer.step(near, wanted)
    moved = net.flat() - trainer.net.flat()
    loss = lambda f: -np.mean([plain_log(shaped(f), n, w) for n, w in zip(near, wanted)])
    for i in np.random.default_rng(3).choice(len(moved), 150, replace=False):
        up, down = net.flat(), net.flat()
        up[i] += 1e-5
        down[i] -= 1e-5
        slope = (loss(up) - loss(down)) / 2e-5
        assert np.isclose(moved[i], 0.05 * slope / np.sqrt(1e-4 + slope**2), atol=1e-4)


def test_rounds_train_on_every_position_once(monkeypatch):
    texts, seen = [np.arange(40), np.arange(0), np.arange(40, 47), np.arange(47, 5100)], []
    trainer = Trainer(Net.start(np.ones(5100), MEMBERS))
    monkeypatch.setattr(trainer, "step", lambda near, wanted: seen.extend(wanted.tolist()))
    for turn in range(lm.ROUNDS):
        trainer.learn(*laid(texts), lm.EVERY, turn)
    assert sorted(seen) == list(range(5100))


def test_lists_are_laid_in_bounded_pieces(monkeypatch):
    monkeypatch.setattr(lm, "LAID", 10)
    lists = [[], [1] * 4, [2] * 6, [3] * 25, [], [4], [5] * 9, [6]]
    got = list(lm.laid(pa.array(lists, pa.list_(pa.int32()))))
    assert [x for flat, lengths in got for x in np.split(flat, np.cumsum(lengths)[:-1]) if len(x)] and sum(len(n) for _, n in got) == 8
    assert [n for _, lengths in got for n in lengths.tolist()] == [len(x) for x in lists]
    assert np.concatenate([f for f, _ in got]).tolist() == [x for t in lists for x in t]
    assert all(len(f) <= 10 or len(n) == 1 for f, n in got)


def odd_texts(rng, n):
    signs = ["a", "B", "c c", " ", "\t", "\x0b", "\x0c", "\r", "\n", "\x1c", "\x85", "\u2003", "É", "\x00", "𝒳"]
    return [None if rng.random() < 0.1 else "".join(rng.choice(signs) for _ in range(rng.randint(0, 9))) for _ in range(n)]


def test_words_of_slices_equal_those_of_each_text(monkeypatch):
    """Nulls, white space of all kinds, capitals, slices of arrays and both string types."""
    texts = odd_texts(random.Random(6), 3000)
    for kind in (pa.string(), pa.large_string()):
        whole = pa.array(texts, kind)
        late = whole.slice(100, 900)
        for some in (whole, late, late.cast(pa.large_string()), whole.slice(7, 0), pa.array([None, None], kind), pa.array(["", " "], kind)):
            for most in (1 << 21, 50):
                monkeypatch.setattr(lm, "SLICE_BYTES", most)
                got = list(lm.words_in(some))
                want = [lm.words_of(t) for t in some.to_pylist()]
                assert [w for words, _ in got for w in words.to_pylist()] == [w for t in want for w in t]
                assert [n for _, lengths in got for n in lengths.tolist()] == [len(t) for t in want]


def test_numbers_of_words_equal_those_of_each_text():
    texts = [*odd_texts(random.Random(7), 500), *(f"w{k} w{k % 7} rare{k}" for k in range(500))]
    for frequent in ([b"c", b"w3", b"a", "É".encode()], []):
        tokens = lm.Tokens(frequent)
        got = np.concatenate([tokens.of_words(words) for words, _ in lm.words_in(pa.array(texts, pa.string()))])
        assert got.tolist() == [k for t in texts for k in tokens.of(t).tolist()]
        assert tokens.of_words(pa.array([], pa.binary())).tolist() == []


def test_stored_numbers_come_back_as_lists():
    lists = [[], [1, 6143], [0], [], [7] * 9, [65535], []]
    made = lm.stored(np.array([x for t in lists for x in t], lm.NUMBER), np.array([len(t) for t in lists]))
    assert made.type == pa.binary() and [len(b) for b in made.to_pylist()] == [2 * len(t) for t in lists]
    for first, n in ((0, 7), (2, 4), (3, 1), (0, 1), (6, 1), (5, 0)):
        some = lm.lists_of(made.slice(first, n))
        assert some.to_pylist() == lists[first : first + n]
        assert [f.tolist() for f, _ in lm.laid(some)] == ([[x for t in lists[first : first + n] for x in t]] if n else [])
    none = lm.stored(np.zeros(0, lm.NUMBER), np.zeros(2, dtype=np.int64))
    assert lm.lists_of(none).to_pylist() == [[], []]


def test_the_stored_table_has_two_bytes_a_token(session):
    texts = ["a b A", None, "", "b é É \x0b c " * 9]
    df = session.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    tokens = lm.Tokens([b"a", b"b"])
    got = [r.x for r in lm.with_numbers(df, tokens, "text", "x").collect()]
    assert [np.frombuffer(x, lm.NUMBER).tolist() for x in got] == [tokens.of(t).tolist() for t in texts]


def test_batches_are_in_the_order_of_classes(monkeypatch):
    """Sorted many at once, each has the positions it had; a step sorts what is not in order."""
    texts = [np.random.default_rng(5).integers(0, 60, n) for n in (40, 0, 700)]
    monkeypatch.setattr(window_net, "BATCH", 50)
    for together in (2, 64):
        monkeypatch.setattr(window_net, "SORTED", together)
        trainer, got = Trainer(some_net(60)), []
        monkeypatch.setattr(trainer, "step", lambda near, wanted: got.append((near, wanted)))
        trainer.learn(*laid(texts), 2, 1)
        net = trainer.net
        row, at = net.lay(*laid(texts))
        at = np.random.default_rng(len(at[1::2]) + 1).permutation(at[1::2])
        for k, (near, wanted) in enumerate(got):
            some = at[50 * k : 50 * k + 50]
            assert (np.diff(wanted // MEMBERS) >= 0).all()
            some = some[np.argsort(row[some] // MEMBERS, kind="stable")]
            assert (wanted == row[some]).all() and (near == net.around(row, some)).all()
        assert sum(len(w) for _, w in got) == len(at)
    near, wanted = got[0]
    sorted_, mixed = Trainer(some_net(60)), Trainer(some_net(60))
    sorted_.step(near, wanted)
    turn = np.random.default_rng(8).permutation(len(wanted))
    mixed.step(near[turn], wanted[turn])
    assert np.allclose(sorted_.net.flat(), mixed.net.flat(), atol=1e-5)


def sentences(rng, n):
    """Each word tells the next and the one before."""
    ring = [f"w{k}" for k in range(30)]
    out = []
    for _ in range(n):
        at = rng.randrange(30)
        out.append(" ".join(ring[(at + k) % 30] for k in range(rng.randint(20, 60))))
    return out


def test_trained_scores_beat_frequencies_and_tell_shuffled_text(session):
    rng = random.Random(4)
    texts = sentences(rng, 1500)
    df = session.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    tokens, net = lm.learn(df)
    fresh = sentences(rng, 50)
    mixed = [" ".join(rng.sample(t.split(), len(t.split()))) for t in fresh]
    start = Net.start(np.bincount(np.concatenate([tokens.of(t) for t in texts]), minlength=tokens.size), lm.MEMBERS)
    mean = lambda m, ts: m.score(*laid([tokens.of(t) for t in ts])).sum() / sum(len(t.split()) for t in ts)
    assert mean(net, fresh) > mean(start, fresh) + 1 and mean(net, fresh) > mean(net, mixed) + 1


def test_word_counts_equal_plain_counts(session, monkeypatch):
    monkeypatch.setattr(lm, "COUNTED", 3)
    texts = ["a b A", None, "", "b é É \x0b c " * 9, "a a"]
    df = session.createDataFrame([(t,) for t in texts], "text string")
    got = {bytes(r.word): r.n for r in lm.count_words(df, "text").collect()}
    assert got == Counter(w for t in texts for w in lm.words_of(t))


def test_nulls_long_texts_repeats_clashes_and_empty_tables(spark):
    rows = [(1, None, 0), (2, " ", 0), (3, "a b c", 0), (3, "a b c", 0), (4, "a b " * 60_000, 0), (None, "c", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    model = lm.learn(df)
    got = lm.with_pseudo_likelihood(df, model)
    out = [(r.n_tokens, r.pseudo_log_likelihood, r.mean_log_likelihood) for r in got.collect()]
    assert out[0] == out[1] == (0, 0.0, None) and out[2] == out[3] and out[4][0] == 120_000
    assert all(r[1] <= 0 for r in out) and got.columns == ["doc_id", "text", "n_tokens", "pseudo_log_likelihood", "mean_log_likelihood"]
    assert lm.with_pseudo_likelihood(df.limit(0), model).count() == 0
    nothing = lm.learn(df.limit(0))
    assert lm.with_pseudo_likelihood(df, nothing).count() == len(rows)


def test_query_scores_equal_a_plain_recomputation(session, monkeypatch):
    """Every document's tokens and, with the learned net, its score by the definition."""
    kept = {}
    trained = lm.train
    monkeypatch.setattr(lm, "train", lambda *a: kept.setdefault("net", trained(*a)))
    rows = repo.queries()["op4_masked_pseudo_likelihood"](session, repo.SMALL).collect()
    docs = session.read.parquet(f"{repo.SMALL}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert {r.doc_id: r.n_tokens for r in rows} == {k: len(lm.words_of(t)) for k, t in texts.items()}
    tokens, _ = lm.learn_tokens(docs, "text")
    counts = Counter(w for t in texts.values() for w in lm.words_of(t))
    assert tokens.frequent == sorted(counts, key=lambda w: (-counts[w], w))[: lm.WORDS]
    for r in rows:
        if r.n_tokens < 400:
            want = plain_score(kept["net"], tokens.of(texts[r.doc_id]).tolist())
            assert abs(r.pseudo_log_likelihood - want) <= 1e-4 * max(abs(want), 1)
